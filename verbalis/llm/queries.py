"""The operators over the given tables, and equal SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbalis.llm import bagminhash, bpe, embeddings, exact, linededup, merkle, mixing, negatives, packing, ppm, quality, quoting, warc
from verbalis.llm.common import space_of, table, whole_text

#: Tokens of a packed sequence, the tokenizer of its ids, and the id behind every document.
SEQUENCE, TOKENIZER, END_ID = 2048, "byte_bpe_50k.json", 0


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.ppm_scores(table(spark, sf_dir, "documents"), space_of(spark))


def op2_bagminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_copies(table(spark, sf_dir, "documents"), space_of(spark))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_copies(table(spark, sf_dir, "documents"), space_of(spark))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), space_of(spark)
    )


def op5_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quoting.reply_ordered(table(spark, sf_dir, "conversations"), space_of(spark))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), space_of(spark))
    kept = F.when(F.col("n_dropped") == 0, whole_text("text")).otherwise(
        linededup.kept_text(F.col("text"), F.col("keep_runs"))
    )
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(kept, 256).alias("kept_sha256"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, space_of(spark), tokenizer_path(), SEQUENCE, END_ID)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    member, size = F.array("source"), mixing.words_in("text")
    mix = mixing.solve_mix(docs, space_of(spark), member, size)
    taken = mixing.times_taken(docs, mix, member).withColumn("size", size)
    rows = [(s, n, t) for s, n, t in zip(mix.sources, mix.sizes, mix.targets)]
    sources = spark.createDataFrame(rows, "name string, source_size long, target double")
    joined = taken.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("name")))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times_taken")).alias("taken"))


def op9_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.archived(pages, space_of(spark)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), space_of(spark))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle.manifest(table(spark, sf_dir, "documents"), space_of(spark))
    sibling = F.transform("path", lambda x: F.concat(x["left"], x["right"]))
    return out.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join(sibling, ""), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows, space_of(spark), F.col("vec_id") % 100 == 0, label)


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    automaton = bpe.MergeAutomaton.compiled(tokenizer_path())
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = bpe.decoded(bpe.encoded(docs, automaton), automaton)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ppm_scores,
        op2_bagminhash_dedup,
        op3_exact_dedup,
        op4_quality,
        op5_quote_links,
        op6_line_dedup,
        op7_best_fit_packing,
        op8_source_mix,
        op9_warc_normaliser,
        op10_embedding_dedup,
        op11_merkle_manifest,
        op12_hard_negatives,
        op13_bpe,
    )
}

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES: dict[str, str] = {
    "op3_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        )
        SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
            doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
        FROM texts""",
    "op6_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ), keyed AS (
            SELECT *, translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM lines
        ), repeated AS (
            SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
        ), marked AS (
            SELECT doc_id, line, pos, last IS NOT NULL AND doc_id <> last AS lost FROM keyed LEFT JOIN repeated USING (k)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op11_merkle_manifest": """
        WITH RECURSIVE rows_ AS (
            SELECT doc_id, coalesce('=' || lang, '') AS g, text,
                coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
            FROM documents
        ), leaves AS (
            SELECT doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS changed,
                row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos
            FROM rows_
        ), up AS (
            SELECT g, 0 AS lvl, pos, leaf AS node, count(*) OVER (PARTITION BY g) AS n FROM leaves
            UNION ALL
            SELECT g, lvl, pos, node, count(*) OVER (PARTITION BY g) AS n FROM (
                SELECT g, max(lvl) + 1 AS lvl, pos // 8 AS pos, sha256(string_agg(node, '' ORDER BY pos)) AS node
                FROM up WHERE n > 1 GROUP BY g, pos // 8)
        ), subroots AS (
            SELECT g, node AS subroot, lvl AS height, row_number() OVER (ORDER BY g) - 1 AS pos FROM up WHERE n = 1
        ), over_ AS (
            SELECT 0 AS lvl, pos, subroot AS node, count(*) OVER () AS n FROM subroots
            UNION ALL
            SELECT lvl, pos, node, count(*) OVER () AS n FROM (
                SELECT max(lvl) + 1 AS lvl, pos // 8 AS pos, sha256(string_agg(node, '' ORDER BY pos)) AS node
                FROM over_ WHERE n > 1 GROUP BY pos // 8)
        ), steps AS (
            SELECT l.doc_id, u.lvl, u.pos, l.pos // (8 ** u.lvl)::BIGINT AS own, u.node
            FROM leaves l JOIN up u ON u.g = l.g AND u.n > 1 AND u.pos // 8 = l.pos // (8 ** (u.lvl + 1))::BIGINT
            UNION ALL
            SELECT l.doc_id, s.height + o.lvl, o.pos, s.pos // (8 ** o.lvl)::BIGINT, o.node
            FROM leaves l JOIN subroots s USING (g) JOIN over_ o ON o.n > 1 AND o.pos // 8 = s.pos // (8 ** (o.lvl + 1))::BIGINT
        ), pairs AS (
            SELECT doc_id, lvl, coalesce(string_agg(node, '' ORDER BY pos) FILTER (pos < own), '') AS l,
                coalesce(string_agg(node, '' ORDER BY pos) FILTER (pos > own), '') AS r
            FROM steps GROUP BY doc_id, lvl
        ), crc_table AS (
            SELECT i, list_reduce([i::UINTEGER, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UINTEGER) ELSE c >> 1 END) AS c FROM range(256) t(i)
        ), entries AS (SELECT list(c ORDER BY i) AS t FROM crc_table
        ), crc AS (
            SELECT doc_id, xor(list_reduce(list_prepend(4294967295::UINTEGER, list_transform(string_split(doc_id::VARCHAR, ''),
                lambda x: ascii(x)::UINTEGER)), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295::UINTEGER) AS crc
            FROM documents, entries
        ), folded AS (
            SELECT doc_id, 0 AS lvl, CASE WHEN crc % 3 = 0 THEN changed ELSE leaf END AS now FROM leaves JOIN crc USING (doc_id)
            UNION ALL
            SELECT f.doc_id, f.lvl + 1, sha256(p.l || f.now || p.r) FROM folded f JOIN pairs p ON p.doc_id = f.doc_id AND p.lvl = f.lvl
        ), proofs AS (SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY lvl)) AS proof_sha256 FROM pairs GROUP BY doc_id
        ), ends AS (SELECT doc_id, arg_max(now, lvl) AS folded_root FROM folded GROUP BY doc_id)
        SELECT doc_id, leaf, subroot, o.node AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
            folded_root = o.node AS verified
        FROM leaves JOIN subroots USING (g) JOIN ends USING (doc_id) LEFT JOIN proofs USING (doc_id), over_ o WHERE o.n = 1""",
    "op12_hard_negatives": """
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
            FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id,
            (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
            vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scores USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10""",
    "op9_warc_normaliser": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
                max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
            FROM pages
        )
        SELECT page_id, strlen(html) AS payload_bytes,
            list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(hex, (i // 4 * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)),
                'string_agg', '') AS payload_digest,
            CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> last THEN last END AS refers_to
        FROM payloads""",
}
