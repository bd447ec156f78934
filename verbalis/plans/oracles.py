"""SQL that computes the queries' results independently, for the check against another engine.

Statements are put together from named common table expressions; a statement takes those it mentions.
"""

from __future__ import annotations

import re

from verbalis.functions.lexicons import (
    DEFAULT_TAG,
    LEMMA_RULES,
    SEED_EXCEPTIONS,
    SEED_POS,
    SEED_SENTIMENT,
    STOP_WORDS,
    SUFFIX_TAGS,
)
from verbalis.operators.rowstats import ALL_FEATURES, TAG_FEATURES
from verbalis.plans.data import DICTIONARY_MIN_DOCS

TABLES: dict[str, str] = {}
ORACLES: dict[str, str] = {}


def _literal(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def _values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) t({columns})"


def _needs(sql: str) -> list[str]:
    found: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in found and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(TABLES[name])
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def oracle(name: str, sql: str) -> None:
    needed = _needs(sql)
    head = ", ".join(f"{n} AS MATERIALIZED ({TABLES[n]})" for n in needed)
    ORACLES[name] = (f"WITH {head} " if needed else "") + sql


STOPS = "(" + ", ".join(_literal(w) for w in STOP_WORDS) + ")"


def _split(text: str) -> str:
    return rf"list_filter(regexp_extract_all({text}, '[\p{{L}}\p{{N}}_]+'), lambda w: NOT contains(w, '_'))"


def _unstopped(words: str) -> str:
    return f"list_filter({words}, lambda w: w NOT IN {STOPS})"


def _exploded(source: str, words: str, extra: str = "") -> str:
    return (
        f"SELECT doc_id{extra}, CAST(unnest(range(len(words))) AS INTEGER) AS pos, unnest(words) AS word "
        f"FROM (SELECT doc_id{extra}, {words} AS words FROM {source})"
    )


T = TABLES
T["lab"] = "SELECT d.doc_id, d.text, CAST(l.quality AS VARCHAR) AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
T["dictionary"] = (
    rf"SELECT word FROM (SELECT DISTINCT doc_id, unnest({_split('lower(text)')}) AS word FROM documents WHERE lang = 'en') "
    rf"WHERE regexp_matches(word, '^\p{{L}}+$') GROUP BY word HAVING count(*) >= {DICTIONARY_MIN_DOCS}"
)
T["pos_lexicon"] = _values(SEED_POS, "word, tag")
T["exception_list"] = _values(SEED_EXCEPTIONS, "word, tag, lemma")
T["sentiment_lexicon"] = "SELECT word, CAST(p AS DOUBLE) AS polarity, CAST(s AS DOUBLE) AS subjectivity FROM (" + _values(SEED_SENTIMENT, "word, p, s") + ")"
T["detachment"] = _values([(i, *r) for i, r in enumerate(LEMMA_RULES, 1)], "rule, tag, suffix, replacement")
RECORD = f"list_transform({_unstopped(_split('text'))}, lambda w: lower(w))"
CORPUS = _unstopped(_split("lower(text)"))
T["tok"] = _exploded("documents", RECORD)
T["ltok"] = _exploded("lab", RECORD)
T["ctok"] = _exploded("documents", CORPUS)
T["lctok"] = _exploded("lab", CORPUS)
CASES = " ".join(f"WHEN ends_with(word, '{s}') THEN '{t}'" for s, t in SUFFIX_TAGS)
for pre, source in (("", "tok"), ("l", "ltok")):
    T[f"{pre}vw"] = f"SELECT DISTINCT word FROM {source}"
    T[f"{pre}good"] = (
        rf"SELECT word FROM {pre}vw WHERE regexp_matches(word, '^\p{{L}}+$') AND word IN (SELECT word FROM dictionary) "
        f"AND word NOT IN {STOPS}"
    )
    T[f"{pre}tags"] = (
        f"SELECT v.word, coalesce(p.tag, CASE {CASES.replace('(word', '(v.word')} ELSE '{DEFAULT_TAG}' END) AS tag "
        f"FROM {pre}vw v LEFT JOIN pos_lexicon p ON v.word = p.word"
    )
    T[f"{pre}cands"] = (
        f"SELECT word, tag, word AS candidate, 0 AS rule FROM {pre}tags UNION ALL "
        "SELECT t.word, t.tag, left(t.word, length(t.word) - length(r.suffix)) || r.replacement, r.rule "
        f"FROM {pre}tags t JOIN detachment r ON r.tag = (CASE WHEN t.tag = 'o' THEN 'n' ELSE t.tag END) "
        "AND ends_with(t.word, r.suffix)"
    )
    T[f"{pre}lem"] = (
        f"SELECT t.word, t.tag, coalesce(e.lemma, k.candidate, t.word) AS lemma FROM {pre}tags t "
        "LEFT JOIN exception_list e ON e.word = t.word AND e.tag = (CASE WHEN t.tag = 'o' THEN 'n' ELSE t.tag END) "
        "LEFT JOIN (SELECT word, candidate FROM (SELECT *, row_number() OVER (PARTITION BY word "
        f"ORDER BY length(candidate), rule, candidate) AS r FROM {pre}cands WHERE candidate IN (SELECT word FROM dictionary)) "
        "WHERE r = 1) k ON k.word = t.word"
    )
    T[f"{pre}lt"] = (
        f"SELECT s.doc_id, s.pos, s.word, m.tag, m.lemma FROM {source} s JOIN {pre}good g ON s.word = g.word "
        f"JOIN {pre}lem m ON s.word = m.word"
    )
for pre, source in (("", "ctok"), ("l", "lctok")):
    w = "OVER (PARTITION BY doc_id ORDER BY pos)"
    T[f"{pre}grams"] = (
        f"SELECT doc_id, word AS w1, lead(word, 1) {w} AS w2, lead(word, 2) {w} AS w3 FROM {source}"
    )
    T[f"{pre}uni"] = f"SELECT word, count(*) AS n FROM {source} GROUP BY word"
    T[f"{pre}tot"] = f"SELECT CAST(sum(n) AS DOUBLE) AS t FROM {pre}uni"
    T[f"{pre}bif"] = f"SELECT w1, w2, count(*) AS n FROM {pre}grams WHERE w2 IS NOT NULL GROUP BY w1, w2"
    T[f"{pre}trif"] = f"SELECT w1, w2, w3, count(*) AS n FROM {pre}grams WHERE w3 IS NOT NULL GROUP BY w1, w2, w3"
    T[f"{pre}skipf"] = f"SELECT w1, w3, count(*) AS n FROM {pre}grams WHERE w3 IS NOT NULL GROUP BY w1, w3"
    T[f"{pre}bicells"] = (
        "SELECT w1, w2, b.n AS n12, a.n AS n1, c.n AS n2, CAST(b.n AS DOUBLE) AS o11, CAST(a.n - b.n AS DOUBLE) AS o12, "
        f"CAST(c.n - b.n AS DOUBLE) AS o21, t - a.n - c.n + b.n AS o22, t FROM {pre}bif b JOIN {pre}uni a ON a.word = w1 "
        f"JOIN {pre}uni c ON c.word = w2 CROSS JOIN {pre}tot WHERE b.n >= 20"
    )
    G = lambda o, e: f"(CASE WHEN {o} > 0 THEN {o} * ln({o} / ({e})) ELSE 0 END)"
    T[f"{pre}biscore"] = (
        "SELECT w1, w2, n12, n1, n2, round(2 * ("
        + " + ".join(
            G(o, f"({r}) * ({c}) / t")
            for o, r, c in (
                ("o11", "o11 + o12", "o11 + o21"),
                ("o12", "o11 + o12", "o12 + o22"),
                ("o21", "o21 + o22", "o11 + o21"),
                ("o22", "o21 + o22", "o12 + o22"),
            )
        )
        + f"), 4) AS score FROM {pre}bicells"
    )
    T[f"{pre}tricells"] = (
        "SELECT x.w1, x.w2, x.w3, x.n AS n123, CAST(x.n AS DOUBLE) AS c111, "
        "CAST(ab.n - x.n AS DOUBLE) AS c110, CAST(ac.n - x.n AS DOUBLE) AS c101, CAST(bc.n - x.n AS DOUBLE) AS c011, "
        "CAST(a.n - ab.n - ac.n + x.n AS DOUBLE) AS c100, CAST(b.n - ab.n - bc.n + x.n AS DOUBLE) AS c010, "
        "CAST(c.n - ac.n - bc.n + x.n AS DOUBLE) AS c001, t - a.n - b.n - c.n + ab.n + ac.n + bc.n - x.n AS c000, "
        f"a.n AS na, b.n AS nb, c.n AS nc, t FROM {pre}trif x JOIN {pre}bif ab ON ab.w1 = x.w1 AND ab.w2 = x.w2 "
        f"JOIN {pre}bif bc ON bc.w1 = x.w2 AND bc.w2 = x.w3 JOIN {pre}skipf ac ON ac.w1 = x.w1 AND ac.w3 = x.w3 "
        f"JOIN {pre}uni a ON a.word = x.w1 JOIN {pre}uni b ON b.word = x.w2 JOIN {pre}uni c ON c.word = x.w3 CROSS JOIN {pre}tot "
        "WHERE x.n >= 10"
    )
    SIDE = {"1": "{0}", "0": "(t - {0})"}
    T[f"{pre}triscore"] = (
        "SELECT w1, w2, w3, n123, round(2 * ("
        + " + ".join(
            G(f"c{a}{b}{c}", f"{SIDE[a].format('na')} * {SIDE[b].format('nb')} * {SIDE[c].format('nc')} / (t * t)")
            for a in "10"
            for b in "10"
            for c in "10"
        )
        + f"), 4) AS score FROM {pre}tricells"
    )
    GOOD = (
        rf"(SELECT word FROM {pre}uni WHERE regexp_matches(word, '^\p{{L}}+$') AND word IN (SELECT word FROM dictionary) "
        f"AND word NOT IN {STOPS})"
    )
    T[f"{pre}bicol"] = (
        f"SELECT w1 || ' ' || w2 AS term, w1, w2, score FROM {pre}biscore WHERE w1 IN {GOOD} AND w2 IN {GOOD} "
        "ORDER BY score DESC, w1, w2 LIMIT 300"
    )
    T[f"{pre}tricol"] = (
        f"SELECT w1 || ' ' || w2 || ' ' || w3 AS term, score FROM {pre}triscore WHERE w1 IN {GOOD} AND w2 IN {GOOD} "
        f"AND w3 IN {GOOD} ORDER BY score DESC, w1, w2, w3 LIMIT 200"
    )
T["anybi"] = "SELECT w1 || ' ' || w2 AS term, w1, w2 FROM biscore ORDER BY score DESC, w1, w2 LIMIT 300"
T["anytri"] = "SELECT w1, w2, w3 FROM triscore ORDER BY score DESC, w1, w2, w3 LIMIT 200"
for pre in ("", "l"):
    T[f"{pre}lemvocab"] = (
        f"SELECT lemma AS term, count(DISTINCT doc_id) AS df FROM {pre}lt WHERE length(lemma) >= 3 GROUP BY lemma "
        "HAVING count(DISTINCT doc_id) >= 20"
    )

# ---- sources and records
oracle("read_csv_project", "SELECT text, lang AS label FROM documents")
oracle("write_rows", "SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conversations")
oracle("read_labelled_parquet", "SELECT doc_id, text, source AS label FROM documents")
oracle(
    "labelled_records",
    "SELECT d.doc_id, coalesce(text, '') AS text, CAST(quality AS VARCHAR) AS label FROM documents d "
    "LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL",
)
T["turns"] = "SELECT conv_id || '-' || turn AS doc_id, text, role AS label FROM conversations"
oracle("rare_class_filter", "SELECT * FROM turns WHERE label IN (SELECT label FROM turns GROUP BY label HAVING count(*) >= 50)")
oracle("class_counts", "SELECT label, count(*) AS n FROM turns GROUP BY label")

# ---- sampling
T["bylang"] = "SELECT doc_id, lang AS label FROM documents"
T["hashed"] = "SELECT *, md5('5:' || doc_id) AS h FROM bylang"


def _stratified(source: str, wanted: str) -> str:
    """``doc_id, label, split`` with the wanted number of test rows."""
    return (
        "SELECT doc_id, label, CASE WHEN r <= n - base - extra THEN 'test' ELSE 'train' END AS split FROM "
        f"(SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, doc_id) AS r FROM {source}) JOIN "
        "(SELECT *, CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= train - sum(base) OVER () THEN 1 ELSE 0 END AS extra "
        "FROM (SELECT label, n, train, CAST(n AS HUGEINT) * train // total AS base, CAST(n AS HUGEINT) * train % total AS rest "
        f"FROM (SELECT label, n, total, total - {wanted} AS train FROM (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total "
        f"FROM {source} GROUP BY label)))) USING (label)"
    )


T["strat"] = _stratified("hashed", "CAST(ceil(0.2 * total) AS BIGINT)")
T["trainside"] = "SELECT hashed.* FROM hashed JOIN strat USING (doc_id) WHERE split = 'train'"
oracle(
    "subsample_stratified",
    "SELECT doc_id, label FROM (" + _stratified("hashed", "CAST(round_even(0.05 * total, 0) AS BIGINT)") + ") WHERE split = 'test'",
)
oracle("subsample_random", "SELECT doc_id, label FROM hashed ORDER BY h, doc_id LIMIT 77")
oracle("split_stratified", "SELECT * FROM strat")
oracle(
    "split_random",
    "SELECT doc_id, label, CASE WHEN row_number() OVER (ORDER BY h, doc_id) <= ceil(0.2 * count(*) OVER ()) THEN 'test' "
    "ELSE 'train' END AS split FROM hashed",
)
oracle(
    "split_class_shares",
    "SELECT label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM strat WHERE split = 'test' GROUP BY label",
)
oracle("capped_pool", "SELECT doc_id, label FROM (" + _stratified("trainside", "least(300, total)") + ") WHERE split = 'test'")
T["folded"] = (
    "SELECT doc_id, label, (SELECT CAST(min(i) AS INTEGER) FROM (SELECT label AS l, i, sum(c) OVER (PARTITION BY label ORDER BY i) AS upto "
    "FROM (SELECT label, i, count(*) FILTER (WHERE p % 5 = i) AS c FROM (SELECT label, row_number() OVER (ORDER BY label, doc_id) - 1 AS p "
    "FROM hashed), range(5) t(i) GROUP BY label, i)) a WHERE a.l = x.label AND x.r < a.upto) AS fold FROM "
    "(SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, doc_id) - 1 AS r FROM hashed) x"
)
oracle("kfold_assign", "SELECT * FROM folded")

# ---- cleaning
oracle("tokens", "SELECT * FROM tok")
oracle(
    "stop_words_removed",
    f"SELECT doc_id, len({_split('text')}) AS tokens, len({_unstopped(_split('text'))}) AS kept_raw_case, "
    f"len({CORPUS}) AS kept_lower FROM documents",
)
oracle("alpha_words", r"SELECT word FROM vw WHERE regexp_matches(word, '^\p{L}+$')")
oracle(
    "word_classes",
    r"SELECT word, regexp_matches(word, '^\p{L}+$') AS alpha, regexp_matches(word, '^\p{N}+$') AS number, "
    r"regexp_matches(word, '^[\p{L}\p{N}]+$') AS alphanumeric FROM vw",
)
oracle("dictionary_words", "SELECT word FROM vw WHERE word IN (SELECT word FROM dictionary)")
oracle(
    "proper_noun_words",
    f"SELECT word FROM vw WHERE word IN (SELECT unnest({_split('lower(text)')}) FROM benchmark) AND word NOT IN (SELECT word FROM good)",
)
oracle(
    "junk_filter",
    "SELECT word, 'lemmas' AS profile FROM good UNION ALL "
    rf"SELECT word, 'no_dictionary' FROM vw WHERE regexp_matches(word, '^\p{{L}}+$') AND word NOT IN {STOPS} UNION ALL "
    r"SELECT word, 'with_numbers' FROM vw WHERE word IN (SELECT word FROM good) OR regexp_matches(word, '^\p{N}+$')",
)
oracle("excluded_words", "SELECT word FROM vw WHERE word NOT IN (SELECT word FROM good)")
oracle("good_tokens", "SELECT * FROM tok WHERE word IN (SELECT word FROM good)")
oracle("pos_tags", "SELECT * FROM tags")
oracle("lemmas", "SELECT * FROM lem")
oracle("lemma_tokens", "SELECT * FROM lt")
PHRASES = (
    "SELECT d.doc_id, coalesce(p, '') AS lemma_phrase FROM documents d LEFT JOIN "
    "(SELECT doc_id, string_agg(lemma, ' ' ORDER BY pos) AS p FROM lt GROUP BY doc_id) x ON d.doc_id = x.doc_id"
)
oracle("lemma_phrases", PHRASES)
oracle("lemma_phrases_joined", PHRASES)
TRIMMED = r"regexp_replace(text, '[ \t\n\r\f]+$', '')"
SENTENCES = (
    rf"CAST(len(regexp_extract_all({TRIMMED}, '[.!?]+([ \t\n\r\f]|$)')) + CASE WHEN length({TRIMMED}) > 0 AND NOT "
    rf"regexp_matches({TRIMMED}, '[.!?]$') THEN 1 ELSE 0 END AS BIGINT)"
)
oracle("sentence_counts", f"SELECT doc_id, {SENTENCES} AS sentences FROM documents")

# ---- corpus statistics
SPACE = r"[\p{Z}\t\n\x0B\f\r\x1c-\x1f\x{85}]+"


def _text_words(source: str) -> str:
    return f"SELECT DISTINCT word FROM (SELECT unnest(regexp_split_to_array(lower(text), '{SPACE}')) AS word FROM {source}) WHERE word <> ''"


oracle("distinct_words", _text_words("documents"))
oracle("distinct_bigrams", "SELECT w1, w2 FROM bif")
oracle("distinct_trigrams", "SELECT w1, w2, w3 FROM trif")
oracle("word_freq", "SELECT * FROM uni")
oracle("bigram_freq", "SELECT * FROM bif")
oracle("trigram_freq", "SELECT * FROM trif")
oracle("skipgram_freq", "SELECT * FROM skipf")
oracle("bigram_collocations", "SELECT term, score FROM bicol")
oracle("trigram_collocations", "SELECT term, score FROM tricol")
oracle("bigram_scores", "SELECT * FROM biscore")
oracle("trigram_scores", "SELECT * FROM triscore")
oracle("lemma_vocab", "SELECT * FROM lemvocab")
oracle("redundant_lemmas", "SELECT term FROM lemvocab WHERE term IN (SELECT w1 FROM anybi UNION SELECT w2 FROM anybi)")
oracle(
    "redundant_bigrams",
    "SELECT term FROM anybi b WHERE NOT EXISTS (SELECT 1 FROM anytri t WHERE (t.w1 = b.w1 AND t.w2 = b.w2) OR "
    "(t.w2 = b.w1 AND t.w3 = b.w2))",
)
T["vocab"] = (
    "SELECT row_number() OVER (ORDER BY k, term) - 1 AS term_id, term, kind FROM (SELECT 0 AS k, term, 'lemma' AS kind FROM llemvocab "
    "UNION ALL SELECT 1, term, 'bigram' FROM lbicol UNION ALL SELECT 2, term, 'trigram' FROM ltricol)"
)
oracle("term_vocab", "SELECT * FROM vocab")
oracle(
    "corpus_counts",
    f"SELECT (SELECT count(*) FROM ({_text_words('lab')})) AS words_count, count(*) FILTER (WHERE kind = 'lemma') AS lemma_count, "
    "count(*) FILTER (WHERE kind = 'bigram') AS bigram_collocation_count, "
    "count(*) FILTER (WHERE kind = 'trigram') AS trigram_collocation_count, count(*) AS term_count FROM vocab",
)

# ---- record statistics
for pre, source in (("", "documents"), ("l", "lab")):
    tok, tags = f"{pre}tok", f"{pre}tags"
    T[f"{pre}wstats"] = (
        "SELECT d.doc_id, CAST(coalesce(n, 0) AS DOUBLE) AS meta__words_count, CAST(s AS DOUBLE) AS meta__sentence_count, "
        "coalesce(chars / n, 0.0) AS meta__avg_word_length, coalesce(CASE WHEN s > 0 THEN n / s END, 0.0) AS meta__avg_sentence_length, "
        f"coalesce(u / n, 0.0) AS meta__lexical_diversity FROM (SELECT doc_id, {SENTENCES} AS s FROM {source}) d LEFT JOIN "
        f"(SELECT doc_id, count(*) AS n, sum(length(word)) AS chars, count(DISTINCT word) AS u FROM {tok} GROUP BY doc_id) w "
        "ON d.doc_id = w.doc_id"
    )
    T[f"{pre}tstats"] = (
        "SELECT d.doc_id, "
        + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in TAG_FEATURES.values())
        + f" FROM {source} d LEFT JOIN (SELECT doc_id, "
        + ", ".join(f"avg(CASE WHEN tag = '{t}' THEN 1.0 ELSE 0.0 END) AS {c}" for t, c in TAG_FEATURES.items())
        + f" FROM {tok} s JOIN {tags} g ON s.word = g.word GROUP BY doc_id) x ON d.doc_id = x.doc_id"
    )
    T[f"{pre}sstats"] = (
        "SELECT d.doc_id, coalesce(p, 0.0) AS eng__polarity_avg, coalesce(s, 0.0) AS eng__subjectivity_avg "
        f"FROM {source} d LEFT JOIN (SELECT doc_id, avg(polarity) AS p, avg(subjectivity) AS s FROM {tok} t "
        "JOIN sentiment_lexicon x ON t.word = x.word GROUP BY doc_id) y ON d.doc_id = y.doc_id"
    )
    T[f"{pre}rowstats"] = (
        "SELECT a.doc_id, "
        + ", ".join(ALL_FEATURES)
        + f" FROM {pre}wstats a JOIN {pre}tstats b ON a.doc_id = b.doc_id JOIN {pre}sstats c ON a.doc_id = c.doc_id"
    )


def _rounded(names, digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)


WORD_STATS = [f for f in ALL_FEATURES if f in T["wstats"]]
oracle("row_word_stats", f"SELECT doc_id, {_rounded(WORD_STATS)} FROM wstats")
oracle("row_pos_ratios", f"SELECT doc_id, {_rounded(TAG_FEATURES.values())} FROM tstats")
oracle("row_sentiment", f"SELECT doc_id, {_rounded(['eng__polarity_avg', 'eng__subjectivity_avg'])} FROM sstats")
oracle("row_features", f"SELECT doc_id, {_rounded(ALL_FEATURES)} FROM rowstats")

# ---- vectors
T["gtok"] = (
    "SELECT doc_id, unnest(range(len(words))) AS pos, unnest(words) AS word FROM "
    r"(SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}_]{2,}') AS words FROM lab)"
)
T["occurrences"] = (
    "SELECT doc_id, 'lemma' AS kind, lemma AS term FROM llt UNION ALL "
    "SELECT doc_id, 'bigram', word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY pos) FROM gtok UNION ALL "
    "SELECT doc_id, 'trigram', word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY pos) || ' ' || "
    "lead(word, 2) OVER (PARTITION BY doc_id ORDER BY pos) FROM gtok"
)
T["tf"] = (
    "SELECT doc_id, v.kind, term_id, count(*) AS tf FROM occurrences o JOIN vocab v ON o.kind = v.kind AND o.term = v.term "
    "GROUP BY doc_id, v.kind, term_id"
)
for name, kind in (("unigrams", "lemma"), ("bigrams", "bigram"), ("trigrams", "trigram")):
    oracle(f"count_{name}", f"SELECT doc_id, term_id, tf FROM tf WHERE kind = '{kind}'")
oracle("presence", "SELECT doc_id, term_id, least(tf, 1) AS tf FROM tf")
T["idfs"] = (
    "SELECT v.term_id, count(tf.doc_id) AS df, ln((1.0 + (SELECT count(*) FROM lab)) / (1.0 + count(tf.doc_id))) + 1.0 AS idf "
    "FROM vocab v LEFT JOIN tf ON v.term_id = tf.term_id GROUP BY v.term_id"
)
oracle("idf", "SELECT term_id, df, round(idf, 6) AS idf FROM idfs")
T["weights"] = "SELECT doc_id, tf.term_id, tf * idf AS value FROM tf JOIN idfs ON tf.term_id = idfs.term_id"
oracle("tfidf", "SELECT doc_id, term_id, round(value, 6) AS value FROM weights")
T["unit"] = "SELECT doc_id, term_id, value / sqrt(sum(value * value) OVER (PARTITION BY doc_id)) AS value FROM weights"
oracle("tfidf_l2", "SELECT doc_id, term_id, round(value, 6) AS value FROM unit")
T["scaled"] = (
    "SELECT doc_id, name, CASE WHEN hi = lo THEN 0.0 ELSE (value - lo) / (hi - lo) END AS value FROM (SELECT *, "
    "max(value) OVER (PARTITION BY name) AS hi, min(value) OVER (PARTITION BY name) AS lo FROM ("
    + " UNION ALL ".join(f"SELECT doc_id, '{n}' AS name, {i} AS place, {n} AS value FROM lrowstats" for i, n in enumerate(ALL_FEATURES))
    + "))"
)
oracle("minmax_meta", "SELECT doc_id, name, round(value, 6) AS value FROM scaled")
T["statids"] = (
    "SELECT name, (SELECT count(*) FROM vocab) + place AS term_id FROM ("
    + _values(list(enumerate(ALL_FEATURES)), "place, name")
    + ")"
)
T["feats"] = (
    "SELECT x.doc_id, label, term_id, value FROM (SELECT * FROM unit UNION ALL SELECT doc_id, term_id, value FROM scaled "
    "JOIN statids USING (name)) x JOIN lab USING (doc_id) WHERE value <> 0"
)
oracle("feature_table", "SELECT doc_id, label, term_id, round(value, 6) AS value FROM feats")

# ---- feature scores, with every (feature, class) cell spelled out
T["csize"] = "SELECT label, count(*) AS n, sum(count(*)) OVER () AS total, count(*) OVER () AS k FROM lab GROUP BY label"
T["cells"] = (
    "SELECT f.term_id, c.label, c.n, c.total, c.k, coalesce(sum(value), 0) AS s, coalesce(sum(value * value), 0) AS q "
    "FROM (SELECT DISTINCT term_id FROM feats) f CROSS JOIN csize c LEFT JOIN feats x ON x.term_id = f.term_id AND x.label = c.label "
    "GROUP BY f.term_id, c.label, c.n, c.total, c.k"
)
T["chi"] = (
    "SELECT term_id, sum((s - e) * (s - e) / e) AS score FROM (SELECT term_id, s, n / total * sum(s) OVER (PARTITION BY term_id) AS e "
    "FROM cells) GROUP BY term_id"
)
oracle("chi2_scores", "SELECT term_id, round(score, 6) AS score FROM chi")
oracle(
    "f_scores",
    "SELECT term_id, CASE WHEN ssw > 1e-12 THEN round((ssb / (k - 1)) / (ssw / (total - k)), 4) WHEN ssb > 1e-12 THEN 'inf'::DOUBLE END AS score "
    "FROM (SELECT term_id, any_value(k) AS k, any_value(total) AS total, sum(n * (s / n - m) * (s / n - m)) AS ssb, sum(q - s * s / n) AS ssw "
    "FROM (SELECT *, sum(s) OVER (PARTITION BY term_id) / total AS m FROM cells) GROUP BY term_id)",
)
T["binned"] = (
    "SELECT f.term_id, l.label, coalesce(CASE WHEN f.term_id < (SELECT count(*) FROM vocab) THEN CASE WHEN value > 0 THEN 1 ELSE 0 END "
    "WHEN value IS NULL THEN 0 ELSE least(floor(round(value * 10, 6)), 9) END, 0) AS bin FROM (SELECT DISTINCT term_id FROM feats) f CROSS JOIN lab l "
    "LEFT JOIN feats x ON x.term_id = f.term_id AND x.doc_id = l.doc_id"
)
T["joint"] = "SELECT term_id, label, bin, count(*) AS j FROM binned GROUP BY term_id, label, bin"
oracle(
    "mi_scores",
    "SELECT term_id, round(sum(j / total * ln(j * total / (b * n))), 6) AS score FROM (SELECT jt.term_id, j, "
    "sum(j) OVER (PARTITION BY jt.term_id, bin) AS b, c.n, c.total FROM joint jt JOIN csize c ON c.label = jt.label) "
    "WHERE term_id IN (SELECT term_id FROM joint WHERE bin > 0) GROUP BY term_id",
)
T["catalog"] = "SELECT term_id, term AS name FROM vocab UNION ALL SELECT term_id, name FROM statids"
T["chosen"] = (
    "SELECT term_id, name, row_number() OVER (ORDER BY term_id) - 1 AS feature FROM (SELECT c.term_id, c.name FROM catalog c "
    "LEFT JOIN chi ON chi.term_id = c.term_id ORDER BY round(chi.score, 6) DESC NULLS LAST, c.term_id DESC "
    "LIMIT (SELECT greatest(1, CAST(floor(count(*) * 0.1) AS BIGINT)) FROM catalog))"
)
oracle("select_k_best", "SELECT * FROM chosen")
T["kept"] = "SELECT doc_id, feature, value FROM feats JOIN chosen USING (term_id)"
oracle("selected_values", "SELECT doc_id, feature, round(value, 6) AS value FROM kept")
oracle("drop_zero_vectors", "SELECT doc_id FROM kept GROUP BY doc_id HAVING sum(value * value) > 0")
oracle("renormalised", "SELECT doc_id, feature, round(value / sqrt(sum(value * value) OVER (PARTITION BY doc_id)), 6) AS value FROM kept")
oracle(
    "selection_summary",
    "SELECT 'features_count' AS metric, (SELECT count(*) FROM catalog) AS value UNION ALL "
    "SELECT 'selected_features_count', (SELECT count(*) FROM chosen) UNION ALL "
    "SELECT 'zero_row_vector_count', (SELECT count(*) FROM lab) - (SELECT count(DISTINCT doc_id) FROM kept) UNION ALL "
    "SELECT 'matrix_rows', (SELECT count(DISTINCT doc_id) FROM kept)",
)
T["swords"] = "SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, word AS term FROM lctok) WHERE length(term) >= 3 GROUP BY term HAVING count(DISTINCT doc_id) >= 20"
T["svocab"] = "SELECT row_number() OVER (ORDER BY term) - 1 AS term_id, term, df FROM swords"
T["stf"] = "SELECT t.doc_id, term_id, term, df, count(*) AS tf FROM lctok t JOIN svocab v ON t.word = v.term GROUP BY t.doc_id, term_id, term, df"
T["sw"] = (
    "SELECT doc_id, term_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS value FROM (SELECT *, "
    "tf * (ln((1.0 + (SELECT count(*) FROM lab)) / (1.0 + df)) + 1.0) AS w FROM stf)"
)
T["scells"] = (
    "SELECT v.term_id, v.term, c.n / c.total AS p, coalesce(sum(value), 0) AS s FROM svocab v CROSS JOIN csize c LEFT JOIN "
    "(SELECT sw.*, label FROM sw JOIN lab USING (doc_id)) x ON x.term_id = v.term_id AND x.label = c.label "
    "GROUP BY v.term_id, v.term, c.n, c.total, c.label"
)
oracle(
    "separating_words",
    "SELECT name, score, row_number() OVER (ORDER BY term_id) - 1 AS feature FROM (SELECT term_id, term AS name, "
    "round(sum((s - p * f) * (s - p * f) / (p * f)), 6) AS score FROM (SELECT *, sum(s) OVER (PARTITION BY term_id) AS f FROM scells) "
    "GROUP BY term_id, term ORDER BY score DESC, term_id DESC LIMIT 50)",
)

# ---- scaling, votes, metrics
oracle(
    "standard_scale",
    "SELECT vec_id, dim, round(CASE WHEN sd > 0 THEN (value - mean) / sd ELSE 0.0 END, 5) AS value FROM (SELECT *, "
    "avg(value) OVER (PARTITION BY dim) AS mean, stddev_pop(value) OVER (PARTITION BY dim) AS sd FROM (SELECT vec_id, "
    "CAST(unnest(range(len(embedding))) AS INTEGER) AS dim, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings))",
)
T["seen"] = (
    "SELECT m.model, d.doc_id, d.lang AS label, s.split, CASE m.model WHEN 'source' THEN d.source WHEN 'length' THEN "
    "CAST(CAST(trunc(log2(length(d.text) + 1)) AS INTEGER) AS VARCHAR) ELSE 'all' END AS key FROM documents d JOIN strat s ON s.doc_id = d.doc_id "
    "CROSS JOIN (VALUES ('source'), ('length'), ('all')) m(model)"
)
T["shares"] = (
    "SELECT model, key, label AS guess, count(*) / sum(count(*)) OVER (PARTITION BY model, key) AS probability FROM seen "
    "WHERE split = 'train' GROUP BY model, key, label"
)
T["probs"] = (
    "SELECT t.model, t.doc_id, t.label, h.guess, h.probability FROM seen t JOIN shares h ON t.model = h.model AND t.key = h.key "
    "WHERE t.split = 'test'"
)
T["preds"] = (
    "SELECT model, doc_id, label, guess AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY model, doc_id "
    "ORDER BY round(probability, 9) DESC, guess) AS r FROM probs) WHERE r = 1"
)
oracle(
    "vote_hard",
    "SELECT doc_id, prediction, votes FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY votes DESC, prediction) AS r "
    "FROM (SELECT doc_id, prediction, count(*) AS votes FROM preds GROUP BY doc_id, prediction)) WHERE r = 1",
)
oracle(
    "vote_soft",
    "SELECT doc_id, guess AS prediction, probability FROM (SELECT *, row_number() OVER (PARTITION BY doc_id "
    "ORDER BY probability DESC, guess) AS r FROM (SELECT doc_id, guess, round(avg(probability), 6) AS probability FROM probs "
    "GROUP BY doc_id, guess)) WHERE r = 1",
)
T["conf"] = "SELECT model, label, prediction, count(*) AS n FROM preds GROUP BY model, label, prediction"
oracle("confusion", "SELECT * FROM conf")
oracle(
    "confusion_matrix",
    "SELECT label, "
    + ", ".join(f"count(*) FILTER (WHERE prediction = '{c}') AS {c}" for c in ("de", "en", "es", "fr"))
    + " FROM preds WHERE model = 'length' GROUP BY label",
)
oracle(
    "accuracy_folds",
    "SELECT model, round(avg(a), 6) AS accuracy FROM (SELECT model, fold, avg(CASE WHEN p.label = prediction THEN 1.0 ELSE 0.0 END) AS a "
    "FROM preds p JOIN folded f ON p.doc_id = f.doc_id GROUP BY model, fold) GROUP BY model",
)
T["perclass"] = (
    "SELECT model, c AS label, count(*) FILTER (WHERE label = c AND prediction = c) AS tp, count(*) FILTER (WHERE label = c) AS support, "
    "count(*) FILTER (WHERE prediction = c) AS predicted FROM preds JOIN (SELECT DISTINCT model AS m, label AS c FROM preds UNION "
    "SELECT model, prediction FROM preds) k ON k.m = preds.model GROUP BY model, c"
)
T["prf"] = (
    "SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END "
    "AS recall, CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0.0 END AS f1 FROM perclass"
)
oracle(
    "balanced_accuracy",
    "SELECT model, round(avg(recall) FILTER (WHERE support > 0), 6) AS balanced_accuracy FROM prf GROUP BY model",
)
oracle(
    "macro_prf",
    "SELECT model, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1_macro FROM prf GROUP BY model",
)
oracle("micro_f1", "SELECT model, round(sum(tp) / sum(support), 6) AS f1_micro FROM prf GROUP BY model")
T["one"] = "SELECT * FROM prf WHERE model = 'length'"
oracle(
    "classification_report",
    'SELECT label AS "row", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM one UNION ALL '
    "SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM one UNION ALL "
    "SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM one UNION ALL "
    "SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), "
    "round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM one",
)
T["macro"] = "SELECT model, round(avg(f1), 6) AS f1_macro FROM prf GROUP BY model"
oracle(
    "rank_models",
    "SELECT model, f1_macro FROM macro WHERE f1_macro >= 0.1 ORDER BY f1_macro DESC, CASE model WHEN 'source' THEN 1 WHEN 'length' THEN 2 ELSE 3 END LIMIT 2",
)
oracle("passing_models", "SELECT model, f1_macro FROM macro WHERE f1_macro >= 0.15")

# ---- neighbours and workbooks
T["vhash"] = "SELECT vec_id AS doc_id, CAST(label AS VARCHAR) AS label, embedding, md5('5:' || vec_id) AS h FROM embeddings"
T["vsplit"] = _stratified("vhash", "CAST(ceil(0.2 * total) AS BIGINT)")
T["vside"] = "SELECT doc_id, label, split, CAST(embedding AS DOUBLE[]) AS e FROM vhash JOIN vsplit USING (doc_id, label)"
oracle(
    "knn_predict",
    "SELECT query_id, CAST(label AS INTEGER) AS prediction FROM (SELECT query_id, label, row_number() OVER (PARTITION BY query_id "
    "ORDER BY count(*) DESC, CAST(label AS INTEGER)) AS r FROM (SELECT q.doc_id AS query_id, t.label, row_number() OVER "
    "(PARTITION BY q.doc_id ORDER BY round(list_sum(list_transform(list_zip(q.e, t.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6), "
    "t.doc_id) AS near FROM vside q CROSS JOIN vside t WHERE q.split = 'test' AND t.split = 'train') WHERE near <= 5 GROUP BY query_id, label) "
    "WHERE r = 1",
)
oracle("read_xlsx", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang AS label FROM documents")
