"""Near-duplicate texts: weighted-Jaccard signatures by hierarchical Poisson processes, bands, verified multiset overlap."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbalis.llm.common import SPACE_RUN, columns_of, folded, lean, short_batches, small_batches, whole_row, whole_text
from verbalis.llm.components import components
from verbalis.llm.texthash import U, mix, nth, shingles_of, words_of
from verbalis.session import Workspace

#: A pair of similarity 0.8 shares no band once in 190,000 pairs: (1 - 0.8 ** 6) ** 40.
BANDS, ROWS = 40, 6
#: Members of a bucket that are paired by a join; larger buckets are compared and verified in tiles.
TILE = 16
#: Members and bytes of text of one side of a tile, on average.
SIDE, SIDE_BYTES = 256, 4 << 20
#: A bucket of at most so many sides, and of twice the bytes of one, is a tile of its own.
WHOLE = 4
#: Turns with drawn centres before all pairs of what is left are compared.
DRAWS = 1
TEXT_BYTES = 1 << 18


def _unit(seed: np.ndarray, k: int) -> np.ndarray:
    """Uniform numbers in (0, 1), the k-th of each seed."""
    return ((mix(seed + nth(k)) >> U(12)).astype(np.float64) + 0.5) * 2.0**-52


def signatures(text: np.ndarray, value: np.ndarray, count: np.ndarray, n_texts: int, size: int) -> np.ndarray:
    """A signature of ``size`` numbers per text: two texts agree in a place with the probability of their weighted Jaccard.

    Weights are whole numbers. Weight levels are cut into (0, 1], (1, 2], (2, 4], (4, 8] and so on; a shingle has a
    Poisson process per cut, with a rate of its width, whose points carry a time, a place in the signature and a level.
    A text sees the points whose level its weight reaches, and each place keeps its earliest time. Equal shingles have
    equal points in all texts. Processes are followed only up to a time by which all places should have a point; texts
    that still lack one go on with twice the time, so the outcome is that of following every process for ever.
    """
    out = np.full((n_texts, size), np.inf)
    flat = out.reshape(-1)
    total = np.bincount(text, count, n_texts)
    limit = np.divide(size * (np.log(size) + 3), total, out=np.zeros(n_texts), where=total > 0)
    depth = int(count.max()).bit_length() + 1 if len(count) else 0
    parts = []
    for j in range(depth):
        low = 0 if j == 0 else 1 << (j - 1)
        here = np.flatnonzero(count > low)
        if len(here):
            width = 1 if j == 0 else low
            parts.append((text[here], mix(value[here] + nth(j + 1)), count[here] - low, np.full(len(here), float(width))))
    if not parts:
        return out
    owner, seed, reach, rate = (np.concatenate(x) for x in zip(*parts))
    todo = np.flatnonzero(total > 0)
    while len(todo):
        wanted = np.zeros(n_texts, bool)
        wanted[todo] = True
        at = np.flatnonzero(wanted[owner])
        time, step = np.zeros(len(at)), 0
        while len(at):
            # several points of each process at once when few processes are left; gaps are added to the time one after
            # the other, so that times are the same to the last bit whatever the step
            ahead = max(1, min(64, (1 << 15) // len(at)))
            s = mix(seed[at][:, None] + nth(np.arange(step, step + ahead))[None, :])
            gaps = -np.log(_unit(s, 1)) / rate[at][:, None]
            times = np.cumsum(np.hstack([time[:, None], gaps]), axis=1)[:, 1:]
            inside = times <= limit[owner[at]][:, None]
            level = np.floor(_unit(s, 2) * rate[at][:, None])
            seen = inside & (level < reach[at][:, None])
            place = (mix(s[seen] + nth(3)) >> U(33)).astype(np.int64) % size
            np.minimum.at(flat, np.broadcast_to(owner[at][:, None], s.shape)[seen] * size + place, times[seen])
            alive = inside[:, -1]
            at, time, step = at[alive], times[alive, -1], step + ahead
        todo = todo[np.isinf(out[todo]).any(axis=1)]
        limit[todo] *= 2
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of every signature."""
    bits = sketch.view(U).reshape(len(sketch), bands, rows)
    key = np.broadcast_to(mix(nth(np.arange(1, bands + 1))), (len(sketch), bands)).copy()
    for r in range(rows):
        key = mix(key * U(31) + bits[:, :, r])
    return key.view(np.int64)


def plain_words(text: str | Column) -> Column:
    """The words of a text with one space between them."""
    return F.trim(F.regexp_replace(whole_text(text), SPACE_RUN, " "))


def _sketch(shingle: int, bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in small_batches(batches, "words", TEXT_BYTES):
            texts = [t.encode() for t in batch.column("words").to_pylist()]
            found = shingles_of(words_of(texts), len(texts), shingle)
            keys = band_keys(signatures(*found, len(texts), bands * rows), bands, rows)
            keys = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), bands).cast(pa.list_(pa.int64()))
            full = pa.array(np.fromiter(map(len, texts), np.int64, len(texts)) > 0)
            keys = pa.compute.if_else(full, keys, pa.scalar([], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("print"), keys], names=["doc_id", "print", "keys"])

    return sketch


def overlaps(left: list[bytes], right: list[bytes], shingle: int) -> np.ndarray:
    """Weighted Jaccard of the shingle multisets of each pair of texts; of two texts without words it is 1."""
    n = len(left)
    text, value, count = shingles_of(words_of(left + right), 2 * n, shingle)
    pair = text % n
    order = np.lexsort((value, pair))
    pair, value, count = pair[order], value[order], count[order]
    twin = np.flatnonzero((pair[1:] == pair[:-1]) & (value[1:] == value[:-1]))
    shared = np.bincount(pair[twin], np.minimum(count[twin], count[twin + 1]), n)
    joint = np.bincount(pair, count, n) - shared
    return np.divide(shared, joint, out=np.ones(n), where=joint > 0)


def _verify(shingle: int, similarity: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in small_batches(batches, "words_a", TEXT_BYTES // 4):
            a, b = ([t.encode() for t in batch.column(c).to_pylist()] for c in ("words_a", "words_b"))
            good = pa.array(overlaps(a, b, shingle) >= similarity)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(good)

    return verify


def _parts(texts: list[bytes]) -> list[tuple[int, int]]:
    """Ranges of texts of about ``TEXT_BYTES``; a longer text is a range of its own."""
    cuts, total = [0], 0
    for i, text in enumerate(texts):
        if total and total + len(text) > TEXT_BYTES:
            cuts.append(i)
            total = 0
        total += len(text)
    return list(zip(cuts, [*cuts[1:], len(texts)]))


def all_overlaps(left: list[bytes], right: list[bytes], shingle: int, wanted: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """For each text on the left: its place, the first place and the weighted Jaccards of a range of texts on the right.

    Ranges without a wanted pair are left out. Each range is cut into shingles once for all texts of the other side.
    """
    for low, high in _parts(right):
        for start, end in _parts(left):
            if not wanted[start:end, low:high].any():
                continue
            n, m = end - start, high - low
            text, value, count = shingles_of(words_of(left[start:end] + right[low:high]), n + m, shingle)
            total = np.bincount(text, count, n + m)
            value = np.unique(value, return_inverse=True)[1]
            mine = [np.flatnonzero(text == i) for i in range(n)]
            theirs = np.flatnonzero(text >= n)
            owner, word, times = text[theirs] - n, value[theirs], count[theirs]
            weight = np.zeros(value.max(initial=-1) + 1)
            for i in np.flatnonzero(wanted[start:end, low:high].any(axis=1)):
                weight[value[mine[i]]] = count[mine[i]]
                shared = np.bincount(owner, np.minimum(weight[word], times), m)
                weight[value[mine[i]]] = 0
                joint = total[i] + total[n:] - shared
                yield start + i, low, np.divide(shared, joint, out=np.ones(m), where=joint > 0)


def may_reach(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether multisets of so many shingles can overlap enough: their weighted Jaccard is at most the ratio of their sizes."""
    return np.minimum(a, b) >= similarity * np.maximum(a, b) - 1e-6


def _tile(shingle: int, similarity: float):
    def tile(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        """Verified links of one tile, as many as it takes to join the components that its pairs join.

        All pairs of a tile share its bucket. A pair is compared in the lowest bucket it shares: as long as it is of two
        components, all its buckets are open.
        """
        lean()
        bucket, low, high = (k.as_py() for k in key)
        node, group, chunk, weight = (rows.column(c).to_numpy() for c in ("node", "component", "chunk", "weight"))
        keys = rows.column("keys").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        words = rows.column("words")
        # by size, so that ranges of texts that cannot overlap enough are left out as a whole
        order = np.argsort(weight, kind="stable")
        i, j = (order[chunk[order] == c] for c in (low, high))
        wanted = group[i][:, None] != group[j][None, :]
        wanted &= may_reach(weight[i][:, None], weight[j][None, :], similarity)
        if low == high:
            wanted &= node[i][:, None] < node[j][None, :]
        for k in range(keys.shape[1]):
            wanted &= (keys[i, k][:, None] != keys[j, k][None, :]) | (keys[i, k] >= bucket)[:, None]
        left, right = ([words[int(x)].as_py().encode() for x in side] for side in (i, j))
        group, links = group.copy(), []
        for x, start, value in all_overlaps(left, right, shingle, wanted):
            for y in np.flatnonzero((value >= similarity) & wanted[x, start : start + len(value)]) + start:
                mine, other = group[i[x]], group[j[y]]
                if mine != other:
                    group[group == other] = mine
                    links.append(sorted((node[i[x]], node[j[y]])))
        found = np.array(links, np.int64).reshape(-1, 2)
        return pa.Table.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return tile


class _Search:
    """Candidate pairs are found in turns; each turn leaves out what earlier links have joined already."""

    def __init__(self, nodes: DataFrame, texts: DataFrame, space: Workspace, shingle: int, similarity: float):
        self.space, self.texts, self.shingle, self.similarity = space, texts, shingle, similarity
        self.members = nodes.select("node", "weight", "bytes", F.explode("keys").alias("bucket"))
        self.nodes = nodes
        self.links: DataFrame | None = None
        self.groups: DataFrame | None = None

    def verified(self, pairs: DataFrame, name: str, crowd: DataFrame | None = None) -> None:
        """Keep the pairs whose texts overlap enough, and the links of ``crowd``; find the components so far."""
        a = self.texts.select(F.col("node").alias("a"), F.col("words").alias("words_a"))
        b = self.texts.select(F.col("node").alias("b"), F.col("words").alias("words_b"))
        both = pairs.join(a, "a").join(b, "b")
        found = both.mapInArrow(_verify(self.shingle, self.similarity), "a long, b long")
        with short_batches(self.space.spark):
            found = self.space.keep(found if crowd is None else found.unionByName(crowd), f"links_{name}")
        self.links = found if self.links is None else self.links.unionByName(found)
        self.groups = components(self.links, self.space, f"groups_{name}")

    def open_members(self) -> DataFrame:
        """Members of buckets that hold more than one component: bucket, node, component, their sizes and their number."""
        group = F.coalesce("component", "node").alias("component")
        own = ("bucket", "node", "weight", "bytes")
        named = self.crowded.select(*own).join(self.groups, "node", "left").select(*own, group)
        parted = named.groupBy("bucket").agg(
            F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("n")
        )
        parted = parted.filter("least <> most").select("bucket", "n")
        return named.join(parted, "bucket")

    def first(self) -> DataFrame:
        """Every member with the smallest one of its bucket: the copies of one text mostly share that centre."""
        found = self.members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("centre"))
        # most buckets have one member; what follows reads only those with more
        self.crowded = self.space.keep(self.members.join(found.filter("n > 1"), "bucket"), "crowded")
        pairs = self.crowded.filter("node <> centre")
        return pairs.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()

    def reachable(self, a: str, b: str) -> Column:
        """``may_reach`` for columns: what the sizes rule out needs no text."""
        return F.least(a, b) >= F.greatest(a, b) * self.similarity - 1e-6

    def second(self, turn: int) -> DataFrame:
        """Every member of an open bucket with a centre drawn for that bucket, so families get centres in many places."""
        draw = F.xxhash64("bucket", "node", F.lit(turn))
        rows = self.space.keep(self.open_members().withColumn("draw", draw), f"open_draw_{turn}")
        first = F.min(F.struct("draw", "node", "component", "weight")).alias("first")
        centres = rows.groupBy("bucket").agg(first).select(
            "bucket", *[F.col(f"first.{c}").alias(n) for c, n in (("node", "centre"), ("component", "own"), ("weight", "size"))]
        )
        pairs = rows.join(centres, "bucket").filter((F.col("component") != F.col("own")) & self.reachable("weight", "size"))
        return pairs.select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct()

    def third(self) -> DataFrame:
        """All pairs across components of buckets still open that have at most ``TILE`` members."""
        self.open = self.space.keep(self.open_members(), "open_3")
        small = self.open.filter(F.col("n") <= TILE)
        other = small.select("bucket", F.col("node").alias("b"), F.col("component").alias("other"), F.col("weight").alias("size"))
        pairs = small.join(other, "bucket").filter("node < b and component <> other").filter(self.reachable("weight", "size"))
        return pairs.select(F.col("node").alias("a"), "b").distinct()

    def crowd(self) -> DataFrame:
        """Links across components of the larger ones: all their pairs, compared and verified in tiles, so that a crowd
        with one passage in common makes no rows for its pairs.

        Members are parted by size first: those of one class of sizes can only overlap enough with those of the same and
        the next class. Chunks of a class have bounded numbers and bytes, and a tile is made of two chunks. A bucket within
        ``WHOLE`` sides is one tile, and its members make one row each. Texts are joined before members are dealt to tiles.
        """
        large = self.open.filter(F.col("n") > TILE)
        total = large.groupBy("bucket").agg(F.sum("bytes").alias("all"))
        large = large.join(total, "bucket").withColumn("whole", (F.col("n") <= WHOLE * SIDE) & (F.col("all") <= 2 * SIDE_BYTES))
        level = F.floor(F.log(F.greatest("weight", F.lit(1))) / -math.log(self.similarity) + 1e-9)
        large = large.withColumn("class", F.when(F.col("whole"), F.lit(0).cast("long")).otherwise(level))
        size = large.groupBy("bucket", "class", "whole").agg(F.count("*").alias("m"), F.sum("bytes").alias("bytes"))
        chunks = F.ceil(F.greatest(F.col("m") / SIDE, F.col("bytes") / SIDE_BYTES))
        size = size.select("bucket", "class", F.when(F.col("whole"), F.lit(1).cast("long")).otherwise(chunks).alias("chunks"))
        size = self.space.keep(size, "crowd_sizes")
        after = size.select("bucket", (F.col("class") - 1).alias("class"), F.col("chunks").alias("next"))
        before = size.select("bucket", (F.col("class") + 1).alias("class"), F.col("chunks").alias("last"))
        size = size.join(after, ["bucket", "class"], "left").join(before, ["bucket", "class"], "left")
        rows = large.join(size, ["bucket", "class"]).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
        rows = rows.drop("bytes", "all", "whole", "n")
        # chunks are numbered (class, chunk); a member meets its own class, and the classes on both sides
        number = lambda level, chunk: level * (1 << 32) + chunk
        own = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda k: number(F.col("class"), k))
        none = F.array().cast("array<bigint>")
        up = F.when(F.col("next").isNotNull(), F.transform(F.sequence(F.lit(0).cast("long"), F.col("next") - 1), lambda k: number(F.col("class") + 1, k)))
        down = F.when(F.col("last").isNotNull(), F.transform(F.sequence(F.lit(0).cast("long"), F.col("last") - 1), lambda k: number(F.col("class") - 1, k)))
        rows = rows.withColumn("chunk", number(F.col("class"), F.col("chunk")))
        rows = rows.withColumn("others", F.concat(own, F.coalesce(up, none), F.coalesce(down, none)))
        rows = rows.select("bucket", "node", "component", "chunk", "weight", "others")

        def dealt(members: DataFrame) -> DataFrame:
            met = members.withColumn("other", F.explode("others")).drop("others")
            return met.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")}).drop("other")

        # tiles with members of one component only have nothing to compare
        alive = dealt(rows).groupBy("bucket", "low", "high").agg(F.min("component").alias("least"), F.max("component").alias("most"))
        alive = alive.filter("least <> most").drop("least", "most")
        rows = rows.join(self.nodes.select("node", "keys"), "node").join(self.texts, "node")
        tiles = dealt(rows).join(alive, ["bucket", "low", "high"])
        tile = _tile(self.shingle, self.similarity)
        return tiles.groupBy("bucket", "low", "high").applyInArrow(tile, "a long, b long").distinct()


def print_of(words: Column) -> Column:
    """A hash that is equal for texts of equal words, then the spaces and bytes that they have in common."""
    spaces = F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))
    return F.concat_ws(":", F.md5(folded(words)), spaces.cast("string"), F.octet_length(words).cast("string"))


def sizes_of(print_: str, shingle: int) -> tuple[Column, Column]:
    """Shingles and bytes of the text of a print."""
    spaces, size = (F.split(print_, ":")[k].cast("long") for k in (1, 2))
    return F.when(size == 0, F.lit(0).cast("long")).otherwise(F.greatest(spaces + 2 - shingle, F.lit(1).cast("long"))), size


def _classes(
    docs: DataFrame, space: Workspace, similarity: float, shingle: int, bands: int, rows: int, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame]:
    """``doc_id, print`` of every row, and ``print, component, least, copies`` of every text."""
    id_type = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc_id"), plain_words(text_col).alias("words"))
    given = given.withColumn("print", print_of(F.col("words")))
    made = given.mapInArrow(_sketch(shingle, bands, rows), f"doc_id {id_type}, print string, keys array<long>")
    with short_batches(docs.sparkSession):
        sketched = space.keep(made.withColumn("row", F.monotonically_increasing_id()), "sketches")
    # rows that repeat a text and its id are counted first, so that one of them can stand for the text
    repeats = sketched.groupBy("print", "doc_id").agg(F.min("row").alias("row"), F.count("*").alias("n"))
    texts = repeats.groupBy("print").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("least"), F.sum("n").alias("copies"), F.min_by("n", "row").alias("n")
    )
    texts = space.keep(texts, "texts")
    nodes = sketched.drop("print").join(texts.select(F.col("node").alias("row"), "print", (F.col("n") > 1).alias("twins")), "row")
    weight, size = sizes_of("print", shingle)
    nodes = space.keep(nodes.withColumnRenamed("row", "node").withColumns({"weight": weight, "bytes": size}), "nodes")
    search = _Search(nodes, given, space, shingle, similarity)
    pairs = space.keep(search.first(), "pairs_1")
    paired = search.crowded.select("node").distinct()
    wanted = nodes.select("node", "print", "doc_id", "twins").join(paired, "node", "left_semi")
    found = given.join(wanted.withColumnRenamed("doc_id", "id"), "print")
    found = found.filter(F.col("doc_id").eqNullSafe(F.col("id"))).select("node", "twins", "words")
    one_each = found.filter("twins").groupBy("node").agg(F.first("words").alias("words"))
    one_each = found.filter("not twins").select("node", "words").unionByName(one_each)
    search.texts = space.keep(one_each, "words")
    search.verified(pairs, "1")
    for turn in range(DRAWS):
        pairs = space.keep(search.second(turn), f"pairs_draw_{turn}")
        if pairs.isEmpty():
            break
        search.verified(pairs, f"draw_{turn}")
    pairs = space.keep(search.third(), "pairs_all")
    if not search.open.isEmpty():
        search.verified(pairs, "all", search.crowd())
    space.drop("words")
    named = texts.join(search.groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return sketched.select("doc_id", "print"), named.select("print", "component", "least", "copies")


def near_copies(
    docs: DataFrame,
    space: Workspace,
    similarity: float = 0.8,
    shingle: int = 5,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, class_id (the smallest id of its class), class_size, kept.

    Two texts link if the multisets of their word shingles have a weighted Jaccard of at least ``similarity``; classes
    are the components of links. Texts of equal words (A-Z lower-cased) are one text, so copies cost no pairs. Texts that
    share a band are candidates: first with one centre per bucket, then with centres drawn per bucket, and at last, in
    buckets that still hold several components, with all members of other components whose sizes do not rule a link out. Every candidate is verified by
    its words before it counts.

    Texts of fewer words than a shingle have one shingle; texts without words (null, empty, white space) are one class.
    A null id is larger than any other. Rows that repeat an id are rows of their own. Empty tables give an empty result;
    other columns are not read.
    """
    rows_of, named = _classes(docs, space, similarity, shingle, bands, rows, id_col, text_col)
    classes = named.groupBy("component").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"))
    named = named.join(classes, "component").select("print", "class_id", "class_size")
    out = rows_of.join(named, "print")
    return out.select(
        F.col("doc_id").alias(id_col),
        "class_id",
        F.col("class_size").cast("long").alias("class_size"),
        F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"),
    )


def without_near_copies(docs: DataFrame, space: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class of near copies: that of the smallest id.

    Of rows of a class that repeat its smallest id, or are all without one, the text of the smallest hash stays, and of
    rows that repeat that too the first by the hash of all columns. Classes are told apart by their texts, so an id may
    stay in several of them. Both choices are least values, summed up in every task first.
    """
    _, named = _classes(docs.select(id_col, text_col), space, 0.8, 5, BANDS, ROWS, id_col, text_col)
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "print")).alias("first")
    stay = named.groupBy("component").agg(first).select(F.col("first.print").alias("_key"), F.col("first.least").alias("_stay"))
    rows = docs.select(whole_row(docs), F.col(id_col).alias("_id"), print_of(plain_words(text_col)).alias("_print"))
    same = (F.col("_print") == F.col("_key")) & F.col("_id").eqNullSafe(F.col("_stay"))
    left = rows.join(stay, same, "left_semi")
    left = left.groupBy("_print").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return left.select(*columns_of(docs))
