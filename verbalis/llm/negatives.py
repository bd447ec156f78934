"""Hard negatives: an inverted multi-index of two half-space codebooks, visited best bound first, with certified stops."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from verbalis.llm.common import lean
from verbalis.session import Workspace

#: Entries of each half's codebook, rows that the codebooks are fitted on, rows of a chunk of a cell.
HALVES, FIT_ROWS, CHUNK_ROWS = 16, 8192, 2048
#: Anchors that travel together, and how many such blocks one task holds beside a chunk.
BLOCK, BLOCKS = 256, 64
#: Rows that an anchor looks at before it stops by bounds alone.
OPENING = 4096
#: Integers up to this are exact in double precision.
EXACT = float(1 << 53)
LAST = np.iinfo(np.int64).max


def whole(embedding: Column) -> Column:
    """Whether a vector takes part: not null, and no component null or non-finite."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def integers(vectors: pa.Array, dim: int, scale: float) -> np.ndarray:
    """``floor(scale * x)`` of every component, as doubles that hold integers; shorter vectors end in zeros."""
    sizes = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), dim))
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    inside = np.arange(dim) < sizes[:, None]
    with np.errstate(over="ignore"):
        out[inside] = np.clip(np.floor(values * scale), -1.7e308, 1.7e308)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in double precision where no partial sum can pass 2 ** 53, else with long integers.

    Products beyond 64 bits count as the largest or smallest 64-bit integer.
    """
    a, b = a.astype(np.float64), b.astype(np.float64)
    with np.errstate(over="ignore"):
        bound = np.sqrt((a**2).sum(axis=1).max(initial=0)) * np.sqrt((b**2).sum(axis=1).max(initial=0))
    if bound < EXACT:
        return (a @ b.T).astype(np.int64)
    long_a, long_b = ([[int(x) for x in row] for row in m.tolist()] for m in (a, b))
    exact = [[sum(x * y for x, y in zip(p, q)) for q in long_b] for p in long_a]
    return np.array([[max(-LAST, min(LAST, x)) for x in row] for row in exact], np.int64).reshape(len(a), len(b))


def codebook(points: np.ndarray, size: int, seed: int = 7, turns: int = 12) -> np.ndarray:
    """Centres by Lloyd's steps from seeded distinct points."""
    distinct = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.permutation(len(distinct))[:size]]
    for _ in range(turns):
        near = _nearest(points, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        gap = (centres**2).sum(axis=1) - 2 * points @ centres.T
    return np.nan_to_num(gap, nan=np.inf).argmin(axis=1)


@dataclass
class MultiIndex:
    """Codebooks, radii of their entries over all rows, and rows and chunks of every cell. Its size depends on ``halves`` only."""

    books: list[np.ndarray]
    kind: str  # how codes are stored
    dim: int
    scale: float
    radii: list[np.ndarray] | None = None
    rows: np.ndarray | None = None
    first_chunk: np.ndarray | None = None

    def parts(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.books[0].shape[1]
        return codes[:, :cut], codes[:, cut:]

    def placed(self, codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Cell of every row, and per half its distance from the centre, rounded up."""
        nears, gaps = [], []
        for half, book in zip(self.parts(codes), self.books):
            near = _nearest(half, book)
            with np.errstate(over="ignore", invalid="ignore"):
                gap = np.sqrt(((half - book[near]) ** 2).sum(axis=1))
            nears.append(near)
            gaps.append(np.nan_to_num(gap, nan=np.inf) * (1 + 1e-9) + 1e-6)
        return nears[0] * len(self.books[1]) + nears[1], gaps

    def bounds(self, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per half: lower and upper bounds of (anchor, entry) half scores, with radii, rounded outwards."""
        out = []
        for half, book, radius in zip(self.parts(codes), self.books, self.radii):
            with np.errstate(over="ignore", invalid="ignore"):
                middle = half @ book.T
                size = np.sqrt((half**2).sum(axis=1))[:, None]
                slack = size * radius + 1e-9 * size * np.sqrt((book**2).sum(axis=1)) + 1e-6
                low, high = middle - slack, middle + slack
            # -inf where an entry has no rows at all; no bound is known where numbers overflow
            low, high = np.nan_to_num(low, nan=-np.inf, posinf=np.inf, neginf=-np.inf), np.nan_to_num(high, nan=np.inf, posinf=np.inf, neginf=-np.inf)
            out.append((low, high))
        return out

    def visits(self, high_1: np.ndarray, high_2: np.ndarray) -> Iterator[tuple[float, int]]:
        """(bound, cell) of all cells, highest bound first: a heap walks the sums of two sorted lists (multi-sequence)."""
        order_1, order_2 = np.argsort(-high_1, kind="stable").tolist(), np.argsort(-high_2, kind="stable").tolist()
        one, two = high_1[order_1].tolist(), high_2[order_2].tolist()
        width, n, m = len(self.books[1]), len(one), len(two)
        heap = [(-(one[0] + two[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            yield -bound, order_1[i] * width + order_2[j]
            if j + 1 < m:
                heapq.heappush(heap, (-(one[i] + two[j + 1]), i, j + 1))
            if j == 0 and i + 1 < n:
                heapq.heappush(heap, (-(one[i + 1] + two[0]), i + 1, 0))


def _wanted(index: MultiIndex, codes: np.ndarray, stop: np.ndarray, top: np.ndarray, closing: bool) -> dict[int, list[int]]:
    """Chunks with the anchors (row numbers) that have to look at them.

    An anchor visits cells by falling bound. Cells without a score up to ``top`` (by lower bounds) are passed over. The
    opening takes cells until their rows reach OPENING; the closing goes on from there to the first bound below ``stop``,
    where every score that still counts is certain to have been seen.
    """
    (low_1, high_1), (low_2, high_2) = index.bounds(codes)
    width = len(index.books[1])
    out: dict[int, list[int]] = {}
    for r in range(len(codes)):
        seen = 0
        for bound, cell in index.visits(high_1[r], high_2[r]):
            if closing and bound < stop[r]:
                break
            n = int(index.rows[cell])
            if not n or low_1[r, cell // width] + low_2[r, cell % width] > top[r]:
                continue
            opening = seen < OPENING
            seen += n
            if opening and not closing or not opening and closing:
                for chunk in range(int(index.first_chunk[cell]), int(index.first_chunk[cell + 1])):
                    out.setdefault(chunk, []).append(r)
            elif not closing:
                break
    return out


REQUEST = "chunk long, slot long, keys binary, labels binary, codes binary, floors binary, tops binary"


def _requests(index: MultiIndex, windows: int, closing: bool):
    names = [f.split()[0] for f in REQUEST.split(", ")]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                keys, labels = (part.column(c).to_numpy() for c in ("_key", "_label"))
                codes = np.frombuffer(b"".join(part.column("_codes").to_pylist()), index.kind).reshape(-1, index.dim)
                # per anchor and window the lowest and highest score that counts; an empty window has its floor above
                floors, tops = (np.array(part.column(c).to_pylist(), np.int64).reshape(-1, windows) for c in ("_floors", "_tops"))
                slot = (TaskContext.get().partitionId() << 32) + number // BLOCKS
                number += 1
                stop, top = floors.min(axis=1), tops.max(axis=1)
                # the ends of the 64-bit integers stand for all scores beyond them
                stop, top = np.where(stop == -LAST, -np.inf, stop), np.where(top == LAST, np.inf, top)
                for chunk, rows in _wanted(index, codes.astype(np.float64), stop, top, closing).items():
                    values = [x[rows].tobytes() for x in (keys, labels, codes, floors, tops)]
                    columns = [pa.array([chunk]), pa.array([slot]), *(pa.array([v], pa.binary()) for v in values)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return ask


FOUND = "_anchor long, _other long, _id {id}, _score long"


def _compare(index: MultiIndex, windows: int, same: bool, best: int, id_type: pa.DataType):
    schema = pa.schema([("_anchor", pa.int64()), ("_other", pa.int64()), ("_id", id_type), ("_score", pa.int64())])

    def compare(requests: pa.Table, chunks: pa.Table) -> pa.Table:
        """The ``best`` rows of a chunk for every window of every anchor that asked for it.

        A chunk's rows stand in order of their ids, so a stable sort by score leaves ties in that order.
        """
        lean()
        if not len(chunks) or not len(requests):
            return schema.empty_table()
        chunk = chunks.slice(0, 1).to_pylist()[0]
        ids = pa.ipc.open_stream(chunk["ids"]).read_all().column(0).combine_chunks()
        keys, labels = np.frombuffer(chunk["keys"], np.int64), np.frombuffer(chunk["labels"], np.int64)
        codes = np.frombuffer(chunk["codes"], index.kind).reshape(-1, index.dim)
        anchors, others, scores = [], [], []
        for request in requests.to_pylist():
            asked, asked_labels = (np.frombuffer(request[c], np.int64) for c in ("keys", "labels"))
            floors, tops = (np.frombuffer(request[c], np.int64).reshape(-1, windows) for c in ("floors", "tops"))
            table = products(np.frombuffer(request["codes"], index.kind).reshape(-1, index.dim), codes)
            fits = ((asked_labels[:, None] == labels) == same) & (asked[:, None] != keys)
            fits &= (table >= floors.min(axis=1)[:, None]) & (table <= tops.max(axis=1)[:, None])
            for r in np.flatnonzero(fits.any(axis=1)).tolist():
                at = np.flatnonzero(fits[r])
                at = at[np.argsort(-table[r, at], kind="stable")]
                score = table[r, at]
                # tops and floors of windows as places in the falling scores
                first = np.searchsorted(-score, -tops[r], "left")
                last = np.minimum(np.searchsorted(-score, -floors[r], "right"), first + best)
                take = np.unique(np.concatenate([np.arange(a, b) for a, b in zip(first, last)]))
                anchors.append(np.full(len(take), asked[r]))
                others.append(at[take])
                scores.append(score[take])
        empty = np.empty(0, np.int64)
        at = np.concatenate([empty, *others])
        columns = [np.concatenate([empty, *anchors]), keys[at], None, np.concatenate([empty, *scores])]
        arrays = [ids.take(pa.array(at)) if c is None else pa.array(c, pa.int64()) for c in columns]
        return pa.Table.from_arrays(arrays, schema=schema)

    return compare


def _pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """One row for a chunk of a cell: its rows in order of their ids, null ids last."""
    rows = rows.sort_by([("_id", "ascending"), ("_key", "ascending")])
    ids = pa.table({"id": rows.column("_id").combine_chunks()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, ids.schema) as out:
        out.write_table(ids)
    values = [sink.getvalue().to_pybytes(), *(rows.column(c).to_numpy().tobytes() for c in ("_key", "_label"))]
    values.append(b"".join(rows.column("_codes").to_pylist()))
    return pa.Table.from_arrays([pa.array([key[0].as_py()]), *(pa.array([v], pa.binary()) for v in values)], names=["chunk", "ids", "keys", "labels", "codes"])


def built(rows: DataFrame, space: Workspace, scale: float, halves: int) -> tuple[DataFrame, DataFrame, MultiIndex]:
    """(coded rows, chunks of cells, index). Codebooks are fitted on FIT_ROWS rows of smallest hash; all rows are indexed."""
    widest, largest, n = rows.agg(F.max(F.size("_vector")), F.max(F.array_max(F.transform("_vector", lambda x: F.abs(x.cast("double"))))), F.count("*")).first()
    dim, largest = max(2, widest or 0), scale * (largest or 0) + 1
    kind = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<f8"
    sample = rows.orderBy(F.xxhash64("_id", "_vector")).limit(FIT_ROWS).select("_vector").toArrow().column(0).combine_chunks()
    points = integers(sample, dim, scale)
    points = np.clip(points, -1e150, 1e150)  # so that no square overflows
    cut = dim // 2
    books = [codebook(points[:, :cut], halves), codebook(points[:, cut:], halves)] if len(points) else [np.zeros((1, cut)), np.zeros((1, dim - cut))]
    index = MultiIndex(books, kind, dim, scale)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = integers(batch.column("_vector"), dim, scale)
            cells, gaps = index.placed(codes)
            stored = codes.astype(kind)
            made = [pa.array([x.tobytes() for x in stored], pa.binary()), pa.array(cells, pa.int32()), *(pa.array(g) for g in gaps)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_key", "_id", "_label")), *made], names=[*coded_names])

    coded_names = ["_key", "_id", "_label", "_codes", "_cell", "_gap_1", "_gap_2"]
    id_type = rows.schema["_id"].dataType.simpleString()
    fields = f"_key long, _id {id_type}, _label long, _codes binary, _cell int, _gap_1 double, _gap_2 double"
    coded = space.keep(rows.select("_key", "_id", "_label", "_vector").mapInArrow(code, fields), "coded")
    width = len(books[1])
    cells = coded.groupBy("_cell").agg(F.count("*").alias("n"), F.max("_gap_1").alias("r1"), F.max("_gap_2").alias("r2")).collect()
    index.rows = np.zeros(len(books[0]) * width, np.int64)
    index.radii = [np.zeros(len(b)) for b in books]
    for r in cells:
        index.rows[r["_cell"]] = r["n"]
        index.radii[0][r["_cell"] // width] = max(index.radii[0][r["_cell"] // width], r["r1"])
        index.radii[1][r["_cell"] % width] = max(index.radii[1][r["_cell"] % width], r["r2"])
    chunks = -(-index.rows // CHUNK_ROWS)
    index.first_chunk = np.concatenate([[0], np.cumsum(chunks)])
    spark = rows.sparkSession
    table = [(c, int(index.first_chunk[c]), int(k)) for c, k in enumerate(chunks.tolist())]  # halves ** 2 rows at most
    dealt = coded.join(F.broadcast(spark.createDataFrame(table, "_cell int, _first long, _n long")), "_cell")
    dealt = dealt.withColumn("chunk", F.col("_first") + F.pmod(F.xxhash64("_key"), F.col("_n")))
    packed = dealt.select("chunk", "_key", "_id", "_label", "_codes").groupBy("chunk")
    packed = packed.applyInArrow(_pack, "chunk long, ids binary, keys binary, labels binary, codes binary")
    return coded, space.keep(packed, "chunks"), index


def _looked_up(anchors: DataFrame, chunks: DataFrame, index: MultiIndex, windows: int, same: bool, best: int, closing: bool, space: Workspace, name: str) -> DataFrame:
    """``_anchor, _other, _id, _score``: what the anchors find in the cells of this visit."""
    id_type = anchors.schema["_id"].dataType.simpleString()
    requests = space.keep(anchors.mapInArrow(_requests(index, windows, closing), REQUEST), f"{name}_requests")
    held = requests.select(F.col("chunk").alias("_held"), F.col("slot").alias("_slot")).distinct()
    held = held.join(chunks.withColumnRenamed("chunk", "_held"), "_held")
    work = requests.groupBy("chunk", "slot").cogroup(held.groupBy("_held", "_slot"))
    arrow_id = pa.schema(anchors.select("_id").limit(0).toArrow().schema).field(0).type
    return space.keep(work.applyInArrow(_compare(index, windows, same, best, arrow_id), FOUND.format(id=id_type)), name)


def _best(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` highest scores per key with their ``rank``; ties by id, null ids last."""
    order = Window.partitionBy(*keys).orderBy(F.col("_score").desc(), F.col("_id").asc_nulls_last(), "_other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def hard_negatives(
    rows: DataFrame,
    space: Workspace,
    anchors: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: float = 256.0,
    halves: int = HALVES,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A row's score is the integer product of its ``floor(scale * x)`` with the anchor's. An anchor's positives are the
    ``positives`` highest rows of its label besides itself. For each of them the ``negatives`` highest rows of other
    labels are returned whose score is at least window[0] and at most window[1] percent of the positive's.

    1. Codebooks of both halves are fitted on a bounded sample; all rows are dealt to cells, cells cut to chunks.
    2. Every anchor opens the cells of highest bound, then closes: it goes on to the first cell whose bound lies below the
       worst score it still needs. Bounds are certain, so results are exact, and equal those of comparing all rows.
    3. The same for negatives, with the windows of the positives: cells that lie above all windows are passed over, and the
       visit stops below the worst of the windows' last scores.

    Chunks and blocks of anchors meet in tasks of bounded size; a task returns the best few per window, never its pairs.
    A cell of very many rows is many chunks. How many cells bounds spare depends on the vectors: for vectors without any
    clusters nearly none, and work grows with anchors times rows.

    Rows with a null label, a null vector, or null or non-finite components take no part. Shorter vectors end in zeros.
    Null ids come last in ties. Rows that repeat an id are rows of their own. An anchor without positives, or positives
    without negatives in their window, give no row. An empty table gives an empty result; other columns are not read.
    """
    given = rows.filter(F.col(label_col).isNotNull() & whole(F.col(vector_col)))
    made = (F.col(label_col) if label is None else label).cast("long").alias("_label")
    given = given.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_vector"), made, F.coalesce(anchors, F.lit(False)).alias("_asks"))
    given = space.keep(given.withColumn("_key", F.monotonically_increasing_id()), "vectors")
    coded, chunks, index = built(given, space, scale, halves)
    asking = given.filter("_asks").select("_key")
    asked = space.keep(coded.join(asking, "_key", "left_semi").select("_key", "_id", "_label", "_codes"), "anchors")
    asked = asked.coalesce(max(1, -(-asked.count() // 4096)))
    least, most = F.lit(-LAST), F.lit(LAST)

    def looked(kept: DataFrame, windows: int, same: bool, best: int, step: str, closing: bool) -> DataFrame:
        return _looked_up(kept, chunks, index, windows, same, best, closing, space, f"{step}_{'closing' if closing else 'opening'}")

    wide = asked.withColumn("_floors", F.array(least)).withColumn("_tops", F.array(most))
    opened = looked(wide, 1, True, positives, "positives", False)
    worst = _best(opened, ["_anchor"], positives).groupBy(F.col("_anchor").alias("_key"))
    worst = worst.agg(F.when(F.count("*") == positives, F.min("_score")).alias("_worst"))
    narrow = asked.join(worst, "_key", "left").withColumn("_floors", F.array(F.coalesce("_worst", least))).withColumn("_tops", F.array(most))
    closed = looked(_few(narrow.drop("_worst"), space, "asking_positives"), 1, True, positives, "positives", True)
    pairs = _best(opened.unionByName(closed), ["_anchor"], positives)
    low = F.ceil(F.col("_score").cast("decimal(20,0)") * window[0] / 100).cast("long")
    high = F.floor(F.col("_score").cast("decimal(20,0)") * window[1] / 100).cast("long")
    pairs = pairs.select("_anchor", F.col("rank").alias("_place"), F.col("_id").alias("positive_id"), F.col("_score").alias("positive_score"), low.alias("_low"), high.alias("_high"))
    pairs = space.keep(pairs, "positives")

    def windows_of(kept: DataFrame) -> DataFrame:
        """Floors and tops per anchor by place of the positive; where there is none, an empty window."""
        per_place = []
        for p in range(1, positives + 1):
            here = (F.col("_place") == p) & (F.col("_low") <= F.col("_high"))
            per_place.append((F.max(F.when(here, F.col("_low"))), F.max(F.when(here, F.col("_high")))))
        sums = kept.groupBy(F.col("_anchor").alias("_key")).agg(
            F.array(*[F.coalesce(a, most) for a, _ in per_place]).alias("_floors"),
            F.array(*[F.coalesce(b, least) for _, b in per_place]).alias("_tops"),
        )
        return asked.join(sums, "_key").filter(F.exists("_tops", lambda x: x > least))

    def in_window(found: DataFrame) -> DataFrame:
        inside = found.join(pairs, "_anchor").filter(F.col("_score").between(F.col("_low"), F.col("_high")))
        return _best(inside, ["_anchor", "_place"], negatives)

    first = _few(windows_of(pairs), space, "asking_first")
    opened = looked(first, positives, False, negatives, "negatives", False)
    tenth = in_window(opened).groupBy("_anchor", "_place").agg(F.when(F.count("*") == negatives, F.min("_score")).alias("_tenth"))
    tight = pairs.join(tenth, ["_anchor", "_place"], "left").withColumn("_low", F.coalesce("_tenth", "_low"))
    closed = looked(_few(windows_of(tight), space, "asking_last"), positives, False, negatives, "negatives", True)
    out = in_window(opened.unionByName(closed))
    names = asked.select(F.col("_key").alias("_anchor"), F.col("_id").alias("anchor_id"))
    return out.join(names, "_anchor").select(
        "anchor_id", "positive_id", "rank", F.col("_id").alias("negative_id"), "positive_score", F.col("_score").alias("negative_score")
    )


def _few(anchors: DataFrame, space: Workspace, name: str) -> DataFrame:
    """The anchors, kept and in as few partitions as blocks of them need."""
    kept = space.keep(anchors, name)
    return kept.coalesce(max(1, -(-kept.count() // 4096)))
