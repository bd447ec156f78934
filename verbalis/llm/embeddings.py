"""Near-duplicate vectors: int8 tile products with error bounds; only pairs that may reach the threshold are recomputed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbalis.llm.common import lean
from verbalis.llm.components import components
from verbalis.session import Workspace

#: Bytes of one block's vectors, and the most rows of a block; a task holds two blocks.
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 8192
STRIP = 1024
PAIRS = 1 << 16
#: Products of int8 codes are exact in single precision up to so many dimensions.
EXACT_DIMS = (1 << 24) // (127 * 127)
BLOCK = "dim int, block int, keys binary, copies binary, vectors binary, codes binary, scale binary, error binary"


def usable(embedding: Column) -> Column:
    """Whether a vector has a direction: not null or empty, all components finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and error norms of unit vectors: ``|unit - scale * codes| <= error``, rounded up."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.sqrt(((unit - codes * scale[:, None]) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-12
    return codes, scale, error


def scaled(given: np.ndarray) -> np.ndarray:
    """Vectors in double precision, each times the power of two that brings its largest component to between 1/2 and 1.

    That changes no digit, and no square or product of them over- or underflows.
    """
    vectors = given.astype(np.float64)
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors**2).sum(axis=1))


def _pack_block(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """One row for a block: its vectors as given, codes, scales and errors."""
    lean()
    dim, block = (k.as_py() for k in key)
    given = rows.column("_vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    vectors = scaled(given)
    codes, scale, error = quantised(vectors / lengths(vectors)[:, None])
    keys, copies = (rows.column(c).to_numpy().astype(np.int64) for c in ("_key", "_copies"))
    parts = [x.tobytes() for x in (keys, copies, given, codes, scale, error)]
    ints = [pa.array([x], pa.int32()) for x in (dim, block)]
    names = [f.split()[0] for f in BLOCK.split(", ")]
    return pa.Table.from_arrays([*ints, *(pa.array([x], pa.binary()) for x in parts)], names=names)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of codes, as single-precision matrix products of at most EXACT_DIMS dimensions each."""
    if a.shape[1] <= EXACT_DIMS:
        return a @ b.T
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_DIMS):
        out += a[:, at : at + EXACT_DIMS] @ b[:, at : at + EXACT_DIMS].T
    return out


def tile_links(a: dict, b: dict, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs of two blocks whose cosine in double precision is at least ``threshold``.

    With x = scale * codes + e: the cosine differs from the scaled integer product by at most
    |x'| |e_y| + |e_x| |y'| + |e_x| |e_y|. Pairs that stay below the threshold with that added are out for certain.
    """
    left, right = a["codes"].astype(np.float32), b["codes"].astype(np.float32)
    length_a, length_b = 1 + a["error"], float(1 + b["error"].max())  # of the quantised vectors, at most
    slack = length_a * b["error"].max() + a["error"] * length_b + a["error"] * b["error"].max()
    floor = ((threshold - slack - 2e-6) / a["scale"]).astype(np.float32)
    scale_b = b["scale"].astype(np.float32)
    vectors_a, vectors_b = scaled(a["vectors"]), scaled(b["vectors"])
    norm_a, norm_b = lengths(vectors_a), lengths(vectors_b)
    rows, columns = [], []
    for at in range(0, len(left), STRIP):
        product = _products(left[at : at + STRIP], right)
        product *= scale_b
        r, c = np.nonzero(product >= floor[at : at + STRIP, None])
        r += at
        if same:
            r, c = r[c > r], c[c > r]
        for k in range(0, len(r), PAIRS):
            i, j = r[k : k + PAIRS], c[k : k + PAIRS]
            cosine = (vectors_a[i] * vectors_b[j]).sum(axis=1) / (norm_a[i] * norm_b[j])
            hit = cosine >= threshold
            rows.append(i[hit])
            columns.append(j[hit])
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *rows]), np.concatenate([empty, *columns])


def least_reachable(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For every one of ``n`` nodes the smallest node that links within a tile lead to."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = np.minimum(label, label[label])
        if (label == before).all():
            return label


def _unpacked(keys, copies, vectors, codes, scale, error, dim: int, kind: type) -> dict:
    return {
        "keys": np.frombuffer(keys, np.int64),
        "copies": np.frombuffer(copies, np.int64),
        "vectors": np.frombuffer(vectors, kind).reshape(-1, dim),
        "codes": np.frombuffer(codes, np.int8).reshape(-1, dim),
        "scale": np.frombuffer(scale, np.float64),
        "error": np.frombuffer(error, np.float64),
    }


def _tiles(threshold: float, kind: type):
    columns = [f.split()[0] for f in BLOCK.split(", ")][2:]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each pair of blocks one row per linked vector: links in the tile, and the smallest vector reached there."""
        lean()
        for batch in batches:
            for row in range(batch.num_rows):
                one = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                a, b = (_unpacked(*(one[p + c] for c in columns), one["dim"], kind) for p in ("a_", "b_"))
                same = one["a_block"] == one["b_block"]
                i, j = tile_links(a, b, same, threshold)
                shift = 0 if same else len(a["keys"])
                keys = a["keys"] if same else np.concatenate([a["keys"], b["keys"]])
                copies = a["copies"] if same else np.concatenate([a["copies"], b["copies"]])
                j = j + shift
                links = np.bincount(i, copies[j], len(keys)) + np.bincount(j, copies[i], len(keys))
                order = np.argsort(keys)  # nodes numbered by key, so the smallest node is the smallest key
                place = np.empty_like(order)
                place[order] = np.arange(len(keys))
                root = keys[order][least_reachable(place[i], place[j], len(keys))][place]
                at = np.flatnonzero(links)
                parts = [pa.array(x, pa.int64()) for x in (keys[at], links[at].astype(np.int64), root[at])]
                yield pa.RecordBatch.from_arrays(parts, names=["_key", "links", "root"])

    return compare


def near_vectors(
    rows: DataFrame,
    space: Workspace,
    threshold: float = 0.9,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Rows link if their cosine, in double precision, is at least ``threshold`` (above 0). Equal vectors are compared
    once and count as often as they occur. Vectors are dealt to blocks of at most ``block_rows`` on average, and every
    pair of blocks is one tile; a tile returns a row per linked vector, never its pairs. All tiles are compared, so work
    grows with the square of the number of different vectors; no link is lost.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and vectors of different
    length do not link. Null ids are larger than any other. Rows that repeat an id are rows of their own. Empty tables
    give an empty result; other columns are not read.
    """
    spark = rows.sparkSession
    given = rows.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_vector"))
    good = given.filter(usable(F.col("_vector")))
    distinct = good.groupBy("_vector").agg(F.min("_id").alias("_least"), F.count("*").alias("_copies"))
    distinct = space.keep(distinct.withColumn("_key", F.monotonically_increasing_id()), "vectors")
    dims = {r["d"]: r["n"] for r in distinct.groupBy(F.size("_vector").alias("d")).agg(F.count("*").alias("n")).collect()}
    blocks = {d: -(-n // max(1, min(block_rows, BLOCK_BYTES // (8 * d) + 1))) for d, n in dims.items()}
    sizes = spark.createDataFrame(sorted(blocks.items()) or [(0, 1)], "dim int, n_blocks int")
    dealt = distinct.withColumn("dim", F.size("_vector")).join(F.broadcast(sizes), "dim")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("_key"), F.col("n_blocks")).cast("int"))
    packed = dealt.select("dim", "block", "_key", "_copies", "_vector").groupBy("dim", "block").applyInArrow(_pack_block, BLOCK)
    packed = space.keep(packed, "blocks")
    pairs = sizes.select("dim", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("a_block"), "n_blocks")
    pairs = pairs.select("dim", "a_block", F.explode(F.sequence("a_block", F.col("n_blocks") - 1)).alias("b_block"))
    a, b = (packed.select("dim", *[F.col(c).alias(p + c) for c in packed.columns[1:]]) for p in ("a_", "b_"))
    tiles = pairs.join(a, ["dim", "a_block"]).join(b, ["dim", "b_block"])
    tiles = tiles.repartition(max(1, sum(n * (n + 1) // 2 for n in blocks.values())))
    kind = np.float64 if rows.schema[vector_col].dataType.elementType.typeName() == "double" else np.float32
    found = space.keep(tiles.mapInArrow(_tiles(threshold, kind), "_key long, links long, root long"), "tile_links")
    counts = found.groupBy("_key").agg(F.sum("links").alias("_links"))
    group = components(found.filter("_key <> root").select("_key", "root"), space, "vector_groups")
    named = distinct.select("_key", "_vector", "_least", "_copies").join(counts, "_key", "left")
    named = named.join(group.withColumnRenamed("node", "_key"), "_key", "left")
    named = space.keep(named.withColumn("_group", F.coalesce("component", "_key")), "vectors_linked")
    least = named.groupBy("_group").agg(F.min("_least").alias("component_id"))
    named = named.join(least, "_group").select("_vector", "_links", "_copies", "component_id")
    # a null vector equals nothing, so rows without a direction find no partner here
    vector = F.when(usable(F.col("_vector")), F.col("_vector"))
    out = given.select("_id", vector.alias("_vector")).join(named, "_vector", "left")
    component = F.when(F.col("_copies").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    links = F.coalesce("_links", F.lit(0)) + F.coalesce("_copies", F.lit(1)) - 1
    return out.select(
        F.col("_id").alias(id_col),
        links.cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )
