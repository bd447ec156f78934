"""Mixing overlapping sources to target weights: min-cost flow over membership patterns, then seeded documents."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from verbalis.llm.common import WORD_RUN, columns_of, whole_row, whole_text
from verbalis.session import Workspace

#: Sources and patterns are settings of a mix, not data; more of them raise an error instead of filling the driver.
MAX_PATTERNS = 20_000


def words_in(text: str | Column) -> Column:
    """Number of words of the text; null has none."""
    return F.regexp_count(whole_text(text), F.lit(WORD_RUN)).cast("long")


def capped_targets(sizes: list[int], weights: list[float], repeats: int) -> list[float]:
    """Shares of all sizes by weight, none above ``repeats`` times its size; the excess goes to the others by weight."""
    total, capped = float(sum(sizes)), set()
    targets = [0.0] * len(sizes)
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        rest = total - sum(repeats * sizes[i] for i in capped)
        weight = sum(weights[i] for i in free)
        for i in capped:
            targets[i] = float(repeats * sizes[i])
        for i in free:
            targets[i] = rest * weights[i] / weight if weight else 0.0
        above = {i for i in free if targets[i] > repeats * sizes[i]}
        if not above:
            return targets
        capped |= above


def whole_quotas(targets: list[float]) -> list[int]:
    """Targets as whole words with the same sum: the largest fractions are rounded up."""
    floors = [int(t) for t in targets]
    missing = round(sum(targets)) - sum(floors)
    order = sorted(range(len(targets)), key=lambda i: (floors[i] - targets[i], i))
    for i in order[: max(0, missing)]:
        floors[i] += 1
    return floors


def least_cost_routes(
    sizes: list[int], members: list[tuple[int, ...]], quotas: list[int], repeats: int
) -> dict[tuple[int, int], int]:
    """Words routed from each pattern to each source, as many as quotas and capacities allow, at the least cost.

    A pattern offers its words up to ``repeats`` times; the k-th round costs k - 1 a word, so the cost is convex and
    fresh words are used before repeated ones wherever sources overlap. Shortest augmenting paths with potentials.
    """
    p, s = len(sizes), len(quotas)
    start, end = p + s, p + s + 1
    edges: list[list[int]] = []  # to, capacity, cost; the reverse edge is at index ^ 1
    out: list[list[int]] = [[] for _ in range(p + s + 2)]

    def add(a: int, b: int, capacity: int, cost: int) -> None:
        out[a].append(len(edges))
        edges.append([b, capacity, cost])
        out[b].append(len(edges))
        edges.append([a, 0, -cost])

    for i, size in enumerate(sizes):
        for k in range(repeats):
            add(start, i, size, k)
        for j in members[i]:
            add(i, p + j, repeats * size, 0)
    for j, quota in enumerate(quotas):
        add(p + j, end, quota, 0)
    level = [0] * len(out)
    while True:
        far: list[float] = [float("inf")] * len(out)
        came = [-1] * len(out)
        far[start], queue = 0, [(0, start)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in out[a]:
                b, capacity, cost = edges[e]
                if capacity and (n := d + cost + level[a] - level[b]) < far[b]:
                    far[b], came[b] = n, e
                    heapq.heappush(queue, (n, b))
        if far[end] == float("inf"):
            break
        level = [x + (y if y < float("inf") else far[end]) for x, y in zip(level, far)]
        path, at = [], end
        while at != start:
            path.append(came[at])
            at = edges[came[at] ^ 1][0]
        pushed = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= pushed
            edges[e ^ 1][1] += pushed
    flows = {}
    for i in range(p):
        for e in out[i]:
            if e % 2 == 0 and p <= (j := edges[e][0]) < p + s and edges[e ^ 1][1]:
                flows[i, j - p] = edges[e ^ 1][1]
    return flows


@dataclass
class Mix:
    """A solved mix: ``cuts`` has one row per pattern (pattern, rounds, cut), the others are per source in order."""

    cuts: DataFrame
    sources: list[str | None]
    sizes: list[int]
    targets: list[float]
    flows: dict[tuple[int, int], int]
    seed: int


def draw(seed: int, docs: DataFrame, id_col: str) -> Column:
    """The place of a row in the seeded order: by its id and its other columns, so rows that share an id are apart."""
    hashed = [f.name for f in docs.schema if f.name != id_col and f.dataType.typeName() not in ("map", "variant")]
    return F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in sorted(hashed)])


def _cuts(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """For every pattern the hash up to which documents are taken once more, so that their words come nearest ``rest``.

    The hash is narrowed by 256 parts twice, with sums per part; only documents in the last part are ranked.
    """
    spark = sized.sparkSession
    docs = sized.join(F.broadcast(wanted), sized["_pattern"].eqNullSafe(wanted["_wanted"])).drop("_wanted")
    docs = docs.select("_pattern", "_size", "_hash", F.col("_rest"), F.lit(0).cast("long").alias("_before"))
    for shift in (56, 48):
        part = F.shiftright("_hash", shift)
        parts = docs.groupBy("_pattern", part.alias("_part")).agg(
            F.sum("_size").alias("_words"), F.max("_rest").alias("_rest"), F.max("_before").alias("_before")
        )
        upto = F.sum("_words").over(Window.partitionBy("_pattern").orderBy("_part")) + F.col("_before")
        parts = parts.withColumn("_upto", upto).withColumn("_under", F.col("_upto") - F.col("_words"))
        here = parts.filter("_under < _rest and _rest <= _upto").select(
            F.col("_pattern").alias("_p"), F.col("_part").alias("_at"), F.col("_under")
        )
        hit = docs["_pattern"].eqNullSafe(here["_p"]) & (F.shiftright(docs["_hash"], shift) == here["_at"])
        docs = docs.join(F.broadcast(here), hit).select(
            "_pattern", "_size", "_hash", "_rest", F.col("_under").alias("_before")
        )
    tied = docs.groupBy("_pattern", "_hash", "_rest", "_before").agg(F.sum("_size").alias("_words"))
    upto = F.sum("_words").over(Window.partitionBy("_pattern").orderBy("_hash")) + F.col("_before")
    inside = tied.withColumn("_mid", upto - F.col("_words") / 2)
    lowest = F.shiftleft(F.shiftright("_hash", 48), 48) - 1  # all documents of earlier parts
    cut = inside.groupBy("_pattern").agg(
        F.coalesce(F.max(F.when(F.col("_mid") <= F.col("_rest"), F.col("_hash"))), F.min(lowest)).alias("cut")
    )
    out = wanted.join(F.broadcast(cut), wanted["_wanted"].eqNullSafe(cut["_pattern"]), "left")
    return spark.createDataFrame(
        out.select(F.col("_wanted").alias("pattern"), F.col("_rounds").alias("rounds"), "_rest", "cut").toArrow()
    )


def _nearer(sized: DataFrame, cuts: DataFrame) -> DataFrame:
    """``cuts`` with ``swap``, the hash of one document per pattern whose taking or leaving brings the words nearer."""
    inside = F.coalesce(F.col("_hash") <= F.col("cut"), F.lit(False))
    docs = sized.join(F.broadcast(cuts.filter("_rest > 0")), sized["_pattern"].eqNullSafe(cuts["pattern"]))
    docs = docs.select("_pattern", "_size", "_hash", "_rest", inside.alias("_in"))
    gaps = docs.groupBy("_pattern").agg(
        (F.max("_rest") - F.sum(F.when(F.col("_in"), F.col("_size")).otherwise(0))).alias("_gap")
    )
    gaps = gaps.select(F.col("_pattern").alias("_p"), "_gap")
    change = F.when(F.col("_in"), -F.col("_size")).otherwise(F.col("_size"))
    left = F.abs(F.col("_gap") - change)
    near = docs.join(F.broadcast(gaps), docs["_pattern"].eqNullSafe(gaps["_p"])).filter(left < F.abs("_gap"))
    best = near.groupBy("_pattern").agg(F.min(F.struct(left.alias("left"), F.col("_hash").alias("swap"))).alias("_best"))
    best = best.select(F.col("_pattern").alias("_q"), "_best.swap")
    return cuts.join(F.broadcast(best), cuts["pattern"].eqNullSafe(best["_q"]), "left").drop("_q")


def solve_mix(
    docs: DataFrame,
    space: Workspace,
    membership: Column,
    size: Column,
    weights=None,
    id_col: str = "doc_id",
    repeats: int = 3,
    seed: int = 17,
) -> Mix:
    """Route words of membership patterns to source quotas.

    ``membership`` is an array of source names, null being a source too; ``weights`` gives the weight of the i-th source
    in code-point order, null last (1, 2, 3 and again, if it is not given). Documents are summed up by pattern, so the
    driver sees one row per pattern, at most ``MAX_PATTERNS`` (checked). Rows that are equal in all columns share their
    place in the seeded order and are taken together. Words still missing or too many at a cut are evened out by one document.
    """
    sized = docs.select(
        F.array_sort(F.array_distinct(membership)).alias("_pattern"), size.alias("_size"), draw(seed, docs, id_col).alias("_hash")
    )
    sized = space.keep(sized, "mix_sizes")
    found = sized.groupBy("_pattern").agg(F.sum("_size").alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"a mix takes at most {MAX_PATTERNS} membership patterns")
    found = sorted(found, key=lambda r: [(x is None, x or "") for x in r["_pattern"] or []])
    patterns, sizes = [list(r["_pattern"] or []) for r in found], [int(r["n"] or 0) for r in found]
    names = sorted({x for p in patterns for x in p}, key=lambda x: (x is None, (x or "").encode()))
    place = {x: i for i, x in enumerate(names)}
    weights = weights or (lambda i: i % 3 + 1)
    members = [tuple(place[x] for x in p) for p in patterns]
    # a source's own size counts every document that is a member of it
    own = [sum(n for n, m in zip(sizes, members) if i in m) for i in range(len(names))]
    raw = capped_targets(own, [float(weights(i)) for i in range(len(names))], repeats)
    # overlapping sources count some words twice; targets share the words that exist
    scale = sum(sizes) / sum(own) if sum(own) else 1.0
    targets = [t * scale for t in raw]
    flows = least_cost_routes(sizes, members, whole_quotas(targets), repeats)
    rows = []
    for i, (pattern, n) in enumerate(zip(patterns, sizes)):
        routed = sum(w for (a, _), w in flows.items() if a == i)
        rows.append((pattern, routed // n if n else 0, routed % n if n else 0))
    wanted = docs.sparkSession.createDataFrame(rows, "_wanted array<string>, _rounds long, _rest long")
    cuts = _nearer(sized, _cuts(sized, wanted))
    return Mix(docs.sparkSession.createDataFrame(cuts.toArrow()), names, own, targets, flows, seed)


def _taken(docs: DataFrame, mix: Mix, membership: Column, id_col: str) -> DataFrame:
    """``_row`` and ``_times``, how often the mix takes it. One narrow pass: patterns are few (checked)."""
    place = draw(mix.seed, docs, id_col).alias("_place")
    rows = docs.select(whole_row(docs), F.array_sort(F.array_distinct(membership)).alias("_pattern"), place)
    joined = rows.join(F.broadcast(mix.cuts), rows["_pattern"].eqNullSafe(mix.cuts["pattern"]), "left")
    inside = F.coalesce(F.col("_place") <= F.col("cut"), F.lit(False))
    swapped = F.coalesce(F.col("_place") == F.col("swap"), F.lit(False))
    more = F.when(inside != swapped, 1).otherwise(0)
    return joined.select("_row", (F.coalesce("rounds", F.lit(0)) + more).cast("long").alias("_times"))


def times_taken(
    docs: DataFrame, mix: Mix, membership: Column, id_col: str = "doc_id", name: str = "times_taken"
) -> DataFrame:
    """``docs`` with a column ``name`` (it replaces one of that name), how often the mix takes each row."""
    return _taken(docs, mix, membership, id_col).select(*columns_of(docs, {name}), F.col("_times").alias(name))


def mixed(docs: DataFrame, space: Workspace, source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The documents of the mix: a document taken twice is two rows, one not taken is none. Columns as they were.

    Null text has no words; null is a source of its own; an empty table gives an empty result.
    """
    member = F.array(source_col)
    mix = solve_mix(docs, space, member, words_in(text_col), **options)
    taken = _taken(docs, mix, member, options.get("id_col", "doc_id")).filter("_times > 0")
    copies = taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    return copies.select(*columns_of(docs))
