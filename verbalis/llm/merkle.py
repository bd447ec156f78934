"""Merkle manifest of a table: levels as strings of concatenated hashes, hashed and cut by fixed-width substrings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from verbalis.llm.common import fold
from verbalis.session import Workspace

#: Nodes under one parent, hexadecimal digits of a node, and levels that a block holds as strings.
FAN, WIDTH, LEVELS = 8, 64, 3


def field(value: Column) -> Column:
    """A value for hashing: ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def plain_lower(text: Column) -> Column:
    """The text with A-Z in lower case; other letters stay."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, capitals, capitals.lower()))


def ranked(rows: DataFrame, order: list[str], space: Workspace, name: str) -> DataFrame:
    """``rows`` with ``rank``, their place from 0 within ``tree`` by ``order``; kept as a table.

    One range shuffle over (tree, order): a tree of any size is dealt over many tasks. A place is that within the task,
    less the tree's first one there, plus the tree's rows in earlier tasks.
    """
    placed = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = placed.withColumn("_task", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    placed = space.keep(placed, f"{name}_sorted")
    runs = placed.groupBy("tree", "_task").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("tree").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    total = F.sum("_n").over(Window.partitionBy("tree")).alias("nodes")
    runs = space.keep(runs.select("tree", "_task", "_first", "_before", total), f"{name}_runs")
    found = placed.join(runs, ["tree", "_task"])
    return found.withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before")).drop("_task", "_at", "_first", "_before")


def parents(level: Column) -> Column:
    """The level above: hashes of the runs of ``FAN`` nodes (the last run has fewer), as one string again."""
    run = FAN * WIDTH
    starts = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / run).cast("int"))
    return F.array_join(F.transform(starts, lambda k: F.sha2(F.substring(level, k * run + 1, F.lit(run)), 256)), "")


def blocks_of(nodes: DataFrame, payload: list[str], space: Workspace, name: str) -> DataFrame:
    """``tree, block, single, items, level_0 .. level_n, top``: aligned blocks of FAN ** LEVELS nodes of one tree.

    ``nodes`` has tree, rank, nodes (of the tree) and node. Each level is one string. Hashing goes on while the tree has
    several nodes left, so a tree that fits one block may need fewer levels; the others are null. ``top`` is the last.
    """
    size = FAN**LEVELS
    item = F.struct("rank", "node", *payload)
    rows = nodes.withColumn("block", F.floor(F.col("rank") / size))
    rows = rows.groupBy("tree", "block", (F.col("nodes") <= size).alias("single")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    rows = rows.withColumn("level_0", F.array_join(F.col("items").getField("node"), ""))
    for k in range(LEVELS):
        below = F.col(f"level_{k}")
        rows = rows.withColumn(f"level_{k + 1}", F.when(~F.col("single") | (F.length(below) > WIDTH), parents(below)))
    rows = rows.withColumn("top", F.coalesce(*[F.col(f"level_{k}") for k in range(LEVELS, -1, -1)]))
    return space.keep(rows, name)


def siblings(blocks: DataFrame, above: DataFrame | None, payload: list[str]) -> DataFrame:
    """``tree, rank, node, path`` and the payload for every node of ``blocks``.

    ``path`` has a (left, right) pair of sibling strings for every level that is hashed, from the node's own level to the
    root: the two segments of its run that flank it. ``above`` has the paths of the blocks' tops. The lowest level is cut
    into runs before rows multiply, so no row carries a block's whole level.
    """
    run = FAN * WIDTH
    starts = F.sequence(F.lit(0), F.floor((F.length("level_0") - 1) / run).cast("int"))
    parts = F.transform(
        starts, lambda k: F.struct(k.alias("k"), F.substring("level_0", k * run + 1, F.lit(run)).alias("run"), F.slice("items", k * FAN + 1, FAN).alias("some"))
    )
    upper = [f"level_{k}" for k in range(1, LEVELS + 1)]
    rows = blocks.select("tree", "block", *upper, F.explode(parts).alias("part"))
    pairs = []
    for k in range(1, LEVELS):
        step = FAN ** (k - 1)
        at = F.floor(F.col("part.k") / step).cast("int")
        pairs.append(_flanks(F.substring(f"level_{k}", F.floor(at / FAN).cast("int") * run + 1, F.lit(run)), at % FAN, F.col(f"level_{k + 1}").isNotNull()))
    rows = rows.select("tree", "block", "part", F.col("level_1").isNotNull().alias("hashed"), F.concat(*pairs).alias("higher"))
    if above is not None:
        rows = rows.join(above.withColumnRenamed("path", "_above"), ["tree", "block"], "left")
        rows = rows.withColumn("higher", F.concat("higher", F.coalesce("_above", F.array().cast("array<struct<left:string,right:string>>"))))
    rows = rows.select("tree", "hashed", "higher", F.col("part.run").alias("run"), F.posexplode("part.some").alias("at", "item"))
    path = F.concat(_flanks(F.col("run"), F.col("at"), F.col("hashed")), F.col("higher")).alias("path")
    return rows.select("tree", *[F.col(f"item.{c}").alias(c) for c in ("rank", "node", *payload)], path)


def _flanks(run: Column, at: Column, there: Column) -> Column:
    """The parts of ``run`` left and right of its node ``at``, as an array of one pair; empty if this level is not hashed."""
    pair = F.struct(
        F.substring(run, F.lit(1), at * WIDTH).alias("left"), F.substring(run, at * WIDTH + WIDTH + 1, F.lit(FAN * WIDTH)).alias("right")
    )
    return F.when(there, F.array(pair)).otherwise(F.array().cast("array<struct<left:string,right:string>>"))


def fold_up(node: Column, path: Column) -> Column:
    """The root that a node and its path lead to."""
    return F.aggregate(path, node, lambda now, x: F.sha2(F.concat(x["left"], now, x["right"]), 256))


def grown(nodes: DataFrame, payload: list[str], space: Workspace, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Tiers of blocks from ``nodes`` up, and ``tree, top`` of every tree. Tops of blocks are the next tier's nodes."""
    tiers, tops = [], []
    while True:
        blocks = blocks_of(nodes, payload if not tiers else [], space, f"{name}_tier_{len(tiers)}")
        tiers.append(blocks)
        tops.append(blocks.filter("single").select("tree", "top"))
        more = blocks.filter("not single").select("tree", F.col("block").alias("rank"), F.col("top").alias("node"))
        counts = more.groupBy("tree").agg(F.count("*").alias("nodes"))
        if counts.isEmpty():
            return tiers, reduce(DataFrame.unionByName, tops)
        nodes = more.join(counts, "tree")


def descended(tiers: list[DataFrame], above: DataFrame | None, payload: list[str], space: Workspace, name: str) -> DataFrame:
    """Paths of the lowest tier's nodes: paths of a tier's nodes are what lies above the blocks of the tier below.

    ``above`` has ``tree, path`` from each tree's top on, if that is not yet the root.
    """
    start = None if above is None else above.withColumnRenamed("path", "_start")
    for k in range(len(tiers) - 1, -1, -1):
        blocks, over = tiers[k], None
        if start is not None:
            over = blocks.filter("single").select("tree", "block").join(start, "tree").withColumnRenamed("_start", "path")
        if k + 1 < len(tiers):
            upper = found.select("tree", F.col("rank").alias("block"), "path")
            over = upper if over is None else over.unionByName(upper)
        found = siblings(blocks, over, payload if k == 0 else [])
        if k:
            found = space.keep(found.select("tree", "rank", "path"), f"{name}_paths_{k}")
    return found


def manifest(
    docs: DataFrame,
    space: Workspace,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "lang",
    text_col: str = "text",
    tampered: Column | None = None,
) -> DataFrame:
    """One row per input row: id, ``leaf, subroot, root``, ``path`` (pairs of sibling strings), and ``folded_root``.

    A row's leaf is the hash of ``columns``. Per value of ``group_col`` (null is one, and comes first) leaves ascend by id
    and are hashed in runs of eight until one node, the subroot, is left; subroots are hashed likewise to the root.
    ``folded_root`` starts from the leaf that the row has now: where ``tampered`` holds, its text's A-Z are lower-case.

    Texts are hashed where they are read and never shuffled; ids and hashes are sorted once. Blocks of 512 nodes keep a
    level as one string; tops of blocks are nodes of the next tier, so no task ever holds a tree, however large one group
    is. Null ids come first, rows that repeat an id are ordered by their leaves, equal rows have equal leaves but places
    of their own. A null id counts as an empty text for tampering. An empty table gives an empty result. Columns that
    are not named are not read.
    """
    changed = fold(F.col(id_col), 3) == 0 if tampered is None else tampered
    was = [F.col(c) for c in columns]
    now = [plain_lower(F.col(c)) if c == text_col else F.col(c) for c in columns]
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("tree")
    rows = docs.select(F.col(id_col).alias("id"), group, leaf(was).alias("node"), F.when(changed, leaf(now)).alias("_other"))
    rows = rows.withColumn("now", F.coalesce("_other", "node")).drop("_other")
    nodes = ranked(rows, ["id", "node", "now"], space, "leaves")
    tiers, subroots = grown(nodes, ["id", "now"], space, "groups")
    subroots = space.keep(subroots.select(F.col("tree").alias("name"), F.col("top").alias("node")), "subroots")
    tops = ranked(subroots.withColumn("tree", F.lit("")), ["name"], space, "tops")
    top_tiers, root = grown(tops, ["name"], space, "root")
    above = descended(top_tiers, None, ["name"], space, "root").select(F.col("name").alias("tree"), F.col("node").alias("subroot"), "path")
    above = space.keep(above, "above")
    paths = descended(tiers, above.select("tree", "path"), ["id", "now"], space, "groups")
    out = paths.join(above.select("tree", "subroot"), "tree").crossJoin(F.broadcast(root.select(F.col("top").alias("root"))))
    return out.select(
        F.col("id").alias(id_col),
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        "path",
        fold_up(F.col("now"), F.col("path")).alias("folded_root"),
    )
