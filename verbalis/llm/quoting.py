"""Quotation linking: nested quotes are parsed, matched to the messages they come from, and conversations are ordered by reply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbalis.llm.common import SPACE_RUN, folded, whole_text
from verbalis.session import Workspace

#: Quote marks at the start of a line: one level for each.
MARKS = r"^[ \t]*((?:>[ \t]?)+)"
#: How the line that introduces a quote ends.
INTRODUCTION = r"(wrote|writes|schrieb|schreibt|a écrit|escribió)\s*:\s*$"
#: Turns of a conversation that one sort group holds; longer conversations are carried from group to group.
SPAN = 1024


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACE_RUN, " "))


def parsed(text: str | Column) -> Column:
    """The lines of a text as (level, body): the number of quote marks, and the line without them."""
    line = F.split(whole_text(text), "\n", -1)
    return F.transform(
        line,
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 1), "[^>]", "")).alias("level"),
            F.regexp_replace(x, MARKS, "").alias("body"),
        ),
    )


def _introduces(lines: Column, i: Column) -> Column:
    """Whether line ``i`` only introduces the quote that follows it."""
    here, behind = F.get(lines, i), F.get(lines, i + 1)
    return (here["level"] == 0) & F.coalesce(behind["level"] > 0, F.lit(False)) & here["body"].rlike(INTRODUCTION)


def unquoted(lines: Column, text: Column) -> Column:
    """The text without quoted lines and their introductions; a text without quotes stays as it is."""
    own = F.filter(lines, lambda x, i: (x["level"] == 0) & ~_introduces(lines, i))
    rest = F.btrim(F.array_join(F.transform(own, lambda x: x["body"]), "\n"), F.lit(" \t\n\r"))
    return F.when(F.exists(lines, lambda x: x["level"] > 0), rest).otherwise(whole_text(text))


def passages(lines: Column) -> Column:
    """(level, normalised text): every line that is not blank, and every paragraph of more than one line.

    A paragraph is a run of such lines of one level, so quotes that were wrapped anew still match.
    """
    full = lambda x: F.length(_plain(x["body"])) > 0
    goes_on = lambda i: (
        (i >= 0)
        & F.coalesce(full(F.get(lines, i)), F.lit(False))
        & F.coalesce(full(F.get(lines, i + 1)), F.lit(False))
        & F.coalesce(F.get(lines, i)["level"] == F.get(lines, i + 1)["level"], F.lit(False))
    )
    at = F.sequence(F.lit(0), F.size(lines) - 1)
    starts = F.filter(at, lambda i: full(F.get(lines, i)) & ~goes_on(i - 1) & goes_on(i))
    ends = F.filter(at, lambda i: goes_on(i - 1) & ~goes_on(i))
    single = F.filter(lines, full)
    pick = lambda level, text: F.struct(level.alias("level"), text.alias("text"))
    one = F.transform(single, lambda x: pick(x["level"], _plain(x["body"])))
    many = F.transform(
        F.arrays_zip(starts.alias("s"), ends.alias("e")),
        lambda r: pick(
            F.get(lines, r["s"])["level"],
            _plain(F.array_join(F.transform(F.slice(lines, r["s"] + 1, r["e"] - r["s"] + 1), lambda x: x["body"]), " ")),
        ),
    )
    return F.concat(one, many)


def latest(rows: DataFrame, keys: list[str], turn: str, value: str, name: str, own: bool) -> DataFrame:
    """``rows`` with the largest ``value`` of the rows of equal keys at earlier turns (``own``: at the same turn, too).

    Turns are sorted in spans, and a span takes over the largest value of all earlier spans, so a key of very many rows
    is sorted in many tasks.
    """
    spanned = rows.withColumn("_span", F.floor(F.col(turn) / SPAN))
    within = Window.partitionBy(*keys, "_span").orderBy(turn).rangeBetween(Window.unboundedPreceding, 0 if own else -1)
    spans = spanned.groupBy(*keys, "_span").agg(F.max(value).alias("_most"))
    earlier = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.withColumn("_carried", F.max("_most").over(earlier)).filter("_carried is not null")
    carried = carried.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_span").alias("__span"), "_carried")
    same = F.col("_span") == F.col("__span")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = spanned.withColumn(name, F.max(value).over(within)).join(carried, same, "left")
    return joined.withColumn(name, F.greatest(name, "_carried")).select(*rows.columns, name)


def quote_parents(messages: DataFrame) -> DataFrame:
    """``conv, turn, parent``: for every turn with quotes the turn that most of its outermost quoted text comes from.

    A quoted passage comes from the latest earlier turn of the conversation that has it unquoted. Of the passages of the
    lowest quote level that was found anywhere, the turn with most characters wins, then the latest.
    """
    units = messages.select("conv", "turn", F.explode(passages(F.col("lines"))).alias("u"))
    units = units.select("conv", "turn", "u.level", F.unhex(F.md5(folded(F.col("u.text")))).alias("hash"), F.length("u.text").alias("chars"))
    units = units.withColumn("source", F.when(F.col("level") == 0, F.col("turn")))
    found = latest(units, ["conv", "hash"], "turn", "source", "parent", own=False)
    votes = found.filter("level > 0 and parent is not null").groupBy("conv", "turn", "level", "parent")
    votes = votes.agg(F.sum("chars").alias("chars"))
    best = F.min(F.struct("level", (-F.col("chars")).alias("chars"), (-F.col("parent")).alias("parent")))
    return votes.groupBy("conv", "turn").agg((-best["parent"]).alias("parent"))


def _paths(segments: DataFrame, space: Workspace) -> DataFrame:
    """``conv, head, path``: where a branch leaves its conversation, level by level; paths double in every round."""
    now = segments.select(
        "conv",
        "head",
        F.col("parent_head").alias("up"),
        F.when(F.col("parent").isNull(), F.array().cast("array<struct<back:bigint,head:bigint>>"))
        .otherwise(F.array(F.struct((-F.col("parent")).alias("back"), "head")))
        .alias("path"),
    )
    turn = 0
    while True:
        now = space.keep(now, f"paths_{turn}")
        if now.filter("up is not null").isEmpty():
            return now.select("conv", "head", "path")
        above = now.select(
            F.col("conv").alias("c"), F.col("head").alias("h"), F.col("up").alias("higher"), F.col("path").alias("before")
        )
        joined = now.join(above, F.col("conv").eqNullSafe(F.col("c")) & (F.col("up") == F.col("h")), "left")
        path = F.concat(F.coalesce("before", F.array().cast("array<struct<back:bigint,head:bigint>>")), "path")
        now = joined.select("conv", "head", F.col("higher").alias("up"), path.alias("path"))
        turn += 1


def _ranked(rows: DataFrame, space: Workspace) -> DataFrame:
    """``reply_order`` by path and turn within each conversation; a long conversation is ranked part by part."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "conv", "path", "turn").withColumn("part", F.spark_partition_id())
    ranged = space.keep(ranged, "ranged")
    sizes = ranged.groupBy("conv", "part").count()
    before = F.sum("count").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(F.col("conv").alias("c"), F.col("part").alias("p"), F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("conv", "part").orderBy("path", "turn"))
    joined = ranged.withColumn("at", within).join(sizes, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    return joined.withColumn("reply_order", F.col("at") + F.col("before") - 1)


def reply_ordered(
    messages: DataFrame,
    space: Workspace,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per message: conversation, turn, role, text without quotes, parent_turn, link, depth, reply_order.

    A message that quotes replies to the message it quotes (``link`` is ``quote``), any other to the one before it
    (``previous``); the first is the ``root``. Quotes are matched by whole lines and whole paragraphs; a quote of a part of
    a line finds nothing. A branch begins where a message quotes another one than that right before it, so a plain thread
    has none, however long. ``depth`` counts the branches that lead to a message, and
    ``reply_order`` counts messages from 0 so that every message follows the one it replies to: first the answer that
    comes next, then later ones, each with all that follows from it.

    Null text is empty. A null conversation is one of its own. Rows that repeat a conversation and turn are one message:
    they share links and order. Rows without a turn have no links and no order. Empty tables give an empty result; other
    columns are not read. ``link`` of messages without a turn is null.
    """
    given = messages.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    read = given.withColumn("lines", parsed("text"))
    ordered = read.filter("turn is not null")
    parents = space.keep(quote_parents(ordered.select("conv", "turn", "lines")), "quote_parents")
    parents = parents.select(F.col("conv").alias("c"), F.col("turn").alias("t"), "parent")
    nodes = given.select("conv", "turn").filter("turn is not null").distinct()
    nodes = nodes.join(parents, F.col("conv").eqNullSafe(F.col("c")) & (F.col("turn") == F.col("t")), "left")
    nodes = latest(nodes.select("conv", "turn", "parent"), ["conv"], "turn", "turn", "previous", own=False)
    # a message that quotes the one right before it goes on in its branch
    nodes = nodes.withColumn("start", F.when(F.col("parent") != F.col("previous"), F.col("turn")))
    nodes = latest(nodes, ["conv"], "turn", "start", "branch", own=True)
    first = F.lit(-(1 << 62))  # the branch that a conversation begins with
    nodes = space.keep(nodes.withColumn("head", F.coalesce("branch", first)), "nodes")
    starts = nodes.filter("start is not null").select("conv", F.col("turn").alias("head"), "parent")
    at = nodes.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("head").alias("parent_head"))
    starts = starts.join(at, F.col("conv").eqNullSafe(F.col("c")) & (F.col("parent") == F.col("t")), "left")
    trunk = F.when(F.col("parent_head") != first, F.col("parent_head")).alias("parent_head")
    paths = _paths(starts.select("conv", "head", "parent", trunk), space)
    paths = paths.select(F.col("conv").alias("c"), F.col("head").alias("h"), "path")
    placed = nodes.join(paths, F.col("conv").eqNullSafe(F.col("c")) & (F.col("head") == F.col("h")), "left")
    empty = F.array().cast("array<struct<back:bigint,head:bigint>>")
    placed = placed.select("conv", "turn", "parent", "previous", F.coalesce("path", empty).alias("path"))
    link = F.when(F.col("parent").isNotNull(), "quote").when(F.col("previous").isNotNull(), "previous").otherwise("root")
    ranked = _ranked(placed, space).select(
        F.col("conv").alias("c"),
        F.col("turn").alias("t"),
        F.coalesce("parent", "previous").alias("parent_turn"),
        link.alias("link"),
        F.size("path").alias("depth"),
        F.col("reply_order").cast("long").alias("reply_order"),
    )
    clean = read.select("conv", "turn", "role", unquoted(F.col("lines"), F.col("text")).alias("text"))
    out = clean.join(ranked, F.col("conv").eqNullSafe(F.col("c")) & (F.col("turn") == F.col("t")), "left")
    return out.select(
        F.col("conv").alias(conv_col),
        F.col("turn").alias(turn_col),
        F.col("role").alias(role_col),
        F.col("text").alias(text_col),
        "parent_turn",
        "link",
        "depth",
        "reply_order",
    )
