"""Prediction by partial matching: a byte-context trie with escapes and symbol exclusion scores whole texts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from verbalis.llm.common import fold, lean, short_batches, small_batches
from verbalis.llm.texthash import U, Words, mix, words_of
from verbalis.session import Workspace

#: Bytes that no UTF-8 text contains: before the text, and its end, which is a symbol of the alphabet.
BEFORE, END = 0xFF, 0xFE
ALPHABET = 257
ORDER = 5
#: A block ends at so many bytes of text, or at so many different grams and words, whichever comes first.
BLOCK_BYTES, BLOCK_KEYS = 48 << 20, 1_600_000
#: Bytes of text that are worked on at a time; longer texts are cut into segments behind white space.
CHUNK = 1 << 18
#: Keys of words have the sign bit, keys of grams do not reach it.
WORD = U(1 << 63)


class Segments(NamedTuple):
    """Lower-cased texts or parts of them, the bytes before each one, and whether the text ends with it."""

    texts: list[bytes]
    heads: list[bytes]
    last: list[bool]


def gram_keys(parts: Segments, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(context and symbol of every position as one number, where each part starts): ``order`` bytes, then the symbol."""
    data = b"".join(h + t + (bytes([END]) if x else b"") for h, t, x in zip(parts.heads, parts.texts, parts.last))
    data = np.frombuffer(data, np.uint8).astype(U)
    keys = np.zeros(max(0, len(data) - order), U)
    for j in range(order + 1):
        keys <<= U(8)
        keys |= data[j : j + len(keys)]
    sizes = np.fromiter(map(len, parts.texts), np.int64, len(parts.texts)) + np.array(parts.last, np.int64)
    starts = np.cumsum(sizes) - sizes
    # the key at a place has its symbol ``order`` bytes on; keys whose symbol stands in a head belong to no part
    heads = (starts + order * np.arange(len(starts)))[1:, None] + np.arange(order) - order
    inside = np.ones(len(keys), bool)
    inside[heads.ravel() if len(heads) else []] = False
    return keys[inside], starts


def word_keys(texts: list[bytes]) -> Words:
    words = words_of(texts)
    return words._replace(hash=words.hash | WORD)


class _Counts:
    """Sorted keys with their counts; additions are merged whenever they have grown as large as what is there."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counted: bool) -> None:
        found, n = np.unique(keys, return_counts=True)
        self.parts.append((found, n if counted else np.zeros(len(found), np.int64)))
        self.waiting += len(found) if len(self.parts) > 1 else 0
        if self.waiting > max(1 << 18, len(self.parts[0][0]) // 4):
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            (base, total), *rest = self.parts
            self.parts = []
            keys, n = (np.concatenate(x) for x in zip(*rest))
            order = np.argsort(keys)
            keys, n = keys[order], n[order]
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
            keys, n = keys[at], np.add.reduceat(n, at) if len(at) else n
            # known keys are counted in place, new ones put between them: what is there is not sorted again
            place = np.searchsorted(base, keys)
            known = np.zeros(len(keys), bool)
            inside = place < len(base)
            known[inside] = base[place[inside]] == keys[inside]
            total[place[known]] += n[known]
            keys, n, place = keys[~known], n[~known], place[~known]
            base = np.insert(base, place, keys)
            self.parts = [(base, np.insert(total, place, n))]
        self.waiting = 0
        return self.parts[0] if self.parts else (np.empty(0, U), np.empty(0, np.int64))

    def size(self) -> int:
        """How many keys there are, at most."""
        return self.waiting + (len(self.parts[0][0]) if self.parts else 0)


SEGMENT = pa.schema([("doc_id", pa.null()), ("held_out", pa.bool_()), ("text", pa.binary()), ("head", pa.binary()), ("last", pa.bool_()), ("cut", pa.int64())])


def segments(batch: pa.RecordBatch, order: int, number: int, longest: int) -> Iterator[pa.RecordBatch]:
    """The rows with lower-cased text; a row with a long text becomes several, marked with ``number``, that follow on.

    Cuts stand behind white space, so no word is cut; a word longer than ``longest`` stays whole.
    """
    texts = [(t or "").encode().lower() for t in batch.column("text").to_pylist()]
    schema = SEGMENT.set(0, batch.schema.field("doc_id"))
    begin = bytes([BEFORE]) * order
    if len(texts) != 1 or len(texts[0]) <= longest:
        rest = [pa.array(texts, pa.binary()), pa.array([begin] * len(texts)), pa.array([True] * len(texts)), pa.nulls(len(texts), pa.int64())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *rest], schema=schema)
        return
    text, at = texts[0], 0
    space = re.compile(rb"[\x20\x09-\x0D]")
    while at < len(text):
        found = space.search(text, at + longest)
        end = found.end() if found else len(text)
        head = (begin + text[max(0, at - order) : at])[-order:] if order else b""
        one = [pa.array([text[at:end]], pa.binary()), pa.array([head]), pa.array([end == len(text)]), pa.array([number])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *one], schema=schema)
        at = end


def _parts(batch: pa.RecordBatch, rows: np.ndarray | None = None) -> Segments:
    columns = [batch.column(c).to_pylist() for c in ("text", "head", "last")]
    if rows is not None:
        columns = [[c[i] for i in rows] for c in columns]
    return Segments(*columns)


def _blocks(order: int, block_bytes: int, block_keys: int, longest: int):
    schema = pa.schema([("block", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("docs", pa.binary())])

    def rows(block: int, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(keys), 1 << 16):
            part = pa.array(keys[at : at + (1 << 16)].view(np.int64))
            size = len(part)
            columns = [pa.array(np.full(size, block)), part, pa.array(n[at : at + size]), pa.nulls(size, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of texts: a row with the texts themselves, and one per distinct gram and word."""
        lean()
        block = number = TaskContext.get().partitionId() << 32
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        counts, out, size = _Counts(), None, 0

        def flushed() -> Iterator[pa.RecordBatch]:
            out.close()
            one = [pa.array([block]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())]
            held = sink.getvalue()
            ends = pa.py_buffer(np.array([0, held.size], np.int32))
            yield pa.RecordBatch.from_arrays([*one, pa.Array.from_buffers(pa.binary(), 1, [None, ends, held])], schema=schema)
            yield from rows(block, *counts.merged())

        for given in small_batches(batches, "text", longest):
            number += 1
            for batch in segments(given, order, number, longest):
                if out is None:
                    sink = pa.BufferOutputStream()
                    out = pa.ipc.new_stream(sink, batch.schema, options=options)
                out.write_batch(batch)
                learned = ~batch.column("held_out").to_numpy(zero_copy_only=False)
                for part in (True, False):
                    some = np.flatnonzero(learned == part)
                    if len(some):
                        parts = _parts(batch, some)
                        counts.add(gram_keys(parts, order)[0], part)
                        counts.add(word_keys(parts.texts).hash, part)
                        size += sum(map(len, parts.texts))
                if size >= block_bytes or counts.size() >= block_keys:
                    yield from flushed()
                    block, counts, out, size = block + 1, _Counts(), None, 0
                    lean()
        if out is not None:
            yield from flushed()

    return cut


def _log(x: Column) -> Column:
    return F.log10(x)


def trie_values(grams: DataFrame, order: int, space: Workspace) -> DataFrame:
    """``key, value``: log10 probability of the last byte of every gram after the bytes before it.

    ``grams`` has ``key`` (``order`` context bytes and a symbol) and ``n``, its count in the training texts; grams of
    other texts have 0. A context of any length is the end of longer ones, so each table comes from the next longer one.
    Counts of shorter contexts are updated with exclusion: a symbol counts once for every longer context it follows.
    From the empty context upwards each table adds to every gram: N and T, total and number of different symbols of its
    context, and two values. With c' the context without its first byte:

    * below: the symbol after c', if the symbols seen after c are excluded (escape method D: of N counts every seen
      symbol gives up one half, and these halves are the chance of an escape);
    * fresh: the symbol after c without exclusion, or after c' if c was never seen.

    A symbol seen after c was seen after c', so what is excluded at c' is known from c alone, and values of all grams
    come from one join and one window per order. Contexts have at most 257 symbols, so no group is large.
    """
    tables = [grams.select("key", "n")]
    for j in range(order - 1, -1, -1):
        mask = F.lit((1 << (8 * (j + 1))) - 1)
        shorter = tables[-1].groupBy(F.col("key").bitwiseAND(mask).alias("key")).agg(
            F.sum((F.col("n") > 0).cast("long")).alias("n")
        )
        tables.append(space.keep(shorter, f"grams_{j}"))
    known = None
    for j, table in enumerate(reversed(tables)):
        context = Window.partitionBy(F.shiftright("key", 8))
        total, kinds = F.sum("n").over(context), F.sum((F.col("n") > 0).cast("long")).over(context)
        if j == 0:
            rows = table.withColumn("total", total).withColumn("kinds", kinds)
            rows = rows.withColumn("below", -_log(F.greatest(F.lit(ALPHABET) - F.col("kinds"), F.lit(1)).cast("double")))
            unseen = F.lit(-float(np.log10(ALPHABET)))
        else:
            low = known.select(F.col("key").alias("low"), *[F.col(c).alias(f"low_{c}") for c in known.columns[1:]])
            mask = F.lit((1 << (8 * j)) - 1)
            rows = table.join(low, F.col("key").bitwiseAND(mask) == F.col("low"))
            rows = rows.withColumn("total", total).withColumn("kinds", kinds)
            out = F.sum(F.when(F.col("n") > 0, F.col("low_n")).otherwise(0)).over(context)
            rows = rows.withColumn("rest", F.col("low_total") - out).withColumn("others", F.col("low_kinds") - F.col("kinds"))
            here = F.when(F.col("low_n") > 0, _log((F.col("low_n") - 0.5) / F.col("rest"))).otherwise(
                _log(F.col("others") / 2 / F.col("rest")) + F.col("low_below")
            )
            rows = rows.withColumn("below", F.when(F.col("others") > 0, here).otherwise(F.col("low_below")))
            unseen = F.col("low_fresh")
        fresh = (
            F.when(F.col("total") == 0, unseen)
            .when(F.col("n") > 0, _log((F.col("n") - 0.5) / F.col("total")))
            .otherwise(_log(F.col("kinds") / 2 / F.col("total")) + F.col("below"))
        )
        rows = rows.select("key", "n", "total", "kinds", "below", fresh.alias("fresh"))
        known = space.keep(rows, f"trie_{j}")
    return known.select("key", F.col("fresh").alias("value"))


class _Lookup:
    """Places of keys in an array, by open addressing; every key asked for is there."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(len(keys) * 3).bit_length())
        self.keys, self.shift, self.mask = keys, U(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(keys), dtype=np.int32), self._home(keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys * U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = self._home(keys)
        found = self.slots[out]
        wrong = np.flatnonzero(self.keys[found] != keys)
        at = out[wrong]
        while len(wrong):
            at = (at + 1) & self.mask
            found[wrong] = self.slots[at]
            still = self.keys[found[wrong]] != keys[wrong]
            wrong, at = wrong[still], at[still]
        return found


def _score_block(order: int):
    def score(docs: pa.Table, values: pa.Table) -> pa.Table:
        """Scores of one block's texts from the values of its grams and words."""
        lean()
        keys = values.column("key").combine_chunks().to_numpy().view(U)
        value = values.column("value").combine_chunks().to_numpy()
        place = _Lookup(keys)
        out = []
        for batch in pa.ipc.open_stream(docs.column("docs")[0].as_py()):
            parts = _parts(batch)
            grams, starts = gram_keys(parts, order)
            score = np.add.reduceat(value[place(grams)], starts)
            found = word_keys(parts.texts)
            count = value[place(found.hash)]
            n = np.bincount(found.text, minlength=len(parts.texts))
            known = np.bincount(found.text, count > 0, len(parts.texts)).astype(np.int64)
            logs = np.bincount(found.text, np.log10(count + 0.5), len(parts.texts))
            columns = [batch.column(c) for c in ("doc_id", "held_out", "cut")] + [pa.array(x) for x in (n, known, logs, score)]
            out.append(pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "cut", "words", "known", "logs", "score"]))
        return pa.Table.from_batches(out)

    return score


def ppm_scores(
    docs: DataFrame,
    space: Workspace,
    held_out: Column | None = None,
    order: int = ORDER,
    block_bytes: int = BLOCK_BYTES,
    block_keys: int = BLOCK_KEYS,
    longest: int = CHUNK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is the log10 probability of the text's bytes (A-Z lower-cased) and its end under a trie of byte contexts
    up to ``order``, counted over all texts that are not held out. ``base_score`` is that of its words under their
    smoothed frequencies.

    1. Texts are gathered in blocks; a block is written with the distinct grams and words in it and their counts. It ends
       at ``block_keys`` of them or at ``block_bytes`` of text, so its memory is bounded whatever the texts are. Long texts
       are cut behind white space, with the context carried on; their parts may lie in several blocks.
    2. Counts are summed over blocks, and each gram gets its probability (``trie_values``).
    3. The values that a block needs come back to it by a join, and its texts are scored. So a task never holds the trie,
       which may grow with the corpus, only its own block's share, and nothing is broadcast.

    Words are told apart by 63-bit hashes; among 100 million different words, two share one in 1 of 1,800 corpora.
    Null text is empty: it has only its end. A null id counts as an empty text for the fold. Rows that repeat an id are
    rows of their own. Without training texts all symbols are equally likely. Empty tables give an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    out_of_training = fold(F.col(id_col)) == 1 if held_out is None else held_out
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(out_of_training, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")), F.sum((~F.col("held_out")).cast("long"))).first()
    n_bytes, train_docs = size[0] or 0, size[1] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    wanted = max(-(-n_bytes // block_bytes), min(cores, -(-n_bytes // (block_bytes // 8))), 1)
    made = rows.coalesce(wanted).mapInArrow(_blocks(order, block_bytes, block_keys, longest), "block long, key long, n long, docs binary")
    with short_batches(docs.sparkSession):
        blocks = space.keep(made, "ppm_blocks")
    used = blocks.filter("key IS NOT NULL").select("block", "key", "n")
    counts = space.keep(used.groupBy("key").agg(F.sum("n").alias("n")), "ppm_counts")
    words = counts.filter("key < 0")
    sums = words.agg(F.sum("n"), F.count_if(F.col("n") > 0)).first()
    values = trie_values(counts.filter("key >= 0"), order, space)
    values = values.unionByName(words.select("key", F.col("n").cast("double").alias("value")))
    needed = used.select("block", "key").join(values, "key")
    texts = blocks.filter("key IS NULL").select(F.col("block").alias("home"), "docs")
    found = texts.groupBy("home").cogroup(needed.groupBy("block"))
    fields = f"doc_id {id_type}, held_out boolean, cut long, words long, known long, logs double, score double"
    scored = space.keep(found.applyInArrow(_score_block(order), fields), "ppm_scored")
    several = scored.filter("cut IS NOT NULL").groupBy("cut").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "held_out")], *[F.sum(c).alias(c) for c in ("words", "known", "logs", "score")]
    )
    scored = scored.filter("cut IS NULL").drop("cut").unionByName(several.drop("cut"))
    different = (sums[1] or 0) + (1 if train_docs else 0)
    tokens = (sums[0] or 0) + train_docs
    scale = float(np.log10(tokens + 0.5 * (different + 1)))
    end = float(np.log10(train_docs + 0.5))
    return scored.select(
        F.col("doc_id").alias(id_col),
        "held_out",
        (F.col("words") + 1).alias("n_tokens"),
        (F.col("known") + (1 if train_docs else 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + end - (F.col("words") + 1) * scale).alias("base_score"),
        "score",
    )
