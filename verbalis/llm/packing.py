"""Best-fit packing into sequences: lower bounds certify a partition; partitions with gaps exchange bins and pack again."""

from __future__ import annotations

import json
import re
import uuid
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbalis.llm.common import lean, short_batches, small_batches
from verbalis.session import Workspace

#: Chunks of text whose ids one Python worker remembers, and the bytes they may take; further ones are encoded each time.
#: Ids do not depend on either.
REMEMBERED, REMEMBERED_BYTES = 200_000, 64 << 20
#: Line feeds, printable ASCII and two blocks of Latin letters: no white space but the space and the line feed.
_LATIN = re.compile("[\n\x20-\x7e\xa1-\xac\xae-\u017f]*")
#: Fixed value: how a byte-level tokenizer of this kind parts a text before it merges.
PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_WORKERS: dict[str, ChunkedTokenizer] = {}


class ChunkedTokenizer:
    """Ids of whole texts, chunk by chunk, for a byte-level tokenizer that splits words at spaces.

    Such a tokenizer joins a single space to the word behind it and never merges across that place. Texts whose spaces
    all stand alone between other characters are therefore encoded word by word, and ids of words are remembered. Every
    other text (tabs, spaces in a row, exotic characters) is encoded as a whole.

    New words are merged by ranks if the file's merges stand in the order of their ids, which is checked: the two kinds
    of merging are one then, and ranks take a fifth of the time.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.encoder.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        parts = file.get("pre_tokenizer") or {}
        by_words = parts.get("type") == "ByteLevel" and parts.get("use_regex", True) and not parts.get("add_prefix_space")
        self.by_words = bool(by_words and not file.get("normalizer"))
        self.ranked = self.by_ranks(file["model"]) if self.by_words else None
        self.ids: dict[str, bytes] = {}
        self.size = 0

    @staticmethod
    def by_ranks(model: dict):
        """An encoder of the same vocabulary by ranks, or None if the merges of the file are ordered otherwise."""
        import tiktoken

        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in pairs]
        # The byte-level alphabet. Visible Latin-1 characters stand for themselves, other bytes follow 255.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        singles = [model["vocab"].get(c, -1) for c in byte_of]
        if made != sorted(made) or min(singles) < 0 or made and max(singles) > made[0]:
            return None
        merged = {a + b for a, b in pairs} | set(byte_of)
        ranks = {bytes(byte_of[c] for c in t): model["vocab"][t] for t in merged}
        return tiktoken.Encoding("ranks", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, path: str) -> ChunkedTokenizer:
        if path not in _WORKERS:
            _WORKERS[path] = cls(path)
        return _WORKERS[path]

    def encode(self, texts: list[str]) -> list[bytes]:
        """For every text its ids as unsigned 32-bit integers (of the machine's order, little-endian wherever Spark runs)."""
        found = self.encoder.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def fresh(self, names: list[str]) -> dict[str, bytes]:
        """Ids of chunks that are not known yet."""
        texts = [c[1:] if c[0:1] == "\0" else " " + c for c in names]
        if self.ranked is None:
            return dict(zip(names, self.encode(texts)))
        one = self.ranked.encode_ordinary
        return {name: array("I", one(text)).tobytes() for name, text in zip(names, texts)}

    @staticmethod
    def plain(text: str) -> bool:
        """Whether every space stands alone between two characters that are no white space."""
        if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ":
            return False
        return _LATIN.fullmatch(text) is not None

    @staticmethod
    def chunks(text: str) -> list[str]:
        """Names of the chunks: a word stands for itself with the space before it, the first one follows a NUL."""
        words = text.split(" ")
        words[0] = "\0" + words[0]
        return words

    def __call__(self, texts: list[str]) -> list[bytes]:
        known = self.ids
        split = [self.chunks(t) if t and self.by_words and self.plain(t) else None for t in texts]
        new = self.fresh(list(set().union(*(s for s in split if s)).difference(known)))
        known.update(new)
        self.size += sum(map(self.cost, new, new.values()))
        whole = iter(self.encode([t for t, s in zip(texts, split) if s is None]))
        out = [next(whole) if s is None else b"".join(map(known.__getitem__, s)) for s in split]
        for name in reversed(list(new)):
            if len(known) <= REMEMBERED and self.size <= REMEMBERED_BYTES:
                break
            self.size -= self.cost(name, known.pop(name))
        return out

    @staticmethod
    def cost(name: str, ids: bytes) -> int:
        """Bytes that an entry takes, about."""
        return 200 + len(name) + len(ids)


def pieces_of(ids: bytes, limit: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc) of a document's ids: pieces of ``limit`` from its end, the first takes the rest."""
    n = len(ids) // 4
    first = n if n <= limit else n % limit or limit
    start, piece, length = 0, 0, first
    while start < n:
        yield piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])
        start, piece, length = start + length, piece + 1, limit


def token_pieces(
    docs: DataFrame, tokenizer: str, limit: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: ids of every text and ``end_id``, cut at ``limit``. One narrow pass."""
    id_type = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        lean()
        encoder = ChunkedTokenizer.of(tokenizer)
        for batch in small_batches(batches, "text", 1 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows: list[tuple] = []
            at: list[int] = []
            for i, ids in enumerate(encoder(texts)):
                found = list(pieces_of(ids + end, limit))
                rows += found
                at += [i] * len(found)
            ids = batch.column("doc_id").take(pa.array(at, pa.int64()))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


def bound_of_counts(counts: np.ndarray, limit: int) -> int:
    """Bins of ``limit`` that any packing needs of ``counts[n]`` pieces of length n: the best of several dual feasible functions.

    For every threshold t: pieces above limit - t count as a whole bin, those below t as nothing, the rest by length;
    and for k = 1, 2, ... the rounding function x -> floor((k + 1) x / limit) / k, exact where (k + 1) x / limit is whole.
    """
    counts = counts.astype(np.int64)
    size = np.arange(limit + 1, dtype=np.int64)
    mass = np.cumsum(counts * size)
    total = np.cumsum(counts)
    t = np.arange(0, limit // 2 + 1)
    middle = mass[limit - t] - np.where(t > 0, mass[np.maximum(t - 1, 0)], 0)
    large = total[limit] - total[limit - t]
    best = int((large + -(-middle // limit)).max())
    for k in range(1, 33):
        scaled = (k + 1) * size
        value = np.where(scaled % limit == 0, size * k, scaled // limit * limit)  # times 1 / (k * limit)
        best = max(best, int(-(-(counts * value).sum() // (k * limit))))
    return best


def lower_bound(lengths: np.ndarray, limit: int) -> int:
    return bound_of_counts(np.bincount(lengths, minlength=limit + 1), limit)


def best_fit(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every length; lengths come in decreasing order. Each goes to the fullest bin that has room.

    Bins wait in stacks by their room; a bit set of rooms in use finds the smallest one that is large enough.
    """
    stacks: dict[int, list[int]] = defaultdict(list)
    rooms, made = 0, 0
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        above = rooms >> n
        if above:
            room = n + (above & -above).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
        else:
            room, b, made = limit, made, made + 1
        bins[i], offsets[i] = b, limit - room
        left = room - n
        if left:
            if not stacks[left]:
                rooms |= 1 << left
            stacks[left].append(b)
    return bins, offsets


def _pack_group(limit: int, turn: int):
    keys = [("length", "descending"), *((c, "ascending") for c in ("doc_id", "piece", "ids_crc32", "start"))]

    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        """Pack one group anew, unless its former bins are as few as a lower bound or as a new packing of it."""
        lean()
        rows = rows.drop_columns(["_group"]).sort_by(keys)
        lengths, former = rows.column("length").to_numpy(), rows.column("sequence_id").to_numpy()
        before = len(np.unique(former))
        certified = turn and before == lower_bound(lengths, limit)
        bins, offsets = (former, None) if certified else best_fit(lengths, limit)
        if certified or turn and before <= int(bins.max()) + 1:
            ids, offsets = former, rows.column("offset").to_numpy()
        else:
            ids = (((turn << 28) + key[0].as_py()) << 28) + bins
        _, inverse = np.unique(ids, return_inverse=True)
        full = np.bincount(inverse, weights=lengths)[inverse] == limit
        for name, values in (("sequence_id", ids), ("offset", offsets)):
            rows = rows.set_column(rows.schema.get_field_index(name), name, pa.array(values, pa.int64()))
        return rows.append_column("full", pa.array(full))

    return pack


def numbered(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``_key``, a hash that tells equal rows apart by numbers: rows are counted and written out again."""
    step = 100_000
    counted = pieces.groupBy(*pieces.columns).agg(F.count("*").alias("_n"))
    parts = counted.withColumn("_part", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / step))))
    parts = parts.repartition(*pieces.columns, "_part")  # a row of very many copies becomes rows of many tasks
    first = F.col("_part") * step
    rows = parts.withColumn("_at", F.explode(F.sequence(first, F.least(first + step, F.col("_n")) - 1)))
    return rows.withColumn("_key", F.xxhash64("doc_id", "piece", "ids_crc32", "start", "_at")).drop("_n", "_part", "_at")


def pack_pieces(pieces: DataFrame, space: Workspace, limit: int, group_rows: int = 4000) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, in as few sequences of ``limit`` as exchanges reach.

    1. Pieces are dealt to groups by hash and packed there, largest first, each into the fullest bin with room.
    2. Full bins are done. A group whose number of bins equals a lower bound is certified: no packing of its rows alone
       is better, so it is not packed again, but its part-filled bins go on to meet those of other groups.
    3. Bins that are not full are dealt anew, whole, to groups, and these are packed again. A group keeps its former bins
       unless a new packing saves some, so no turn makes the result worse.
    4. This ends when all bins together are as few as a lower bound of all pieces (from the count of every length), when
       one group holds all that is left, or when a turn saves nothing.

    Groups have about ``group_rows`` rows at every size of input. Full-length pieces never meet another one. Rows that
    repeat an id are packed as rows of their own. Equal rows are counted and numbered, so that any number of them is dealt
    over all groups. Sequences of pieces below full length are the same in a rerun, whatever the order of the input.
    """
    schema = pieces.schema
    alone = pieces.filter(F.col("length") >= limit)
    rest = pieces.filter(F.col("length") < limit)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    out_schema = f"{columns}, sequence_id long, offset long, full boolean"
    counts = np.zeros(limit + 1, np.int64)
    for r in rest.groupBy("length").count().collect():  # fewer rows than limit
        counts[r["length"]] = r["count"]
    n, least, done, before, turn = int(counts.sum()), bound_of_counts(counts, limit), 0, None, 0
    mark = uuid.uuid4().hex
    now = numbered(rest).withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    finished = []
    while True:
        groups = max(1, round(n / group_rows))
        dealt = now.withColumn("_group", F.pmod("_key", F.lit(groups)))
        packed = dealt.drop("_key").groupBy("_group").applyInArrow(_pack_group(limit, turn), out_schema)
        packed = space.keep(packed, f"packed_{mark}_{turn}")
        first = F.col("offset") == 0
        size = packed.agg(F.count_if(first & F.col("full")), F.count_if(first & ~F.col("full")), F.count_if(~F.col("full"))).first()
        full, open_bins, n = size
        if groups == 1 or done + full + open_bins == least or before is not None and full + open_bins == before:
            finished.append(packed.drop("full"))
            break
        finished.append(packed.filter("full").drop("full"))
        done, before, turn = done + full, open_bins, turn + 1
        now = packed.filter("not full").drop("full").withColumn("_key", F.xxhash64("sequence_id", F.lit(turn)))
        now = now.withColumn("_key", F.shiftright("_key", 1))
    # full pieces: a sequence of their own, with numbers that no group has
    singles = alone.withColumn("sequence_id", F.monotonically_increasing_id() + F.lit(1 << 62)).withColumn(
        "offset", F.lit(0).cast("long")
    )
    out = singles
    for f in finished:
        out = out.unionByName(f)
    return out


def pack_documents(
    docs: DataFrame,
    space: Workspace,
    tokenizer: str,
    limit: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is the path of a byte-level tokenizer file on every executor. Null and empty texts have only the end
    id. An empty table gives an empty result; columns besides id and text are not read.
    """
    pieces = token_pieces(docs, tokenizer, limit, end_id, id_col, text_col)
    with short_batches(docs.sparkSession):
        pieces = space.keep(pieces, f"pieces_{uuid.uuid4().hex}")
    return pack_pieces(pieces, space, limit, **options)
