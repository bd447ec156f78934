"""BPE by a tokenization automaton: merges compiled gadget by gadget, words encoded by its transitions, labels decoded."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbalis.llm.common import lean, small_batches

#: Fixed value: how a byte-level tokenizer of this kind parts a text into words before it merges.
PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of the same class in every version of the Unicode tables that the libraries here carry.
_SETTLED = re.compile("[\x00-ӿ -⁯]*")
#: Texts whose white space is single spaces (checked apart) and line feeds are parted at spaces first.
_LATIN = re.compile("[\n\x20-\x7e\xa1-\xac\xae-ſ]*")
#: Words up to this many bytes are encoded many at once, longer ones one by one.
SHORT = 48
CELLS = 1 << 20
#: Bytes of words and their ids that a worker remembers; ids do not depend on it.
REMEMBERED = 96 << 20
BATCH = 1 << 20
START = -1


class KeyTable:
    """Numbers by 64-bit keys: open addressing with at most one slot in eight in use, so nearly every look-up is one probe."""

    def __init__(self, found: dict[int, int]):
        keys, values = (np.fromiter(x, np.int64, len(found)) for x in (found, found.values()))
        bits = max(4, int(8 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1), np.full(1 << bits, -1)
        at = self._home(keys)
        left = np.arange(len(keys))
        while len(left):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[left[free]]
            lost = self.keys[at] != keys[left]
            self.values[at[~lost]] = values[left[~lost]]
            left, at = left[lost], (at[lost] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of every key, -1 for keys that are not there."""
        at = self._home(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.values[at], -1)
        open_ = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            seen = self.keys[at[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return out


@dataclass
class MergeAutomaton:
    """A deterministic automaton over labels (tokens) whose paths are exactly the token sequences that merging yields.

    It starts as one state that every byte label leads back to. Merges are then applied in order; the gadget of the merge
    of labels a and b, made at time k, does three things:

    * the state behind a is split: arcs labelled a now lead to a copy of it without the arc b, since b after a would have
      been merged (``cut``: label a loses b at time k);
    * every state that still has an arc a gets an arc ab (``first``: ab is there wherever a is);
    * arcs ab lead to the state that b led to, as it was at time k (``second``: the state behind ab is split from it).

    All arcs of one label lead to the same state, so a state is named by the label that enters it. A state differs from
    the one it was split from by its cuts alone, and a label is present wherever its first part is, but for its own cuts.
    So three tables hold the whole automaton, and whether a state has an arc is looked up along ``first`` and ``second``
    (``has_arc``), from the later made of state and label to the earlier one. The full table would have a bit for every
    pair of labels. Byte paths of labels are kept as a trie, so a word is read by table look-ups only.
    """

    labels: list[bytes]  # by id; empty where an id has no arc
    born: np.ndarray  # time of a label's merge, -1 for bytes
    first: np.ndarray
    second: np.ndarray
    cuts: KeyTable = None  # time by (a << 32 | b)
    edges: KeyTable = None  # node by (node << 8 | byte) of the trie
    node_label: np.ndarray = None
    specials: dict[str, int] = field(default_factory=dict)

    @classmethod
    def compiled(cls, path: str) -> MergeAutomaton:
        """The automaton of a byte-level tokenizer file. Raises ValueError for files of another kind."""
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model, parts = data["model"], data.get("pre_tokenizer") or {}
        regular = parts.get("type") == "ByteLevel" and parts.get("use_regex", True) and not parts.get("add_prefix_space")
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if not regular or odd or data.get("normalizer"):
            raise ValueError(f"{path} is no plain byte-level BPE file")
        # The byte-level alphabet. Visible Latin-1 characters stand for themselves, other bytes follow 255.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(c not in vocab for c in byte_of):
            raise ValueError(f"{path} lacks ids of single bytes")
        added = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        if any(t.get(k) for t in data.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} has added tokens with rules for their surroundings")
        size = max([*vocab.values(), *added.values()]) + 1
        made = cls([b""] * size, *(np.full(size, x, np.int64) for x in (-2, -1, -1)), specials=added)
        for c, b in byte_of.items():
            made.labels[vocab[c]], made.born[vocab[c]] = bytes([b]), -1
        cuts: dict[int, int] = {}
        for time, (a, b) in enumerate(pairs):
            made._gadget(vocab[a], vocab[b], vocab[a + b], time, cuts)
        made.cuts = KeyTable(cuts)
        made._spell()
        return made

    def _gadget(self, a: int, b: int, ab: int, time: int, cuts: dict[int, int]) -> None:
        if self.born[ab] != -2 or self.born[a] == -2 or self.born[b] == -2:
            raise ValueError("a merge makes a token anew, or comes before its parts")
        cuts[a << 32 | b] = time
        self.first[ab], self.second[ab], self.born[ab] = a, b, time
        self.labels[ab] = self.labels[a] + self.labels[b]

    def _spell(self) -> None:
        """The byte paths of all labels as a trie."""
        edges: dict[int, int] = {}
        ends = [-1]
        for i in np.flatnonzero(self.born > -2).tolist():
            node = 0
            for byte in self.labels[i]:
                node = edges.setdefault(node << 8 | byte, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = i
        self.edges, self.node_label = KeyTable(edges), np.array(ends)

    def has_arc(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Whether the state behind label ``state`` has an arc ``label``; the start has all arcs.

        Of the two, what was made later is traced to what it was made from, at the time it was made: only cuts that were
        there by then are inherited. A label takes over the cuts of its own gadget, a state does not.
        """
        out = np.ones(len(state), bool)
        at = np.flatnonzero(state != START)
        s, w = state[at], label[at]
        until = np.full(len(at), np.iinfo(np.int64).max)
        while len(at):
            time = self.cuts(s << 32 | w)
            cut = (time >= 0) & (time < until)
            out[at[cut]] = False
            s_born, w_born = self.born[s], self.born[w]
            go = ~cut & (np.maximum(s_born, w_born) >= 0)
            at, s, w, s_born, w_born = at[go], s[go], w[go], s_born[go], w_born[go]
            by_label = w_born >= s_born
            until = np.where(by_label, w_born + 1, s_born)
            s, w = np.where(by_label, s, self.second[s]), np.where(by_label, self.first[w], w)
        return out

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The trie's node behind a byte, -1 if there is none."""
        return self.edges(node << 8 | byte)

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of every word: the labels of the one path from the start that spells it."""
        out: list[list[int]] = [[]] * len(words)
        order = sorted((i for i in range(len(words)) if 0 < len(words[i]) <= SHORT), key=lambda i: len(words[i]))
        at = 0
        while at < len(order):
            longest = len(words[order[at]])
            some = order[at : at + max(1, CELLS // (2 * longest + 8))]
            for i, ids in zip(some, self._many([words[i] for i in some])):
                out[i] = ids
            at += len(some)
        for i, word in enumerate(words):
            if len(word) > SHORT:
                out[i] = self._one(word)
        return out

    def _many(self, words: list[bytes]) -> list[list[int]]:
        """Every prefix of a word has one path; ``entered`` holds its last label. Words advance together, byte by byte."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        width = int(sizes.max())
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        text = text.astype(np.int64)
        entered = np.full((len(words), width + 1), START)
        for j in range(width):
            row = np.flatnonzero(sizes > j)
            node = np.zeros(len(row), np.int64)
            for k in range(j, width):
                node = self.step(node, text[row, k])
                on = (node >= 0) & (sizes[row] > k)
                row, node = row[on], node[on]
                if not len(row):
                    break
                label = self.node_label[node]
                ends = np.flatnonzero(label >= 0)
                found = self.has_arc(entered[row[ends], j], label[ends])
                entered[row[ends[found]], k + 1] = label[ends[found]]
        lengths = np.fromiter(map(len, self.labels), np.int64, len(self.labels))
        end, row = sizes.copy(), np.arange(len(words))
        steps = []
        while len(row):
            label = entered[row, end[row]]
            steps.append((row, label))
            end[row] -= lengths[label]
            row = row[end[row] > 0]
        out: list[list[int]] = [[] for _ in words]
        for row, label in reversed(steps):
            for i, x in zip(row.tolist(), label.tolist()):
                out[i].append(x)
        return out

    def _one(self, word: bytes) -> list[int]:
        """The same for one long word, with memory and time in proportion to its length: a window of it at a time."""
        n, longest = len(word), max(map(len, self.labels))
        text = np.frombuffer(word, np.uint8).astype(np.int64)
        entered = np.full(n + 1, START)
        block = max(1, CELLS // longest)
        for at in range(0, n, block):
            start = np.arange(at, min(n, at + block))
            table = np.full((len(start), longest), -1, np.int32)
            row, node = np.arange(len(start)), np.zeros(len(start), np.int64)
            for k in range(longest):
                on = start[row] + k < n
                row, node = row[on], node[on]
                node = self.step(node, text[start[row] + k])
                row, node = row[node >= 0], node[node >= 0]
                if not len(row):
                    break
                table[row, k] = self.node_label[node]
            known: dict[tuple[int, int], bool] = {}
            for r, labels in enumerate(table.tolist()):
                state = int(entered[at + r])
                for k, label in enumerate(labels):
                    if label >= 0:
                        pair = (state, label)
                        if pair not in known:
                            known[pair] = bool(self.has_arc(np.array([state]), np.array([label]))[0])
                        if known[pair]:
                            entered[at + r + k + 1] = label
        out, end = [], n
        while end:
            label = int(entered[end])
            out.append(label)
            end -= len(self.labels[label])
        return out[::-1]


class Encoder:
    """Ids of whole texts: parted into words, which are encoded once and remembered within a bound of bytes."""

    def __init__(self, automaton: MergeAutomaton):
        import regex
        from tokenizers import pre_tokenizers

        self.automaton = automaton
        self.parts = regex.compile(PARTS)
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False)
        names = sorted(automaton.specials, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.known: dict[str, bytes] = {}
        self.size = 0

    def words(self, text: str) -> list[str]:
        """Words of a text that holds no special token. Rare scripts are parted by the tokenizer library's own tables."""
        if _SETTLED.fullmatch(text):
            return self.parts.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    @staticmethod
    def chunks(text: str) -> list[str] | None:
        """Runs between single spaces, each with its space, if no word can reach across one; None for other texts."""
        if "  " in text or " \n" in text or "\n " in text or text[-1:] == " " or not _LATIN.fullmatch(text):
            return None
        first, *rest = text.split(" ")
        return [first, *[" " + w for w in rest]] if first else [" " + w for w in rest]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text. Strings of special tokens get the ids of these."""
        specials = self.automaton.specials
        split: list[list[str]] = []
        marks: list[list[tuple[int, int]]] = []
        for text in texts:
            runs = self.special.split(text) if self.special else [text]
            chunks, special = [], []
            for k, run in enumerate(runs):
                if k % 2:
                    special.append((len(chunks), specials[run]))
                elif run:
                    found = self.chunks(run)
                    chunks += self.words(run) if found is None else found
            split.append(chunks)
            marks.append(special)
        fresh = list(set().union(*split).difference(self.known)) if split else []
        self._learn(fresh)
        out = []
        for chunks, special in zip(split, marks):
            parts = list(map(self.known.__getitem__, chunks))
            for at, i in reversed(special):
                parts.insert(at, array("i", [i]).tobytes())
            out.append(np.frombuffer(b"".join(parts), np.int32))
        for chunk in reversed(fresh):  # what came first is the most frequent
            if self.size <= REMEMBERED:
                break
            self.size -= self._cost(chunk, self.known.pop(chunk))
        return out

    @staticmethod
    def _cost(chunk: str, ids: bytes) -> int:
        """Bytes that an entry takes, about."""
        return 200 + len(chunk) + len(ids)

    def _learn(self, chunks: list[str]) -> None:
        split = [self.words(c) for c in chunks]
        distinct = list(set().union(*split)) if split else []
        found = self.automaton.encode_words([w.encode() for w in distinct])
        ids = {w: array("i", i).tobytes() for w, i in zip(distinct, found)}
        for chunk, words in zip(chunks, split):
            self.known[chunk] = made = ids[words[0]] if len(words) == 1 else b"".join([ids[w] for w in words])
            self.size += self._cost(chunk, made)


def encoded(docs: DataFrame, automaton: MergeAutomaton, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the token ids (array of int) of every whole text, in one narrow pass.

    Equal to what the tokenizer library yields for the file of ``automaton`` without added special tokens; strings of
    special tokens that stand in a text get their ids. Null and empty texts have no ids. Rows that repeat an id stay rows
    of their own; other columns are not read, an empty table gives an empty result. The automaton is as large as the
    vocabulary file, whatever the documents, and goes to executors as a broadcast variable.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        encoder = Encoder(shared.value)
        for batch in small_batches(batches, "text", BATCH):
            ids = encoder([t or "" for t in batch.column("text").to_pylist()])
            ends = np.cumsum([0, *map(len, ids)])
            values = pa.array(np.concatenate([np.empty(0, np.int32), *ids]), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, f"doc_id {id_type}, ids array<int>").withColumnRenamed("doc_id", id_col)


def decoded(rows: DataFrame, automaton: MergeAutomaton, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text that the labels of ``ids_col`` spell; special tokens are spelled out.

    Bytes that are no UTF-8 become U+FFFD. Null ids give a null text, ids that the vocabulary lacks nothing.
    """
    shared = rows.sparkSession.sparkContext.broadcast(automaton)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        labels = list(shared.value.labels)
        for name, i in shared.value.specials.items():
            labels[i] = name.encode()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = []
                for ids in part.column(ids_col):
                    found = None if not ids.is_valid else ids.values.to_numpy(zero_copy_only=False).tolist()
                    spelled = None if found is None else b"".join([labels[i] for i in found if 0 <= i < len(labels)])
                    texts.append(None if spelled is None else spelled.decode("utf-8", "replace"))
                columns = [part.column(c) for c in part.schema.names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*part.schema.names, text_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(decode, f"{fields}, `{text_col}` string")
