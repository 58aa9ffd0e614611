"""BPE encoding and decoding by a tokenization automaton.

``compile_merges`` starts from one state with a loop for every symbol and adds
one gadget per merge (u, v) -> w, in rank order: whatever state u leads to is
replaced by a copy without its arc v, and each state that has an arc u gets an
arc w to where that arc v led.  All arcs of one label lead to one state, and a
copy differs from its origin by one arc, so the automaton is kept as

* ``after``: the state that each label leads to,
* the arcs that each state lacks.  An arc that goes at merge k takes along all
  labels that begin with it and are made from merge k on.  Numbered by a
  depth-first walk over first parts, later merges first, these are one run of
  numbers; a state lacks a few such runs.

The automaton accepts exactly the token sequences that the merges leave, one
for each string, and is deterministic over tokens.  A word is read symbol by
symbol.  Table-driven transitions of a trie follow the labels that may end at
each place, and the only one with an arc from the state before it gives the
state of the prefix read so far; the path back from the end is the encoding.
Words of equal length are read side by side in numpy matrices.  Decoding emits
the labels of the arcs, joined by a blank.

Words are what the tokenizer file's normalizer and splitting pattern make of a
text.  No word spans a blank or a line feed, so texts are cut there, and each
distinct chunk is split once per task and each distinct word read once.
Strings of added tokens are found in the text as it is, before normalizing.

Defined cases: null text encodes as empty: no ids.  Null ids decode as the
empty string, an id outside the vocabulary raises.  Row order, ties and
repeated rows do not matter: all columns are row-local.  Input columns
called ``ids`` or ``decoded`` are replaced, all others pass through.  Empty tables give empty results.  A tokenizer
file with other parts than the ones described raises when it is read.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from losslens.llm.byte_bpe import NONE, Numbering, PairTable, Runs, gather
from losslens.llm.common import text_blocks

WORD_END = "</w>"
FINAL = 256  # added to the last symbol of a word
CACHE = 300_000  # chunks, and words, that a task remembers
BLOCK = 1 << 23  # bytes of text encoded at once
CELLS = 1 << 18  # cells of a matrix of words
TOKENS = 1 << 18  # ids decoded at once
GROUP = 256  # chunks that one call to the splitter takes
#: splitting pattern of the file for lowered ASCII text; its \\s, \\p{L} and \\p{N} written out
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
#: fixed value: the splitting pattern that ASCII_WORDS stands for
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Automaton:
    """Tokenization automaton over labels 0 .. n - 1."""

    def __init__(self, after: np.ndarray, number: np.ndarray, bounds: np.ndarray):
        #: state after each label; number of each label; ends of the runs of
        #: lacking arcs, state by state, from state * labels on
        self.after, self.number, self.bounds = after, number, bounds

    def has_arc(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        at = state.astype(np.int64) * len(self.number) + self.number[label]
        return np.searchsorted(self.bounds, at, "right") & 1 == 0


def compile_merges(labels: int, merges: list[tuple[int, int, int]]) -> Automaton:
    """Automaton of merges (u, v, w) in rank order over ``labels`` labels; a
    label that no merge makes is a symbol."""
    never = len(merges)
    made = [never] * labels  # merge that makes each label
    first = [-1] * labels
    for k, (u, _, w) in enumerate(merges):
        if made[w] != never:
            raise ValueError(f"label {w} is made by two merges")
        made[w], first[w] = k, u
    after = [0] * labels
    origin, lacks, since = [-1], [-1], [-1]  # of each state: copied from, without this arc, from this merge on
    dead = set()  # labels without any arc: their merge never applies
    for k, (u, v, w) in enumerate(merges):
        if any(made[x] != never and made[x] >= k for x in (u, v)):
            raise ValueError(f"merge {k} joins a label that is made later")
        state, label, begin = after[u], v, {}
        until = k
        while label >= 0:  # what v begins with, each with the merge that goes on from it
            begin[label] = until
            until, label = made[label], first[label]
        while state > 0 and begin.get(lacks[state], -1) < since[state]:
            state = origin[state]
        if state > 0 or u in dead or v in dead:
            dead.add(w)
            continue
        target = after[v]
        origin.append(after[u])
        lacks.append(v)
        since.append(k)
        after[u] = len(origin) - 1
        after[w] = target
    # number labels: what begins with a label follows it, later merges first
    follow: list[list[int]] = [[] for _ in range(labels)]
    for _, (u, _, w) in enumerate(merges):
        follow[u].append(w)
    number, size, order = np.zeros(labels, np.int64), np.ones(labels, np.int64), []
    todo = [x for x in range(labels) if first[x] < 0]
    while todo:
        x = todo.pop()
        number[x] = len(order)
        order.append(x)
        todo += follow[x]  # ascending, so that the latest is taken first
    for x in reversed(order):
        if first[x] >= 0:
            size[first[x]] += size[x]
    # runs of lacking arcs of every state: a label, and what goes on from it at a merge from ``since`` on
    used = {s: i for i, s in enumerate(sorted(set(after)))}
    chain = []
    for s, i in used.items():
        chain += [(i, x, never) for x in dead]
        while s > 0:
            chain.append((i, lacks[s], since[s]))
            s = origin[s]
    state, label, begun = np.array(chain, np.int64).reshape(-1, 3).T
    joined = np.array([w for _, _, w in merges], np.int64)  # by merge; below sorted by first part, later merges first
    part = np.array([u for u, _, _ in merges], np.int64) * (never + 1) + never - np.arange(never)
    order = np.argsort(part)
    reach = np.concatenate(([0], np.cumsum(size[joined[order]])))
    low = np.searchsorted(part[order], label * (never + 1))
    high = np.searchsorted(part[order], label * (never + 1) + never - begun, "right")
    begin = state * labels + number[label]
    end = begin + 1 + reach[high] - reach[low]
    order = np.lexsort((end, begin))
    begin, end = begin[order], np.maximum.accumulate(end[order]) if len(order) else end
    new = np.append(True, begin[1:] > end[:-1])[:len(begin)]
    bounds = np.column_stack([begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]] if len(begin)
                             else [begin, end])
    return Automaton(np.array([used[s] for s in after], np.int64), number, bounds.ravel())


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._require(spec)
        library = Tokenizer.from_file(path)  # its normalizer and splitter only
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.is_added = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or "(?!)")
        vocabulary = spec["model"]["vocab"]
        letters = byte_letters()
        self.to_byte = {ord(c): b for b, c in enumerate(letters)}
        merges = [(vocabulary[u], vocabulary[v], vocabulary[u + v]) for u, v in map(tuple, spec["model"]["merges"])]
        self.automaton = compile_merges(max(vocabulary.values()) + 1, merges)
        # trie of the labels' symbols
        spelled = {vocabulary[c]: (b,) for b, c in enumerate(letters)}
        spelled |= {vocabulary[c + WORD_END]: (FINAL + b,) for b, c in enumerate(letters)}
        for u, v, w in merges:
            spelled[w] = spelled[u] + spelled[v]
        go, label = {}, [-1]
        for x, symbols in spelled.items():
            at = 0
            for s in symbols:
                if (to := go.get((at, s))) is None:
                    to = go[at, s] = len(label)
                    label.append(-1)
                at = to
            label[at] = x
        self.go, self.label = PairTable(go), np.array(label, np.int64)
        self.longest = max(map(len, spelled.values()))
        self.chunks, self.chunk_runs = Numbering(), Runs()
        self.words, self.word_runs = Numbering(), Runs()

    @staticmethod
    def _require(spec: dict) -> None:
        model = spec["model"]
        splits = [p for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        fits = (model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
                and model.get("end_of_word_suffix") == WORD_END and not model.get("continuing_subword_prefix")
                and spec["decoder"] is None and kinds == ["NFC", "Replace", "Lowercase"]
                and [p["pattern"] for p in splits] == [{"Regex": PATTERN}]
                and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]))
        if not fits:
            raise ValueError("not a tokenizer file of the kind described")

    def read(self, words: list[bytes]) -> Runs:
        """Ids of non-empty words, in order."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        flat, count, k = [], [], 0
        while k < len(order):
            width = int(size[order[k]])
            n = min(int(np.searchsorted(size[order], width, "right")), k + max(1, CELLS // width))
            raw = b"".join([words[i] for i in order[k:n].tolist()])
            ids, sizes = self._read_equal(np.frombuffer(raw, np.uint8).reshape(-1, width))
            flat.append(ids)
            count.append(sizes)
            k = n
        runs, out = Runs(), Runs()
        if flat:
            runs.extend(np.concatenate(flat), np.concatenate(count))
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            out.extend(*runs.gather(place))
        return out

    def _read_equal(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, ids per word) of a matrix of words."""
        rows, width = raw.shape
        symbol = raw.astype(np.int32)
        symbol[:, -1] += FINAL
        state = np.zeros((rows, width + 1), np.int64)
        token = np.full((rows, width + 1), -1, np.int64)
        begin = np.zeros((rows, width + 1), np.int64)
        low = 0  # first place where a label that is still read may begin
        node = np.zeros((rows, 0), np.int32)  # trie node of the symbols from each such place on
        for end in range(1, width + 1):
            node = np.column_stack([node, np.zeros(rows, np.int32)])
            node = self.go.ranks(node, np.broadcast_to(symbol[:, end - 1:end], node.shape))
            node[node == NONE] = -1
            alive = (node >= 0).any(0)
            skip = int(alive.argmax()) if alive.any() else node.shape[1]
            node, low = node[:, skip:], low + skip
            label = np.where(node >= 0, self.label[node], -1)
            row, column = np.nonzero(label >= 0)
            label, start = label[row, column], column + low
            on = self.automaton.has_arc(state[row, start], label)
            row, label = row[on], label[on]
            if len(row) != rows or (np.diff(row) != 1).any():
                raise RuntimeError("the automaton is not deterministic")
            token[:, end], begin[:, end], state[:, end] = label, start[on], self.automaton.after[label]
        at, row, found = np.full(rows, width), np.arange(rows), []
        while len(row):
            found.append((row, token[row, at]))
            at = begin[row, at]
            row, at = row[at > 0], at[at > 0]
        row = np.concatenate([r for r, _ in found][::-1])
        ids = np.concatenate([x for _, x in found][::-1])
        by_row = np.argsort(row, kind="stable")
        return ids[by_row], np.bincount(row, minlength=rows)

    def _pieces(self, text: str) -> list[bytes]:
        """Words of a text without added tokens."""
        if text.isascii():
            return [w.encode() for w in ASCII_WORDS.findall(text.lower())]
        return [w.translate(self.to_byte).encode("latin-1") for w, _ in self.split(self.normalize(text))]

    def _wide_pieces(self, chunks: list[str]) -> list[list[bytes]]:
        """Words of each chunk, by one call for all of them where no chunk has
        white space of its own."""
        text = self.normalize(" ".join(chunks))
        if text.count(" ") != len(chunks) - 1:
            return [self._pieces(c) for c in chunks]
        ends = [i for i, c in enumerate(text) if c == " "]
        out: list[list[bytes]] = [[] for _ in chunks]
        found = self.split(text)
        owner = np.searchsorted(ends, [a for _, (a, _) in found], "right")
        for i, (w, _) in zip(owner.tolist(), found):
            out[i].append(w.translate(self.to_byte).encode("latin-1"))
        return out

    def _learn(self, chunks: list[str]) -> None:
        """Appends the ids of new chunks."""
        parts: list[list[bytes | int]] = [[]] * len(chunks)
        wide = []
        for i, c in enumerate(chunks):
            if "<" in c and self.is_added.search(c):
                parts[i], at = [], 0
                for m in self.is_added.finditer(c):
                    parts[i] += [*self._pieces(c[at:m.start()]), self.added[m[0]]]
                    at = m.end()
                parts[i] += self._pieces(c[at:])
            elif not c.isascii():
                wide.append(i)
            else:
                parts[i] = [c.lower().encode()] if c.isalpha() else self._pieces(c)
        for k in range(0, len(wide), GROUP):
            for i, p in zip(wide[k:k + GROUP], self._wide_pieces([chunks[i] for i in wide[k:k + GROUP]])):
                parts[i] = p
        count = np.fromiter(map(len, parts), np.int64, len(parts))
        rows = np.array([self.words[w] for p in parts for w in p], np.int64)
        new = self.words.take()
        known = [i for i, w in enumerate(new) if isinstance(w, int)]
        spelled = self.read([w for w in new if not isinstance(w, int)])
        if known:  # added tokens are their own ids
            flat, size, at = [], [], iter(range(len(new)))
            for w in new:
                if isinstance(w, int):
                    flat.append(np.array([w]))
                else:
                    i = next(at)
                    flat.append(spelled.flat[spelled.start[i]:spelled.start[i + 1]])
                size.append(len(flat[-1]))
            self.word_runs.extend(np.concatenate(flat), np.array(size))
        else:
            self.word_runs.extend(spelled.flat, np.diff(spelled.start))
        flat, size = self.word_runs.gather(rows)
        ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(count)))]
        self.chunk_runs.extend(flat, np.diff(ends))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, ids per text)."""
        if len(self.chunks) > CACHE:
            self.chunks, self.chunk_runs = Numbering(), Runs()
        if len(self.words) > CACHE:
            self.words, self.word_runs = Numbering(), Runs()
        rows, count = [], []
        for t in texts:
            cut = t.replace("\n", " ").split(" ")
            rows.append(np.fromiter(map(self.chunks.__getitem__, cut), np.int64, len(cut)))
            count.append(len(cut))
        self._learn(self.chunks.take())
        flat, size = self.chunk_runs.gather(np.concatenate(rows))
        total = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(count)))]
        return flat, np.diff(total)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(2)
def arc_labels(path: str) -> tuple[np.ndarray, np.ndarray]:
    """(labels of all ids end to end, each with a blank after it, start of each);
    an id without a label has an empty run."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    names = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    table = [b""] * (max(names.values()) + 1)
    for t, i in names.items():
        table[i] = t.encode() + b" "
    return np.frombuffer(b"".join(table), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in table])))


def _encoded(texts: pa.Array, path: str) -> pa.Array:
    found = [encoder(path).encode(block) for block in text_blocks(texts, BLOCK)]
    at = np.zeros(len(texts) + 1, np.int32)
    if found:
        np.cumsum(np.concatenate([size for _, size in found]), out=at[1:])
    flat = np.concatenate([ids for ids, _ in found]) if found else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat, pa.int32()))


def _packed(lists: pa.Array) -> pa.Array:
    flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
    at = (4 * lists.offsets.to_numpy().astype(np.int64)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(at), pa.py_buffer(flat)])


def _decoded(lists: pa.Array, path: str) -> pa.Array:
    raw, start = arc_labels(path)
    flat = lists.values.to_numpy(zero_copy_only=False)
    if len(flat) and (flat.min() < 0 or flat.max() >= len(start) - 1 or (start[flat + 1] == start[flat]).any()):
        raise ValueError("id outside the vocabulary")
    first = lists.offsets.to_numpy().astype(np.int64)
    size = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    out, k, after = [], 0, np.cumsum(size)
    while k < len(size):
        n = max(k + 1, int(np.searchsorted(after, (after[k - 1] if k else 0) + TOKENS, "right")))
        rows = np.concatenate([flat[a:a + s] for a, s in zip(first[k:n], size[k:n])])
        letters, width = gather(raw, start, rows)
        ends = np.concatenate(([0], np.cumsum(width)))[np.concatenate(([0], np.cumsum(size[k:n])))]
        joined = letters.tobytes()
        out += [joined[a:b - 1] if b > a else b"" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        k = n
    return pa.array(out, pa.binary()).cast(pa.string())


def encode_column(text: Column, path: str) -> Column:
    """Column of array<int> with the ids of a text column."""
    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        return _encoded(texts, path)
    return ids(text)


def decode_column(ids: Column, path: str) -> Column:
    """Column of string with the labels of an array<int> column of ids."""
    @F.arrow_udf("string")
    def text(lists: pa.Array) -> pa.Array:
        return _decoded(lists, path)
    return text(ids)


def encode_and_decode(documents: DataFrame, path: str, text_col: str = "text", packed: bool = False) -> DataFrame:
    """Adds ``ids`` (array<int>; ``packed``: binary, little-endian unsigned
    32-bit integers) and ``decoded`` (string, from the ids).

    One function makes both: a second one would run beside it in workers of
    its own, or run the encoder again."""
    @F.arrow_udf(f"struct<ids:{'binary' if packed else 'array<int>'},decoded:string>")
    def both(texts: pa.Array) -> pa.Array:
        ids = _encoded(texts, path)
        return pa.StructArray.from_arrays([_packed(ids) if packed else ids, _decoded(ids, path)], ["ids", "decoded"])

    out = documents.select(F.struct("*").alias("row"), both(F.col(text_col)).alias("b"))
    own = [F.col("row")[c].alias(c) for c in documents.columns if c.lower() not in ("ids", "decoded")]
    return out.select(*own, F.col("b.ids").alias("ids"), F.col("b.decoded").alias("decoded"))


def digests() -> list[Column]:
    """Columns n_tokens, ids_sha256 and decoded_sha256 of a table with packed ids."""
    return [F.expr("cast(octet_length(ids) div 4 AS bigint)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
            F.sha2("decoded", 256).alias("decoded_sha256")]
