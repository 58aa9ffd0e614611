"""Byte-level BPE over a rank file, as padded numpy matrices.

A text is cut before each blank that a visible character follows; no match of
the splitting pattern crosses such a cut, so each distinct chunk is split and
merged once per task and then looked up.  A chunk's pieces are the matches of
``pattern``.  A piece that is a vocabulary entry is that id; all others are
merged: pieces of similar length form one padded matrix of byte ids, and in
each round every row merges its leftmost pair of least rank.  Pair ranks come
from an open-addressing hash table over (left id, right id) with a row for
every split of a vocabulary entry into two entries, i.e. the rank of the
joined bytes.  Rows compact to the left by one column a round and leave the
matrix when no pair of theirs has a rank.  A piece over ``WIDE`` bytes would
need a round for nearly every byte of it; those merge the same way from a
heap.

Defined cases: null text encodes as empty: no ids, no bytes.  Null ids decode
as empty, and an id outside the vocabulary raises.  Row order, ties and
repeated rows do not matter: both functions are row-local.  Input columns
called ``ids`` or ``decoded`` are replaced, all others pass through.
"""

from __future__ import annotations

import base64
import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from losslens.llm.common import text_blocks

NONE = np.int32(2**31 - 1)
WIDE = 1024
CELLS = 1 << 20
CACHE = 400_000  # chunks that a task remembers
BLOCK = 1 << 23  # bytes of text encoded at once
_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?:\s|\Z)")


def _cut(text: str) -> list[str]:
    """The chunks of a text, each without the blank before it.  The first has
    none and gets one as a mark, since no other chunk begins with a blank."""
    parts = _CUT.split(text) if _ODD.search(text) else text.split(" ")
    parts[0] = " " + parts[0]
    return parts


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PairTable:
    """Ranks of id pairs in an open-addressing table of numpy arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        n = len(pairs)
        self.bits = max(4, int(3 * n).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, NONE, np.int32)
        keys = np.fromiter((a << 32 | b for a, b in pairs), np.int64, n)
        ranks = np.fromiter(pairs.values(), np.int32, n)
        at = self._slot(keys)
        while len(keys):  # each free slot takes one of those that want it
            free = self.key[at] == -1
            self.key[at[free]] = keys[free]
            placed = self.key[at] == keys
            self.rank[at[placed]] = ranks[placed]
            keys, ranks, at = keys[~placed], ranks[~placed], (at[~placed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where there is none or an id is negative."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(keys.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0).ravel() & (right >= 0).ravel())
        keys, flat = keys.ravel()[todo], out.ravel()
        at = self._slot(keys)
        while len(todo):
            found = self.key[at]
            flat[todo] = np.where(found == keys, self.rank[at], NONE)
            on = (found != keys) & (found != -1)
            todo, keys, at = todo[on], keys[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return flat.reshape(out.shape)


def merge_matrix(ids: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """(merged ids of all rows in row order, ids per row) of a matrix padded
    with -1 on the right."""
    done = np.full(ids.shape, -1, np.int32)
    rows = np.arange(len(ids))
    rank = table.ranks(ids[:, :-1], ids[:, 1:])
    while len(rows):
        n = np.arange(len(rows))
        best = rank.argmin(1) if rank.shape[1] else np.zeros(len(rows), np.int64)  # the leftmost of the least
        least = rank[n, best] if rank.shape[1] else np.full(len(rows), NONE)
        ended = least == NONE
        done[rows[ended], : ids.shape[1]] = ids[ended]
        if ended.all():
            break
        on = ~ended
        rows, ids, rank, best, least = rows[on], ids[on], rank[on], best[on], least[on]
        n = n[: len(rows)]
        ids[n, best] = least  # a merged id is its rank
        keep = np.arange(ids.shape[1] - 1)
        ids = np.take_along_axis(ids, keep + (keep > best[:, None]), 1)
        keep = np.arange(rank.shape[1] - 1)
        rank = np.take_along_axis(rank, keep + (keep >= best[:, None]), 1)
        has = best < rank.shape[1]  # the pair that begins with the merged id
        rank[n[has], best[has]] = table.ranks(ids[n[has], best[has]], ids[n[has], best[has] + 1])
        has = best > 0  # the pair that ends with it
        rank[n[has], best[has] - 1] = table.ranks(ids[n[has], best[has] - 1], ids[n[has], best[has]])
    return done[done >= 0], (done >= 0).sum(1)


def merge_wide(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for one long piece, from a heap of (rank, place)."""
    part = [piece[i:i + 1] for i in range(len(piece))]
    after, before = list(range(1, len(part))) + [-1], list(range(-1, len(part) - 1))
    heap = [(r, i) for i in range(len(part) - 1) if (r := ranks.get(part[i] + part[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        j = after[i]
        if part[i] is None or j < 0 or ranks.get(part[i] + part[j]) != r:
            continue
        part[i], part[j] = part[i] + part[j], None
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] >= 0 and (x := ranks.get(part[a] + part[after[a]])) is not None:
                heapq.heappush(heap, (x, a))
    return [ranks[p] for p in part if p is not None]


class Numbering(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new = []

    def __missing__(self, key):
        self[key] = n = len(self)
        self.new.append(key)
        return n

    def take(self) -> list:
        """The keys numbered since the last call."""
        new, self.new = self.new, []
        return new


class Runs:
    """Rows of ids of different length, end to end."""

    def __init__(self):
        self.flat = np.zeros(0, np.int32)
        self.start = np.zeros(1, np.int64)

    def extend(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the rows' ids end to end, ids per row)."""
        return gather(self.flat, self.start, rows)


def gather(flat: np.ndarray, start: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = start[rows]
    size = start[rows + 1] - first
    after = np.cumsum(size)
    at = np.repeat(first - after + size, size)
    at += np.arange(len(at))
    return flat[at], size


class Encoder:
    def __init__(self, path: str, pattern: str):
        self.ids = load_ranks(path)
        self.split = regex.compile(pattern)
        self.first = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        self.table = PairTable({(self.ids[t[:i]], self.ids[t[i:]]): r for t, r in self.ids.items()
                                for i in range(1, len(t)) if t[:i] in self.ids and t[i:] in self.ids})
        self._forget()

    def _forget(self):
        self.seen, self.chunks = Numbering(), Runs()

    def merge(self, pieces: list[bytes]) -> Runs:
        """Ids of each piece, in order."""
        order, flat, sizes = [], [], []

        def add(rows, ids, size):
            order.append(rows)
            flat.append(ids)
            sizes.append(size)

        whole = np.fromiter((self.ids.get(p, -1) for p in pieces), np.int32, len(pieces))
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        rows = np.flatnonzero(whole >= 0)
        add(rows, whole[rows], np.ones(len(rows), np.int64))
        for row in np.flatnonzero((whole < 0) & (size > WIDE)):
            ids = merge_wide(pieces[row], self.ids)
            add([row], ids, [len(ids)])
        rest = np.flatnonzero((whole < 0) & (size <= WIDE))
        rest = rest[np.argsort(size[rest], kind="stable")]
        k = 0
        while k < len(rest):
            width = max(4, 1 << (int(size[rest[k]]) - 1).bit_length())  # lengths up to the next power of two
            n = min(int(np.searchsorted(size[rest], width, "right")), k + max(1, CELLS // width))
            rows, k = rest[k:n], n
            ids = np.full((len(rows), int(size[rows[-1]])), -1, np.int32)
            raw = np.frombuffer(b"".join([pieces[r] for r in rows.tolist()]), np.uint8)
            ids[np.arange(ids.shape[1]) < size[rows][:, None]] = self.first[raw]
            add(rows, *merge_matrix(ids, self.table))
        out, runs = Runs(), Runs()
        runs.extend(np.concatenate(flat), np.concatenate(sizes).astype(np.int64))
        place = np.empty(len(pieces), np.int64)
        place[np.concatenate(order).astype(np.int64)] = np.arange(len(pieces))
        out.extend(*runs.gather(place))
        return out

    def learn(self, chunks: list[str]) -> None:
        """Appends the ids of new chunks."""
        pieces = Numbering()
        rows, count = [], np.ones(len(chunks), np.int64)
        for i, c in enumerate(chunks):
            if c[1:].isalpha() and c[0] == " ":  # blank and letters: one match
                rows.append(pieces[c])
            else:
                found = self.split.findall(c)
                rows += map(pieces.__getitem__, found)
                count[i] = len(found)
        runs = self.merge([p.encode("utf-8", "surrogatepass") for p in pieces])
        flat, size = runs.gather(np.asarray(rows, np.int64))
        ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(count)))]
        self.chunks.extend(flat, np.diff(ends))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, ids per text)."""
        if len(self.seen) > CACHE:
            self._forget()
        rows, count = [], []
        for t in texts:
            parts = _cut(t)
            rows.append(np.fromiter(map(self.seen.__getitem__, parts), np.int64, len(parts)))
            count.append(len(parts))
        self.learn([c[1:] if c[0] == " " else " " + c for c in self.seen.take()])
        flat, size = self.chunks.gather(np.concatenate(rows))
        total = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(count)))]
        return flat, np.diff(total)


@lru_cache(2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@lru_cache(2)
def vocabulary(path: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all ids end to end, start of each)."""
    ranks = load_ranks(path)
    table: list[bytes] = [b""] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        table[r] = t
    return np.frombuffer(b"".join(table), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in table])))


def _encoded(texts: pa.Array, path: str, pattern: str) -> pa.Array:
    enc = encoder(path, pattern)
    found = [enc.encode(block) for block in text_blocks(texts, BLOCK)]
    at = np.zeros(len(texts) + 1, np.int32)
    if found:
        np.cumsum(np.concatenate([size for _, size in found]), out=at[1:])
    flat = np.concatenate([ids for ids, _ in found]) if found else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat, pa.int32()))


def _decoded(lists: pa.Array, path: str) -> pa.Array:
    raw, start = vocabulary(path)
    flat = lists.values.to_numpy(zero_copy_only=False)
    if len(flat) and (flat.min() < 0 or flat.max() >= len(start) - 1):
        raise ValueError("id outside the vocabulary")
    at, size = lists.offsets.to_numpy(), lists.value_lengths().fill_null(0).to_numpy()
    return pa.array([gather(raw, start, flat[a:a + n])[0].tobytes() for a, n in zip(at, size)], pa.binary())


def encode_column(text, path: str, pattern: str):
    """Column of array<int> with the ids of a text column."""
    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        return _encoded(texts, path, pattern)
    return ids(text)


def decode_column(ids, path: str):
    """Column of binary with the bytes of an array<int> column of ids."""
    @F.arrow_udf("binary")
    def text(lists: pa.Array) -> pa.Array:
        return _decoded(lists, path)
    return text(ids)


def encode_and_decode(documents, path: str, pattern: str, text_col: str = "text"):
    """Adds ``ids`` (array<int>) and ``decoded`` (binary, from the ids).

    One function makes both: a second one would run the encoder again, or in
    workers of its own beside it."""
    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def both(texts: pa.Array) -> pa.Array:
        ids = _encoded(texts, path, pattern)
        return pa.StructArray.from_arrays([ids, _decoded(ids, path)], ["ids", "decoded"])

    out = documents.select(F.struct("*").alias("row"), both(F.col(text_col)).alias("b"))
    own = [F.col("row")[c].alias(c) for c in documents.columns if c.lower() not in ("ids", "decoded")]
    return out.select(*own, F.col("b.ids").alias("ids"), F.col("b.decoded").alias("decoded"))


def digests(encoded) -> list:
    """Columns n_tokens, ids_sha256 and decoded_sha256 of an encoded table."""
    return [F.expr("cast(size(ids) AS bigint)").alias("n_tokens"),
            F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
            F.sha2("decoded", 256).alias("decoded_sha256")]
