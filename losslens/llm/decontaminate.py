"""Benchmark passages in documents by latent semantic retrieval.

1. Words (Latin letters lowered, without marks around them) are hashed to 32 bits; the hash
   also gives a term number below ``TERMS``.  Disjoint runs of ``WINDOW``
   words are the passages whose term frequencies give idf weights; terms in
   over ``COMMON`` of all passages weigh nothing.
2. Randomised SVD: with A the TF-IDF matrix of all passages and a random
   orthonormal O, every task sums its part of Z = A'(A O) and the parts are
   added up in Spark by blocks of terms.  A's leading right singular vectors
   follow from Z and O alone (Nystroem), so one pass over A is enough.  Z has
   a fixed size (``TERMS`` x (``RANK`` + ``EXTRA``)) whatever the corpus.
3. Every window of 32 words (in steps of 16) and of 16 words (in steps of 8)
   of every document is projected and compared by cosine with windows of all
   benchmark items: items over ``LONG`` words give all their windows of 32,
   others all their windows of 16.  The items are the stated query set and go
   in blocks of ``BLOCK``.  A pair is a candidate from ``NEAR`` on, less for
   items that don't fill a window.
4. Candidates that share too few weighted terms go; for the others the words
   around the window are compared with the item: it is found when their
   longest common subsequence holds ``LCS`` of the item's words, and ``ANSWER``
   of the item's last words (its answer) occur in order at its end.
5. What cosines miss (words too common for a weight, edits in the windows, an
   item in a large part of all documents) is found exactly: of n words of an
   item at most n - LCS n may lack, so of its n - LCS n + ``HITS`` rarest words
   ``HITS`` stand close together wherever it is found.  Such places are
   compared in the same way, for every item; no weight or cosine decides there.

Defined cases: null and wordless texts and items match nothing; null ids are
kept as null in the pairs; repeated documents or items give one pair per
pair of ids; an empty table on either side gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from losslens.llm.common import arrow_rows, checkpoint, new_folder

TERMS = 1 << 15
RANK = 64
EXTRA = 8
WINDOW = 32
STEP = 8
LONG = 36
COMMON = 0.02
NEAR = {32: 0.6, 16: 0.5}
PIECE = 1 << 20  # bytes hashed at once
BASE = 0x9E3779B97F4A7C15
SHARED = 0.45
HITS = 3
PLACES = 256  # terms of a row added place by place
PARTS = 8  # parts of Z for each core: a lost one is a small share of the pass
LCS = 0.8
ANSWER = 0.6
ANSWER_WORDS = 5
BLOCK = 2048
SEED = 9
TERM_BLOCKS = 64
_KIND = np.array([0 if chr(c) in " \t\n\x0b\x0c\r" else 2 if c > 127 or chr(c).isalnum() else 1 for c in range(256)],
                 np.uint8)
_LOWER = np.array([c + 33 if 65 <= c <= 90 else c + 1 for c in range(256)], np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, modulo 2^64."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(n, np.uint64(base))
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


_POWERS = lru_cache(1)(lambda: _powers(PIECE))


def word_hashes(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hashes of all words, words per text) of UTF-8 texts laid end to
    end; ends: one past the last byte of each.

    Words are runs without ASCII white space, Latin letters lowered, without
    ASCII marks at either end; what is nothing but marks is no word.  A word's hash is the
    difference of two prefix sums of byte * BASE^place, moved to place 0."""
    if not len(raw):
        return np.zeros(0, np.uint32), np.zeros(len(ends), np.int64)
    up, down = _POWERS() if len(raw) <= PIECE else _powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    letters = _LOWER[raw]
    second = np.flatnonzero(raw[:-1] == 0xC3) + 1  # capitals A-grave to Thorn, but for the times sign
    second = second[(raw[second] <= 0x9E) & (raw[second] != 0x97)]
    letters[second] += np.uint64(32)
    np.cumsum(letters * up[: len(raw)], out=sums[1:])
    kind = _KIND[raw]  # 0 white space, 1 mark, 2 other
    inside = kind > 0
    begins, stops = inside.copy(), inside.copy()
    edge = np.zeros(len(raw) + 1, bool)
    edge[ends] = True
    edge[0] = True
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    a, b = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    for at, move, shift in ((a, 1, 0), (b, -1, -1)):  # off with the marks
        todo = np.flatnonzero(kind[at + shift] == 1)
        while len(todo):
            at[todo] += move
            todo = todo[a[todo] < b[todo]]
            todo = todo[kind[at[todo] + shift] == 1]
    word = a < b
    starts = np.concatenate(([0], ends[:-1]))
    first = np.searchsorted(np.flatnonzero(begins), starts)
    count = np.concatenate(([0], np.cumsum(word)))
    sizes = np.diff(np.append(count[first], count[-1]))
    a, b = a[word], b[word]
    h = (sums[b] - sums[a]) * down[a]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(32)).astype(np.uint32), sizes


def _pieces(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of runs of rows of up to PIECE bytes together."""
    rows, size, first = [], 0, 0
    for i, t in enumerate(texts.cast(pa.binary()) if texts.type != pa.binary() else texts):
        t = t.as_py() or b""
        if size and size + len(t) > PIECE:
            yield first, rows
            rows, size, first = [], 0, i
        rows.append(t)
        size += len(t)
    if rows:
        yield first, rows


def hash_texts(texts: pa.Array) -> list[np.ndarray]:
    """Word hashes of each text of an Arrow column; null is empty."""
    out = []
    for _, rows in _pieces(texts):
        # a text over PIECE is cut at white space, where it has any
        parts, owner = [], []
        for i, t in enumerate(rows):
            while len(t) > PIECE and (cut := max(t.rfind(b" ", 0, PIECE), t.rfind(b"\n", 0, PIECE))) > 0:
                parts.append(t[:cut])
                owner.append(i)
                t = t[cut:]
            parts.append(t)
            owner.append(i)
        found = [[] for _ in rows]
        k = 0
        while k < len(parts):
            n, size = k, 0
            while n < len(parts) and (n == k or size + len(parts[n]) <= PIECE):
                size += len(parts[n])
                n += 1
            h, sizes = word_hashes(np.frombuffer(b"".join(parts[k:n]), np.uint8), np.cumsum([len(p) for p in parts[k:n]]))
            for i, x in zip(owner[k:n], np.split(h, np.cumsum(sizes)[:-1])):
                found[i].append(x)
            k = n
        out += [x[0] if len(x) == 1 else np.concatenate(x) for x in found]
    return out


def terms_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint32(TERMS - 1)).astype(np.int64)


def _hash_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = hash_texts(batch.column("t"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([h.tobytes() for h in found], pa.binary())], ["doc_id", "words"])


def _flat(batch: pa.RecordBatch):
    """Runs of rows with few words together: (first row, hashes end to end, sizes)."""
    column, k = batch.column("words"), 0
    lengths = np.array([x.as_buffer().size // 4 for x in column], np.int64)
    while k < len(lengths):
        total = np.cumsum(lengths[k:])
        n = max(1, int(np.searchsorted(total, 1 << 18, "right")))
        raw = b"".join([x.as_py() for x in column[k:k + n]])
        yield k, np.frombuffer(raw, np.uint32), lengths[k:k + n]
        k += n


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes end to end, sizes) of runs of rows, across batches."""
    parts, words = [], 0
    for batch in batches:
        for _, hashes, sizes in _flat(batch):
            if parts and words + len(hashes) > 1 << 18:
                yield tuple(np.concatenate(x) for x in zip(*parts))
                parts, words = [], 0
            parts.append((hashes, sizes))
            words += len(hashes)
    if parts:
        yield tuple(np.concatenate(x) for x in zip(*parts))


def _passage_of(sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the width-word run of each word, runs per text)."""
    runs = -(-sizes // width)
    base = np.cumsum(runs) - runs
    start = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) - np.repeat(start, sizes)
    return np.repeat(base, sizes) + at // width, runs


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count, passages = np.zeros(TERMS, np.int64), 0
    for batch in batches:
        for _, hashes, sizes in _flat(batch):
            passage, runs = _passage_of(sizes, WINDOW)
            n = int(runs.sum())
            place = np.arange(len(passage)) - np.searchsorted(passage, np.arange(n))[passage]
            rows = np.full((n, WINDOW), TERMS, np.uint16)
            rows[passage, place] = terms_of(hashes)
            rows.sort(axis=1)
            first = np.ones(rows.shape, bool)
            first[:, 1:] = rows[:, 1:] != rows[:, :-1]
            count += np.bincount(rows[first], minlength=TERMS + 1)[:TERMS]
            passages += n
    used = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(count[used], passages))],
                                     ["term", "n"])


def random_basis() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((TERMS, RANK + EXTRA), np.float32)


def _project(terms: np.ndarray, row: np.ndarray, rows: int, table: np.ndarray) -> np.ndarray:
    """Sums of the table's vectors over the terms of each row (sorted rows).

    Rows go by falling size, so the first, second, ... terms of many rows are
    added at once; what a row has beyond PLACES terms is added by itself."""
    out = np.zeros((rows, table.shape[1]), np.float32)
    size = np.bincount(row, minlength=rows)
    first = np.cumsum(size) - size
    order = np.argsort(-size, kind="stable")[:np.count_nonzero(size)]
    for k in range(0, len(order), 1024):
        at, n = first[order[k:k + 1024]], size[order[k:k + 1024]]
        sums = table[terms[at]]
        for j in range(1, min(PLACES, int(n[0]))):
            have = int(np.searchsorted(-n, -j))  # rows with more than j terms
            sums[:have] += table[terms[at[:have] + j]]
        for i in range(int(np.searchsorted(-n, -PLACES))):
            for a in range(at[i] + PLACES, at[i] + n[i], 4096):
                sums[i] += table[terms[a:min(a + 4096, at[i] + n[i])]].sum(0)
        out[order[k:k + 1024]] = sums
    return out


def _sketch(weights):
    """Parts of Z = A'(A O), by blocks of terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = weights.value
        table = random_basis() * weight[:, None].astype(np.float32)
        z = np.zeros(table.shape)
        for hashes, sizes in _runs(batches):
            terms = terms_of(hashes)
            passage, runs = _passage_of(sizes, WINDOW)
            on = weight[terms] > 0
            terms, passage = terms[on], passage[on]
            n = int(runs.sum())
            length = np.sqrt(np.bincount(passage, weight[terms] ** 2, n)) + 1e-9
            y = (_project(terms, passage, n, table) / (length**2)[:, None]).astype(np.float32)
            order = np.argsort(terms.astype(np.uint16), kind="stable")  # the terms' passages, term by term
            used, row = np.unique(terms[order], return_inverse=True)
            z[used] += _project(passage[order], row, len(used), y)
        z = (z * weight[:, None]).astype(np.float32)
        step = TERMS // TERM_BLOCKS
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(TERM_BLOCKS), pa.int32()), pa.array([TaskContext.get().partitionId()] * TERM_BLOCKS, pa.int32()),
             pa.array([z[k * step:(k + 1) * step].tobytes() for k in range(TERM_BLOCKS)], pa.binary())],
            ["block", "task", "z"])
    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of blocks whose parts come one after the other; one sum is held."""
    block, total = None, None
    for batch in batches:
        for b, z in zip(batch.column("block").to_pylist(), batch.column("z").to_pylist()):
            z = np.frombuffer(z, np.float32).astype(np.float64)
            if b != block:
                if total is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                                     ["block", "z"])
                block, total = b, z
            else:
                total += z
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["block", "z"])


def singular_vectors(z: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(right singular vectors, singular values) of A from Z = A'A O."""
    shift = 1e-6 * np.linalg.norm(z) / np.linalg.norm(basis)
    y = z + shift * basis
    gram = basis.T @ y
    gram = (gram + gram.T) / 2
    lower = np.linalg.cholesky(gram + 1e-9 * np.trace(gram) / len(gram) * np.eye(len(gram)))
    f = np.linalg.solve(lower, y.T).T  # f f' is near A'A
    values, turn = np.linalg.eigh(f.T @ f)
    order = np.argsort(-values)[:RANK]
    values = np.maximum(values[order], 1e-12)
    return f @ turn[:, order] / np.sqrt(values), np.sqrt(np.maximum(values - shift, 0))


def _projection(parts: list, weight: np.ndarray) -> np.ndarray:
    """Weighted right singular vectors of the parts of Z."""
    basis = random_basis().astype(np.float64)
    z = np.zeros(basis.shape)
    step = TERMS // TERM_BLOCKS
    for r in parts:
        z[r.block * step:(r.block + 1) * step] = np.frombuffer(r.z).reshape(step, -1)
    vectors = singular_vectors(z, basis)[0] if np.any(z) else basis[:, :RANK]
    return (vectors * weight[:, None]).astype(np.float32)


def _with_next(steps: np.ndarray, row: np.ndarray, ahead: int, join=np.add) -> np.ndarray:
    """Each step's value joined with that of the step so far ahead in its text."""
    out = steps.copy()
    same = np.flatnonzero(row[ahead:] == row[:-ahead])
    out[same] = join(steps[same], steps[same + ahead])
    return out


def _bit(terms: np.ndarray) -> np.ndarray:
    return np.uint64(1) << (terms & 63).astype(np.uint64)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def common_subsequence(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(length of the longest common subsequence, place in b just after the
    first prefix of b that holds it), by bits of one integer."""
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row, best, end = full, 0, 0
    for k, x in enumerate(b.tolist()):
        match = places.get(x)
        if match:
            u = row & match
            row = ((row + u) | (row - u)) & full
            n = len(a) - row.bit_count()
            if n > best:
                best, end = n, k + 1
    return best, end


class Queries:
    """Projected windows of one width of the items of a block."""

    def __init__(self, words: list[np.ndarray], width: int, table: np.ndarray, weight: np.ndarray):
        self.width, item, vectors, need, rows = width, [], [], [], []
        for i, w in enumerate(words):
            parts = [terms_of(w[a:a + width]) for a in range(0, max(1, len(w) - width // 2), width // 2)]
            for part in (p for p in parts if weight[p].any()):
                item.append(i)
                vectors.append(table[part].sum(0))
                rows.append(np.unique(part[weight[part] > 0]))
                need.append(NEAR[width] * np.sqrt(len(part) / width))
        self.item = np.array(item, np.int64)
        self.vectors = _unit(np.array(vectors, np.float32)) if vectors else np.zeros((0, RANK), np.float32)
        self.need = np.array(need, np.float32)
        self.size = np.array([len(r) for r in rows], np.int64)
        self.terms = np.full((len(rows), width), TERMS + 1, np.uint16)
        for k, r in enumerate(rows):
            self.terms[k, : len(r)] = r
        self.bits = np.array([np.bitwise_or.reduce(_bit(r)) for r in rows], np.uint64)
        # so many bits are common at least where enough terms are
        self.least = np.ceil(SHARED * self.size - 1e-9) - (self.size - np.bitwise_count(self.bits))

    def shared(self, k: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Share of each item window's weighted terms in a document window."""
        out = np.empty(len(k))
        for j in range(0, len(k), 8192):
            pair = self.terms[k[j:j + 8192], :, None] == windows[j:j + 8192, None, :]
            out[j:j + 8192] = pair.any(2).sum(1)
        return out / self.size[k]

    def candidates(self, windows, bits, begin, stop, terms):
        """(windows, items) of pairs that are near and share enough terms;
        bits: of each window's terms; terms: of all words, TERMS for those
        without weight."""
        for k in range(0, len(windows) if len(self.item) else 0, 2048):
            near = _unit(windows[k:k + 2048]) @ self.vectors.T >= self.need
            at, query = np.divmod(np.flatnonzero(near), len(self.item))  # faster than the places of a matrix
            at += k
            some = np.bitwise_count(bits[at] & self.bits[query]) >= self.least[query]
            at, query = at[some], query[some]
            place = begin[at, None] + np.arange(self.width)
            own = np.where(place < stop[at, None], terms[np.minimum(place, len(terms) - 1)], TERMS).astype(np.uint16)
            kept = self.shared(query, own) >= SHARED
            yield from zip(at[kept].tolist(), self.item[query[kept]].tolist())


class Rarest:
    """The rarest words of a block of items, to find all places where an item
    can be; frequency: of each term, any figures give the same result."""

    def __init__(self, words: list[np.ndarray], frequency: np.ndarray):
        found, item = [], []
        self.hits, self.span = np.ones(len(words), np.int64), np.zeros(len(words), np.int64)
        for i, w in enumerate(words):
            need = least_common(len(w))
            self.hits[i], self.span[i] = max(1, min(HITS, need)), 2 * len(w) + WINDOW
            rare = np.argsort(frequency[terms_of(w)], kind="stable")[:len(w) - need + self.hits[i]]
            found.append(np.unique(w[rare]))
            item.append(np.full(len(found[-1]), i))
        found, item = np.concatenate(found), np.concatenate(item)
        self.item = item[np.argsort(found, kind="stable")]
        self.words, self.begin, self.count = np.unique(np.sort(found), return_index=True, return_counts=True)
        self.flag = np.zeros(1 << 20, bool)
        self.flag[self.words >> np.uint32(12)] = True

    def places(self, hashes: np.ndarray, text: np.ndarray):
        """(item, first, last place) of runs of hits of an item close together;
        text: the text of each word."""
        at = np.flatnonzero(self.flag[hashes >> np.uint32(12)])
        if not len(at):
            return
        k = np.minimum(np.searchsorted(self.words, hashes[at]), len(self.words) - 1)
        same = self.words[k] == hashes[at]
        at, k = at[same], k[same]
        n = self.count[k]
        item = self.item[np.repeat(self.begin[k] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        order = np.argsort(item, kind="stable")
        item, at = item[order], np.repeat(at, n)[order]
        first = np.arange(len(item))
        last = first + self.hits[item] - 1
        first, last = first[last < len(item)], last[last < len(item)]
        near = ((item[first] == item[last]) & (text[at[first]] == text[at[last]])
                & (at[last] - at[first] < self.span[item[first]]))
        first, last = first[near], last[near]
        yield from zip(item[first].tolist(), at[first].tolist(), at[last].tolist())


def least_common(n: int) -> int:
    """Least common subsequence with which an item of n words is found."""
    return next(k for k in range(n + 1) if not k < LCS * n)


def around(hashes: np.ndarray, begin: int, start: int, stop: int, n: int) -> np.ndarray:
    """The words of a text (start to stop) that an item of n words is compared
    with at a window."""
    return hashes[max(start, begin - n):min(stop, begin + WINDOW + n)]


def exact(item: np.ndarray, hashes: np.ndarray, first: int, last: int, start: int, stop: int, tried: set) -> float | None:
    """confirm() at all windows of a text whose surroundings hold both places,
    but for those tried before."""
    n = len(item)
    low = max(start, last - WINDOW - n + 1)
    low += -(low - start) % STEP
    begins = range(low, min(stop - 1, first + n) + 1, STEP)
    begins = [b for b in sorted(begins, key=lambda b: abs(b - first)) if b not in tried]
    tried.update(begins)
    if begins:
        held = np.isin(item, hashes[max(start, min(begins) - n):min(stop, max(begins) + WINDOW + n)])
        if held.sum() >= least_common(n):
            return next((s for b in begins if (s := confirm(item, around(hashes, b, start, stop, n))) is not None), None)
    return None


def confirm(item: np.ndarray, around: np.ndarray) -> float | None:
    """Share of the item's words in common order with the words around a
    window, if the item is found there."""
    found, end = common_subsequence(item, around)
    if found < LCS * len(item):
        return None
    answer = item[-min(ANSWER_WORDS, len(item)):]
    tail = around[max(0, end - 2 * len(answer) - 1):end + len(answer)]
    if common_subsequence(answer, tail)[0] < ANSWER * len(answer):
        return None
    return found / len(item)


def _search(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, table, weight, frequency = sent.value
        words = [np.frombuffer(w, np.uint32) for w in words]
        long = [w if len(w) > LONG else w[:0] for w in words]
        short = [w if len(w) <= LONG else w[:0] for w in words]
        queries = [Queries(long, WINDOW, table, weight), Queries(short, 16, table, weight)]
        rarest = Rarest(words, frequency)  # one table: each word of the corpus is looked up once
        for batch in batches:
            doc, item, share, by_cosine = [], [], [], []
            for first, hashes, sizes in _flat(batch):
                if not len(hashes):
                    continue
                terms = terms_of(hashes)
                step, runs = _passage_of(sizes, STEP)
                on = weight[terms] > 0
                steps = _project(terms[on], step[on], int(runs.sum()), table)
                row = np.repeat(np.arange(len(sizes)), runs)
                start = np.cumsum(sizes) - sizes
                place = np.arange(len(row)) - (np.cumsum(runs) - runs)[row]  # of the step in its text
                begin, stop = start[row] + place * STEP, (start + sizes)[row]
                pairs = _with_next(steps, row, 1)
                bits = np.zeros(len(row), np.uint64)
                if on.any():
                    first_of = np.flatnonzero(np.diff(step[on], prepend=-1))
                    bits[step[on][first_of]] = np.bitwise_or.reduceat(_bit(terms[on]), first_of)
                two = _with_next(bits, row, 1, np.bitwise_or)
                four = _with_next(two, row, 2, np.bitwise_or)
                even = np.flatnonzero(place % 2 == 0)
                known = np.where(on, terms, TERMS)
                done = set()
                for query, windows, has, at in ((queries[0], _with_next(pairs, row, 2)[even], four[even], even),
                                                (queries[1], pairs, two, np.arange(len(row)))):
                    for k, i in query.candidates(windows, has, begin[at], stop[at], known):
                        h = at[k]
                        if (row[h], i) in done:
                            continue
                        s = confirm(words[i], around(hashes, begin[h], start[row[h]], stop[h], len(words[i])))
                        if s is not None:
                            done.add((row[h], i))
                            doc.append(first + row[h])
                            item.append(i)
                            share.append(s)
                            by_cosine.append(True)
                text = np.repeat(np.arange(len(sizes)), sizes)
                tried = defaultdict(set)
                for i, a, b in rarest.places(hashes, text):
                    r = int(text[a])
                    if (r, i) in done:
                        continue
                    s = exact(words[i], hashes, a, b, int(start[r]), int(start[r] + sizes[r]), tried[r, i])
                    if s is not None:
                        done.add((r, i))
                        doc.append(first + r)
                        item.append(i)
                        share.append(s)
                        by_cosine.append(False)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc, pa.int64())), pa.array([ids[i] for i in item], pa.int64()),
                 pa.array(share, pa.float64()), pa.array(by_cosine, pa.bool_())], ["doc_id", "item_id", "lcs", "by_cosine"])
    return run


def contaminated(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, lcs, by_cosine) of every document that holds an item;
    by_cosine: the cosines found it, not only the search by rarest words."""
    spark = documents.sparkSession
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    path = new_folder(spark, "decontaminate")
    docs.mapInArrow(_hash_documents, f"doc_id {kind}, words binary").write.parquet(path)
    hashed = spark.read.parquet(path)

    counts = (hashed.select("words").mapInArrow(_frequencies, "term long, n long")
              .groupBy("term").agg(F.sum("n").alias("n")).collect())  # at most TERMS + 1 rows
    passages = max(1, next((r.n for r in counts if r.term < 0), 1))
    weight, frequency = np.zeros(TERMS), np.zeros(TERMS, np.int64)
    for r in counts:
        if r.term >= 0:
            frequency[r.term] = r.n
        if r.term >= 0 and r.n <= max(COMMON * passages, 50):
            weight[r.term] = np.log(1 + passages / r.n)

    sent = spark.sparkContext.broadcast(weight)
    tasks = PARTS * spark.sparkContext.defaultParallelism  # each gives one part of Z
    with arrow_rows(spark, 64):
        parts = (hashed.select("words").coalesce(tasks).mapInArrow(_sketch(sent), "block int, task int, z binary")
                 .repartition(TERM_BLOCKS, "block").sortWithinPartitions("block", "task").select("block", "z")
                 .mapInArrow(_add, "block int, z binary").collect())  # TERMS * (RANK + EXTRA) numbers
    sent.destroy()
    table = _projection(parts, weight)
    del parts

    items = (benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))
             .distinct())
    out = None
    block: list = []
    for row in [*items.toLocalIterator(), None]:  # the stated query set, a block at a time
        if row is not None:
            block.append(row)
        if block and (row is None or len(block) == BLOCK):
            words = hash_texts(pa.array([r.t for r in block], pa.string()))
            query = ([r.item_id for r in block], [w.tobytes() for w in words], table, weight, frequency)
            sent = spark.sparkContext.broadcast(query)
            found = checkpoint(hashed.mapInArrow(_search(sent), f"doc_id {kind}, item_id long, lcs double, by_cosine boolean"))
            sent.destroy()
            out, block = found if out is None else out.union(found), []
    if out is None:
        return spark.createDataFrame([], f"doc_id {kind}, item_id long, lcs double, by_cosine boolean")
    return out.groupBy("doc_id", "item_id").agg(F.max("lcs").alias("lcs"), F.max("by_cosine").alias("by_cosine"))
