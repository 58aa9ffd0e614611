"""Removal of repeated byte strings with sharded suffix arrays.

A byte goes when it lies in a window of ``length`` bytes that starts at two
or more places of the table, the same document included; windows overlap
freely, never cross documents, and are judged on the input.

1. Each window has a minimizer: the least hash of its ``GRAM``-byte grams.
   Equal windows have equal minimizers, so equal windows meet under that
   key.  A maximal run of windows with one minimizer is a *segment* (about
   170 windows); a segment is known by its key and content hash.
2. Keys that occur once are done.  Of the others, identical segments
   collapse into one with a count, and only that one's bytes move.
3. Segments are dealt to shards by key.  A task joins whole keys to texts of
   a few MB, builds their suffix arrays by induced sorting, and reads the
   permuted common prefixes: a window repeats when a neighbour in the array
   shares ``length`` bytes with it or its segment has a count over one.
4. A key with more than ``SEGMENTS`` different segments (a short string
   common to very many different contexts) is not given to one task: its
   windows are dealt by their own 128-bit hash and counted, which splits it
   completely.
5. Repeated windows become byte spans per document, and the text is cut.

Rows are joined by a 128-bit hash of id and text, so null and repeated ids
are told apart by text.  Defined cases: null text is empty; identical rows
repeat each other, so all of a long enough text goes in each of them; texts
under ``length`` bytes stay whole; a text of any length is scanned in pieces;
an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from losslens.llm.common import ensure_checkpoint_dir
from losslens.llm.suffix_array import permuted_lcp, suffix_array

LENGTH = 400
GRAM = 64
SEGMENTS = 2048
KEY_BYTES = 1 << 24  # bytes of one key's segments that one suffix array holds
PIECE = 1 << 18  # bytes scanned at once; positions in a piece fit 20 bits
SHARD_TEXT = 1 << 20  # bytes of one suffix array, unless one key has more
SHARD_BYTES = 1 << 24
_PLACE = np.uint64((1 << 20) - 1)
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and reread: cuts lineage, compressed."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/substrings-{uuid.uuid4().hex}-{name}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _gram_hash(text: np.ndarray, size: int, base: int = _BASE) -> np.ndarray:
    """Polynomial hash of each gram of the size, joined from powers of two."""
    out, done, h, k = None, 0, _TABLE[text], 1
    while True:
        if size & k:
            if out is None:
                out = h
            else:  # out covers `done` bytes, h the next k
                n = len(h) - done
                out = out[:n] * np.uint64(pow(base, k, 1 << 64)) + h[done:done + n]
            done += k
        if done == size:
            return out[: len(text) - size + 1]
        h = h[:-k] * np.uint64(pow(base, k, 1 << 64)) + h[k:]
        k *= 2


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` keys, from block minima."""
    n = len(key) - width + 1
    blocks = np.full(-(-len(key) // width) * width, np.uint64(2**64 - 1), np.uint64)
    blocks[: len(key)] = key
    blocks = blocks.reshape(-1, width)
    left = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    right = np.minimum.accumulate(blocks, 1).ravel()
    return np.minimum(left[:n], right[width - 1:width - 1 + n])


def segments_of(text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(start, windows, key, occurrences of the key) of all segments of
    documents laid end to end; ends: one past the last byte of each."""
    if len(text) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    grams = length - GRAM + 1
    key = (_mix(_gram_hash(text, GRAM)) & ~_PLACE) | np.arange(len(text) - GRAM + 1, dtype=np.uint64)
    least = _least(key, grams)
    own = least >> np.uint64(20)
    at = np.arange(len(least))
    valid = np.repeat(ends, np.diff(ends, prepend=0))[: len(least)] - at >= length
    starts = valid.copy()
    starts[1:] &= (own[1:] != own[:-1]) | ~valid[:-1]
    new_doc = ends[:-1][ends[:-1] < len(least)]
    starts[new_doc] = valid[new_doc]
    first = np.flatnonzero(starts)
    if not len(first):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    places = valid.copy()
    places[1:] &= least[1:] != least[:-1]
    places |= starts
    count = np.add.reduceat(valid.astype(np.int64), first)
    return first, count, own[first].astype(np.int64), np.add.reduceat(places.astype(np.int64), first)


def _pieces(batch: pa.RecordBatch, length: int):
    """(row numbers, byte offsets, text, ends) of runs of rows within PIECE."""
    rows, offsets, parts, size = [], [], [], 0
    texts = batch.column("t")
    for row in range(len(texts)):
        text = (texts[row].as_py() or "").encode()
        for at in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[at:at + PIECE + length - 1]
            if len(part) < length:
                continue
            if size + len(part) > PIECE + length - 1:
                yield rows, offsets, b"".join(parts), np.cumsum([len(p) for p in parts])
                rows, offsets, parts, size = [], [], [], 0
            rows.append(row)
            offsets.append(at)
            parts.append(part)
            size += len(part)
    if parts:
        yield rows, offsets, b"".join(parts), np.cumsum([len(p) for p in parts])


def _scan(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
            for rows, offsets, raw, ends in _pieces(batch, length):
                first, count, key, occurs = segments_of(np.frombuffer(raw, np.uint8), ends, length)
                doc = np.searchsorted(ends, first, "right")
                content = np.fromiter(
                    (xxhash.xxh3_64_intdigest(raw[a:a + n + length - 1]) for a, n in zip(first.tolist(), count.tolist())),
                    np.uint64, len(first)).astype(np.int64)
                row = np.asarray(rows)[doc]
                start = first - np.concatenate(([0], ends))[doc] + np.asarray(offsets)[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (k1[row], k2[row], start, count, key, content, occurs)],
                    ["k1", "k2", "start", "windows", "key", "content", "occurs"])
    return run


def _cut_segments(length: int):
    """Bytes of the listed segments of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "content", "windows", "n", "hot"]
        for batch in batches:
            lists = batch.column("segments")
            flat = lists.flatten()
            cols = {c: flat.field(c) for c in [*names, "start"]}
            start, windows = (cols[c].to_pylist() for c in ("start", "windows"))
            sizes, k, raw = lists.value_lengths().to_pylist(), 0, []
            for row, size in enumerate(sizes):
                text = (batch.column("t")[row].as_py() or "").encode()
                raw += [text[start[i]:start[i] + windows[i] + length - 1] for i in range(k, k + size)]
                k += size
            yield pa.RecordBatch.from_arrays([*(cols[c] for c in names), pa.array(raw, pa.binary())], [*names, "bytes"])
    return run


def repeated_windows(texts: list[bytes], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """For each segment, which of its windows repeat within the segments or
    because the segment itself does."""
    raw = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(size + 1) - 1
    symbols = raw.astype(np.int32) + 2
    symbols[ends] = 1  # between segments
    symbols = np.append(symbols, 0).astype(np.int32)
    before, common = permuted_lcp(symbols, suffix_array(symbols))
    at = np.arange(len(raw))
    window = np.repeat(ends, size + 1) - at >= length
    hit = np.flatnonzero(window & (common[:-1] >= length))
    repeats = np.zeros(len(symbols), bool)
    repeats[hit] = True
    repeats[before[hit]] = True
    starts = ends - size
    return [repeats[a:e - length + 1] | (c > 1) for a, e, c in zip(starts, ends, counts)]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _shards(length: int):
    """Sorted by key: suffix arrays over whole keys, SHARD_TEXT bytes at a time."""
    def solve(rows):
        if not rows:
            return None
        key, content, counts, texts = zip(*rows)
        out = [[], [], [], []]
        for k, c, flags in zip(key, content, repeated_windows(list(texts), np.array(counts), length)):
            a, b = _runs(flags)
            out[0] += [k] * len(a)
            out[1] += [c] * len(a)
            out[2] += a.tolist()
            out[3] += b.tolist()
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["key", "content", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "content", "n", "bytes"))):
                if size >= SHARD_TEXT and rows[-1][0] != row[0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield solve(rows)
    return run


def _window_hashes(length: int):
    """Every window of a segment by its own hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, content, n, raw in zip(*(batch.column(c).to_pylist() for c in ("key", "content", "n", "bytes"))):
                text = np.frombuffer(raw, np.uint8)
                a, b = (_mix(_gram_hash(text, length, x)).view(np.int64) for x in (_BASE, 0xC2B2AE3D27D4EB4F))
                same = np.ones(len(a), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (a, b, key * same, content * same, np.arange(len(a)), n * same)],
                    ["w1", "w2", "key", "content", "at", "n"])
    return run


def _remove(text: str | None, a: list[int], b: list[int]) -> tuple[int, int, int, bytes]:
    """(bytes, removed, spans, what is left) for sorted spans, which may overlap."""
    raw = (text or "").encode()
    left, at, removed, spans = [], 0, 0, 0
    for x, y in zip(a, b):
        if x > at or spans == 0:
            spans += 1
        left.append(raw[at:max(at, x)])
        removed += max(0, y - max(at, x))
        at = max(at, y)
    left.append(raw[at:])
    return len(raw), removed, spans, b"".join(left)


def _removed(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, s in zip(texts, spans.to_pylist()):
        s = s or []
        n, removed, count, kept = _remove(text.as_py(), [x["a"] for x in s], [x["b"] for x in s])
        out.append((n, removed, count, kept, hashlib.sha256(kept).hexdigest()))
    cols = list(zip(*out)) or [[]] * 5
    kinds = [pa.int64()] * 3 + [pa.binary(), pa.string()]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      ["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])


def remove_repeats(documents: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   max_segments: int = SEGMENTS, key_bytes: int = KEY_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) for every row;
    kept is the remaining bytes (binary: a span may end inside a character)."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    docs = docs.withColumns({"k1": F.xxhash64("doc_id", "t"), "k2": F.xxhash64(F.lit("k2"), "t", "doc_id")})
    kinds = "k1 long, k2 long, start long, windows long, key long, content long, occurs long"
    every = _stored(docs.select("k1", "k2", "t").mapInArrow(_scan(length), kinds), "segments")
    # one row per different segment, with its keys' totals; keys that occur once go
    kept = every.groupBy("key", "content", "windows").agg(
        F.count("*").alias("n"), F.sum("occurs").alias("occurs"), F.min(F.struct("k1", "k2", "start")).alias("one"))
    totals = kept.groupBy("key").agg(F.sum("occurs").alias("total"), F.count("*").alias("different"),
                                     F.sum(F.col("windows") + (length - 1)).alias("size")).where("total > 1")
    kept = _stored(kept.join(totals, "key").selectExpr(
        "key", "content", "windows", "n", f"different > {max_segments} OR size > {key_bytes} AS hot", "one.*"), "kept")
    lists = kept.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("key", "content", "windows", "n", "hot", "start")).alias("segments"))
    cut = _stored(docs.select("k1", "k2", "t").join(lists, ["k1", "k2"]).select("t", "segments").mapInArrow(
        _cut_segments(length), "key long, content long, windows long, n long, hot boolean, bytes binary"), "bytes")
    total = cut.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES), min(2 * cut.sparkSession.sparkContext.defaultParallelism,
                                                  total // SHARD_TEXT))
    columns = "key", "content", "n", "bytes"
    found = (cut.where("NOT hot").select(*columns).dropDuplicates(["key", "content"])
             .repartition(int(shards), "key").sortWithinPartitions("key")
             .mapInArrow(_shards(length), "key long, content long, a long, b long"))
    windows = _stored(cut.where("hot").select(*columns).dropDuplicates(["key", "content"])
                      .mapInArrow(_window_hashes(length), "w1 long, w2 long, key long, content long, at long, n long"),
                      "windows")
    # what is joined is stored first: between plain tables a window or a segment of a third of all documents is
    # a partition that is split
    again = _stored(windows.groupBy("w1", "w2").agg(F.sum("n").alias("total")).where("total > 1").select("w1", "w2"), "again")
    found = found.union(windows.join(again, ["w1", "w2"]).selectExpr("key", "content", "at AS a", "at + 1 AS b"))
    lists = _stored(found.groupBy("key", "content").agg(F.collect_list(F.struct("a", "b")).alias("ab")), "lists")
    spans = (lists
             .join(every.select("key", "content", "k1", "k2", "start"), ["key", "content"])
             .select("k1", "k2", F.expr(f"inline(transform(ab, x -> struct(start + x.a AS a, start + x.b + {length - 1} AS b)))"))
             .groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans")))
    removed = F.arrow_udf(_removed, "struct<n_bytes:long,n_removed:long,n_spans:long,kept:binary,kept_sha256:string>")
    return (docs.join(spans, ["k1", "k2"], "left").withColumn("r", removed("t", "spans"))
            .select("doc_id", "r.*"))
