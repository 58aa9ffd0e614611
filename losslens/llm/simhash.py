"""SimHash near-copies by covering locality-sensitive hashing.

Fingerprint: A-Z are lowered, words are runs without ASCII white space,
shingles are ``shingle`` consecutive words joined by blanks, repeats
included (a shorter text is one shingle; a text without words has
fingerprint zero and is linked like any other).  A bit is set when it is set
in more than half of the shingles' XXH64 values (seed 42).

Search: bit i of the fingerprint gets a nonzero vector m(i) of r + 1 bits.
For each of the 2^(r+1) - 1 nonzero vectors v, table v keeps the bits with
odd <m(i), v>.  At most r differing bits span fewer than r + 1 dimensions,
so some v is orthogonal to all of them and table v drops every differing
bit: each pair within the radius meets in some table, always.

Copies collapse first: only distinct fingerprints are searched.  A bucket
over ``BUCKET`` fingerprints is refined rather than cut: the bits its table
dropped are dealt into r + 1 parts, and each fingerprint goes to r + 1
narrower buckets that keep one part more.  A pair within the radius agrees on
at least one part, so nothing is lost; a bucket whose bits are all kept holds
one fingerprint, so refining ends.  A bucket emits the edges of a spanning
star for each group that is linked inside it, never all its pairs.

Defined cases: null text counts as empty.  Repeated rows each get a row.  A
null id never becomes a component id while the component has another id; a
component of null ids only has a null id.  Empty tables give empty results.
Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from losslens.llm.common import checkpoint
from losslens.llm.graph import star_components

SHINGLE = 3
DISTANCE = 3
SEED = 42
BUCKET = 4096
ROWS = 128
BLOCK = 1 << 18


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) < shingle:
        ends, starts = [len(joined)], [0]
    else:
        step = np.fromiter(map(len, words), np.int64, len(words)) + 1
        after = np.cumsum(step)
        starts = (after - step)[: len(words) - shingle + 1].tolist()
        ends = (after - 1)[shingle - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, len(starts), BLOCK):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[k:k + BLOCK], ends[k:k + BLOCK])])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big", signed=True)


def fingerprint_column(text, shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return of(text)


def covering_masks(distance: int) -> list[int]:
    """Signed 64-bit masks of the kept bits, one per table."""
    vectors = [1 + i % (2 ** (distance + 1) - 1) for i in range(64)]
    masks = []
    for v in range(1, 2 ** (distance + 1)):
        kept = sum(1 << i for i, m in enumerate(vectors) if bin(m & v).count("1") % 2)
        masks.append(kept - (1 << 64) if kept >> 63 else kept)
    return masks


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))  # of signed numbers it would count abs()


def linked_stars(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(members, smallest fingerprint of their group) of the groups linked
    inside one bucket, without the smallest itself."""
    fps = np.unique(fps)
    label = np.full(len(fps), -1)
    for i in range(len(fps)):
        if label[i] < 0:
            label[i] = i
            front = [i]
            while len(front):  # a block of the front against all that are free yet
                free = np.flatnonzero(label < 0)
                block, front = front[:ROWS], front[ROWS:]
                near = differing_bits(fps[block][:, None], fps[free][None, :]) <= distance
                new = free[near.any(0)]
                label[new] = i
                front = np.concatenate([front, new]).astype(np.int64)
    member = label != np.arange(len(fps))
    return fps[member], fps[label[member]]


def _stars_of(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.int64)
            at = lists.offsets.to_numpy()
            u, v = [], []
            pair = np.flatnonzero(np.diff(at) == 2)
            a, b = flat[at[pair]], flat[at[pair] + 1]
            close = differing_bits(a, b) <= distance
            u.append(np.maximum(a, b)[close])
            v.append(np.minimum(a, b)[close])
            for k in np.flatnonzero(np.diff(at) > 2):
                x, y = linked_stars(flat[at[k]:at[k + 1]], distance)
                u.append(x)
                v.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])
    return run


def covering_links(nodes: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v), u > v, whose components are those of all pairs of
    ``nodes.fp`` (distinct) within the distance."""
    keys = ", ".join(f"{m}L" if m != -(1 << 63) else "-9223372036854775807L - 1" for m in covering_masks(distance))
    rows = (nodes.select("fp", F.expr(f"explode(array({keys}))").alias("mask"))
            .select("mask", F.expr("fp & mask").alias("key"), "fp"))
    edges = None
    while True:
        sizes = checkpoint(rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"))
        cold = sizes.where(F.col("n") <= bucket).select("mask", "key")
        groups = (rows.join(cold, ["mask", "key"]).groupBy("mask", "key")
                  .agg(F.collect_list("fp").alias("fps")).select("fps"))
        found = checkpoint(groups.mapInArrow(_stars_of(distance), "u long, v long"))  # else the plan grows by every round
        edges = found if edges is None else edges.union(found)
        if sizes.where(F.col("n") > bucket).isEmpty():
            return edges
        hot = sizes.where(F.col("n") > bucket).select("mask", "key")
        rows = checkpoint(_refined(rows.join(hot, ["mask", "key"], "left_semi"), distance).distinct())


def _refined(rows: DataFrame, distance: int) -> DataFrame:
    """The rows of hot buckets, each in distance + 1 narrower buckets."""
    @F.pandas_udf("array<long>")
    def narrower(mask: pd.Series) -> pd.Series:
        cache = {}
        for m in mask.unique():
            free = [i for i in range(64) if not (int(m) >> i) & 1]
            out = []
            for part in range(distance + 1):
                kept = (int(m) & (2**64 - 1)) | sum(1 << i for i in free[part::distance + 1])
                out.append(kept - (1 << 64) if kept >> 63 else kept)
            cache[m] = out
        return mask.map(cache)
    wider = rows.select("fp", "mask", F.explode(narrower("mask")).alias("to")).where("to <> mask")
    return wider.select(F.col("to").alias("mask"), F.expr("fp & to").alias("key"), "fp")


def simhash_components(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) for every row; fp is the signed fingerprint."""
    fps = checkpoint(documents.select(F.col(id_col).alias("doc_id"),
                                      fingerprint_column(F.col(text_col), shingle).alias("fp")))
    nodes = checkpoint(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    stars = star_components(covering_links(nodes, distance))
    rooted = (nodes.join(stars.withColumnRenamed("u", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    # stored, so that the join below is between plain tables, where a hot fingerprint's partition is split
    of_fp = checkpoint(rooted.join(ids, "root").select("fp", "component_id"))
    return fps.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The document of least id of each component, with all its columns.

    Each row is judged by its own text's component.  Rows that share a kept id
    and have it as the least of their components leave one row, that of the
    least text hash.  Rows without an id belong to no document and stay."""
    named = documents.where(F.col(id_col).isNotNull())
    of_id = simhash_components(named, id_col, text_col, shingle, distance)
    texts = checkpoint(of_id.groupBy("doc_id", "fp").agg(F.max("component_id").alias("c"), F.count("*").alias("n")))
    kept = texts.groupBy("doc_id").agg(F.max(F.expr("doc_id = c")).alias("least"), F.sum("n").alias("n")).where("least")
    kept = checkpoint(kept.select(F.col("doc_id").alias("kept_id"), "n"))
    row = documents.select(F.struct("*").alias("row"))
    out = row.join(kept, F.col("row")[id_col] == F.col("kept_id"))
    least = texts.where("doc_id = c").select(F.col("doc_id").alias("kept_id"), "fp")
    once = (out.where("n > 1").withColumn("fp", fingerprint_column(F.col("row")[text_col], shingle))
            .join(least, ["kept_id", "fp"], "left_semi").groupBy("kept_id")
            .agg(F.min_by("row", F.xxhash64(F.col("row")[text_col])).alias("row")).select("row.*"))
    return out.where("n = 1").select("row.*").union(once).union(documents.where(F.col(id_col).isNull()))


def hexadecimal(fp: str) -> str:
    return f"lower(lpad(hex({fp}), 16, '0'))"
