"""Quoted CSV that any number of tasks read.

A line feed inside quotes does not end a record, so a file cannot be cut at
line feeds alone.  But whether a place lies inside quotes depends only on the
parity of the quotes before it (a doubled quote changes nothing):

1. the lines of a file are read in blocks, as Spark splits text files, and
   the quotes of each block are counted;
2. a prefix sum over the blocks of each file gives the parity at which each
   block begins (one row a block);
3. each block then cuts itself into records; what is open at its end, and what
   it holds of a record begun before, leave it as fragments, at most two a
   block, which are joined per file in order.

Records are parsed by ``from_csv``.  Quoting is that of RFC 4180: quotes
surround whole fields and are doubled inside.  Blank lines are no records; a
carriage return before the line feed that ends a record is dropped.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from losslens.session import cut_lineage

MAX_BLOCKS = 1 << 20  # blocks whose parities are sent to the tasks
WHOLE, HEAD, REST = range(3)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def block_parities(lines: DataFrame) -> dict[tuple[str, int], int]:
    """Parity of the quotes before each block of each file."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    own = lines.groupBy("file", "block").agg(F.sum(quotes).alias("q"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    found = cut_lineage(own.select("file", "block", F.pmod(F.coalesce(F.sum("q").over(before), F.lit(0)), F.lit(2)).alias("p")))
    n = found.count()
    if n > MAX_BLOCKS:
        raise ValueError(f"{n} blocks; at most {MAX_BLOCKS} are read at a time")
    return {(r.file, r.block): r.p for r in found.toLocalIterator()}


def _cut(parities):
    """(file, block, n, kind, record) of the blocks' records and fragments; n
    is the record's place in its block, and a fragment of an earlier record
    has -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parity, held, n, out = None, 0, [], -1, []

        def close(kind):
            out.append((*at, n, kind, "\n".join(held)))

        for batch in batches:
            counts = pc.count_substring(batch.column("value"), '"')
            if not parity and batch.num_rows and not (counts.to_numpy() & 1).any():
                # every line closes its own quotes: records are the lines as they are
                blocks, files = batch.column("block").to_numpy(), batch.column("file").dictionary_encode()
                code = files.indices.to_numpy()
                start = np.flatnonzero(np.r_[True, (blocks[1:] != blocks[:-1]) | (code[1:] != code[:-1])])
                ats = [(files.dictionary[code[i]].as_py(), int(blocks[i])) for i in start.tolist()]
                gone = [a for a in ats if a not in parities.value]
                if gone:
                    raise ValueError(f"{gone[0][0]} was split anew between two reads; read it with one setting")
                if not any(parities.value[a] for a in ats[ats[0] == at:]):
                    first = np.zeros(len(start), np.int64)
                    first[0] = n + 1 if ats[0] == at else 0
                    size = np.diff(np.r_[start, len(blocks)])
                    place = np.arange(len(blocks)) + np.repeat(first - start, size)
                    at, n, held = ats[-1], int(place[-1]), []
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("file"), batch.column("block"), pa.array(place), pa.array(np.full(len(blocks), WHOLE, np.int32)),
                         batch.column("value")], ["file", "block", "n", "kind", "record"])
                    continue
            counts = counts.to_pylist()
            for line, quotes, file, block in zip(batch.column("value").to_pylist(), counts, batch.column("file").to_pylist(),
                                                 batch.column("block").to_pylist()):
                if (file, block) != at:
                    if at is not None and parity:
                        close(HEAD if n >= 0 else REST)
                    at, n, held = (file, block), -1, []
                    if at not in parities.value:
                        raise ValueError(f"{file} was split anew between two reads; read it with one setting")
                    parity = parities.value[at]
                if not parity:
                    held, n = [], n + 1
                held.append(line)
                parity ^= quotes & 1
                if not parity:
                    close(WHOLE if n >= 0 else REST)
            yield _batch(out)
            out = []
        if at is not None and parity:
            close(HEAD if n >= 0 else REST)
            yield _batch(out)
    return run


def _batch(rows: list) -> pa.RecordBatch:
    kinds = [("file", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("kind", pa.int32()), ("record", pa.string())]
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], [k for k, _ in kinds])


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, n, record) of all records of the files under a path; the
    first record of a file has block 0 and n 0."""
    return _records(_lines(spark, path), spark.sparkContext.broadcast(block_parities(_lines(spark, path))))


def _records(lines: DataFrame, parities) -> DataFrame:
    """``parities``: broadcast, at most ``MAX_BLOCKS`` numbers."""
    cut = lines.mapInArrow(_cut(parities), "file string, block long, n long, kind int, record string")
    pieces = cut_lineage(cut.where(F.col("kind") != WHOLE))  # at most two a block
    order = Window.partitionBy("file").orderBy("block", "n")
    joined = (pieces.withColumn("g", F.sum((F.col("kind") == HEAD).cast("int")).over(order))
              .groupBy("file", "g").agg(F.sort_array(F.collect_list(F.struct("block", "n", "record"))).alias("p"))
              .select("file", F.expr("p[0].block").alias("block"), F.expr("p[0].n").alias("n"),
                      F.expr("array_join(transform(p, x -> x.record), '\\n')").alias("record")))
    whole = cut.where(F.col("kind") == WHOLE).select("file", "block", "n", "record")
    return (whole.union(joined)
            .withColumn("record", F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)"))
                        .otherwise(F.col("record")))
            .where(F.col("record").rlike(r"[^ \r\n\t]")))


def read_quoted_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Columns of the files under a path by the header of the first; strings
    without a schema."""
    lines = _lines(spark, path)
    found = block_parities(lines)
    parities = spark.sparkContext.broadcast(found)
    rows = _records(lines, parities)

    def header(rows):
        return rows.where("block = 0 AND n = 0").orderBy("file").select("record").first()
    # the first file has it, unless it begins with a blank line; Spark reads that
    # file alone and cuts it by its own size, so its blocks are others
    one = lines.where(F.col("file") == min(found)[0]) if found else None
    first = (header(_records(one, spark.sparkContext.broadcast(block_parities(one)))) if found else None) or header(rows)
    if first is None:
        raise ValueError(f"no header in {path}")
    names = next(csv.reader([first[0]]))
    kind = schema or ", ".join(f"c{i} string" for i in range(len(names)))
    parsed = F.from_csv("record", F.lit(kind), {"escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"})
    out = rows.where("NOT (block = 0 AND n = 0)").select(parsed.alias("r")).select("r.*")
    return out if schema else out.toDF(*names)
