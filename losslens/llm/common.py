"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from losslens.session import cut_lineage, ensure_checkpoint_dir

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder on the storage that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the session's shared folder."""
    return cut_lineage(df)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """At most so many rows in an Arrow batch of the actions inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_blocks(column: pa.Array, size: int) -> Iterator[list[str]]:
    """The texts of an Arrow column (null as empty) in runs of up to so many
    bytes; a longer text is alone.  Only one run is ever in Python strings."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield [t or "" for t in column.slice(at, stop - at).to_pylist()]
        at = stop


__all__ = ["arrow_rows", "checkpoint", "ensure_checkpoint_dir", "new_folder", "read_table", "text_blocks"]
