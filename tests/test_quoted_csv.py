"""CSV with quoted line feeds, read in many blocks, against Python's csv module."""
import csv
import random

import pytest
from pyspark.sql import functions as F

from losslens.sources import quoted_csv as Q
from losslens.sources import raw

BITS = ["a", "b c", '"', "\n", ",", "\n\n", "é", '""', " ", "x" * 30, "\t", "'"]


def write(path, rows, end="\n", bom=False):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write("﻿" if bom else "")
        csv.writer(f, lineterminator=end).writerows(rows)


@pytest.fixture
def blocks(spark):
    """Blocks of a few dozen bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0",
             "spark.sql.files.minPartitionNum": "64"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def texts(seed, n):
    rnd = random.Random(seed)
    return [[str(i), "".join(rnd.choice(BITS) for _ in range(rnd.randint(1, 6))) + ".",
             "" if rnd.random() < .2 else "z" + rnd.choice(BITS) * rnd.randint(0, 40) + "z"] for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_are_those_of_the_csv_module(spark, blocks, tmp_path, end):
    rows = texts(3, 120)
    write(tmp_path / "one.csv", [["id", " text ", 'la"st'], *rows], end)
    write(tmp_path / "two.csv", [["id", " text ", 'la"st'], *[[str(1000 + int(r[0])), *r[1:]] for r in rows[:7]]], end)
    lines = Q._lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20 and len(Q.block_parities(lines)) > 20
    df = raw.read_csv(spark, str(tmp_path))
    assert df.columns == ["id", "text", 'la"st']
    got = {r[0]: (r[1], r[2] or "") for r in df.collect()}
    want = {r[0]: (r[1], r[2]) for r in rows} | {str(1000 + int(r[0])): (r[1], r[2]) for r in rows[:7]}
    assert got == want


def test_one_record_over_many_blocks(spark, blocks, tmp_path):
    long = "line\n" * 400 + '"quoted"\n,'
    write(tmp_path / "a.csv", [["id", "t"], ["1", "first"], ["2", long], ["3", long + "!"], ["4", "last"]])
    got = {r.id: r.t for r in raw.read_csv(spark, str(tmp_path / "a.csv")).collect()}
    assert got == {"1": "first", "2": long, "3": long + "!", "4": "last"}


def test_blank_lines_marks_and_dates(spark, tmp_path):
    with open(tmp_path / "a.csv", "w") as f:
        f.write('﻿id, created_at ,n\n1,2020-01-02 03:04:05,5\n\n2,"not a ""date""",\n   \n3,,7')
    df = raw.read_csv(spark, str(tmp_path / "a.csv"), ["id", "created_at"], ["created_at"])
    assert [(r.id, r.d) for r in df.select("id", F.col("created_at").cast("string").alias("d")).orderBy("id").collect()] == [
        ("1", "2020-01-02 03:04:05"), ("2", None), ("3", None)]
    typed = raw.read_csv(spark, str(tmp_path / "a.csv"), schema="id int, created_at string, n double")
    assert sorted((r.id, r.n) for r in typed.collect() if r.n) == [(1, 5.0), (3, 7.0)]
    with pytest.raises(ValueError, match="columns not in"):
        raw.read_csv(spark, str(tmp_path / "a.csv"), ["absent"])
    (tmp_path / "none.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        raw.read_csv(spark, str(tmp_path / "none.csv"))
    (tmp_path / "header.csv").write_text("a,b\n")
    assert raw.read_csv(spark, str(tmp_path / "header.csv")).count() == 0


def test_first_file_is_cut_otherwise_when_read_alone(spark, tmp_path):
    # Spark cuts files into parts of all bytes / cores: fewer bytes, shorter blocks
    write(tmp_path / "a.csv", [["id", "t"], *[[str(i), "line\n" + "a" * 40] for i in range(400)]])
    write(tmp_path / "b.csv", [["id", "t"], *[[str(i), "b" * 200] for i in range(400, 1200)]])
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {r.id: r.t for r in raw.read_csv(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert got == {str(i): "line\n" + "a" * 40 if i < 400 else "b" * 200 for i in range(1200)}
