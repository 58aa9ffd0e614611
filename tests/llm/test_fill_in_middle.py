"""Fill-in-middle transformation against a per-text version and its SQL twin."""
import hashlib
import os
import random
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

pytest.importorskip("public_tokenizers")

from losslens.llm import fill_in_middle as fim  # noqa: E402
from losslens.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"
BITS = ["<P>", "<S>", "<M>", "<", ">", "P", "S>", "<P", "é", "日本", "🙂", "a", " ", "\n", "word", "\x00"]


def brute(doc_id, text):
    text = text or ""
    n = len(text)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def check(df):
    want = sorted(((i, *brute(i, t), t or "") for i, t in rows_of(df)), key=repr)
    out = fim.restored(fim.fill_in_middle(df)).collect()
    assert sorted((tuple(r) for r in out), key=repr) == want
    return {r.form for r in out}


def test_random_texts(spark):
    rnd = random.Random(11)
    rows = [(i, "".join(rnd.choice(BITS[3:] if rnd.random() < .8 else BITS) for _ in range(rnd.randint(0, 40))))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert check(df) == {"plain", "psm", "spm"}


def test_small_blocks_cut_nothing():
    rnd = random.Random(12)
    texts = ["".join(rnd.choice(BITS[3:]) for _ in range(rnd.randint(0, 30))) for _ in range(500)] + [None, "x" * 5000]
    column = pa.array(texts).slice(3)
    for size in (1, 64, 1 << 20):
        got, last = [], 0
        for at, raw, off in fim.blocks(column, size):
            assert at == last
            h = np.random.default_rng(1).integers(0, 1 << 32, (len(off) - 1, 4))
            p = fim.scatter(raw, off, h, plain_from=100)
            back, back_off = fim.gather_back(p["raw"], p["off"], p["form"])
            assert back.tobytes() == raw.tobytes() and np.array_equal(back_off, off)
            got += [raw[a:b].tobytes().decode() for a, b in zip(off, off[1:])]
            last = at + len(off) - 1
        assert got == [t or "" for t in texts[3:]]


def test_odd_rows(spark):
    long = "é🙂 word\n" * 200_000
    rows = [(1, None, "a", 1), (2, "", "b", 2), (None, "no id", "c", 3), (4, "same", "d", 4), (4, "same", "d", 4),
            (5, long, "e", 5), (6, "a <P> b", "f", 6), (7, "🙂", "g", 7), (8, "<", "h", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, n long") \
        .selectExpr("*", "text AS output", "n AS f")
    assert "plain" in check(df)
    assert fim.restored(fim.fill_in_middle(df.limit(0))).count() == 0
    assert fim.fill_in_middle(df).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


def test_parameters(spark):
    df = spark.createDataFrame([(i, f"text number {i}") for i in range(400)], "doc_id long, text string")
    forms = {r.form for r in fim.fill_in_middle(df, plain_from=100, spm_below=100).collect()}
    assert forms == {"spm"}
    assert {r.form for r in fim.fill_in_middle(df, plain_from=0).collect()} == {"plain"}
    other = {r.doc_id: r.output for r in fim.fill_in_middle(df, seed="2").collect()}
    assert any(other[r.doc_id] != r.output for r in fim.fill_in_middle(df).collect())


def test_broken_outputs_raise(spark):
    df = spark.createDataFrame([("<P>a<M>b", "psm")], "output string, form string")
    with pytest.raises(Exception, match="three marks"):
        fim.restored(df).collect()
    df = spark.createDataFrame([("<P>a<S>b<M>c", "spm")], "output string, form string")
    with pytest.raises(Exception, match="order of its form"):
        fim.restored(df).collect()


def test_query_is_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(queries.ORACLE_SQL["op13_fill_in_middle"])
    out = queries.QUERIES["op13_fill_in_middle"](spark, SF)
    rows = sorted((tuple(r) for r in out.select(*want.columns).collect()), key=repr)
    assert rows == sorted(want.fetchall(), key=repr) and rows
