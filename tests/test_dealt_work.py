"""Forests grown by dealt trees and by passes, silhouettes by cells, and a
customer table that reads the items once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from losslens.operators import segment as SG
from losslens.operators import trees as T


def _binned(spark, n=400):
    r = np.random.default_rng(3)
    x = r.normal(size=(n, 4))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + r.normal(size=n) > 0.5).astype(int)
    df = spark.createDataFrame([(i, *map(float, x[i]), [int(y[i]), int(x[i, 3] > 0)],
                                 [T.TEST if i % 5 == 0 else i % 3, T.ABSENT if i % 7 == 0 else i % 3]) for i in range(n)],
                               "id int, a double, b double, c double, d double, labels array<int>, parts array<int>")
    names = ["a", "b", "c", "d"]
    return T.bin_rows(df, "id", names, T.bin_edges(df, names)).cache()


def _shape(trees, root):
    """A tree without its numbering of nodes."""
    if trees.feature[root] < 0:
        return tuple(trees.rows[root])
    left = trees.left[root]
    return (int(trees.feature[root]), int(trees.bin[root]), tuple(trees.rows[root]), int(trees.depth[root]),
            round(float(trees.gain[root]), 9), _shape(trees, left), _shape(trees, left + 1))


def test_dealt_trees_are_those_of_the_passes(spark, monkeypatch):
    rows = _binned(spark)
    fits = [T.Forest("x", 0, 1, (0, 1, 2, 3), 5, 4, 30), T.Forest("y", 1, T.TEST, (1, 3), 2, 3, 3)]
    dealt, = T.grow_forests(rows, fits)
    monkeypatch.setattr(T, "_grow_dealt", None)  # beyond the bound it is not called
    monkeypatch.setattr(T, "FOREST_ROWS", 10)
    passed, = T.grow_forests(rows, fits)
    assert len(dealt.feature) == len(passed.feature)
    assert [_shape(dealt, t) for t in range(7)] == [_shape(passed, t) for t in range(7)]
    assert np.allclose(dealt.importances(0, 4, 30), passed.importances(0, 4, 30))


def test_dealt_trees_of_no_rows(spark):
    rows = _binned(spark).where("false")
    trees, = T.grow_forests(rows, [T.Forest("x", 0, 1, (0, 1), 5, 2, 3)])
    assert list(trees.feature) == [-1, -1]


@pytest.mark.parametrize("block", [16, 64])
def test_silhouettes_by_cells(spark, block):
    r = np.random.default_rng(5)
    x = np.round(r.normal(size=(300, 3)), 1) + 1e3  # far from zero, with copies
    x[100:180] = x[0]
    k = np.stack([r.integers(0, 3, 300), r.integers(0, 2, 300)], 1)
    k[:, 0][x[:, 0] > 1001] = 2
    df = spark.createDataFrame([(i, *map(float, x[i]), *map(int, k[i])) for i in range(300)],
                               "id int, a double, b double, c double, k int, m int")
    got = SG.silhouettes(df, ["a", "b", "c"], {"k": 3, "m": 2}, "id", block)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for j, name in enumerate(("k", "m")):
        lab, out = k[:, j], []
        for i in range(300):
            own = (lab == lab[i]).sum()
            inner = d[i, lab == lab[i]].sum() / max(own - 1, 1)
            outer = min(d[i, lab == c].mean() for c in set(lab) - {lab[i]})
            out.append((outer - inner) / max(inner, outer) if own > 1 and max(inner, outer) > 0 else 0.0)
        assert got[name] == pytest.approx(np.mean(out), abs=1e-9)


def test_cells_do_not_depend_on_blocks(spark):
    df = spark.range(2000).select("id", (F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 2).cast("int").alias("k"))
    assert SG.silhouettes(df, ["a"], {"k": 2}, "id", 4)["k"] == pytest.approx(
        SG.silhouettes(df, ["a"], {"k": 2}, "id", 2000)["k"], abs=1e-12)


def test_lines_that_close_their_quotes_are_records(spark, tmp_path, monkeypatch):
    """Batches of such lines are cut without a look at each line."""
    from losslens.sources import quoted_csv as Q
    text = "a,b\n" + "".join(f'{i},"x ""{i}"", y"\n' for i in range(3000)) + '7,"two\nlines"\n' + "8,z\r\n\n \t\n9,end"
    (tmp_path / "t.csv").write_bytes(text.encode())
    (tmp_path / "u.csv").write_bytes(b"a,b\n10,u\n")
    lines = Q._lines(spark, str(tmp_path))
    quick = Q.read_quoted_csv(spark, str(tmp_path)).collect()
    assert lines.count() == 3009
    want = [(str(i), f'x "{i}", y') for i in range(3000)] + [("7", "two\nlines"), ("8", "z"), ("9", "end"), ("10", "u")]
    assert sorted(map(tuple, quick)) == sorted(want)


def test_distinct_rows_are_grouped_once(spark):
    from losslens.operators import quality as QL
    df = spark.createDataFrame([(1, "a", 0.5), (1, "a", 0.5), (2, None, None), (2, None, None), (3, "c", -0.0)],
                               "id int, s string, x double")
    out, report = QL.detect_duplicates(df, action="remove")
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "a", 0.5), (2, None, None), (3, "c", 0.0)], key=str)
    assert tuple(report.first()) == (4, 2, 2)
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
