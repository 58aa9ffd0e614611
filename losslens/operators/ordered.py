"""Distributed order statistics: exact quantiles, average ranks, prefix sums.

A window ``ORDER BY`` without ``PARTITION BY`` moves everything to one
task, and the holistic ``percentile`` aggregate keeps one value map per
group, so one hot group (a third of all rows) would land in one task.
This module avoids both:

1. collapse ties: ``groupBy(keys, v).count()`` (map-side combine), stored, so
   that the input is read once; a key with few distinct values is then an
   ordinary window, and only larger ones go on:
2. split the value axis into ~B order-preserving buckets with global
   splits from ``approxQuantile`` (bounded-memory sketch) and a
   ``Bucketizer``; the bucket id is a pure function of the value, so a
   recomputed partition after an executor loss gets the same ids;
3. per (keys, bucket) totals; their prefix over buckets is a window with
   at most B rows per key (bounded whatever the skew);
4. inside each (keys, bucket) a local running sum gives the exact
   cumulative count of every distinct value.

Rows in one (key, bucket) are about n / B, and B follows the cluster's
``spark.sql.shuffle.partitions`` (x4), so the work per task shrinks as
the cluster grows.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from losslens.session import cut_lineage, shuffle_partitions

_UNB = Window.unboundedPreceding


def default_buckets(df: DataFrame) -> int:
    # bounded: the sketch behind the edges grows with their number and is
    # merged on the driver; 4,096 buckets split a group that holds all rows
    return min(4096, max(16, 4 * shuffle_partitions(df.sparkSession)))


def value_splits(df: DataFrame, v: str, n_buckets: int) -> list[float]:
    """Order-preserving bucket edges (an action on ``df``; bounded memory)."""
    if n_buckets <= 1:
        return []
    probs = [i / n_buckets for i in range(1, n_buckets)]
    qs = df.approxQuantile(v, probs, 1.0 / (4 * n_buckets))
    return sorted({float(q) for q in qs
                   if q is not None and not math.isnan(q) and not math.isinf(q)})


def bucketize(df: DataFrame, v: str, splits: list[float], out: str = "_b") -> DataFrame:
    if not splits:
        return df.withColumn(out, F.lit(0.0))
    bz = Bucketizer(splits=[-math.inf] + splits + [math.inf], inputCol=v, outputCol=out,
                    handleInvalid="keep")
    return bz.transform(df)


def order_key(df: DataFrame, col: str):
    """Double that never decreases in the typed order of a column: the value
    itself, or for strings the six bytes after the prefix that all of them
    share (one aggregate).  Different values may map to one double; callers
    number those by the column itself."""
    if dict(df.dtypes)[col] != "string":
        return F.col(col).cast("timestamp").cast("double") if dict(df.dtypes)[col] == "date" else F.col(col).cast("double")
    lo, hi = (x.encode() if x is not None else b"" for x in df.agg(F.min(col), F.max(col)).first())
    shared = next((i for i, (a, b) in enumerate(zip(lo, hi)) if a != b), min(len(lo), len(hi)))
    six = F.hex(F.substring(F.col(col).cast("binary"), shared + 1, 6))
    return F.conv(F.rpad(six, 12, "0"), 16, 10).cast("double")


IN_KEY = 1 << 17  # distinct values up to which a key is ordered in one task


def value_counts(df: DataFrame, keys: list[str], value: str, sums: list[str] = ()) -> DataFrame:
    """(keys, ``_v``, ``_c`` and ``_s_<name>`` sums) of every distinct (keys,
    value) that is not null / NaN: the one pass over the input, stored, since
    all later steps read only this."""
    d = df.select(*keys, F.col(value).cast("double").alias("_v"),
                  *[F.col(s).cast("double").alias(f"_x_{s}") for s in sums])
    cond = F.col("_v").isNotNull() & ~F.isnan("_v")
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cut_lineage(d.where(cond).groupBy(*keys, "_v").agg(
        F.count(F.lit(1)).alias("_c"), *[F.sum(f"_x_{s}").alias(f"_s_{s}") for s in sums]))


def _split_keys(vc: DataFrame, keys: list[str]) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of keys that one task orders, rows of keys that buckets order)."""
    if not keys:
        return None, vc
    hot = cut_lineage(vc.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d")).where(F.col("_d") > IN_KEY).select(*keys))
    if hot.isEmpty():
        return vc, None
    return vc.join(hot, keys, "left_anti"), vc.join(hot, keys, "left_semi")


def _bucketed(vc: DataFrame, keys: list[str], n_buckets: int | None) -> DataFrame:
    """Value counts with the bucket ``_b`` of each value; splits are quantiles
    of the distinct values, so buckets hold equally many rows of this table."""
    nb = n_buckets or default_buckets(vc)
    return bucketize(vc, "_v", value_splits(vc, "_v", nb))


def positions(df: DataFrame, keys: list[str], value: str, sums: list[str] = (),
              n_buckets: int | None = None) -> DataFrame:
    """One row per distinct (keys, value) that is not null / NaN.

    Columns: keys, ``_v`` (value as double), ``_c`` (rows with this value),
    ``_cum`` (rows in the key with value <= ``_v``), ``_n`` (rows in the
    key), and for each name in ``sums``: ``_s_<name>`` (sum at this value),
    ``_cs_<name>`` (cumulative sum through this value), ``_t_<name>``
    (key total).
    """
    keys, sums = list(keys), list(sums)
    small, large = _split_keys(value_counts(df, keys, value, sums), keys)
    out = []
    if small is not None:  # an ordinary window per key
        wall = Window.partitionBy(*keys)
        through = wall.orderBy("_v").rowsBetween(_UNB, 0)
        out.append(small.select(
            *keys, "_v", "_c", F.sum("_c").over(wall).alias("_n"), F.sum("_c").over(through).alias("_cum"),
            *[F.col(f"_s_{s}") for s in sums], *[F.sum(f"_s_{s}").over(through).alias(f"_cs_{s}") for s in sums],
            *[F.sum(f"_s_{s}").over(wall).alias(f"_t_{s}") for s in sums]))
    if large is not None:
        out.append(_bucket_positions(_bucketed(large, keys, n_buckets), keys, sums))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def _bucket_positions(vb: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    tot = vb.groupBy(*keys, "_b").agg(F.sum("_c").alias("_bc"),
                                      *[F.sum(f"_s_{s}").alias(f"_bs_{s}") for s in sums])
    wk = Window.partitionBy(*keys).orderBy("_b") if keys else Window.orderBy("_b")
    wall = Window.partitionBy(*keys) if keys else Window.partitionBy()
    before = wk.rowsBetween(_UNB, -1)
    tot = tot.select(
        *keys, "_b",
        F.coalesce(F.sum("_bc").over(before), F.lit(0)).alias("_off"),
        F.sum("_bc").over(wall).alias("_n"),
        *[F.coalesce(F.sum(f"_bs_{s}").over(before), F.lit(0.0)).alias(f"_soff_{s}")
          for s in sums],
        *[F.sum(f"_bs_{s}").over(wall).alias(f"_t_{s}") for s in sums])
    # without keys the totals table has at most B rows: a proven broadcast bound
    j = vb.join(tot if keys else F.broadcast(tot), keys + ["_b"])
    wl = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(_UNB, 0)
    return j.select(
        *keys, "_v", "_c", "_n",
        (F.sum("_c").over(wl) + F.col("_off")).alias("_cum"),
        *[F.col(f"_s_{s}") for s in sums],
        *[(F.sum(f"_s_{s}").over(wl) + F.col(f"_soff_{s}")).alias(f"_cs_{s}") for s in sums],
        *[F.col(f"_t_{s}") for s in sums])


def _quantile_exprs(p: float, name: str):
    pos = F.lit(float(p)) * (F.col("_n") - 1)
    lo, hi = F.floor(pos), F.ceil(pos)
    start = F.col("_cum") - F.col("_c")
    at = lambda k: (start <= k) & (k < F.col("_cum"))
    return [F.max(F.when(at(lo), F.col("_v"))).alias(f"{name}__lo"),
            F.max(F.when(at(hi), F.col("_v"))).alias(f"{name}__hi"),
            F.max(pos - lo).alias(f"{name}__f")]


def _interp(name: str):
    lo, hi, f = F.col(f"{name}__lo"), F.col(f"{name}__hi"), F.col(f"{name}__f")
    return (lo + (hi - lo) * f).alias(name)


def quantiles_of_counts(vc: DataFrame, keys: list[str], specs, n_buckets=None) -> DataFrame:
    """Exact quantiles of a table of value counts (see ``value_counts``).

    A key with up to ``IN_KEY`` distinct values is one window.  Of larger ones,
    and without keys, only the one or two buckets that hold ranks
    floor(p(n-1)) and ceil(p(n-1)) of a target are ordered."""
    aggs = [e for n, _, p in specs for e in _quantile_exprs(p, n)]
    small, large = _split_keys(vc, keys)
    out = []
    if small is not None:
        wall = Window.partitionBy(*keys)
        pos = small.select(*keys, "_v", "_c", F.sum("_c").over(wall).alias("_n"),
                           F.sum("_c").over(wall.orderBy("_v").rowsBetween(_UNB, 0)).alias("_cum"))
        out.append(pos.groupBy(*keys).agg(*aggs))
    if large is not None:
        vb = _bucketed(large, keys, n_buckets)
        tot = vb.groupBy(*keys, "_b").agg(F.sum("_c").alias("_bc"))
        wk = Window.partitionBy(*keys).orderBy("_b") if keys else Window.orderBy("_b")
        wall = Window.partitionBy(*keys) if keys else Window.partitionBy()
        tot = tot.select(*keys, "_b", "_bc",
                         F.coalesce(F.sum("_bc").over(wk.rowsBetween(_UNB, -1)), F.lit(0)).alias("_off"),
                         F.sum("_bc").over(wall).alias("_n"))
        hit = F.lit(False)
        for _, _, p in specs:
            at = F.lit(float(p)) * (F.col("_n") - 1)
            for k in (F.floor(at), F.ceil(at)):
                hit = hit | ((F.col("_off") <= k) & (k < F.col("_off") + F.col("_bc")))
        tgt = tot.where(hit).select(*keys, "_b", "_off", "_n")
        cand = vb.join(tgt if keys else F.broadcast(tgt), keys + ["_b"])  # no keys: <= 2 x targets rows
        wl = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(_UNB, 0)
        pos = cand.select(*keys, "_v", "_c", "_n", (F.sum("_c").over(wl) + F.col("_off")).alias("_cum"))
        out.append(pos.groupBy(*keys).agg(*aggs) if keys else pos.agg(*aggs))
    res = out[0] if len(out) == 1 else out[0].unionByName(out[1])
    return res.select(*keys, *[_interp(n) for n, _, _ in specs])


def group_quantiles(df: DataFrame, keys: list[str], specs: list[tuple[str, str, float]],
                    method: str = "exact", accuracy: int = 10000,
                    n_buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (pandas / numpy default) per key.

    ``specs``: list of ``(output_name, value_column, probability)``.
    Null keys and null / NaN values are skipped (pandas groupby rules).
    ``method='approx'`` uses ``percentile_approx`` (opt-in, bounded memory).
    """
    keys = list(keys)
    if method == "approx":
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).isNotNull()
        aggs = [F.percentile_approx(F.col(c).cast("double"), float(p), accuracy).alias(n)
                for n, c, p in specs]
        return (df.where(cond).groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs))
    cols = list(dict.fromkeys(c for _, c, _ in specs))
    if len(cols) == 1:
        return quantiles_of_counts(value_counts(df, keys, cols[0]), keys, specs, n_buckets)
    # several value columns: unpivot once, one pass for all of them
    long = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("_m"), F.col(c).cast("double").alias("_val")) for c in cols
    ])).alias("_kv")).select(*keys, "_kv._m", "_kv._val")
    per_col = []
    for c in cols:
        per_col.append([(n, "_val", p) for n, cc, p in specs if cc == c])
    all_specs = [(f"{n}__{i}", "_val", p) for i, sp in enumerate(per_col) for n, _, p in sp]
    q = quantiles_of_counts(value_counts(long, keys + ["_m"], "_val"), keys + ["_m"], all_specs, n_buckets)
    back = []
    for i, (c, sp) in enumerate(zip(cols, per_col)):
        for n, _, _ in sp:
            back.append(F.max(F.when(F.col("_m") == c, F.col(f"{n}__{i}"))).alias(n))
    res = q.groupBy(*keys).agg(*back) if keys else q.agg(*back)
    return res.select(*keys, *[n for n, _, _ in specs])


BRACKET = 1 / 2048  # share of the rows by which the sketch behind a bracket may miss


def column_quantiles(df: DataFrame, specs: list[tuple[str, str, float]]) -> DataFrame:
    """One row of exact linear-interpolation quantiles of whole columns of a
    stored frame, also where nearly every row has a value of its own.

    A sketch brackets each target, and one more reading counts the values below
    and up to its ends.  Only values inside a bracket are grouped; those outside
    become one infinity on either side, which keeps every rank.  A bracket that
    does not hold both ranks is dropped, and all values are grouped then.
    Null / NaN values are skipped."""
    cols = list(dict.fromkeys(c for _, c, _ in specs))
    d = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    probs = sorted({min(1.0, max(0.0, p + side * 2 * BRACKET)) for _, _, p in specs for side in (-1, 1)})
    sketch = dict(zip(cols, d.approxQuantile(cols, probs, BRACKET)))
    bracket = []
    for _, c, p in specs:
        at = dict(zip(probs, sketch[c])) if sketch[c] else {}  # no values, no sketch
        bracket.append((at.get(max(0.0, p - 2 * BRACKET)), at.get(min(1.0, p + 2 * BRACKET))))
    known = {c: F.col(c).isNotNull() & ~F.isnan(c) for c in cols}
    row = d.agg(*[F.count_if(known[c]).alias(f"n{i}") for i, (_, c, _) in enumerate(specs)],
                *[F.count_if(known[c] & (F.col(c) < F.lit(lo))).alias(f"a{i}")
                  for i, ((_, c, _), (lo, _)) in enumerate(zip(specs, bracket))],
                *[F.count_if(known[c] & (F.col(c) <= F.lit(hi))).alias(f"b{i}")
                  for i, ((_, c, _), (_, hi)) in enumerate(zip(specs, bracket))]).first()
    values = []
    for i, ((name, c, p), (lo, hi)) in enumerate(zip(specs, bracket)):
        at, v = p * (row[f"n{i}"] - 1), F.col(c)
        if row[f"n{i}"] and row[f"a{i}"] <= math.floor(at) and math.ceil(at) < row[f"b{i}"]:
            v = F.when(F.isnan(c), F.col(c)).when(F.col(c) < lo, -math.inf).when(F.col(c) > hi, math.inf).otherwise(F.col(c))
        values.append(F.struct(F.lit(name).alias("_m"), v.alias("_val")))
    counts = value_counts(d.select(F.explode(F.array(*values)).alias("_x")).select("_x.*"), ["_m"], "_val")
    q = None
    for p in sorted({p for _, _, p in specs}):
        names = [n for n, _, at in specs if at == p]
        found = quantiles_of_counts(counts.where(F.col("_m").isin(names)), ["_m"], [("_q", "_v", p)]).agg(
            *[F.max(F.when(F.col("_m") == n, F.col("_q"))).alias(n) for n in names])
        q = found if q is None else q.crossJoin(found)
    return q.select(*[n for n, _, _ in specs])


def average_ranks(df: DataFrame, keys: list[str], value: str, out: str = "rank",
                  n_buckets: int | None = None) -> DataFrame:
    """Attach the average (tie-aware, 1-based) rank of ``value`` within keys.

    Equals pandas ``rank(method='average')``; rows with a null value get a
    null rank.  The rank table has one row per distinct value and is joined
    back by (keys, value); AQE's skew-join splits a hot value.
    """
    pos = positions(df, keys, value, n_buckets=n_buckets)
    rk = pos.select(*keys, F.col("_v").alias("_rv"),
                    (F.col("_cum") - (F.col("_c") - 1) / 2.0).alias(out),
                    F.col("_n").alias(f"{out}__n"))
    base = df.withColumn("_rv", F.col(value).cast("double"))
    return base.join(rk, keys + ["_rv"], "left").drop("_rv")


def feature_ranks(df: DataFrame, id_col: str, cols, prefix: str = "_r_",
                  n_buckets: int | None = None) -> DataFrame:
    """Average ranks of several columns in ONE pass: unpivot to
    (id, feature, value), positions keyed by feature, join back, pivot by id.
    The plan stays linear in the number of columns (chaining per-column
    rank joins would duplicate the input plan at every step)."""
    cols = list(cols)
    long = df.select(F.col(id_col), F.explode(F.array(*[
        F.struct(F.lit(c).alias("_f"), F.col(c).cast("double").alias("_val")) for c in cols
    ])).alias("_kv")).select(id_col, "_kv._f", "_kv._val")
    pos = positions(long, ["_f"], "_val", n_buckets=n_buckets).select(
        "_f", F.col("_v").alias("_val"), (F.col("_cum") - (F.col("_c") - 1) / 2.0).alias("_rank"))
    lr = long.join(pos, ["_f", "_val"], "left")
    wide = lr.groupBy(id_col).pivot("_f", cols).agg(F.first("_rank"))
    return wide.select(id_col, *[F.col(c).alias(prefix + c) for c in cols])
