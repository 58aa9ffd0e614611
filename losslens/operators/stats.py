"""

Every test reduces the data to per-group moments or rank sums in one
distributed pass (partial aggregation; ranks from ``ordered.positions``);
the statistic is a DataFrame expression over that small table and the
p-value a function of a few scalars (``functions.dist``).  Tables of groups
and of their pairs stay DataFrames.  Work caps of the reference (post-hoc
group and row limits) are not applied: the post-hoc runs on all rows because
it costs one aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from losslens.functions import dist
from losslens.operators.ordered import average_ranks, positions
from losslens.session import cut_lineage, shuffle_partitions

ALPHA = 0.05
EFFECT_THRESHOLD = 0.06


def _clean(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.select(F.col(group), F.col(value).cast("double").alias(value)).where(
        F.col(group).isNotNull() & F.col(value).isNotNull() & ~F.isnan(value))


def group_moments(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group n, mean, sample variance, sum of squared deviations and
    population skew / excess kurtosis (for the normality gate)."""
    d = _clean(df, group, value)
    return d.groupBy(group).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"),
        F.var_samp(value).alias("var"), F.var_pop(value).alias("_vp"),
        F.skewness(value).alias("skew"), F.kurtosis(value).alias("kurt")
    ).withColumn("ss", F.col("_vp") * F.col("n")).drop("_vp")


def anova_table(df: DataFrame, group: str, value: str) -> DataFrame:
    """T2 / T3 core numbers: k, n, SS between / within, F, eta squared."""
    m = group_moments(df, group, value)
    g = m.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("_N"),
              (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_grand"))
    j = m.crossJoin(g)  # g is one row
    t = j.agg(F.first("k").alias("k"), F.first("_N").alias("n"),
              F.sum(F.col("n") * (F.col("mean") - F.col("_grand")) ** 2).alias("ss_between"),
              F.sum("ss").alias("ss_within"))
    dfb = F.col("k") - 1
    dfw = F.col("n") - F.col("k")
    f = (F.col("ss_between") / dfb) / (F.col("ss_within") / dfw)
    tot = F.col("ss_between") + F.col("ss_within")
    return t.select(F.col("k").cast("long").alias("k"), F.col("n").cast("long").alias("n"),
                    "ss_between", "ss_within", f.alias("f_stat"),
                    F.when(tot > 0, F.col("ss_between") / tot).otherwise(0.0).alias("eta_squared"))


def _one(df: DataFrame) -> dict:
    r = df.first()
    return r.asDict() if r else {}


def anova(df: DataFrame, group: str, value: str) -> dict:
    r = _one(anova_table(df, group, value))
    r["p_value"] = dist.f_sf(r["f_stat"], r["k"] - 1, r["n"] - r["k"]) if r.get("f_stat") is not None else math.nan
    return r


def kruskal_parts(df: DataFrame, group: str, value: str):
    """Per-group (n_i, rank sum R_i) with global average ranks, and the tie
    term sum(t^3 - t) -- ranks from the bucketed positions primitive.

    The three passes (split sketch, tie counts, group counts) read one
    checkpoint of the two projected columns instead of re-running the
    upstream item pipeline three times."""
    d = cut_lineage(_clean(df, group, value))
    pos = positions(d, [], value)
    ranks = pos.select(F.col("_v"), (F.col("_cum") - (F.col("_c") - 1) / 2.0).alias("_r"),
                       (F.col("_c").cast("double") ** 3 - F.col("_c")).alias("_tie"))
    gv = d.groupBy(group, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_gc"))
    per = gv.join(ranks, ["_v"]).groupBy(group).agg(
        F.sum("_gc").alias("n"), F.sum(F.col("_gc") * F.col("_r")).alias("rank_sum"))
    ties = ranks.agg(F.sum("_tie").alias("tie_sum"))
    return per, ties


def kruskal_table(df: DataFrame, group: str, value: str) -> DataFrame:
    """T4 core numbers: H (tie-corrected), k, n, epsilon squared."""
    per, ties = kruskal_parts(df, group, value)
    g = per.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
                F.sum(F.col("rank_sum") ** 2 / F.col("n")).alias("_s"))
    t = g.crossJoin(ties)
    n = F.col("n").cast("double")
    h0 = 12.0 / (n * (n + 1)) * F.col("_s") - 3 * (n + 1)
    corr = 1 - F.col("tie_sum") / (n ** 3 - n)
    h = h0 / corr
    return t.select(F.col("k").cast("long").alias("k"), F.col("n").cast("long").alias("n"),
                    h.alias("h_stat"),
                    F.when(n - F.col("k") > 0, (h - F.col("k") + 1) / (n - F.col("k"))).otherwise(0.0)
                    .alias("epsilon_squared"))


def kruskal(df: DataFrame, group: str, value: str) -> dict:
    r = _one(kruskal_table(df, group, value))
    r["p_value"] = dist.chi2_sf(r["h_stat"], r["k"] - 1) if r.get("h_stat") is not None else math.nan
    return r


def dunn_z(df: DataFrame, group: str, value: str, groups=None) -> DataFrame:
    """T7 statistics: |z| of mean-rank differences for all ordered pairs
    (tie-corrected variance).  ``groups`` restricts to given levels (the
    reference's largest-12 rule is applied by the caller).  Ranks are
    computed on the rows of the selected groups."""
    d = _clean(df, group, value)
    if isinstance(groups, DataFrame):
        d = d.join(groups.select(group), [group], "left_semi")
    elif groups is not None:
        d = d.where(F.col(group).isin(list(groups)))
    per, ties = kruskal_parts(d, group, value)
    per = cut_lineage(per)
    _pairs_allowed(per)
    tot = per.agg(F.sum("n").alias("N")).crossJoin(ties)
    a = per.select(F.col(group).alias("group_a"), F.col("n").alias("na"),
                   (F.col("rank_sum") / F.col("n")).alias("ra"))
    b = per.select(F.col(group).alias("group_b"), F.col("n").alias("nb"),
                   (F.col("rank_sum") / F.col("n")).alias("rb"))
    # pairs of groups are the result; at most MAX_GROUPS groups
    pairs = a.crossJoin(F.broadcast(b)).crossJoin(F.broadcast(tot))
    N = F.col("N").cast("double")
    var = (N * (N + 1) / 12.0 - F.col("tie_sum") / (12.0 * (N - 1))) * (1 / F.col("na") + 1 / F.col("nb"))
    return pairs.select("group_a", "group_b",
                        F.when(F.col("group_a") == F.col("group_b"), F.lit(0.0))
                        .otherwise(F.abs(F.col("ra") - F.col("rb")) / F.sqrt(var)).alias("z"))


MAX_GROUPS = 20_000  # groups whose pairs are compared: the pairs are the result, 200 million rows


def _pairs_allowed(groups: DataFrame) -> int:
    k = groups.count()
    if k > MAX_GROUPS:
        raise ValueError(f"{k} groups have too many pairs; at most {MAX_GROUPS} are compared")
    return k


def _norm_sf(z):
    """Upper tail of the normal distribution of a column."""
    @F.pandas_udf("double")
    def tail(z: pd.Series) -> pd.Series:
        return pd.Series([0.5 * math.erfc(x / math.sqrt(2)) if x is not None and x == x else math.nan for x in z])
    return tail(z)


def dunn(df: DataFrame, group: str, value: str, groups=None) -> DataFrame:
    """Bonferroni-adjusted two-sided p for every ordered pair, diagonal 1
    (long form, both directions).  ``groups``: levels, or a DataFrame of them."""
    z = dunn_z(df, group, value, groups)
    k = z.where("group_a = group_b")
    m = k.agg((F.count(F.lit(1)) * (F.count(F.lit(1)) - 1) / 2).alias("m"))
    p = F.least(F.lit(1.0), 2 * _norm_sf("z") * F.col("m"))
    return z.crossJoin(F.broadcast(m)).select(  # one row
        F.col("group_a").cast("string").alias("group_a"), F.col("group_b").cast("string").alias("group_b"), "z",
        F.when(F.col("group_a") == F.col("group_b"), 1.0).otherwise(p).alias("p_adj"))


def tukey_hsd(df: DataFrame, group: str, value: str, alpha: float = ALPHA) -> DataFrame:
    """All pairs from group moments.  The studentized range's critical
    value is one number; the pairs' tails are found in blocks of an array."""
    m = cut_lineage(group_moments(df, group, value).select(F.col(group).cast("string").alias("g"), "n", "mean", "ss"))
    k = _pairs_allowed(m)
    one = m.agg(F.sum("n").alias("n"), F.sum("ss").alias("ss")).first()
    dfw = (one["n"] or 0) - k
    mse = one["ss"] / dfw if dfw > 0 else math.nan
    lo, hi = 0.0, 50.0
    for _ in range(60):  # critical q by bisection on the tail
        mid = (lo + hi) / 2
        if dist.tukey_sf(mid, k, dfw) > alpha:
            lo = mid
        else:
            hi = mid
    qcrit = (lo + hi) / 2

    @F.pandas_udf("double")
    def tail(q: pd.Series) -> pd.Series:
        return pd.Series(dist.tukey_sf_many(q.to_numpy(float), k, dfw))

    a = m.select(F.col("g").alias("group1"), F.col("n").alias("n1"), F.col("mean").alias("m1"))
    b = m.select(F.col("g").alias("group2"), F.col("n").alias("n2"), F.col("mean").alias("m2"))
    se = F.sqrt(F.lit(mse / 2) * (1 / F.col("n1") + 1 / F.col("n2")))
    d = (a.join(F.broadcast(b), F.col("group1") < F.col("group2"))  # at most MAX_GROUPS rows
         .withColumn("meandiff", F.col("m2") - F.col("m1")).withColumn("se", se)
         .withColumn("q", F.when(F.col("se") > 0, F.abs("meandiff") / F.col("se")).otherwise(F.lit(math.inf)))
         .withColumn("p_adj", tail("q")))
    return d.select("group1", "group2", "meandiff", "p_adj", (F.col("meandiff") - qcrit * F.col("se")).alias("lower"),
                    (F.col("meandiff") + qcrit * F.col("se")).alias("upper"), (F.col("p_adj") < alpha).alias("reject"))


# ------------------------------------------------------------------ T5 Shapiro-Wilk
SCORES = 4096  # normal scores that one row of ties stands for at most
# fixed values: Royston's polynomials (ascending powers) of the last two weights and of the transformed statistic
_LAST = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
_LAST_BUT_ONE = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
_GAMMA = [-2.273, 0.459]
_SMALL_MEAN, _SMALL_LOG_SD = [0.5440, -0.39978, 0.025054, -6.714e-4], [1.3822, -0.77857, 0.062767, -0.0020322]
_LARGE_MEAN, _LARGE_LOG_SD = [-1.5861, -0.31082, -0.083751, 0.0038915], [-0.4803, -0.082676, 0.0030302]


def _poly(c: list[float], x: float) -> float:
    return sum(a * x**i for i, a in enumerate(c))


def _score(i: int, n: int) -> float:
    return NormalDist().inv_cdf((i - 0.375) / (n + 0.25))


def shapiro_from_sums(n: int, low: float, low2: float, high2: float, high: float, sum_score_x: float,
                      sum_score2: float, ss: float) -> tuple[float, float]:
    """(W, p) of one sample from its size, its two smallest and two largest
    values, the sums of score x value and of score squared over the ordered
    sample, and the squared deviations from the mean."""
    if n < 3 or not ss > 0:
        return math.nan, math.nan
    if n == 3:
        w = 0.5 * (high - low) ** 2 / ss
        w = min(max(w, 0.75), 1.0)
        return w, max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    m1, m2, u = _score(n, n), _score(n - 1, n), 1 / math.sqrt(n)
    a1 = _poly(_LAST, u) + m1 / math.sqrt(sum_score2)
    ends = m1 * (high - low)
    if n > 5:
        a2 = _poly(_LAST_BUT_ONE, u) + m2 / math.sqrt(sum_score2)
        scale = math.sqrt((sum_score2 - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2))
        top = a1 * (high - low) + a2 * (high2 - low2) + (sum_score_x - ends - m2 * (high2 - low2)) / scale
    else:
        scale = math.sqrt((sum_score2 - 2 * m1 * m1) / (1 - 2 * a1 * a1))
        top = a1 * (high - low) + (sum_score_x - ends) / scale
    w = min(top * top / ss, 1.0)
    if w == 1.0:
        return w, 1.0
    y, x = math.log(1 - w), math.log(n)
    if n <= 11:
        g = _poly(_GAMMA, n)
        if y >= g:
            return w, 0.0
        y, mean, sd = -math.log(g - y), _poly(_SMALL_MEAN, n), math.exp(_poly(_SMALL_LOG_SD, n))
    else:
        mean, sd = _poly(_LARGE_MEAN, x), math.exp(_poly(_LARGE_LOG_SD, x))
    return w, 0.5 * math.erfc((y - mean) / sd / math.sqrt(2))


def shapiro_wilk(df: DataFrame, group: str, value: str, alpha: float = ALPHA) -> DataFrame:
    """T5: (group, n, w, p_value, normal) of the Shapiro-Wilk test per group.

    A value's places in its ordered group come from the distributed ranks;
    normal scores of those places are added up in blocks of ``SCORES``, so
    neither a large group nor a value that fills most of it is one task's
    work.  Samples under 3 and constant ones are not normal (p null)."""
    d = cut_lineage(_clean(df, group, value))
    pos = cut_lineage(positions(d, [group], value).select(group, "_v", "_n", (F.col("_cum") - F.col("_c") + 1).alias("_first"),
                                                          F.col("_cum").alias("_last")))
    ties = pos.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_last - _first) div {SCORES}"))).alias("_k")) \
        .selectExpr("*", f"_first + _k * {SCORES} AS _lo", f"least(_last, _first + _k * {SCORES} + {SCORES - 1}) AS _hi")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inverse = NormalDist().inv_cdf
        for batch in batches:
            one, two = [], []
            for lo, hi, n in zip(*(batch.column(c).to_pylist() for c in ("_lo", "_hi", "_n"))):
                m = [inverse((i - 0.375) / (n + 0.25)) for i in range(lo, hi + 1)]
                one.append(sum(m))
                two.append(sum(x * x for x in m))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(one, pa.float64()), pa.array(two, pa.float64())],
                                             [*batch.schema.names, "_m", "_mm"])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ties.schema)
    s = ties.mapInArrow(scored, kinds + ", _m double, _mm double").groupBy(group).agg(
        F.max("_n").cast("long").alias("n"), F.sum(F.col("_m") * F.col("_v")).alias("sx"), F.sum("_mm").alias("mm"),
        F.min("_v").alias("low"), F.max("_v").alias("high"),
        F.min(F.when(F.col("_hi") >= 2, F.col("_v"))).alias("low2"),
        F.max(F.when(F.col("_lo") <= F.col("_n") - 1, F.col("_v"))).alias("high2"))
    s = s.join(group_moments(d, group, value).select(group, "ss"), group)

    @F.pandas_udf("struct<w:double,p:double>")
    def test(n: pd.Series, low: pd.Series, low2: pd.Series, high2: pd.Series, high: pd.Series, sx: pd.Series,
             mm: pd.Series, ss: pd.Series) -> pd.DataFrame:
        found = [shapiro_from_sums(int(r[0]), *map(float, r[1:])) for r in zip(n, low, low2, high2, high, sx, mm, ss)]
        return pd.DataFrame(found, columns=["w", "p"])
    t = s.withColumn("t", test("n", "low", "low2", "high2", "high", "sx", "mm", "ss"))
    p = F.when(~F.isnan("t.p"), F.col("t.p"))
    return t.select(group, "n", F.when(~F.isnan("t.w"), F.col("t.w")).alias("w"), p.alias("p_value"),
                    F.coalesce(p >= alpha, F.lit(False)).alias("normal"))


def normality_gate(df: DataFrame, group: str, value: str, alpha: float = ALPHA) -> DataFrame:
    """Jarque-Bera per group from moments, in one pass without ranks; n < 3 is
    non-normal.  The factor test uses ``shapiro_wilk``."""
    m = group_moments(df, group, value)
    jb = F.col("n") / 6.0 * (F.col("skew") ** 2 + F.col("kurt") ** 2 / 4.0)
    return m.select(group, F.col("n").cast("long").alias("n"), jb.alias("jb_stat"),
                    F.exp(-jb / 2.0).alias("p_value")).withColumn(
        "normal", (F.col("n") >= 3) & F.coalesce(F.col("p_value") >= alpha, F.lit(False)))


def run_factor(df: DataFrame, group: str, value: str = "profit_erosion", min_group_size: int = 5,
               run_posthoc: bool = True, max_groups_posthoc: int | None = None):
    """Drop small groups, pick ANOVA (all groups normal by Shapiro-Wilk) or
    Kruskal, effect size, decision, post-hoc of all groups (or of the
    ``max_groups_posthoc`` largest).  Returns (summary DataFrame, post-hoc)."""
    d = _clean(df, group, value)
    sizes = d.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_group_size)
    sizes = cut_lineage(sizes)
    d = cut_lineage(d.join(sizes.select(group), [group], "left_semi"))
    spark = df.sparkSession
    size = sizes.agg(F.count(F.lit(1)).alias("k"), F.sum("_n").alias("n")).first()
    k, n = size["k"], size["n"] or 0
    schema = ("factor string, test_used string, statistic double, p_value double, effect_size double, "
              "effect_metric string, reject_h0 boolean, meets_effect_threshold boolean, "
              "success_criteria_met boolean, n_groups long, n_rows long, posthoc_ran boolean, "
              "posthoc_note string")
    if k < 2:
        rec = (group, "n/a", None, None, None, "n/a", False, False, False, k, n, False,
               "Not enough groups after filtering.")
        return spark.createDataFrame([rec], schema), None
    normal = shapiro_wilk(d, group, value).where("NOT normal").isEmpty()
    post, note = None, ""
    if normal:
        r = anova(d, group, value)
        stat, p, eff, test, metric = r["f_stat"], r["p_value"], r["eta_squared"], "anova", "eta_squared"
        if run_posthoc:
            post = tukey_hsd(d, group, value)
    else:
        r = kruskal(d, group, value)
        stat, p, eff, test, metric = r["h_stat"], r["p_value"], r["epsilon_squared"], "kruskal", \
            "epsilon_squared"
        if run_posthoc:
            top = sizes.orderBy(F.desc("_n"), F.asc(group)).limit(max_groups_posthoc or k)
            post = dunn(d, group, value, top)
            note = f"Dunn post-hoc ran on top {min(k, max_groups_posthoc or k)} groups with all rows per group."
    if not run_posthoc:
        note = "Post-hoc testing disabled by configuration."
    reject = bool(p < ALPHA)
    ok = bool(eff >= EFFECT_THRESHOLD)
    rec = (group, test, float(stat), float(p), float(eff), metric, reject, ok, reject and ok, k, n,
           post is not None, note)
    return spark.createDataFrame([rec], schema), post


def point_biserial(df: DataFrame, x: str, y: str) -> dict:
    """r = Pearson(x, binary y); t-test p with n - 2 df."""
    r = df.select(F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("r"),
                  F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n")).first()
    rr, n = r["r"], r["n"]
    if rr is None or n < 3:
        return {"r": rr, "n": n, "p_value": math.nan}
    t = rr * math.sqrt((n - 2) / max(1e-300, 1 - rr * rr))
    return {"r": rr, "n": n, "p_value": dist.t_sf2(t, n - 2)}


def spearman(df: DataFrame, x: str, y: str, id_col: str) -> DataFrame:
    """Spearman = Pearson of average ranks (rank primitive for both)."""
    from losslens.operators.ordered import feature_ranks
    d = df.select(id_col, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")) \
          .where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    rk = feature_ranks(d, id_col, ["_x", "_y"])
    j = d.join(rk, [id_col])
    return j.agg(F.corr("_x", "_y").alias("pearson"), F.corr("_r__x", "_r__y").alias("spearman"),
                 F.count(F.lit(1)).alias("n"))


def pairwise_t_bonferroni(df: DataFrame, group: str, value: str) -> DataFrame:
    """T10 part: equal-variance t-test for every pair of groups (from
    moments), Bonferroni over the number of pairs."""
    m = sorted(group_moments(df, group, value).collect(), key=lambda r: str(r[group]))
    pairs = [(a, b) for i, a in enumerate(m) for b in m[i + 1:]]
    rows = []
    for a, b in pairs:
        na, nb = a["n"], b["n"]
        sp2 = ((na - 1) * (a["var"] or 0) + (nb - 1) * (b["var"] or 0)) / (na + nb - 2)
        t = (a["mean"] - b["mean"]) / math.sqrt(sp2 * (1 / na + 1 / nb)) if sp2 > 0 else math.inf
        p = dist.t_sf2(t, na + nb - 2)
        rows.append((str(a[group]), str(b[group]), float(t), float(p), min(1.0, p * len(pairs))))
    return df.sparkSession.createDataFrame(
        rows, "group_a string, group_b string, t_stat double, p_value double, p_bonferroni double")


def eta_label(e: float) -> str:
    return "large" if e >= 0.14 else "medium" if e >= 0.06 else "small" if e >= 0.01 else "negligible"


def cluster_test_bundle(df: DataFrame, cluster: str, value: str) -> DataFrame:
    """ANOVA and Kruskal on the cluster label (both must reject), eta
    squared with its label, strength label."""
    a = anova(df, cluster, value)
    k = kruskal(df, cluster, value)
    both = bool(a["p_value"] < ALPHA and k["p_value"] < ALPHA)
    rec = (float(a["f_stat"]), float(a["p_value"]), float(k["h_stat"]), float(k["p_value"]),
           float(a["eta_squared"]), eta_label(a["eta_squared"]), both,
           "strong" if both and a["eta_squared"] >= 0.14 else "moderate" if both else "weak")
    return df.sparkSession.createDataFrame(
        [rec], "f_stat double, anova_p double, h_stat double, kruskal_p double, eta_squared double, "
               "effect_label string, significant boolean, strength string")


def feature_separation(df: DataFrame, cluster: str, features) -> DataFrame:
    """F, p, eta squared per feature across clusters -- features
    unpivoted, ONE aggregate over (feature, cluster) moments."""
    long = df.select(F.col(cluster), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in features
    ])).alias("_kv")).select(cluster, "_kv.feature", "_kv.x").where(F.col("x").isNotNull())
    m = long.groupBy("feature", cluster).agg(F.count("x").alias("n"), F.avg("x").alias("mean"),
                                             (F.var_pop("x") * F.count("x")).alias("ss"))
    g = m.groupBy("feature").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("_tot"),
                                 (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_g"))
    j = m.join(g, ["feature"])
    t = j.groupBy("feature").agg(F.first("k").alias("k"), F.first("_tot").alias("_tot"),
                                 F.sum(F.col("n") * (F.col("mean") - F.col("_g")) ** 2).alias("ssb"),
                                 F.sum("ss").alias("ssw"))
    out = t.select("feature", F.col("k").cast("long").alias("k"), F.col("_tot").cast("long").alias("n"),
                   ((F.col("ssb") / (F.col("k") - 1)) / (F.col("ssw") / (F.col("_tot") - F.col("k"))))
                   .alias("f_stat"),
                   F.when(F.col("ssb") + F.col("ssw") > 0, F.col("ssb") / (F.col("ssb") + F.col("ssw")))
                   .otherwise(0.0).alias("eta_squared"))
    return out


def add_f_pvalues(table: DataFrame) -> DataFrame:
    """p-values for a small (feature, k, n, f_stat) table (one row per feature)."""
    rows = table.collect()
    spark = table.sparkSession
    out = [(r["feature"], r["f_stat"], dist.f_sf(r["f_stat"], r["k"] - 1, r["n"] - r["k"])
            if r["f_stat"] is not None else None, r["eta_squared"]) for r in rows]
    out.sort(key=lambda x: -(x[1] if x[1] is not None else -math.inf))
    return spark.createDataFrame(out, "feature string, f_stat double, p_value double, eta_squared double")


ROWS_A_CELL = 1 << 18  # rows of a group whose replicates one task adds up


def poisson_weights(ids: np.ndarray, replicates: int, seed: int) -> np.ndarray:
    """Poisson(1) weight of each (row id, replicate), from a hash of both."""
    def mix(x):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
    salt = np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    h = mix(ids.astype(np.int64).view(np.uint64)[:, None] * np.uint64(1000003)
            + np.arange(replicates, dtype=np.uint64)[None, :] + salt)
    cdf = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
    return np.searchsorted(cdf, (h >> np.uint64(11)).astype(np.float64) / float(1 << 53), side="right").astype(np.float64)


def bootstrap_mean_ci(df: DataFrame, group: str, value: str, id_col: str, n_boot: int = 800,
                      seed: int = 42, min_n: int = 30, level: float = 0.95) -> DataFrame:
    """Poisson-bootstrap CI of group means.

    Each row gets a Poisson(1) weight per replicate from a hash of
    (row id, replicate, seed) -- deterministic under recomputation.  Rows are
    dealt to tasks by group (a large group in parts of about ``ROWS_A_CELL``)
    and come sorted, so a task holds the B sums of one part at a time, however
    many groups there are; the parts' sums are added up the same way, and a
    group's interval comes from its B replicate means.  The input is read
    once.  Groups under ``min_n`` rows are left out.
    """
    B = int(n_boot)
    d = cut_lineage(df.select(F.col(id_col).cast("long").alias("_id"), F.col(group).cast("string").alias("_g"),
                              F.col(value).cast("double").alias("_x")).where("_g IS NOT NULL AND _x IS NOT NULL"))
    sizes = cut_lineage(d.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"), F.avg("_x").alias("_mean"))
                        .where(F.col("_n") >= min_n))
    parts = sizes.select("_g", F.expr(f"cast((_n - 1) div {ROWS_A_CELL} + 1 AS int)").alias("_of"))
    dealt = d.join(parts, "_g").select("_g", F.pmod(F.xxhash64("_id", F.lit("part")), F.col("_of")).alias("_s"), "_id", "_x")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.string()), pa.array([at[1]], pa.int64()),
                                               pa.array([total.astype("<f8").tobytes()], pa.binary())], ["_g", "_s", "_t"])
        for batch in batches:
            if not batch.num_rows:
                continue
            g, s = batch.column("_g").dictionary_encode(), batch.column("_s").to_numpy(zero_copy_only=False)
            code, names = g.indices.to_numpy(zero_copy_only=False), g.dictionary.to_pylist()
            cut = np.flatnonzero((np.diff(code) != 0) | (np.diff(s) != 0)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
                if (names[code[a]], int(s[a])) != at:
                    if at is not None:
                        yield out()
                    at, total = (names[code[a]], int(s[a])), np.zeros((2, B))
                ids, x = (batch.column(c).to_numpy(zero_copy_only=False)[a:b] for c in ("_id", "_x"))
                for k in range(0, len(ids), 2048):
                    w = poisson_weights(ids[k:k + 2048], B, seed)
                    total[0] += w.sum(0)
                    total[1] += x[k:k + 2048] @ w
        if at is not None:
            yield out()

    low, high = (1 - level) / 2, 1 - (1 - level) / 2

    def intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None

        def out():
            mean = total[1][total[0] > 0] / total[0][total[0] > 0]
            lo, hi = np.quantile(mean, [low, high]) if len(mean) else (math.nan, math.nan)
            return pa.RecordBatch.from_arrays([pa.array([at], pa.string()), pa.array([float(lo)]), pa.array([float(hi)])],
                                              ["_g", "ci_lower", "ci_upper"])
        for batch in batches:
            for g, t in zip(batch.column("_g").to_pylist(), batch.column("_t").to_pylist()):
                if g != at:
                    if at is not None:
                        yield out()
                    at, total = g, np.zeros((2, B))
                total = total + np.frombuffer(t, "<f8").reshape(2, B)
        if at is not None:
            yield out()

    to = shuffle_partitions(df.sparkSession)
    found = (dealt.repartition(to, "_g", "_s").sortWithinPartitions("_g", "_s", "_id", "_x")
             .mapInArrow(sums, "_g string, _s long, _t binary")
             .repartition(to, "_g").sortWithinPartitions("_g", "_s")
             .mapInArrow(intervals, "_g string, ci_lower double, ci_upper double"))
    return sizes.join(found, "_g").select(F.col("_g").alias(group), F.col("_n").alias("n"), F.col("_mean").alias("mean"),
                                          "ci_lower", "ci_upper", (F.col("ci_upper") - F.col("ci_lower")).alias("ci_width"))
