"""

Two distributed passes; the design matrix never leaves the executors:

* pass 1: X'X and X'y, added up in each task as one matrix over blocks of rows
  (dense numerics, dummies by their places); the k x k solve runs on the
  driver (numpy);
* pass 2: residual, leverage ``h = x' (X'X)^-1 x`` and the HC3 meat
  ``sum(x x' e^2 / (1-h)^2)``, plus residual moments and the Breusch-Pagan
  sums, the same way.
Durbin-Watson needs a declared row order (the id): one range sort, whose
partitions hand over their first and last residual.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from losslens.functions import dist
from losslens.operators.stats import anova
from losslens.session import cut_lineage, shuffle_partitions

# fixed values: RQ4 predictors, controls, categoricals, thresholds
RQ4_TARGET_COL = "total_profit_erosion"
RQ4_HYPOTHESIS_PREDICTORS = ["return_frequency", "avg_basket_size", "purchase_recency_days"]
RQ4_BEHAVIORAL_CONTROLS = ["order_frequency", "avg_order_value", "customer_tenure_days",
                           "customer_return_rate", "age"]
RQ4_CATEGORICALS = ["user_gender", "traffic_source", "dominant_return_category"]
RQ4_ALPHA = 0.05
RQ4_COLLINEARITY_THRESHOLD = 0.85
Z975 = 1.959963984540054


def screen_features(df: DataFrame, target: str = RQ4_TARGET_COL, alpha: float = RQ4_ALPHA,
                    threshold: float = RQ4_COLLINEARITY_THRESHOLD, numeric=None, categorical=None) -> dict:
    """Correlation with the target, pairwise |r| > threshold on complete
    rows drops the one weaker with the target, one-way ANOVA keeps a
    categorical with p < alpha.  Correlations come from one aggregate."""
    num = [c for c in (numeric or RQ4_HYPOTHESIS_PREDICTORS + RQ4_BEHAVIORAL_CONTROLS) if c in df.columns]
    cat = [c for c in (categorical or RQ4_CATEGORICALS) if c in df.columns]
    tc = df.agg(*[F.corr(c, target).alias(c) for c in num]).first()
    complete = df.dropna(subset=num)
    pairs = [(a, b) for i, a in enumerate(num) for b in num[i + 1:]]
    pc = complete.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs]).first() if pairs else {}
    surviving, dropped = list(num), []
    for a, b in pairs:
        r = pc[f"{a}__{b}"]
        if r is not None and abs(r) > threshold:
            ca, cb = abs(tc[a] or 0.0), abs(tc[b] or 0.0)
            drop = b if ca > cb else a
            if drop in surviving:
                surviving.remove(drop)
                dropped.append(drop)
    an, keep = [], []
    for c in cat:
        r = anova(df.where(F.col(c).isNotNull()), c, target)
        if r.get("k", 0) and r["k"] > 1:
            an.append((c, float(r["f_stat"]), float(r["p_value"])))
            if r["p_value"] < alpha:
                keep.append(c)
    spark = df.sparkSession
    return {"correlation_table": spark.createDataFrame(
                [(c, None if tc[c] is None else float(tc[c])) for c in num], "feature string, correlation double"),
            "collinearity_dropped": dropped,
            "anova_table": spark.createDataFrame(an, "categorical_feature string, f_statistic double, p_value double"),
            "surviving_numeric": surviving, "surviving_categorical": keep}


MAX_COLUMNS = 5_000  # columns of a design: its Gram matrix is held by tasks and the driver
CELLS = 1 << 22  # cells of the dense rows that a task multiplies at once
PART = 64  # rows of a Gram matrix that are added up as one


def level_vocabulary(df: DataFrame, column: str) -> DataFrame:
    """(level, place) of a column's sorted levels but the first (like
    ``get_dummies`` with drop_first); more than ``MAX_COLUMNS`` raise."""
    levels = cut_lineage(df.select(F.col(column).alias("level")).distinct())
    n = levels.count()
    if n > MAX_COLUMNS:
        raise ValueError(f"{column} has {n} levels; a design has at most {MAX_COLUMNS} columns")
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("level")) - 2
    return levels.select("level", place.alias("place")).where("place >= 0")


def _regression_rows(df: DataFrame, target: str, numeric, categorical, log_transform: bool, id_col: str | None,
                     drop_constant: bool):
    """Complete rows, the moments of the numerics, and those that vary."""
    keep = [id_col] if id_col and id_col in df.columns else []
    d = df.select(*keep, target, *numeric, *categorical).dropna()
    if log_transform:
        d = d.where(F.col(target) > 0)
    st = d.agg(*[F.avg(c).alias(f"m_{c}") for c in numeric],
               *[F.stddev_samp(c).alias(f"s_{c}") for c in numeric], F.count(F.lit(1)).alias("_n")).first()
    const_cols = [c for c in numeric if not (st[f"s_{c}"] or 0) > 0]
    if const_cols and not drop_constant:
        raise ValueError(f"Feature '{const_cols[0]}' has zero variance and cannot be standardized.")
    numeric = [c for c in numeric if c not in const_cols]
    z = {c: (F.col(c) - F.lit(st[f"m_{c}"])) / F.lit(st[f"s_{c}"]) for c in numeric}
    y = (F.ln(target) if log_transform else F.col(target)).cast("double").alias("y")
    return d, keep, y, z, const_cols


def prepare_regression_data(df: DataFrame, target: str, numeric, categorical, log_transform: bool = True,
                            id_col: str | None = "user_id", drop_constant: bool = True, levels=None):
    """Complete rows, numerics z-scored (ddof 1), one-hot drop-first
    (sorted levels, first dropped like ``get_dummies``), ln target, constant.
    Constant numerics are dropped first and reported (D9).
    Returns (design DataFrame with ``y`` + ``const`` + regressors, names, dropped)."""
    numeric, categorical = list(numeric), list(categorical)
    d, keep, y, z, const_cols = _regression_rows(df, target, numeric, categorical, log_transform, id_col, drop_constant)
    cols = [*[F.col(c) for c in keep], y, F.lit(1.0).alias("const"), *[x.alias(c) for c, x in z.items()]]
    names = ["const", *z]
    for c in categorical:
        own = (levels or {}).get(c)
        own = own[1:] if own else [r[0] for r in level_vocabulary(d, c).orderBy("place").toLocalIterator()]
        cols += [(F.col(c) == F.lit(v)).cast("double").alias(f"{c}_{v}") for v in own]
        names += [f"{c}_{v}" for v in own]
    return d.select(*cols), names, const_cols


def sparse_regression_data(df: DataFrame, target: str, numeric, categorical, log_transform: bool = True,
                           id_col: str | None = "user_id", drop_constant: bool = True):
    """E2 for columns of many levels: (id, y, x, hot), where x holds the
    constant and the numerics and hot the columns whose dummy is 1.  Levels are
    looked up in a vocabulary of at most ``MAX_COLUMNS`` rows, so a row's width
    does not grow with them.  Returns (design, names, dropped)."""
    numeric, categorical = list(numeric), list(categorical)
    d, keep, y, z, const_cols = _regression_rows(df, target, numeric, categorical, log_transform, id_col, drop_constant)
    names, places = ["const", *z], []
    for i, c in enumerate(categorical):
        words = cut_lineage(level_vocabulary(d, c))
        look_up = words.select(F.col("level").alias(f"_l{i}"), (F.col("place") + len(names)).cast("int").alias(f"_p{i}"))
        d = d.join(F.broadcast(look_up), F.col(c) == F.col(f"_l{i}"), "left")  # at most MAX_COLUMNS rows
        names += [f"{c}_{r[0]}" for r in words.orderBy("place").select("level").toLocalIterator()]
        places.append(F.col(f"_p{i}"))
    hot = F.array_compact(F.array(*places)) if places else F.array().cast("array<int>")
    return (d.select(*keep, y, F.array(F.lit(1.0), *z.values()).alias("x"), hot.alias("hot")), names, const_cols)


def _as_arrays(design: DataFrame, names, y: str) -> tuple[DataFrame, int]:
    """(y, x, hot) of a wide or a sparse design, and the size of x."""
    if "hot" in design.columns and "hot" not in names:
        width = len(names) if not design.take(1) else len(design.select("x").first()[0])
        return design.select(F.col(y).alias("y"), "x", "hot"), width
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in names])
    return design.select(F.col(y).cast("double").alias("y"), x.alias("x"), F.array().cast("array<int>").alias("hot")), len(names)


def _summed(rows: DataFrame, k: int, dense: int, height: int, width: int, add) -> np.ndarray:
    """Sum over all rows of a height x width matrix: ``add(X, y, total)`` adds
    a block of dense rows.  Each task keeps one matrix; its parts are added up
    part by part, in order of tasks, before they come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, step = np.zeros((height, width)), max(1, CELLS // k)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                b = batch.slice(at, step)
                x = np.zeros((b.num_rows, k))
                x[:, :dense] = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                hot = b.column("hot")
                row = np.repeat(np.arange(b.num_rows), hot.value_lengths().to_numpy(zero_copy_only=False))
                x[row, hot.flatten().to_numpy(zero_copy_only=False)] = 1.0
                add(x, b.column("y").to_numpy(zero_copy_only=False), total)
        task = TaskContext.get().partitionId()
        for at in range(0, height, PART):
            yield pa.RecordBatch.from_arrays(
                [pa.array([at // PART], pa.int32()), pa.array([task], pa.int32()),
                 pa.array([total[at:at + PART].astype("<f8").tobytes()], pa.binary())], ["part", "task", "v"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, None
        for batch in batches:
            for p, v in zip(batch.column("part").to_pylist(), batch.column("v").to_pylist()):
                v = np.frombuffer(v, "<f8")
                if p != part:
                    if total is not None:
                        yield out(part, total)
                    part, total = p, v.copy()
                else:
                    total += v
        if total is not None:
            yield out(part, total)

    def out(part, total):
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.astype("<f8").tobytes()], pa.binary())],
                                          ["part", "v"])
    parts = -(-height // PART)
    found = (rows.mapInArrow(run, "part int, task int, v binary").repartition(parts, "part")
             .sortWithinPartitions("part", "task").mapInArrow(merge, "part int, v binary").toArrow())  # one matrix
    total = np.zeros((height, width))
    for p, v in zip(found.column("part").to_pylist(), found.column("v").to_pylist()):
        v = np.frombuffer(v, "<f8").reshape(-1, width)
        total[p * PART:p * PART + len(v)] = v
    return total


def _gram(x: np.ndarray, y: np.ndarray, total: np.ndarray) -> None:
    """X'X, X'y, and in the last row n, sum y, sum y^2."""
    k = x.shape[1]
    total[:k, :k] += x.T @ x
    total[:k, k] += x.T @ y
    total[k, :3] += len(y), y.sum(), (y * y).sum()


def _sandwich(b: np.ndarray, inv: np.ndarray):
    """X' diag(e^2 / (1 - h)^2) X, X'e^2, and in the last row the sums of the
    residuals' powers."""
    def add(x: np.ndarray, y: np.ndarray, total: np.ndarray) -> None:
        k = x.shape[1]
        e = y - x @ b
        h = ((x @ inv) * x).sum(1)
        total[:k, :k] += x.T @ (x * (e**2 / (1 - h) ** 2)[:, None])
        total[:k, k] += x.T @ e**2
        total[k, :4] += e.sum(), (e**2).sum(), (e**3).sum(), (e**4).sum()
    return add


def _residual(names, dense: int, b: np.ndarray, sparse: bool, y: str):
    """Column expression of the residual."""
    if not sparse:
        return F.col(y) - sum(F.lit(float(v)) * F.col(f"`{c}`") for v, c in zip(b, names))
    values = F.array(*[F.lit(float(v)) for v in b])
    first = F.aggregate(F.zip_with("x", F.slice(values, 1, dense), lambda a, c: a * c), F.lit(0.0), lambda s, v: s + v)
    return F.col(y) - first - F.aggregate("hot", F.lit(0.0), lambda s, i: s + F.get(values, i))


def fit_ols_hc3(design: DataFrame, names, y: str = "y") -> dict:
    """E3 + E5 + E7: coefficients, HC3 covariance, fit statistics and
    residual diagnostics (Jarque-Bera, Breusch-Pagan; DW separately).  Two
    passes, each one matrix of (k + 1) x (k + 4) sums (see ``_summed``)."""
    k = len(names)
    if k > MAX_COLUMNS:
        raise ValueError(f"{k} columns; a design has at most {MAX_COLUMNS}")
    rows, dense = _as_arrays(design, names, y)
    p1 = _summed(rows, k, dense, k + 1, k + 4, _gram)
    xtx, xty = p1[:k, :k], p1[:k, k]
    n, sy, syy = p1[k, :3]
    cond = np.linalg.cond(xtx)
    if not np.isfinite(cond) or cond > 1e14:
        raise ValueError(f"design matrix is singular or ill-conditioned (cond={cond:.3g})")
    inv = np.linalg.inv(xtx)
    b = inv @ xty
    p2 = _summed(rows, k, dense, k + 1, k + 4, _sandwich(b, inv))
    meat = p2[:k, :k]
    s1, ssr, s3, s4 = p2[k, :4]
    V = inv @ meat @ inv
    se = np.sqrt(np.diag(V))
    sst = syy - sy ** 2 / n
    r2 = 1 - ssr / sst if sst > 0 else math.nan
    adj = 1 - (1 - r2) * (n - 1) / (n - k)
    idx = [i for i, c in enumerate(names) if c != "const"]
    q = len(idx)
    rb = b[idx]
    rv = V[np.ix_(idx, idx)]
    fval = float(rb @ np.linalg.solve(rv, rb) / q) if q else math.nan
    fp = dist.f_sf(fval, q, n - k) if q else math.nan
    llf = -n / 2 * (math.log(2 * math.pi) + math.log(ssr / n) + 1)
    # residual moments (central; the constant makes the mean ~0)
    m1 = s1 / n
    m2 = ssr / n - m1 ** 2
    m3 = s3 / n - 3 * m1 * ssr / n + 2 * m1 ** 3
    m4 = s4 / n - 4 * m1 * s3 / n + 6 * m1 ** 2 * ssr / n - 3 * m1 ** 4
    skew, kurt = m3 / m2 ** 1.5, m4 / m2 ** 2
    jb = n / 6 * (skew ** 2 + (kurt - 3) ** 2 / 4)
    # Breusch-Pagan: regress z = e^2 on X (same X'X), LM = n R^2_aux
    xz = p2[:k, k]
    bz = inv @ xz
    ssr_aux = s4 - bz @ xz
    sst_aux = s4 - ssr ** 2 / n
    r2a = 1 - ssr_aux / sst_aux if sst_aux > 0 else 0.0
    lm = n * r2a
    bp_f = (r2a / (k - 1)) / ((1 - r2a) / (n - k)) if k > 1 else math.nan
    t = b / se
    coef = [(names[i], float(b[i]), float(se[i]), float(t[i]), float(2 * dist.norm_sf(abs(t[i]))),
             float(b[i] - Z975 * se[i]), float(b[i] + Z975 * se[i])) for i in range(k)]
    coef.sort(key=lambda r: -abs(r[1]))
    return {"params": dict(zip(names, b.tolist())), "bse": dict(zip(names, se.tolist())), "cov": V,
            "xtx": xtx, "coefficients": coef, "n_obs": int(n), "k": k, "r_squared": float(r2),
            "adj_r_squared": float(adj), "f_statistic": float(fval), "f_pvalue": float(fp),
            "aic": float(-2 * llf + 2 * k), "bic": float(-2 * llf + k * math.log(n)),
            "jarque_bera": {"statistic": float(jb), "pvalue": float(dist.chi2_sf(jb, 2)), "skewness": float(skew),
                            "kurtosis": float(kurt)},
            "breusch_pagan": {"statistic": float(lm), "pvalue": float(dist.chi2_sf(lm, k - 1)),
                              "f_statistic": float(bp_f)},
            "condition_number": float(cond), "residual_expr": _residual(names, dense, b, "hot" in rows.columns and dense < k, y)}


def durbin_watson(design: DataFrame, fit: dict, order_col: str) -> float:
    """E5: DW over the rows ordered by ``order_col`` (declared order; equal
    keys by residual, null keys left out).

    One range sort; every partition adds up its own neighbours and hands over
    its first and last residual, and the steps between partitions are added
    from those (one row a partition)."""
    parts = shuffle_partitions(design.sparkSession)
    d = (design.select(F.col(order_col).alias("_id"), fit["residual_expr"].alias("_e")).where("_id IS NOT NULL")
         .repartitionByRange(parts, "_id", "_e").sortWithinPartitions("_id", "_e").select("_e"))

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        num = den = 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            e = batch.column("_e").to_numpy(zero_copy_only=False)
            num += float((np.diff(e) ** 2).sum()) + ((float(e[0]) - last) ** 2 if last is not None else 0.0)
            den += float((e * e).sum())
            first, last = float(e[0]) if first is None else first, float(e[-1])
        if first is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()),
                 *[pa.array([x], pa.float64()) for x in (first, last, num, den)]], ["part", "first", "last", "num", "den"])

    r = sorted(d.mapInArrow(steps, "part int, first double, last double, num double, den double").collect())
    between = sum((b["first"] - a["last"]) ** 2 for a, b in zip(r, r[1:]))
    return (sum(x["num"] for x in r) + between) / sum(x["den"] for x in r)


def vif_table(fit: dict, centered: bool = False, design: DataFrame | None = None) -> list:
    """VIF of each regressor from the X'X block by inversion.
    Default (D6) is the reference's uncentered VIF on the design without
    the constant: VIF_j = (X'X)_jj * ((X'X)^-1)_jj.  ``centered=True`` uses
    the correlation matrix.  Non-finite values raise."""
    names = list(fit["params"])
    idx = [i for i, c in enumerate(names) if c != "const"]
    xtx = fit["xtx"]
    if centered:
        n = fit["n_obs"]
        ci = names.index("const")
        mu = xtx[ci, idx] / n
        cov = xtx[np.ix_(idx, idx)] / n - np.outer(mu, mu)
        sd = np.sqrt(np.diag(cov))
        corr = cov / np.outer(sd, sd)
        v = np.diag(np.linalg.inv(corr))
    else:
        sub = xtx[np.ix_(idx, idx)]
        v = np.diag(sub) * np.diag(np.linalg.inv(sub))
    if not np.all(np.isfinite(v)):
        raise ValueError("VIF contains non-finite values")
    out = [(names[i], float(x)) for i, x in zip(idx, v)]
    return sorted(out, key=lambda r: -r[1])


def coefficient_table(spark, fit: dict) -> DataFrame:
    """B, se, z, p, 95% CI (normal, as the HC3 fit reports), by |b|."""
    return spark.createDataFrame(fit["coefficients"], "feature string, coefficient double, std_error double, "
                                                      "t_stat double, p_value double, ci_lower double, ci_upper double")


def fit_summary(spark, fit: dict, hypothesis=RQ4_HYPOTHESIS_PREDICTORS, alpha: float = RQ4_ALPHA) -> DataFrame:
    """Fit statistics and the hypothesis decision (any predictor p < alpha)."""
    sig = [r[0] for r in fit["coefficients"] if r[0] in hypothesis and r[4] < alpha]
    rec = (fit["r_squared"], fit["adj_r_squared"], fit["f_statistic"], fit["f_pvalue"], fit["aic"],
           fit["bic"], fit["n_obs"], bool(sig), ",".join(sig))
    return spark.createDataFrame([rec], "r_squared double, adj_r_squared double, f_statistic double, "
                                        "f_pvalue double, aic double, bic double, n_obs long, "
                                        "h0_rejected boolean, significant_predictors string")


def coefficient_alignment(primary: DataFrame, external: DataFrame, alpha: float = RQ4_ALPHA,
                          features=RQ4_HYPOTHESIS_PREDICTORS) -> DataFrame:
    """The hypothesis predictors of two coefficient tables side by side.
    A direction only counts as aligned when the primary coefficient is
    significant; effects are percent, 100 (exp(b) - 1)."""
    p = primary.select("feature", F.col("coefficient").alias("b_primary"), F.col("p_value").alias("p_primary"))
    e = external.select("feature", F.col("coefficient").alias("b_external"), F.col("p_value").alias("p_external"))
    j = p.join(e, ["feature"], "inner").where(F.col("feature").isin(list(features)))
    sig_p, sig_e = F.col("p_primary") < alpha, F.col("p_external") < alpha
    return j.select("feature", "b_primary", "b_external", "p_primary", "p_external",
                    ((F.exp("b_primary") - 1) * 100).alias("pct_effect_primary"),
                    ((F.exp("b_external") - 1) * 100).alias("pct_effect_external"),
                    sig_p.alias("significant_primary"), sig_e.alias("significant_external"),
                    (sig_p & (F.col("b_primary") * F.col("b_external") > 0)).alias("direction_aligned"),
                    (sig_p == sig_e).alias("significance_agreement"),
                    F.when(F.col("b_primary") != 0, F.col("b_external") / F.col("b_primary")).alias("coefficient_ratio"))


def effect_size_generalisation(primary: DataFrame, external: DataFrame) -> DataFrame:
    """B / se ratio per feature and the share of ratios above 0.5."""
    p = primary.select("feature", (F.col("coefficient") / F.col("std_error")).alias("z_primary"))
    e = external.select("feature", (F.col("coefficient") / F.col("std_error")).alias("z_external"))
    j = p.join(e, ["feature"]).where(F.col("feature") != "const").withColumn(
        "z_ratio", F.when(F.col("z_primary") != 0, F.col("z_external") / F.col("z_primary")))
    return j.agg(F.count(F.lit(1)).alias("features"),
                 F.avg((F.col("z_ratio") > 0.5).cast("double")).alias("share_ratio_above_half"),
                 F.avg("z_ratio").alias("mean_ratio"))
