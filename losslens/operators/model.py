"""

* split / folds: exact stratified counts from hashed ranks (``reshape``);
* imputation and scaling: exact SQL medians / z-scores fitted on train;
* models: logistic regressions of all grid points and folds by Newton steps in
  shared passes; forests and boosted trees of all grid points, folds, feature
  sets and label scenarios in shared passes (``trees``);
* metrics: exact ROC AUC from the rank-sum formula (distributed ranks),
  confusion counts from one ``groupBy``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from losslens.functions import dist
from losslens.operators import trees as T
from losslens.operators.ordered import group_quantiles, positions
from losslens.operators.reshape import fold_column, stratified_split
from losslens.session import cut_lineage

# fixed values: RQ3 candidate features, target and leakage names
RQ3_TARGET = "is_high_erosion_customer"
RQ3_CANDIDATE_FEATURES = [
    "order_frequency", "return_frequency", "customer_return_rate", "avg_basket_size",
    "avg_order_value", "customer_tenure_days", "purchase_recency_days", "total_items",
    "total_sales", "total_margin", "avg_item_price", "avg_item_margin",
]
RQ3_LEAKAGE_COLUMNS = ["total_profit_erosion", "total_margin_reversal", "total_process_cost",
                       "is_high_erosion_customer", "profit_erosion_quartile",
                       "erosion_percentile_rank", "user_id"]
AUC_THRESHOLD = 0.70


# ------------------------------------------------------------------ M1
def prepare_modeling_data(df: DataFrame, features=None, target: str = RQ3_TARGET,
                          id_col: str = "user_id", test_size: float = 0.2, seed: int = 42,
                          impute_scope: str = "train", leakage=RQ3_LEAKAGE_COLUMNS) -> DataFrame:
    """M1: refuse leakage features (D19), stratified split (``is_test``),
    median imputation fitted on the training rows (``impute_scope='all'``
    reproduces the reference's all-rows medians, D18)."""
    features = list(features or RQ3_CANDIDATE_FEATURES)
    missing = [c for c in features + [target] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    bad = [c for c in features if c in set(leakage or [])]
    if bad:
        raise ValueError(f"leakage columns in the feature list: {bad}")
    d = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in features],
                  F.col(target).cast("int").alias(target))
    d = stratified_split(d, target, id_col, test_size, seed)
    src = d.where(F.col("is_test") == 0) if impute_scope == "train" else d
    med = group_quantiles(src, [], [(f"_med_{c}", c, 0.5) for c in features])
    d = d.crossJoin(F.broadcast(med))  # one row
    return d.select(id_col, *[F.coalesce(F.col(c), F.col(f"_med_{c}")).alias(c) for c in features],
                    target, "is_test")


# ------------------------------------------------------------------ M2
def _pairs(feats) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(feats) for b in feats[i + 1:]]


def _screen_measures(feats, target: str) -> list:
    """Variances, correlations with the target and of all pairs: one aggregate."""
    return [F.count(F.lit(1)).alias("_n"), *[F.var_pop(c).alias(f"v_{c}") for c in feats],
            *[F.corr(c, target).alias(f"y_{c}") for c in feats],
            *[F.corr(a, b).alias(f"c_{a}__{b}") for a, b in _pairs(feats)]]


def _screen(one, feats, variance_threshold: float = 0.01, correlation_threshold: float = 0.85,
            significance_level: float = 0.05, use_variance_gate: bool = True, use_correlation_gate: bool = True,
            use_univariate_gate: bool = True) -> tuple[list[str], list[tuple]]:
    """The gates on one row of measures: (survivors, report rows).  The greedy
    rule counts a pair even when one side is already dropped (D16)."""
    n = one["_n"]
    var_pass = {c: (one[f"v_{c}"] or 0.0) > variance_threshold for c in feats}
    after_var = [c for c in feats if var_pass[c]] if use_variance_gate else list(feats)
    drop_corr = set()
    if use_correlation_gate:
        for a, b in _pairs(after_var):
            r = one[f"c_{a}__{b}"] if f"c_{a}__{b}" in one else one[f"c_{b}__{a}"]
            if r is not None and abs(r) > correlation_threshold:
                ra, rb = abs(one[f"y_{a}"] or 0.0), abs(one[f"y_{b}"] or 0.0)
                drop_corr.add(b if ra >= rb else a)
    after_corr = [c for c in after_var if c not in drop_corr]
    alpha = significance_level / len(after_corr) if after_corr else significance_level
    rows, survivors = [], []
    for c in feats:
        r = one[f"y_{c}"]
        if r is not None and n > 2 and abs(r) < 1:
            p = dist.t_sf2(r * math.sqrt((n - 2) / (1 - r * r)), n - 2)
        else:
            p = 0.0 if r is not None and abs(r) == 1 else math.nan
        uni = None
        if c in after_corr:
            uni = (not use_univariate_gate) or (p == p and p <= alpha)
            if uni:
                survivors.append(c)
        rows.append((c, float(one[f"v_{c}"] or 0.0), bool(var_pass[c]) if use_variance_gate else True,
                     None if c not in after_var else (c not in drop_corr),
                     None if r is None else float(r), None if p != p else float(p), uni,
                     "selected" if c in survivors else "dropped"))
    return survivors, rows


_SCREEN_REPORT = ("feature string, variance double, variance_pass boolean, correlation_pass boolean, "
                  "univariate_corr double, univariate_pvalue double, univariate_pass boolean, final_status string")


def screen_features(train: DataFrame, features, target: str = RQ3_TARGET, **gates):
    """M2: three gates on the training rows.  Returns (survivors, report)."""
    feats = list(features)
    survivors, rows = _screen(train.agg(*_screen_measures(feats, target)).first(), feats, **gates)
    return survivors, train.sparkSession.createDataFrame(rows, _SCREEN_REPORT)


# ------------------------------------------------------------------ label scenarios
@dataclass
class Scenarios:
    """Rows with one label and one part for each scenario.

    ``rows``: binned (id, row_key, bins, labels, parts); ``long``: one row for
    each (scenario, id) with label, part and the imputed features."""
    rows: DataFrame
    long: DataFrame
    features: list[str]
    edges: list
    fills: np.ndarray | None
    folds: int
    measures: dict | None = None

    def columns(self, names) -> tuple[int, ...]:
        return tuple(self.features.index(c) for c in names)

    def screened(self, names=None, **gates) -> dict[int, list[str]]:
        """M2's survivors in every scenario.  One aggregate has the measures of all
        features; they don't depend on which of them are screened or by what gates."""
        if self.measures is None:
            found = self.long.where("part >= 0").groupBy("scenario").agg(*_screen_measures(self.features, "label")).collect()
            self.measures = {one["scenario"]: one.asDict() for one in found}  # one row a scenario
        return {s: _screen(one, list(names or self.features), **gates)[0] for s, one in self.measures.items()}


def label_scenarios(customers: DataFrame, labels: DataFrame, n: int, features=None, id_col: str = "user_id",
                    folds: int = 5, test_size: float = 0.2, seed: int = 42) -> Scenarios:
    """M1 for all scenarios at once: ``labels`` is (scenario 0 .. n - 1, id,
    label).  Each scenario is split and dealt into folds by its own labels and
    imputed with the medians of its own training rows."""
    features = list(features or RQ3_CANDIDATE_FEATURES)
    d = labels.select("scenario", id_col, F.col("label").cast("int").alias("label"))
    d = stratified_split(d.withColumn("_stratum", F.concat_ws(":", "scenario", "label")), "_stratum", id_col, test_size, seed)
    d = fold_column(d.withColumn("_stratum", F.concat_ws(":", "_stratum", "is_test")), "_stratum", id_col, folds, seed)
    d = cut_lineage(d.select("scenario", id_col, "label", F.when(F.col("is_test") == 1, T.TEST)
                             .otherwise(F.col("fold")).alias("part")))
    x = cut_lineage(customers.select(id_col, *[F.col(c).cast("double").alias(c) for c in features]))
    long = d.join(x, [id_col])
    nulls = x.agg(*[F.count(F.when(F.col(c).isNull() | F.isnan(c), 1)).alias(c) for c in features]).first()
    edges, fills = T.bin_edges(x, features), None
    if any(nulls):
        med = group_quantiles(long.where("part >= 0"), ["scenario"], [(f"_med_{c}", c, 0.5) for c in features])
        med = cut_lineage(med)
        fills = np.zeros((n, len(features)), np.uint8)
        for r in med.collect():  # one row a scenario
            fills[r["scenario"]] = [np.searchsorted(e, r[f"_med_{c}"], "left") for c, e in zip(features, edges)]
        long = long.join(F.broadcast(med), ["scenario"]).select(  # one row a scenario
            "scenario", id_col, "label", "part", *[F.coalesce(F.nanvl(c, F.col(f"_med_{c}")), F.col(f"_med_{c}")).alias(c)
                                                   for c in features])
    arrays = (d.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("scenario", F.struct("label", "part"))))
                                    .alias("m"))
              .select(id_col, F.expr(f"transform(sequence(0, {n - 1}), s -> coalesce(m[s].label, 0))").alias("labels"),
                      F.expr(f"transform(sequence(0, {n - 1}), s -> coalesce(m[s].part, {T.ABSENT}))").alias("parts")))
    rows = cut_lineage(T.bin_rows(x.join(arrays, [id_col]), id_col, features, edges))
    return Scenarios(rows, cut_lineage(long), features, edges, fills, folds)


# ------------------------------------------------------------------ M3
# fixed values: the grids of the three models (8, 12 and 16 points)
LR_C, LR_L1 = [0.01, 0.1, 1, 10], [0.0, 1.0]
RF_TREES, RF_DEPTH, RF_LEAF = [100, 200], [5, 10, 30], [5, 10]
GB_TREES, GB_DEPTH, GB_RATE, GB_SHARE = [100, 200], [3, 5], [0.01, 0.1], [0.8, 1.0]


def _scale_on_train(d: DataFrame, feats, train: DataFrame | None = None):
    """z-scores (ddof 0, like the reference's scaler) with the statistics of
    the training rows, or of another set's."""
    train = d if train is None else train
    st = train.where(F.col("is_test") == 0).agg(*[F.avg(c).alias(f"_m_{c}") for c in feats],
                                                *[F.stddev_pop(c).alias(f"_s_{c}") for c in feats])
    j = d.crossJoin(F.broadcast(st))
    return j.withColumns({f"_z_{c}": F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}"))
                                            / F.col(f"_s_{c}")).otherwise(0.0) for c in feats}) \
            .drop(*[f"_m_{c}" for c in feats], *[f"_s_{c}" for c in feats])


def model_frame(prepared: DataFrame, feats, target: str = RQ3_TARGET, id_col: str = "user_id",
                folds: int = 5, seed: int = 42) -> DataFrame:
    """Label, balanced weight n / (2 n_c) (train counts), fold id, raw and
    scaled feature vectors."""
    d = prepared.withColumn("label", F.col(target).cast("double"))
    cnt = d.where(F.col("is_test") == 0).groupBy("label").agg(F.count(F.lit(1)).alias("_nc"))
    tot = cnt.agg(F.sum("_nc").alias("_nt"))
    w = cnt.crossJoin(tot).select("label", (F.col("_nt") / (2.0 * F.col("_nc"))).alias("w"))
    d = d.join(F.broadcast(w), ["label"], "left")  # two rows
    d = cut_lineage(_scale_on_train(d, feats))
    d = cut_lineage(fold_column(d, "label", id_col, folds, seed))
    d = VectorAssembler(inputCols=list(feats), outputCol="raw_features").transform(d)
    return VectorAssembler(inputCols=[f"_z_{c}" for c in feats], outputCol="features").transform(d)


# ------------------------------------------------------------------ M5 / M6
def exact_auc(scored: DataFrame, score: str = "score", label: str = "label") -> float:
    """M6: Mann-Whitney AUC with average ranks of tied scores (exact)."""
    d = scored.select(F.col(score).cast("double").alias("_s"), F.col(label).cast("double").alias("_y"))
    pos = positions(d, [], "_s", sums=["_y"])
    r = pos.agg(F.sum(F.col("_s__y") * (F.col("_cum") - (F.col("_c") - 1) / 2.0)).alias("rs"),
                F.sum("_s__y").alias("np"), F.max("_n").alias("n")).first()
    n_pos, n = r["np"] or 0.0, r["n"] or 0
    n_neg = n - n_pos
    if n_pos == 0 or n_neg == 0:
        return math.nan
    return (r["rs"] - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg)


def roc_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """M6: one point per distinct score (descending): FPR, TPR, threshold."""
    d = scored.select((-F.col(score).cast("double")).alias("_s"), F.col(label).cast("double").alias("_y"))
    pos = positions(d, [], "_s", sums=["_y"])
    tp = F.col("_cs__y")
    fp = F.col("_cum") - F.col("_cs__y")
    return pos.select((-F.col("_v")).alias("threshold"), (fp / (F.col("_n") - F.col("_t__y"))).alias("fpr"),
                      (tp / F.col("_t__y")).alias("tpr"))


def classification_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> dict:
    """M5: confusion counts (one groupBy) -> precision, recall, F1, accuracy."""
    return rates({(int(r[0]), int(r[1])): r[2] for r in
                  pred.groupBy(F.col(label).cast("int"), F.col(prediction).cast("int")).count().collect()})


def rates(c: dict[tuple[int, int], int]) -> dict:
    """M5 from counts by (label, prediction)."""
    tp, fp = c.get((1, 1), 0), c.get((0, 1), 0)
    fn, tn = c.get((1, 0), 0), c.get((0, 0), 0)
    prec = tp / (tp + fp) if tp + fp else 0.0
    rec = tp / (tp + fn) if tp + fn else 0.0
    f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
    acc = (tp + tn) / max(1, tp + fp + fn + tn)
    return {"precision": prec, "recall": rec, "f1": f1, "accuracy": acc, "tp": tp, "fp": fp,
            "fn": fn, "tn": tn}


# ------------------------------------------------------------------ M4 / M7
STEPS, TOLERANCE = 200, 1e-9  # Newton steps of a fit at most; gain of the objective at which it ends
ROWS_AT_ONCE = 4096  # rows whose curvatures are added up together


def _logistic_sums(sent, names, folds: int):
    """Loss, gradient and curvature of each open fit over the rows of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beta, held = sent.value  # a column of coefficients and the fold held out for each fit
        d, fits = beta.shape
        loss, slope, bend = np.zeros(fits), np.zeros((fits, d)), np.zeros((fits, d, d))
        for batch in batches:
            every = [batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("label", "w", "fold", *names)]
            for a in range(0, batch.num_rows, ROWS_AT_ONCE):
                y, w, fold, *x = (c[a:a + ROWS_AT_ONCE] for c in every)
                x = np.stack([np.ones(len(y)), *x], 1)
                w = w[:, None] * (fold[:, None] != held[None, :])
                margin = x @ beta
                p = 0.5 * (1 + np.tanh(margin / 2))
                loss += (w * (np.logaddexp(0, margin) - y[:, None] * margin)).sum(0)
                slope += (w * (p - y[:, None])).T @ x
                bend += np.einsum("nf,ni,nj->fij", w * p * (1 - p), x, x, optimize=True)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([v.ravel() for v in (loss, slope, bend)]).tobytes()],
                                                   pa.binary())], ["sums"])
    return run


def _newton_step(beta: np.ndarray, slope: np.ndarray, bend: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """Coefficients (the constant first, without a penalty) at the least of the
    quadratic with these derivatives and the penalties."""
    d = len(beta)
    penal = np.r_[0.0, np.full(d - 1, 1.0)]
    if not l1:
        a = bend + np.diag(l2 * penal + 1e-14)
        return beta + np.linalg.lstsq(a, -(slope + l2 * penal * beta), rcond=None)[0]
    new = beta.copy()
    for _ in range(10_000):
        most = 0.0
        for j in range(d):
            if bend[j, j] <= 0:
                continue
            aim = bend[j, j] * new[j] - (slope[j] + bend[j] @ (new - beta))
            to = np.sign(aim) * max(abs(aim) - l1 * penal[j], 0.0) / bend[j, j]
            most, new[j] = max(most, abs(to - new[j])), to
        if most < 1e-10:
            break
    return new


def logistic_fits(train: DataFrame, names, fits: list[tuple[float, float, int]], folds: int) -> np.ndarray:
    """Coefficients, the constant first, of weighted logistic regressions (penalty,
    its share of L1, fold held out or -1): mean loss by weight plus penalty, as in
    Spark ML.  All fits take a Newton step in one pass over the rows; a step that
    does not gain is halved."""
    rows = train.select(F.col("label").cast("double"), "w", F.col("fold").cast("double").alias("fold"),
                        *[F.col(c).cast("double").alias(c) for c in names])
    weight = {int(r[0]): r[1] for r in rows.groupBy("fold").agg(F.sum("w")).collect()}  # one row a fold
    size = np.array([sum(v for k, v in weight.items() if k != fold) for _, _, fold in fits])
    ones = {int(r[0]): r[1] for r in rows.groupBy("fold").agg(F.sum(F.col("w") * F.col("label"))).collect()}
    first = np.array([sum(v for k, v in ones.items() if k != fold) for _, _, fold in fits]) / size
    d, held = len(names) + 1, np.array([fold for *_, fold in fits], float)
    l1, l2 = np.array([p * a for p, a, _ in fits]), np.array([p * (1 - a) for p, a, _ in fits])
    best, to = np.zeros((len(fits), d)), np.zeros((len(fits), d))
    to[:, 0] = [math.log(q / (1 - q)) if 0 < q < 1 else 0.0 for q in first]
    value, share = np.full(len(fits), np.inf), np.ones(len(fits))
    open_fits = np.flatnonzero(size > 0)
    for _ in range(STEPS):
        if not len(open_fits):
            break
        sent = train.sparkSession.sparkContext.broadcast((to[open_fits].T.copy(), held[open_fits]))
        sums = 0.0
        for r in rows.mapInArrow(_logistic_sums(sent, names, folds), "sums binary").toLocalIterator():  # one row a task
            sums = sums + np.frombuffer(r.sums, "<f8")
        sent.destroy()
        k = len(open_fits)
        loss, slope, bend = sums[:k], sums[k:k + k * d].reshape(k, d), sums[k + k * d:].reshape(k, d, d)
        left = []
        for i, f in enumerate(open_fits):
            now = loss[i] / size[f] + l1[f] * np.abs(to[f, 1:]).sum() + l2[f] / 2 * (to[f, 1:] ** 2).sum()
            if not now <= value[f]:  # too far: back half the way
                share[f] /= 2
                to[f] = (best[f] + to[f]) / 2
                if share[f] > 1e-9:
                    left.append(f)
                continue
            gain, value[f], share[f], best[f] = value[f] - now, now, 1.0, to[f]
            to[f] = _newton_step(best[f], slope[i] / size[f], bend[i] / size[f], l1[f], l2[f])
            if gain > TOLERANCE * max(abs(now), TOLERANCE) and np.abs(to[f] - best[f]).max() > TOLERANCE:
                left.append(f)
        open_fits = np.array(left, int)
    return best


def logistic(frame: DataFrame, feats, folds: int = 5) -> dict:
    """M4: the logistic grid by the mean AUC over the precomputed stratified folds,
    fitted again on all training rows; M7: sizes of its coefficients."""
    names = [f"_z_{c}" for c in feats]
    frame = frame.select("label", "w", "fold", "is_test", *names)
    train = frame.where(F.col("is_test") == 0)
    n = train.count()
    # C maps to a penalty of 1 / (C n)
    grid = [(1.0 / (c * n), a) for c in LR_C for a in LR_L1]
    fits = [(*g, fold) for g in grid for fold in (*range(folds), -1)]
    beta = logistic_fits(train, names, fits, folds)
    scores = [F.lit(float(b[0])) + sum((F.col(c) * float(v) for c, v in zip(names, b[1:])), F.lit(0.0)) for b in beta]
    by_fold = [F.array(*[scores[i] for i, f in enumerate(fits) if f[2] == fold]) for fold in (*range(folds), -1)]
    at = F.when(F.col("is_test") == 1, F.transform(by_fold[folds], lambda s: 1 / (1 + F.exp(-s))))
    part = F.when(F.col("is_test") == 1, folds)
    for fold in range(folds):
        at, part = at.when(F.col("fold") == fold, by_fold[fold]), part.when(F.col("fold") == fold, fold)
    scored = cut_lineage(frame.select(part.cast("int").alias("fit"), F.col("label").cast("int").alias("label"), at.alias("scores"))
                         .where("fit IS NOT NULL"))
    found = T.auc_by_point(scored)
    means = [np.mean([found.get((fold, k), math.nan) for fold in range(folds)]) for k in range(len(grid))]
    best = max(range(len(grid)), key=lambda k: means[k] if means[k] == means[k] else -1)  # the first of equals
    counts = {(r[0], r[1]): r["count"] for r in scored.where(F.col("fit") == folds).groupBy(
        "label", (F.col("scores")[best] > 0.5).cast("int").alias("p")).count().collect()}
    coefficients = beta[fits.index((*grid[best], -1))][1:]
    return {"cv_auc": float(means[best]), "test_auc": found.get((folds, best), math.nan), **rates(counts),
            "importance": {f: abs(float(x)) for f, x in zip(feats, coefficients)}}


def _confusion(scored: DataFrame, of: dict[int, int]) -> dict[int, dict]:
    """M5 of the fits' own points: fit -> point."""
    spark = scored.sparkSession
    at = spark.createDataFrame([(int(f), int(p)) for f, p in of.items()], "fit int, point int")
    found = (scored.join(F.broadcast(at), "fit")  # one row a fit
             .select("fit", "label", (F.expr("scores[point]") > 0.5).cast("int").alias("prediction"))
             .groupBy("fit", "label", "prediction").count().collect())
    counts = {(r[0], r[1], r[2]): r[3] for r in found}
    return {f: rates({k: counts.get((f, *k), 0) for k in ((0, 0), (0, 1), (1, 0), (1, 1))}) for f in of}


def forest_grids(data: Scenarios, sets: dict, seed: int = 42) -> dict:
    """M4, M7: the forest's whole grid for every set (name -> (scenario,
    features)), all grown together; the point of best mean AUC over the folds
    is scored on the set's test rows.

    Forests of ``max(RF_TREES)`` trees down to ``max(RF_DEPTH)`` are grown for
    each leaf size and fold; the other points are parts of them."""
    points = [(n, d) for n in RF_TREES for d in RF_DEPTH]
    fits = [T.Forest((name, leaf, fold), scenario, fold, data.columns(feats), leaf, max(RF_TREES), max(RF_DEPTH))
            for name, (scenario, feats) in sets.items() for leaf in RF_LEAF for fold in (*range(data.folds), T.TEST)]
    measured = dict(zip((f.name for f in fits), T.forest_measures(data.rows, fits, points, data.fills, seed)))
    out = {}
    for name, (_, feats) in sets.items():
        grid = [(np.mean([measured[name, leaf, k][at]["auc"] for k in range(data.folds)]), at, leaf)
                for at in range(len(points)) for leaf in RF_LEAF]
        cv, at, leaf = max(grid, key=lambda g: (g[0] if g[0] == g[0] else -1))  # the first of equals
        test = measured[name, leaf, T.TEST][at]
        out[name] = {"cv_auc": float(cv), "test_auc": test["auc"], "point": (*points[at], leaf),
                     "importance": dict(zip(feats, test["importances"].tolist())), **rates(test["counts"])}
    return out


def forest_scores(data: Scenarios, scenario: int, feats, point: tuple[int, int, int], others: DataFrame, seed: int = 42) -> DataFrame:
    """(id, label, score) of other rows, binned like ``data.rows`` and with one
    label, by the forest of a point (trees, depth, leaf) on all training rows.

    It is grown again: the rows lie beside the training rows as its test rows."""
    trees, depth, leaf = point
    fit = T.Forest("again", 0, T.TEST, data.columns(feats), leaf, trees, depth)
    train = data.rows.where(F.col("parts")[scenario] >= 0).select(
        F.lit(None).cast(others.schema["id"].dataType).alias("id"), "row_key", "bins",
        F.array(F.col("labels")[scenario]).alias("labels"), F.array(F.col("parts")[scenario]).alias("parts"))
    fills = None if data.fills is None else data.fills[scenario:scenario + 1]
    rows = cut_lineage(train.unionByName(others.withColumn("parts", F.array(F.lit(T.TEST)))))
    return T.forest_scores(rows, [fit], [(trees, depth)], fills, seed).select("id", "label", F.col("scores")[0].alias("score"))


def boosting_grid(data: Scenarios, scenario: int, feats, seed: int = 42) -> dict:
    """M4, M7: the boosting grid of one scenario; all its points and folds grow
    side by side, one tree a round, and fewer rounds are a prefix of more."""
    columns = data.columns(feats)
    shapes = [(d, r, s) for d in GB_DEPTH for r in GB_RATE for s in GB_SHARE]
    folds = (*range(data.folds), T.TEST)
    fits = [T.Boost((shape, fold), scenario, fold, columns, *shape, max(GB_TREES)) for shape in shapes for fold in folds]
    scored, importances = T.boost(data.rows, fits, sorted(GB_TREES), data.fills, seed)
    found = T.auc_by_point(scored)
    number = {f.name: i for i, f in enumerate(fits)}
    grid = [(np.mean([found.get((number[shape, k], at), math.nan) for k in range(data.folds)]), at, shape)
            for at in range(len(GB_TREES)) for shape in shapes]
    cv, at, shape = max(grid, key=lambda g: (g[0] if g[0] == g[0] else -1))
    i = number[shape, T.TEST]
    return {"cv_auc": float(cv), "test_auc": found.get((i, at), math.nan), "point": (sorted(GB_TREES)[at], *shape),
            "importance": {f: float(importances[at, i, c]) for f, c in zip(feats, columns)},
            **_confusion(scored, {i: at})[i]}


def comparison_table(spark, results: dict) -> DataFrame:
    """One row per model, sorted by test AUC."""
    rows = [(k, v.get("cv_auc"), v["test_auc"], v["precision"], v["recall"], v["f1"], v["accuracy"])
            for k, v in results.items()]
    rows.sort(key=lambda r: -(r[2] if r[2] == r[2] else -1))
    return spark.createDataFrame(rows, "model string, cv_auc double, test_auc double, precision double, "
                                       "recall double, f1 double, accuracy double")


def importance_table(spark, results: dict) -> DataFrame:
    """M7 + A28: importances per model and their average rank."""
    rows = [(m, f, float(v)) for m, r in results.items() if "importance" in r
            for f, v in r["importance"].items()]
    df = spark.createDataFrame(rows, "model string, feature string, importance double")
    avg = df.groupBy("feature").agg(F.avg("importance").alias("mean_importance"))
    from pyspark.sql import Window
    return avg.withColumn("rank", F.rank().over(Window.orderBy(F.desc("mean_importance"), "feature")))


# ------------------------------------------------------------------ M8
def rule_baseline(prepared: DataFrame, target: str = RQ3_TARGET, feature: str = "return_frequency") -> dict:
    """M8: threshold at the (1 - prevalence) quantile of the feature on the
    training rows; predict ``>=`` threshold; score = value / max (test)."""
    train = prepared.where(F.col("is_test") == 0)
    prev = train.agg(F.avg(F.col(target).cast("double"))).first()[0]
    thr = group_quantiles(train, [], [("t", feature, 1.0 - prev)]).first()["t"]
    test = prepared.where(F.col("is_test") == 1)
    mx = test.agg(F.max(feature)).first()[0] or 0.0
    mx = mx if mx > 0 else 1.0
    scored = test.select(F.col(target).cast("double").alias("label"),
                         (F.col(feature) >= thr).cast("double").alias("prediction"),
                         F.least(F.greatest(F.col(feature) / mx, F.lit(0.0)), F.lit(1.0)).alias("score"))
    return {"threshold": thr, "prevalence": prev, "test_auc": exact_auc(scored),
            **classification_metrics(scored)}


def hypothesis_record(results: dict, threshold: float = AUC_THRESHOLD) -> dict:
    """Best test AUC against the threshold."""
    best = max(results.items(), key=lambda kv: kv[1]["test_auc"])
    return {"best_model": best[0], "best_auc": best[1]["test_auc"], "threshold": threshold,
            "reject_h0": bool(best[1]["test_auc"] > threshold)}
