"""Quality rules with risk-controlled cutoffs (DataFrame / SQL only).

Two layers decide whether a document is kept.

*Base*: a document fails when it has fewer than ``MIN_WORDS`` words, or when
more than ``MAX_REPEAT_PCT`` percent of its words lie in five-word windows
that occur twice or more in it.

*Certified cutoffs*: each rule is a ratio where more is worse.  Labelled
documents (quality 1 = good) that pass the base form the holdout.  Per
stratum and rule, candidate cutoffs are tested from the laxest to the
strictest: a cutoff passes when the exact binomial probability of seeing at
most the observed number of rejected good documents, were the true rate
``alpha / rules``, is at most ``delta / (rules * strata)``.  Testing stops at
the first cutoff that fails (fixed-sequence testing needs no further
correction over cutoffs), and the Bonferroni split over rules and strata
makes all guarantees hold together: with probability 1 - delta, every
stratum loses at most a share alpha of its good documents to the rules.
Among the certified cutoffs the one with the largest ``rejected bad -
GOOD_WEIGHT * rejected good`` is used; if none gains anything, the rule is
off there.  A stratum with too few labels certifies nothing and keeps all
that passes the base.

Defined cases: null text has no words, so it fails the base.  A null stratum
is a stratum of its own.  Repeated rows each get a row; a document counts
once in the holdout (largest value per rule).  A document with contradicting
labels counts as good.  Null ids, null labels and labels other than 0 and 1
do not enter the holdout.  An empty table gives an empty result.  Columns of
the input other than id, text and stratum are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from losslens.llm.common import checkpoint, new_folder

MIN_WORDS = 10
MAX_REPEAT_PCT = 20
WINDOW = 5
ALPHA = 0.05
DELTA = 0.05
GOOD_WEIGHT = 3.0
STEPS = 40
STRATA = 10_000  # strata whose cutoffs are broadcast (three numbers each)
SALTS = 64  # tasks that share a stratum's rows where there are more strata

#: rule -> (value, step between candidate cutoffs); value > cutoff rejects
RULES = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", 0.01),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", 0.02),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", 0.005),
}


def text_measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  stratum_col: str | None = "lang", carry: list[str] = ()) -> DataFrame:
    """One row per input row: (doc_id, stratum, n_words, word_chars,
    n_symbols, n_lines, n_dup_lines, n_repeat_words) and the carried columns.

    Row-local and shuffle-free.  Repeated windows: 64-bit hashes of all
    windows are sorted as a primitive array; only a text in which two are
    equal sorts (hash, position) pairs to find the positions.
    """
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col else F.lit("")
    t = (df.select(F.col(id_col).alias("doc_id"), stratum.alias("stratum"),
                   F.coalesce(F.col(text_col), F.lit("")).alias("t"), *carry)
         .withColumn("w", F.expr("filter(split(t, r'[\\x20\\x09-\\x0D]+'), x -> x <> '')"))
         .withColumn("lines", F.expr("filter(split(t, '\\n'), x -> translate(x, ' \\t\\n\\u000b\\u000c\\r', '') <> '')"))
         .withColumn("h", F.expr(f"""
            CASE WHEN size(w) < {WINDOW} THEN cast(array() AS array<bigint>)
            ELSE transform(sequence(0, size(w) - {WINDOW}),
                 i -> xxhash64(w[i], w[i+1], w[i+2], w[i+3], w[i+4])) END"""))
         .withColumn("s", F.expr("sort_array(h)")))
    t = t.withColumn("twice", F.expr("""
        CASE WHEN size(s) < 2 THEN false
        ELSE exists(sequence(0, size(s) - 2), i -> s[i] = s[i+1]) END"""))
    # sorted pairs; a position counts when the pair before or after has its hash
    t = t.withColumn("p", F.expr("""
        CASE WHEN twice THEN sort_array(transform(h, (x, i) -> struct(x AS x, i AS i)))
        ELSE cast(array() AS array<struct<x:bigint,i:int>>) END"""))
    t = t.withColumn("at", F.expr("""
        sort_array(transform(filter(transform(p, (e, i) -> struct(e.i AS i,
             (i > 0 AND p[greatest(i - 1, 0)].x = e.x)
             OR (i < size(p) - 1 AND p[least(i + 1, size(p) - 1)].x = e.x) AS r)),
             e -> e.r), e -> e.i))"""))
    # one generated row: a filter on measures stays above it, instead of being
    # rewritten in terms of the text once for each use of an array
    return t.select(*carry, "doc_id", "stratum", F.expr(f"""inline(array(named_struct(
        'n_words', cast(size(w) AS bigint),
        'word_chars', cast(char_length(translate(t, ' \\t\\n\\u000b\\u000c\\r', '')) AS bigint),
        'n_symbols', cast(char_length(t) - char_length(translate(t, '#*$%&|<>', '')) AS bigint),
        'n_lines', cast(size(lines) AS bigint),
        'n_dup_lines', cast(size(lines) - size(array_distinct(lines)) AS bigint),
        'n_repeat_words', CASE WHEN size(at) = 0 THEN 0L ELSE
            aggregate(transform(at, (x, i) -> CASE WHEN i = size(at) - 1 THEN {WINDOW}
                      ELSE least({WINDOW}, at[least(i + 1, size(at) - 1)] - x) END),
                      0L, (a, x) -> a + x) END)))"""))


def with_base(measures: DataFrame) -> DataFrame:
    return measures.withColumn(
        "base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words"))


def _log_gamma(x):
    """SQL for ln Gamma(x), x >= 1: Stirling's series after a shift by 8
    (relative error below 1e-13)."""
    y = f"({x} + 8)"
    shift = " - ".join(f"ln({x} + {i})" for i in range(8))
    return (f"(({y} - 0.5D) * ln({y}) - {y} + 0.9189385332046728D + 1D / (12 * {y}) - 1D / (360 * pow({y}, 3)) "
            f"+ 1D / (1260 * pow({y}, 5)) - 1D / (1680 * pow({y}, 7)) - {shift})")


def binomial_tail(k: str, n: str, rate: str) -> str:
    """SQL for P(X <= k), X ~ Binomial(n, rate), where k < n * rate; else 1.

    The largest term comes from log-gammas, the others by their ratios
    downwards from k; terms further than 12 standard deviations (under
    1e-30 of the sum) are not added.
    """
    pmf = (f"exp({_log_gamma(f'({n} + 1D)')} - {_log_gamma(f'({k} + 1D)')} - {_log_gamma(f'({n} - {k} + 1D)')} "
           f"+ {k} * ln({rate}) + ({n} - {k}) * ln(1 - {rate}))")
    terms = f"cast(least({k}, ceil(12 * sqrt({n})) + 60) AS int)"
    return (f"CASE WHEN {n} = 0 OR {k} >= {n} * {rate} THEN 1D ELSE {pmf} * aggregate("
            f"sequence(0, {terms}), struct(0D AS sum, 1D AS term), "
            f"(a, i) -> struct(a.sum + a.term AS sum, "
            f"a.term * ({k} - i) / ({n} - {k} + i + 1) * (1 - {rate}) / {rate} AS term), a -> a.sum) END")


def certified_cutoffs(measures: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
                      label_id: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(stratum, rule, cutoff, n_good, good_rejected, bad_rejected) of the
    chosen cutoffs; a rule without one in a stratum has no row."""
    lab = (labels.select(F.col(label_id).alias("doc_id"), F.col(label_col).alias("y"))
           .where("doc_id IS NOT NULL AND y IN (0, 1)")
           .groupBy("doc_id").agg(F.max("y").alias("y")))
    vals = ", ".join(f"'{r}', cast(least({STEPS}, greatest(0, ceil(({v}) / {step}D))) AS int)"
                     for r, (v, step) in RULES.items())
    held = (measures.where("NOT base_failed").join(lab, "doc_id")
            .selectExpr("doc_id", "stratum", "y", f"stack({len(RULES)}, {vals}) AS (rule, passed)")
            .groupBy("doc_id", "stratum", "rule").agg(F.max("passed").alias("passed"), F.max("y").alias("y")))
    # candidate i is the cutoff i * step; a document is beyond candidates 0 .. passed - 1
    counts = (held.groupBy("stratum", "rule", "passed")
              .agg(F.sum("y").alias("good"), F.sum(F.expr("1 - y")).alias("bad"))
              .groupBy("stratum", "rule")
              .agg(F.collect_list(F.struct("passed", "good", "bad")).alias("c"), F.sum("good").alias("n_good"))
              .selectExpr("stratum", "rule", "n_good", "count(*) OVER (PARTITION BY 1) AS tests", "c")
              .selectExpr("stratum", "rule", "n_good", "tests", f"""inline(transform(sequence(0, {STEPS - 1}), i -> struct(
                   i AS i,
                   aggregate(c, 0L, (a, x) -> a + if(x.passed > i, x.good, 0L)) AS good_rejected,
                   aggregate(c, 0L, (a, x) -> a + if(x.passed > i, x.bad, 0L)) AS bad_rejected)))"""))
    rate = f"{alpha / len(RULES)!r}D"
    tested = counts.selectExpr("*", f"{binomial_tail('good_rejected', 'n_good', rate)} <= {delta!r}D / tests AS holds")
    certified = tested.selectExpr(
        "*", "min(holds) OVER (PARTITION BY stratum, rule ORDER BY i DESC) AS certified",
        f"bad_rejected - {GOOD_WEIGHT}D * good_rejected AS gain").where("certified AND gain > 0")
    step = "CASE rule " + " ".join(f"WHEN '{r}' THEN {s}D" for r, (_, s) in RULES.items()) + " END"
    return (certified.groupBy("stratum", "rule")
            .agg(F.max_by(F.struct("i", "n_good", "good_rejected", "bad_rejected"), F.struct("gain", "i")).alias("b"))
            .selectExpr("stratum", "rule", f"b.i * {step} AS cutoff", "b.n_good", "b.good_rejected", "b.bad_rejected"))


def judge(measures: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds ``kept`` and ``failed_rules`` (sorted) to the measures.

    Cutoffs of up to ``STRATA`` strata are counted and broadcast, so no row
    moves.  Beyond that each stratum's rows are salted over ``SALTS`` tasks."""
    per = checkpoint(cutoffs.groupBy("stratum").agg(F.map_from_entries(
        F.sort_array(F.collect_list(F.struct("rule", "cutoff")))).alias("cut"))
        .withColumnRenamed("stratum", "cut_stratum"))
    salt = F.lit(0)
    if per.count() <= STRATA:
        per = F.broadcast(per.withColumn("cut_salt", F.lit(0)))
    else:
        per = per.withColumn("cut_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars", "n_symbols"), F.lit(SALTS)).cast("int")
    failed = ", ".join(f"if(({v}) > cut['{r}'], '{r}', null)" for r, (v, _) in RULES.items())
    return (measures.join(per, (F.col("stratum") == F.col("cut_stratum")) & (salt == F.col("cut_salt")), "left")
            .withColumn("failed_rules", F.expr(f"array_sort(array_compact(array({failed})))"))
            .withColumn("kept", F.expr("NOT base_failed AND size(failed_rules) = 0"))
            .drop("cut", "cut_stratum", "cut_salt"))


def quality_rules(documents: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
                  id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """Measures, base verdict and certified verdict of every document.

    The narrow measures are checkpointed once; calibration and verdict both
    read them, so texts are scanned a single time."""
    m = checkpoint(with_base(text_measures(documents, id_col, text_col, stratum_col)))
    return judge(m, certified_cutoffs(m, labels, alpha, delta))


def keep(documents: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
         id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """The rows that pass, with all their columns.

    Rows are measured once and written with their measures to the shared
    folder.  The calibration reads the narrow columns of that table, and the
    verdict is row-local: no text is shuffled (see ``judge``)."""
    row = documents.select(F.struct("*").alias("row"))
    path = new_folder(documents.sparkSession, "quality")
    (with_base(text_measures(row, f"row.{id_col}", f"row.{text_col}", f"row.{stratum_col}" if stratum_col else None,
                             ["row"])).write.parquet(path))
    measured = documents.sparkSession.read.parquet(path)
    return judge(measured, certified_cutoffs(measured.drop("row"), labels, alpha, delta)).where("kept").select("row.*")
