"""Regression imputation of late-introduced categories.

Variant A (M1/M3): per store and late category, the cutoff is the first time it was
sold; rows from the cutoff on (with OTHER inflated by the late categories, P13) train a
linear model on the top-k correlated predictors; rows before the cutoff get
``greatest(rint(prediction), 0)``. Then OTHER minus the imputed values (P7), zero-total
rows zeroed (P5), total recomputed (P4).

Variant B (M2/M4): the rows where the category is 0 are imputed from a model trained on
the non-zero rows, predictors = top-k by correlation over all rows; each category runs
two ordered passes (Q32), then clip + zero-total (P6), OTHER minus both (P8), total.

Every step is one distributed pass over all stores and categories at once: a
correlation aggregation, a normal-equation aggregation, a tiny per-group solve, and a
scoring join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources import dims
from . import clean, learn

KEYS = ["store_id", "datetime"]


def _long_by_target(df: DataFrame, targets: list[str]) -> DataFrame:
    """Explode each row once per target (``target``, ``y``); bounded fan-out = #targets."""
    arr = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("y")) for t in targets])
    return df.select("*", F.explode(arr).alias("_t")).select("*", "_t.target", "_t.y").drop("_t")


def safe_corr(a: str, b: str) -> F.Column:
    """Pearson correlation that is null (not an ANSI division error) for a constant column."""
    return F.try_divide(F.covar_pop(a, b), F.sqrt(F.var_pop(a) * F.var_pop(b)))


def top_predictors(train: DataFrame, candidates: list[str], k: int, by: list[str]) -> DataFrame:
    """Per group, boolean mask over ``candidates`` of the top-k by signed
    correlation with ``y`` (desc, ties by name; constant columns never chosen)."""
    agg = train.groupBy(*by).agg(*[safe_corr("y", c).alias(c) for c in candidates])
    long = agg.unpivot(by, candidates, "predictor", "corr").where(F.col("corr").isNotNull() & ~F.isnan("corr"))
    w = Window.partitionBy(*by).orderBy(F.desc("corr"), "predictor")     # one row per candidate column
    top = long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    chosen = top.groupBy(*by).agg(F.collect_set("predictor").alias("_chosen"))
    return chosen.select(*by, F.array(*[F.array_contains("_chosen", c) for c in candidates]).alias("mask"),
                         "_chosen")


def fit_and_score(train: DataFrame, score: DataFrame, candidates: list[str], k: int,
                  by: list[str]) -> DataFrame:
    """Fit per group on ``train`` and return ``score`` rows with ``pred``."""
    masks = top_predictors(train, candidates, k, by)
    stats = learn.normal_equations(train, by, candidates, "y").join(masks.select(*by, "mask"), by)
    coefs = learn.solve_groups(stats, by, candidates, mask_col="mask")
    return learn.predict(score, coefs, by, candidates, name="pred")


def candidates_for(df: DataFrame, targets: list[str], exclude: list[str], include_total: bool) -> list[str]:
    cols = [c for c in dims.CATEGORIES if c in df.columns and c not in exclude]
    if include_total and dims.TOTAL in df.columns:
        cols.append(dims.TOTAL)
    return cols


def impute_variant_a(wide: DataFrame, targets: list[str] = dims.LATE_CATEGORIES, k: int = 7,
                     include_total: bool = False, adjust_scope: str = "imputed") -> DataFrame:
    """M1 + M3 over all stores. ``include_total`` reproduces Q2 (TOTAL_SALES as a
    predictor); ``adjust_scope='all'`` subtracts from OTHER on every row (Q1 literal)."""
    cuts = clean.first_time_sold(wide, targets).withColumnRenamed("category", "target")
    long = _long_by_target(wide, targets).join(cuts, ["store_id", "target"], "inner")
    after = F.col("datetime") >= F.col("first_sold")
    late_sum = sum(F.col(t) for t in targets)
    train = long.where(after).withColumn("OTHER", F.col("OTHER") + late_sum)          # P13
    cand = candidates_for(wide, targets, targets, include_total)
    score = long.where(~after)
    scored = fit_and_score(train, score, cand, k, ["store_id", "target"])
    imputed = scored.select("store_id", "datetime", "target",
                            clean.clip_imputed("pred").cast("bigint").alias("imp"))
    piv = imputed.groupBy(*KEYS).pivot("target", targets).agg(F.first("imp"))
    out = wide.join(piv.select(*KEYS, *[F.col(t).alias(f"_imp_{t}") for t in targets]), KEYS, "left")
    for t in targets:
        was = F.col(f"_imp_{t}").isNotNull()
        out = out.withColumn(t, F.when(was, F.col(f"_imp_{t}")).otherwise(F.col(t)))
        out = clean.adjust_zero_sales(out, t)                                             # P5
        sub = F.col(t) if adjust_scope == "all" else F.when(was, F.col(t)).otherwise(F.lit(0))
        out = out.withColumn("OTHER", F.greatest(F.col("OTHER") - sub, F.lit(0)))         # P7
    out = out.drop(*[f"_imp_{t}" for t in targets])
    return clean.add_total(out, [c for c in dims.CATEGORIES if c in out.columns])        # P4


def _impute_zeros_once(df: DataFrame, target: str, k: int, include_total: bool) -> DataFrame:
    cand = candidates_for(df, [target], [target], include_total)
    long = df.withColumn("target", F.lit(target)).withColumn("y", F.col(target).cast("double"))
    zero = F.col(target) == 0
    # predictors ranked over ALL rows (zeros included), model trained on non-zero rows
    masks = top_predictors(long, cand, k, ["store_id", "target"])
    stats = learn.normal_equations(long.where(~zero), ["store_id", "target"], cand, "y") \
        .join(masks.select("store_id", "target", "mask"), ["store_id", "target"])
    coefs = learn.solve_groups(stats, ["store_id", "target"], cand, mask_col="mask")
    # variant B rounds half-even without clipping here; the clip comes with P6
    scored = learn.predict(long.where(zero), coefs, ["store_id", "target"], cand, name="pred") \
        .select(*KEYS, F.rint("pred").cast("bigint").alias("_p"))
    return df.join(scored, KEYS, "left").withColumn(target, F.coalesce("_p", F.col(target))).drop("_p")


def impute_variant_b(wide: DataFrame, targets: list[str] = dims.LATE_CATEGORIES, k: int = 6,
                     passes: int = 2, include_total: bool = False) -> DataFrame:
    """M2 + M4: ordered passes per category on one evolving table (Q32)."""
    df = wide
    for t in targets:
        for _ in range(passes):
            # each pass reads the table three times (ranking, fit, scoring); checkpointing
            # it keeps the plan linear in the number of passes instead of exponential
            df = cut_lineage(_impute_zeros_once(df, t, k, include_total))
    for t in targets:
        df = clean.adjust_zero_sales(df, t, clip=True)
    df = clean.adjust_other_joint(df, targets)
    return clean.add_total(df, [c for c in dims.CATEGORIES if c in df.columns])
