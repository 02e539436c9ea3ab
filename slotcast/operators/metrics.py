"""Forecast metrics (A10-A16): all plain aggregations over long (y, yhat) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mae(y="y", yhat="yhat") -> Column:
    return F.avg(F.abs(F.col(y) - F.col(yhat)))


def mse(y="y", yhat="yhat") -> Column:
    return F.avg(F.pow(F.col(y) - F.col(yhat), 2))


def rmse(y="y", yhat="yhat") -> Column:
    return F.sqrt(mse(y, yhat))


def coverage(y="y", lo="lo", hi="hi") -> Column:
    """Share of actuals inside [lo, hi]."""
    return F.avg(F.col(y).between(F.col(lo), F.col(hi)).cast("double"))


def per_target(df: DataFrame, by: list[str], y="y", yhat="yhat") -> DataFrame:
    """MAE, MSE, RMSE and count per group."""
    return df.groupBy(*by).agg(mae(y, yhat).alias("mae"), mse(y, yhat).alias("mse"),
                               rmse(y, yhat).alias("rmse"), F.count(F.lit(1)).alias("n"))


def with_uniform_total(per: DataFrame, target: str, by: list[str] | None = None, label: str = "ALL") -> DataFrame:
    """Add a total row per ``by`` group = uniform average over targets (MAE mean;
    RMSE = sqrt of the mean MSE, as ``mean_squared_error(multioutput='uniform_average')``)."""
    by = by or []
    tot = per.groupBy(*by).agg(F.avg("mae").alias("mae"), F.avg("mse").alias("mse"), F.sum("n").alias("n"))
    tot = tot.withColumn("rmse", F.sqrt("mse")).withColumn(target, F.lit(label))
    return per.unionByName(tot.select(*per.columns))


def fold_summary(per_fold: DataFrame, metrics: list[str], by: list[str] | None = None) -> DataFrame:
    """Mean and population std of each metric across folds, long output."""
    by = by or []
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}__mean"), F.stddev_pop(m).alias(f"{m}__std")]
    wide = per_fold.groupBy(*by).agg(*aggs)
    parts = [wide.select(*by, F.lit(m).alias("metric"), F.col(f"{m}__mean").alias("mean"), F.col(f"{m}__std").alias("std"))
             for m in metrics]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def best_by(df: DataFrame, params: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Parameters with the lowest score (``min_by``)."""
    by = by or []
    return df.groupBy(*by).agg(F.min_by(params, score).alias(params), F.min(score).alias(score))


def round6(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in cols})
