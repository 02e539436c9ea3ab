"""Exploration aggregates.

Profiles are hash aggregations (partial + final); correlation matrices are one
aggregation with one ``corr`` per column pair, unpivoted to a long table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import slot_label
from ..sources import dims
from . import clean


def daily_totals(df: DataFrame, measures: list[str], ts: str = "datetime", by=("store_id",)) -> DataFrame:
    """A3: per-day sums of every measure."""
    return df.groupBy(*by, F.to_date(ts).alias("date")).agg(*[F.sum(m).cast("bigint").alias(m) for m in measures])


def weekday_profile(df: DataFrame, categories: list[str], ts: str = "datetime", by=("store_id",)) -> DataFrame:
    """A4: mean slot total by weekday (total = sum of categories only, Q14)."""
    total = sum(F.col(c) for c in categories)
    return (df.groupBy(*by, F.weekday(ts).alias("weekday"))
              .agg(F.round(F.avg(total), 6).alias("mean_total")))


def weekday_slot_profile(df: DataFrame, categories: list[str], ts: str = "datetime", by=("store_id",)) -> DataFrame:
    """A5: mean total by weekday x opening slot, completed to 7 x 11 with 0. The 77-cell
    frame is literal; the store set is attached as an array (scalar subquery)."""
    total = sum(F.col(c) for c in categories)
    valid = clean.valid_slots(df, ts)
    prof = valid.groupBy(*by, F.weekday(ts).alias("weekday"), slot_label(ts).alias("slot_label")) \
                .agg(F.avg(total).alias("_m"))
    frame = df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(0), F.lit(6))).alias("weekday"),
        F.explode(F.array(*[F.lit(s) for s in dims.OPENING_SLOTS])).alias("slot_label"))
    for k in by:
        frame = frame.withColumn(k, F.explode(df.select(F.array_sort(F.collect_set(k))).scalar()))
    out = frame.join(prof, list(by) + ["weekday", "slot_label"], "left")
    return out.select(*by, "weekday", "slot_label", F.round(F.coalesce("_m", F.lit(0.0)), 6).alias("mean_total"))


def category_daily(df: DataFrame, categories: list[str], ts: str = "datetime", by=("store_id",)) -> DataFrame:
    """Weekday-only daily sum per category, long form."""
    d = daily_totals(clean.weekdays_only(df, ts), categories, ts, by)
    return d.unpivot([*by, "date"], categories, "category", "items")


def weekday_daily_total(df: DataFrame, categories: list[str], ts: str = "datetime", by=("store_id",)) -> DataFrame:
    """Weekday-only daily total."""
    total = sum(F.col(c) for c in categories)
    return (clean.weekdays_only(df, ts).groupBy(*by, F.to_date(ts).alias("date"))
              .agg(F.sum(total).cast("bigint").alias("total_sales")))


def correlation_long(df: DataFrame, columns: list[str], by=("store_id",)) -> DataFrame:
    """Pearson correlation of every column pair, long output ``(by..., col_a, col_b, corr)``; null where a
    column does not vary. One aggregation of plain sums and of the cross sums of half the (symmetric) pairs,
    in decimals: exact for whole numbers, so that a constant column has no spread. A row with a null in
    any of the columns takes no part."""
    pairs = [(a, b) for a in columns for b in columns]
    whole = all(isinstance(df.schema[c].dataType, T.IntegralType) for c in columns)
    x = {c: F.col(c).cast("decimal(18,0)" if whole else "double") for c in columns}
    df = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in columns))
    half = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    kind = (lambda digits: f"decimal({digits},0)") if whole else (lambda digits: "double")
    sums = df.groupBy(*by).agg(F.count("*").cast(kind(15)).alias("_n"), *[F.sum(x[c]).cast(kind(19)).alias(f"_s_{c}") for c in columns],
                               *[F.sum(x[a] * x[b]).cast(kind(23)).alias(f"_x_{a}__{b}") for a, b in half])

    def spread(a: str, b: str):
        a, b = sorted((a, b), key=columns.index)
        return (F.col("_n") * F.col(f"_x_{a}__{b}") - F.col(f"_s_{a}") * F.col(f"_s_{b}")).cast("double")

    def corr(a: str, b: str):
        varies = (spread(a, a) > 0) & (spread(b, b) > 0)
        return F.when(varies, spread(a, b) / (F.sqrt(spread(a, a)) * F.sqrt(spread(b, b)))).alias(f"{a}__{b}")

    agg = sums.select(*by, *[corr(a, b) for a, b in pairs])
    long = agg.unpivot(list(by), [f"{a}__{b}" for a, b in pairs], "_pair", "corr")
    parts = F.split("_pair", "__")
    return long.select(*by, parts[0].alias("col_a"), parts[1].alias("col_b"), F.round("corr", 6).alias("corr"))


def top_correlates(corr_long: DataFrame, targets: list[str], k: int, exclude: list[str],
                   variant: str, by=("store_id",)) -> DataFrame:
    """Top-k predictors of each target by signed correlation (desc, ties by
    name), excluding the target and ``exclude``. The window partitions hold one row per
    candidate column, so they are schema-sized."""
    cand = corr_long.where(F.col("col_a").isin(targets) & (F.col("col_b") != F.col("col_a"))
                           & ~F.col("col_b").isin(exclude))
    w = Window.partitionBy(*by, "col_a").orderBy(F.desc_nulls_last("corr"), F.col("col_b"))
    ranked = cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select(*by, F.col("col_a").alias("target"), F.lit(variant).alias("variant"),
                         F.col("rank").cast("int"), F.col("col_b").alias("predictor"), "corr")


def moments(df: DataFrame, columns: list[str], by=("store_id",)) -> DataFrame:
    """Mean, sample std (pandas) and population std (numpy) per column."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std_samp"),
                 F.stddev_pop(c).alias(f"{c}__std_pop")]
    wide = df.groupBy(*by).agg(*aggs)
    out = None
    for c in columns:
        part = wide.select(*by, F.lit(c).alias("column_name"),
                           *[F.round(F.col(f"{c}__{s}"), 6).alias(s) for s in ("mean", "std_samp", "std_pop")])
        out = part if out is None else out.unionByName(part)
    return out


REPORTS: dict[str, Callable] = {
    "daily_totals": daily_totals,
    "weekday_profile": weekday_profile,
    "weekday_slot_profile": weekday_slot_profile,
    "category_daily": category_daily,
    "weekday_daily_total": weekday_daily_total,
}


def run_reports(df: DataFrame, names: list[str], categories: list[str]) -> dict[str, DataFrame]:
    """Run report functions by name; unknown names are reported, not fatal."""
    out = {}
    for n in names:
        fn = REPORTS.get(n)
        if fn is None:
            print(f"unknown report {n!r}; available: {sorted(REPORTS)}")
            continue
        out[n] = fn(df, categories)
    return out
