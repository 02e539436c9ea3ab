"""Cleaning operators (P1-P25): filters, totals, adjustments, first-sold, winsorizing.

All operators are DataFrame -> DataFrame and chain with ``DataFrame.transform`` (P9/E1).
Per-store quantities (first-sold cutoffs, percentiles) are computed as small
aggregates and joined back on the key, never as a window over a whole store: a store
that holds a third of all rows must not land in one task.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import half_even, minute_of_day, slot_label
from ..sources import dims


# --- P9 / E1: ordered steps ------------------------------------------------------

class StepChain:
    """Ordered list of DataFrame -> DataFrame functions with arguments."""

    def __init__(self):
        self.steps: list[tuple[Callable, tuple, dict]] = []

    def add_step(self, fn: Callable, *args, **kwargs) -> "StepChain":
        self.steps.append((fn, args, kwargs))
        return self

    def run(self, df: DataFrame) -> DataFrame:
        for fn, args, kwargs in self.steps:
            df = df.transform(fn, *args, **kwargs)
        return df


# --- projections and filters -------------------------------------------------------

def measure_columns(df: DataFrame, keys=("store_id", "datetime", "date"), exclude=(dims.TOTAL,)) -> list[str]:
    """Numeric non-key columns, computed from the schema at plan time."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in keys and f.name not in exclude]


def columns_like(df: DataFrame, *patterns: str, keys=("store_id", "datetime", "date")) -> list[str]:
    """measure columns whose name contains a match of any of the patterns (regular expressions), in schema order."""
    wanted = [re.compile(p) for p in patterns]
    return [c for c in measure_columns(df, keys=keys, exclude=()) if any(p.search(c) for p in wanted)]


def opening_hours(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """Keep 11:30 <= time <= 14:00 (inclusive)."""
    return df.where(minute_of_day(ts).between(dims.OPEN_FIRST_MINUTE, dims.OPEN_LAST_MINUTE))


def valid_slots(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """Keep rows whose ``HH:mm`` is one of the eleven opening slots."""
    return df.where(slot_label(ts).isin(dims.OPENING_SLOTS))


def weekdays_only(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """Monday..Friday."""
    return df.where(F.weekday(F.col(ts)) < 5)


def add_total(df: DataFrame, cols: list[str] | None = None, name: str = dims.TOTAL) -> DataFrame:
    """Row total of the measure columns (nulls count as 0); recomputing excludes the
    old total."""
    cols = cols or measure_columns(df, exclude=(name,))
    return df.withColumn(name, sum((F.coalesce(F.col(c), F.lit(0)) for c in cols), F.lit(0)).cast("bigint"))


def zero_column_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """P2 profile: one aggregation pass, ``(column_name, nonzero_rows, kept)``.
    NaN/null count as non-zero like the reference's ``!= 0``."""
    agg = df.agg(*[F.count_if(F.col(c).isNull() | (F.col(c) != 0)).alias(c) for c in cols])
    long = agg.unpivot([], cols, "column_name", "nonzero_rows")
    return long.withColumn("kept", F.col("nonzero_rows") > 0)


def drop_zero_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop all-zero measure columns. The profile is one row per column (bounded by
    the schema, not the data), so reading it on the driver is safe."""
    cols = cols or measure_columns(df)
    keep = {r["column_name"] for r in zero_column_profile(df, cols).where("kept").collect()}
    return df.drop(*[c for c in cols if c not in keep])


def adjust_zero_sales(df: DataFrame, category: str, clip: bool = False, total: str = dims.TOTAL) -> DataFrame:
    """P5 (and P6 with ``clip``): zero the category where the slot total is zero."""
    out = df.withColumn(category, F.when(F.col(total) == 0, F.lit(0)).otherwise(F.col(category)))
    if clip:
        out = out.withColumns({c: F.greatest(F.col(c), F.lit(0)) for c in measure_columns(out)})
    return out


def adjust_other_sequential(df: DataFrame, categories: list[str], other: str = "OTHER") -> DataFrame:
    """Subtract each category from OTHER one at a time, clipping at 0 after each."""
    expr = F.col(other)
    for c in categories:
        expr = F.greatest(expr - F.col(c), F.lit(0))
    return df.withColumn(other, expr)


def adjust_other_joint(df: DataFrame, categories: list[str], other: str = "OTHER") -> DataFrame:
    """Subtract all categories together, clip once."""
    return df.withColumn(other, F.greatest(F.col(other) - sum(F.col(c) for c in categories), F.lit(0)))


# --- first sold / cutoffs ---------------------------------------------------------------

def first_time_sold(df: DataFrame, categories: list[str], ts: str = "datetime",
                    by: tuple[str, ...] = ("store_id",)) -> DataFrame:
    """P10: first timestamp each category is non-zero, per store; null when never sold
    (Q3). One partial+final aggregation; output is one row per store and category."""
    agg = df.groupBy(*by).agg(*[F.min(F.when(F.col(c) != 0, F.col(ts))).alias(c) for c in categories])
    return agg.unpivot(list(by), categories, "category", "first_sold")


def with_cutoff(df: DataFrame, category: str, ts: str = "datetime", by: tuple[str, ...] = ("store_id",),
                name: str = "cutoff") -> DataFrame:
    """Attach the first-sold time of ``category`` to every row of its store. The cutoff
    table is one row per store; AQE broadcasts it once measured."""
    cut = df.groupBy(*by).agg(F.min(F.when(F.col(category) != 0, F.col(ts))).alias(name))
    return df.join(cut, list(by), "left")


def trim_after_first_sold(df: DataFrame, category: str, ts: str = "datetime") -> DataFrame:
    """Keep rows from the first non-zero value of ``category`` on."""
    return with_cutoff(df, category, ts).where(F.col(ts) >= F.col("cutoff")).drop("cutoff")


def inflate_other(df: DataFrame, categories: list[str], after: Column, other: str = "OTHER",
                  name: str | None = None) -> DataFrame:
    """After the cutoff add the late categories back into OTHER so training rows look
    like pre-cutoff rows."""
    return df.withColumn(name or other, F.when(after, F.col(other) + sum(F.col(c) for c in categories))
                         .otherwise(F.col(other)))


def late_intro_fixture(wide: DataFrame, start: str = "2024-01-16", late=dims.LATE_CATEGORIES,
                       other: str = "OTHER", ts: str = "datetime") -> DataFrame:
    """Test fixture for imputation: before ``start`` the late categories were not sold
    separately, their items are counted in OTHER."""
    before = F.col(ts) < F.lit(start).cast("timestamp_ntz")
    out = wide.withColumn(other, F.when(before, F.col(other) + sum(F.col(c) for c in late)).otherwise(F.col(other)))
    return out.withColumns({c: F.when(before, F.lit(0).cast("bigint")).otherwise(F.col(c)) for c in late})


# --- prediction clean-up, series filters, winsorizing ------------------------------------

def post_process_predictions(p) -> Column:
    """Negatives -> 0, then round half-even."""
    c = F.col(p) if isinstance(p, str) else p
    return half_even(F.greatest(c, F.lit(0.0)))


def clip_imputed(p) -> Column:
    """Imputation clean-up: round half-even, then clip at 0."""
    c = F.col(p) if isinstance(p, str) else p
    return F.greatest(half_even(c), F.lit(0.0))


def drop_zero_series(df: DataFrame, series: list[str], value: str) -> DataFrame:
    """P20: drop series whose values are all zero (aggregate + left-semi join)."""
    live = df.groupBy(*series).agg(F.max((F.col(value) != 0).cast("int")).alias("_nz")).where("_nz = 1")
    return df.join(live.select(*series), series, "left_semi")


def winsorize(df: DataFrame, value: str, by: list[str] | None = None, lower: float = 1, upper: float = 99,
              name: str | None = None, approx_accuracy: int | None = None) -> DataFrame:
    """Clip to the [lower, upper] percentiles (exact, linear interpolation like
    numpy). Bounds are one row per group, computed by a partial aggregation and joined.
    ``approx_accuracy`` switches to ``percentile_approx`` (bounded sketch per group) for
    columns with very many distinct values; the default stays exact."""
    by = by or []
    probs = F.array(F.lit(lower / 100), F.lit(upper / 100))
    pct = (F.percentile(F.col(value), probs) if approx_accuracy is None
           else F.percentile_approx(F.col(value), probs, approx_accuracy).cast("array<double>"))
    if by:
        out = df.join(df.groupBy(*by).agg(pct.alias("_b")), by, "left")
    else:  # global bounds: a scalar subquery, no join
        out = df.withColumn("_b", df.agg(pct).scalar())
    return (out.withColumn(name or value, F.least(F.greatest(F.col(value), F.col("_b")[0]), F.col("_b")[1]))
               .drop("_b"))


def replace_column(df: DataFrame, other: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """P22 re-aimed: replace ``column`` from a parallel frame by key join, not position."""
    return df.drop(column).join(other.select(*keys, column), keys, "left")
