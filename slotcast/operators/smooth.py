"""Ordered series operators.

Every window is partitioned by the series key, so no window runs globally. A series
is one row per time step, so its length is bounded by the calendar (days x slots),
not by the data volume; a hot store adds rows to its slots, not to its series.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package


def _w(series: list[str], order: str) -> Window:
    return Window.partitionBy(*series).orderBy(order)


def centred_mean(value: str, series: list[str], order: str, width: int) -> Column:
    """Centred rolling mean over ``width`` rows, null unless the window is full."""
    h = width // 2
    w = _w(series, order).rowsBetween(-h, h)
    return F.when(F.count(F.col(value)).over(w) == width, F.avg(value).over(w))


def centred_median(value: str, series: list[str], order: str, width: int, keep_edges: bool = True) -> Column:
    """Centred rolling median (exact ``percentile``, which accepts a frame);
    edges without a full window keep the raw value."""
    h = width // 2
    w = _w(series, order).rowsBetween(-h, h)
    med = F.percentile(F.col(value), 0.5).over(w)
    full = F.count(F.col(value)).over(w) == width
    return F.when(full, med).otherwise(F.col(value).cast("double") if keep_edges else F.lit(None))


def back_then_forward_fill(value: str, series: list[str], order: str) -> Column:
    """Back-fill (next non-null), then forward-fill (previous non-null)."""
    ahead = _w(series, order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    behind = _w(series, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bfilled = F.first(F.col(value), ignorenulls=True).over(ahead)
    return F.coalesce(bfilled, F.last(F.col(value), ignorenulls=True).over(behind))


def ema(df: DataFrame, value: str, series: list[str], order: str, span: float, out: str = "ema") -> DataFrame:
    """Recursive EMA (unadjusted weights) with the absolute-position gap rule: the past weight decays by
    (1 - alpha) per row, missing rows carry the output, rows before the first value have none.

    One pass over each series, whose steps (bounded by the calendar) meet in one group."""
    def smoothed(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(order)
        return f.assign(**{out: f[value].astype("float64").ewm(span=span, adjust=False, ignore_na=False).mean()})

    rows = df.select(*series, order, value)
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.DoubleType())])
    ship_package(df.sparkSession)
    z = rows.groupBy(*series).applyInPandas(smoothed, schema)
    return z.withColumn(out, F.when(~F.isnan(out), F.col(out)))
