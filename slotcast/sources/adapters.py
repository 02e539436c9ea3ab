"""Adapters from the driver tables to slotcast's canonical sales tables.

Adapter A (slot sales, from ``events``)::

    datetime = ts floored to 15 minutes, store_id = user_id % 2 + 1,
    category = event type mapped to a sales category, items = count(*)

Adapter B (daily sales, from ``orders`` x ``customer`` x ``nation``)::

    date = o_orderdate (+ optional year shift), store_id = n_regionkey,
    category = o_orderpriority, items = count(*)

Both are single hash aggregations with map-side partial aggregation, so a hot
store/category/slot is pre-combined on every input partition before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import slot_start
from . import dims
from .tables import read_table

# FIXED VALUES — event type -> sales category mapping of adapter A.
EVENT_CATEGORY = [("click", "MAIN"), ("view", "SIDE"), ("purchase", "OTHER"),
                  ("signup", "CONDIMENT"), ("error", "BAKED_GOOD")]
# Shift that moves the orders calendar (1995-2001) onto the reference's 2024+ calendar.
CALENDAR_SHIFT_YEARS = 29


def event_category(c: Column) -> Column:
    expr = None
    for ev, cat in EVENT_CATEGORY:
        expr = F.when(c == ev, cat) if expr is None else expr.when(c == ev, cat)
    return expr


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        (F.col("user_id") % 2 + 1).cast("int").alias("store_id"),
        slot_start("ts").alias("datetime"),
        event_category(F.col("event_type")).alias("category"))


def slot_sales_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical long table ``sales(store_id, datetime, category, items)``."""
    return (_events(spark, sf_dir)
            .groupBy("store_id", "datetime", "category")
            .agg(F.count(F.lit(1)).alias("items")))


def slot_sales_wide(spark: SparkSession, sf_dir: str, categories: list[str] | None = None) -> DataFrame:
    """Wide slot table (one column per category + TOTAL_SALES) built in ONE aggregation
    straight from the events: conditional counts instead of long-agg + pivot (one shuffle)."""
    cats = categories or dims.CATEGORIES
    ev = _events(spark, sf_dir)
    aggs = [F.count_if(F.col("category") == c).cast("bigint").alias(c) for c in cats]
    wide = ev.groupBy("store_id", "datetime").agg(*aggs)
    return wide.withColumn(dims.TOTAL, sum((F.col(c) for c in cats), F.lit(0).cast("bigint")))


def daily_sales_long(spark: SparkSession, sf_dir: str, shift_years: int = 0) -> DataFrame:
    """Adapter B: ``(date, store_id, category, items)``; orders join customer and nation.
    customer is the larger dimension, so the join is a shuffle join on the key that AQE
    may turn into a broadcast once it has measured the customer side."""
    return (_order_rows(spark, sf_dir, shift_years)
            .groupBy("date", "store_id", "category")
            .agg(F.count(F.lit(1)).alias("items")))


def _order_rows(spark: SparkSession, sf_dir: str, shift_years: int = 0) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    day = F.to_date("o_orderdate")
    if shift_years:
        day = F.add_months(day, 12 * shift_years)
    joined = (o.join(c, o.o_custkey == c.c_custkey)
              .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    return joined.select(day.alias("date"), F.col("n_regionkey").cast("int").alias("store_id"),
                         F.col("o_orderpriority").alias("category"))


def order_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One look-up request per order: its store and day."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(F.col("o_orderkey").alias("request_id"), F.col("n_regionkey").cast("int").alias("store_id"),
                         F.to_date("o_orderdate").alias("date"))


def daily_store_totals(spark: SparkSession, sf_dir: str, shift_years: int = 0) -> DataFrame:
    """Daily total per store ``(store_id, date, y)`` (S7), aggregated straight from the
    order rows (one shuffle, not long-aggregate then re-aggregate)."""
    return (_order_rows(spark, sf_dir, shift_years)
            .groupBy("store_id", "date").agg(F.count(F.lit(1)).cast("bigint").alias("y")))


def dense_daily_store_totals(spark: SparkSession, sf_dir: str, shift_years: int = 0,
                             fill: bool = True) -> DataFrame:
    """Daily store totals on a dense day grid from each store's first to last day.
    The grid is generated per store with ``sequence`` (no join to build it)."""
    tot = daily_store_totals(spark, sf_dir, shift_years)
    bounds = tot.groupBy("store_id").agg(F.min("date").alias("d0"), F.max("date").alias("d1"))
    grid = bounds.select("store_id", F.explode(F.sequence("d0", "d1")).alias("date"))
    out = grid.join(tot, ["store_id", "date"], "left")
    if fill:
        out = out.withColumn("y", F.coalesce("y", F.lit(0)).cast("bigint"))
    return out
