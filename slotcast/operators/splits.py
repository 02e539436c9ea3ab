"""Train/test splits and folds.

Folds are assigned by arithmetic on a date's rank or day number, and each row is
exploded to the folds it belongs to with ``sequence`` (no joins, no pairs). Ranks over
the distinct dates are computed per bucket (month, or hash prefix) plus a prefix sum
over the bucket counts, so no window runs over all rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BITS = 32


def date_hash(d, seed) -> Column:
    """32-bit hash of a date under a seed: the leading bits of md5 over ``seed:date``, which
    every SQL engine has; a different seed gives an unrelated order."""
    day = (F.col(d) if isinstance(d, str) else d).cast("date").cast("string")
    seed_c = (seed if isinstance(seed, Column) else F.lit(seed)).cast("bigint").cast("string")
    return F.conv(F.substring(F.md5(F.concat_ws(":", seed_c, day)), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def date_split(df: DataFrame, date: str = "date", cv_end: str = "2024-12-31", test_start: str = "2024-09-01",
               forecast_start: str = "2025-01-01") -> DataFrame:
    """P14 (cv set / train / test) and P15 (train / score) labels by DATE comparison."""
    d = F.col(date)
    in_cv = d <= F.lit(cv_end).cast("date")
    p14 = F.when(in_cv & (d < F.lit(test_start).cast("date")), "train").when(in_cv, "test")
    p15 = F.when(d < F.lit(forecast_start).cast("date"), "train").otherwise("score")
    return df.withColumns({"in_cv": in_cv.cast("int"), "p14_role": p14, "p15_role": p15})


def global_rank(df: DataFrame, order: list[str], bucket: Column) -> DataFrame:
    """0-based rank of every row in the global ``order`` plus the row count ``n``, without
    a single-partition window over the rows: ``bucket`` must be monotone in ``order``
    (e.g. the month of a date); rows are ranked inside their bucket (window partitioned
    by bucket) and offset by the number of rows in earlier buckets (a prefix sum over
    the small per-bucket count table)."""
    b = df.withColumn("_bucket", bucket)
    counts = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", "_c", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    # bucket -> offset map and n in ONE scalar subquery (a small job), so the ranked
    # rows need no join
    meta = offsets.select(F.struct(F.map_from_entries(F.collect_list(F.struct("_bucket", "_off"))).alias("m"),
                                   F.sum("_c").alias("n"))).scalar()
    inner = Window.partitionBy("_bucket").orderBy(*order)
    ranked = b.withColumn("_r", F.row_number().over(inner) - 1).withColumn("_meta", meta)
    return ranked.select(*df.columns, (F.element_at(F.col("_meta.m"), F.col("_bucket")) + F.col("_r")).alias("rank"),
                         F.col("_meta.n").alias("n"))


def ranked_dates(df: DataFrame, date: str = "date") -> DataFrame:
    """Distinct dates with a 0-based rank and the total count n (buckets = months)."""
    dates = df.select(date).distinct()
    return global_rank(dates, [date], F.trunc(date, "month"))


def sample_dates(df: DataFrame, ratio: float = 0.5, seed: int = 42, date: str = "date") -> DataFrame:
    """Exactly floor(n * ratio) distinct dates, chosen by seeded hash order (ties by
    date). Buckets are the top bits of the 32-bit hash, so the rank is distributed."""
    dates = df.select(date).distinct().withColumn("_h", date_hash(date, seed))
    ranked = global_rank(dates, ["_h", date], F.shiftright(F.col("_h"), HASH_BITS - 10))
    return ranked.where(F.col("rank") < F.floor(F.col("n") * F.lit(ratio))).select(date)


def split_by_dates(df: DataFrame, dates: DataFrame, date: str = "date") -> tuple[DataFrame, DataFrame]:
    """Rows whose date is in ``dates`` (left-semi) and the rest (left-anti)."""
    return df.join(dates, date, "left_semi"), df.join(dates, date, "left_anti")


def expanding_folds(df: DataFrame, n_splits: int = 5, date: str = "date") -> DataFrame:
    """Expanding time split over distinct dates (Q31: by date, not by row).
    m = n // (s+1); fold i tests ranks [n-(s-i)m, n-(s-i-1)m) and trains on every earlier
    rank. Output ``(fold, date, role)``."""
    s = n_splits
    r = ranked_dates(df, date)
    m = F.floor(F.col("n") / (s + 1))
    j = F.floor((F.col("n") - F.col("rank") - 1) / m) + 1            # blocks from the end
    test_fold = F.when((j >= 1) & (j <= s), F.lit(s) - j)
    first_train = F.greatest(F.floor(F.lit(s) - (F.col("n") - F.col("rank")) / m) + 1, F.lit(0)).cast("int")
    tests = r.where(test_fold.isNotNull()).select(test_fold.cast("int").alias("fold"), date, F.lit("test").alias("role"))
    trains = r.where(first_train <= s - 1).select(
        F.explode(F.sequence(first_train, F.lit(s - 1))).alias("fold"), date, F.lit("train").alias("role"))
    return tests.unionByName(trains)


def rolling_origin_folds(df: DataFrame, horizon: int = 30, period: int = 15, initial: int = 400,
                         date: str = "date") -> DataFrame:
    """Cutoffs c_k = max - horizon - k*period while c_k >= min + initial. Each date is
    exploded only to the (at most ceil(horizon/period)) cutoffs whose test window holds
    it; training sizes come from a per-cutoff histogram and a suffix sum over cutoffs."""
    dates = df.select(date).distinct()
    b = df.agg(F.min(date).alias("d0"), F.max(date).alias("d1"))
    k_max = F.floor((F.datediff("d1", "d0") - horizon - initial) / period).cast("int")
    delta = F.datediff("d1", date)
    with_b = dates.withColumn("_b", b.select(F.struct("d0", "d1")).scalar()).select(
        date, F.col("_b.d0").alias("d0"), F.col("_b.d1").alias("d1"))
    lo = F.greatest(F.floor((delta - horizon) / period) + 1, F.lit(0)).cast("int")
    hi = F.least(F.floor(delta / period), k_max).cast("int")
    tests = with_b.where(lo <= hi).select(date, "d1", F.explode(F.sequence(lo, hi)).alias("k"))
    tests = tests.select(F.date_sub("d1", F.lit(horizon) + F.col("k") * period).alias("cutoff"), "k", date)
    # training size per cutoff: date counts toward every k <= floor((delta - horizon)/period)
    kk = F.least(F.floor((delta - horizon) / period), k_max).cast("int")
    hist = with_b.where(kk >= 0).groupBy(kk.alias("k")).agg(F.count(F.lit(1)).alias("_c"))
    ks = b.select(F.explode(F.sequence(F.lit(0), k_max)).alias("k")).where(k_max >= 0)
    # one row per cutoff: a cutoff-sized table, so the unpartitioned suffix sum is tiny
    suffix = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n_train = ks.join(hist, "k", "left").select(
        "k", F.sum(F.coalesce("_c", F.lit(0))).over(suffix).cast("bigint").alias("n_train"))
    return tests.join(n_train, "k", "left").select("cutoff", date, F.lit("test").alias("role"),
                                                    F.coalesce("n_train", F.lit(0)).cast("bigint").alias("n_train"))


def hash_kfold(df: DataFrame, k: int = 5, repeats: int = 3, seed: int = 42, date: str = "date") -> DataFrame:
    """Repeated K-fold by seeded hash of the date; one output row per repeat."""
    return (df.select(date).distinct()
              .select(date, F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat"))
              .withColumn("fold", F.pmod(date_hash(date, F.lit(seed) + F.col("repeat")), F.lit(k)).cast("int")))


def last_n_flag(series: list[str], order: str, n: int) -> Column:
    """1 for the last ``n`` rows of each series."""
    w = Window.partitionBy(*series).orderBy(F.desc(order))
    return (F.row_number().over(w) <= n).cast("int")
