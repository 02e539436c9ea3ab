"""As-of join (J10): every left row gets the latest right row of its key at or before its time.

Both sides are laid on one time line per key, cut into buckets. Inside a bucket a running window carries the last
right row to the left rows after it; a left row with none before it in its bucket takes the last right row of the
nearest earlier bucket, from a table with one row per key and bucket. No pairs of rows are made, and a key that
holds a third of all rows is many buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_SECONDS = 86_400


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str,
              bucket_seconds: int = BUCKET_SECONDS, tolerance_seconds: int | None = None) -> DataFrame:
    """``left`` with the columns of ``right`` other than ``by`` (null where there is none; names must differ from the
    left ones). Of right rows of one time the largest counts, by column order. Left rows with a null key or
    time, and right rows with one, match nothing; a match older than ``tolerance_seconds`` counts as none."""
    values = [c for c in right.columns if c not in by]
    time = lambda c: F.col(c).cast("timestamp_ntz")
    known = lambda df, c: df.where(" AND ".join(f"`{x}` IS NOT NULL" for x in [*by, c]))
    a = known(left, left_time).select(*by, time(left_time).alias("_t"), F.lit(1).alias("_left"), F.struct(*left.columns).alias("_l"))
    b = known(right, right_time).select(*by, time(right_time).alias("_t"), F.lit(0).alias("_left"), F.struct(right_time, *[c for c in values if c != right_time]).alias("_r"))
    both = a.unionByName(b, allowMissingColumns=True)
    seconds = F.unix_timestamp(F.col("_t").cast("timestamp"))
    both = both.withColumn("_b", F.floor(seconds / bucket_seconds))
    ends = both.groupBy(*by, "_b").agg(F.max("_r").alias("_e"))
    earlier = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)      # one row per bucket
    ends = ends.select(*by, "_b", F.last("_e", ignorenulls=True).over(earlier).alias("_c"))
    run = Window.partitionBy(*by, "_b").orderBy("_t", "_left", "_r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = both.withColumn("_r", F.last("_r", ignorenulls=True).over(run)).where("_left = 1")
    out = here.join(ends, [*by, "_b"]).withColumn("_m", F.coalesce("_r", "_c"))
    if tolerance_seconds is not None:
        age = seconds - F.unix_timestamp(F.col(f"_m.{right_time}").cast("timestamp_ntz").cast("timestamp"))
        out = out.withColumn("_m", F.when(age <= tolerance_seconds, F.col("_m")))
    out = out.select("_l.*", *[F.col(f"_m.{c}").alias(c) for c in values])
    lost = left.where(" OR ".join(f"`{c}` IS NULL" for c in [*by, left_time]))
    return out.unionByName(lost, allowMissingColumns=True)
