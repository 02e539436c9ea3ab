"""Readers and writers for the reference's file formats.

The reference keeps one CSV per store with a ``time`` column and one integer column
per category. Here all stores live in one table with a ``store_id`` column that is
either taken from a ``store_id=`` path partition or parsed from the file name.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import dims


def raw_sales_schema(categories: list[str] | None = None, time_col: str = "time") -> T.StructType:
    cats = categories or dims.CATEGORIES
    return T.StructType([T.StructField(time_col, T.StringType(), True)]
                        + [T.StructField(c, T.IntegerType(), True) for c in cats])


def read_store_csv(spark: SparkSession, paths: list[str] | str, categories: list[str] | None = None,
                   time_col: str = "time", tolerant: bool = False) -> DataFrame:
    """Explicit schema (no inference), rename ``time``->``datetime``, parse to
    TIMESTAMP_NTZ, ``store_id`` from the file name (``...store<N>...``).

    ``tolerant`` keeps malformed rows as nulls (PERMISSIVE) and skips missing files, the
    Spark form of "an unreadable file becomes an empty slot, the others continue"."""
    schema = raw_sales_schema(categories, time_col)
    reader = spark.read.schema(schema).option("header", True)
    if tolerant:
        paths = existing_paths(spark, [paths] if isinstance(paths, str) else list(paths))
        reader = reader.option("mode", "PERMISSIVE").option("ignoreMissingFiles", True) \
                       .option("ignoreCorruptFiles", True)
    else:
        reader = reader.option("mode", "FAILFAST")
    df = reader.csv(paths)
    store = F.regexp_extract(F.input_file_name(), r"store_?(\d+)", 1)
    return (df.withColumn("datetime", F.try_to_timestamp(F.col(time_col)).cast("timestamp_ntz"))
              .drop(time_col)
              .withColumn("store_id", F.when(store != "", store.cast("int"))))


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """Keep the paths that exist, checked through the Hadoop file system of each path
    (works for local, HDFS and object-store URIs alike)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    keep = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            keep.append(p)
        else:
            print(f"skipping unreadable input {p}")
    return keep


def count_bad_timestamps(df: DataFrame, raw_col: str, parsed_col: str) -> DataFrame:
    """Number of values that did not parse."""
    return df.agg(F.count_if(F.col(raw_col).isNotNull() & F.col(parsed_col).isNull()).alias("bad_dates"))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                fmt: str = "parquet", sort_within: list[str] | None = None) -> None:
    """Overwrite sink, partitioned by store (partition pruning for S3)."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Metrics or parameters of runs (``experiment, run_id`` and any others). The folders of the runs in
    ``metrics`` are replaced and all others kept, so writing a run again leaves equal rows."""
    (metrics.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("experiment", "run_id").parquet(path))


def save_params(spark: SparkSession, params: dict, path: str) -> None:
    """One-row parameter table (e.g. lambda, label order)."""
    row = {k: (",".join(v) if isinstance(v, (list, tuple)) else v) for k, v in params.items()}
    spark.createDataFrame([row]).coalesce(1).write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> dict:
    return spark.read.parquet(path).first().asDict()


STATE = ("residuals", "nodes", "edges")


def save_state(spark: SparkSession, path: str, residuals: DataFrame, nodes: DataFrame, edges: DataFrame, **params) -> None:
    """One saved reconciliation state: the residual table, the series with their labels and level, the
    summing matrix as (series, bottom) rows, and parameters such as lambda. Saving again replaces it."""
    for name, df in zip(STATE, (residuals, nodes, edges)):
        df.write.mode("overwrite").parquet(os.path.join(path, name))
    save_params(spark, params, os.path.join(path, "params"))


def load_state(spark: SparkSession, path: str) -> dict:
    """The tables and parameters of ``save_state`` by name."""
    state = {name: spark.read.parquet(os.path.join(path, name)) for name in STATE}
    return {**state, **load_params(spark, os.path.join(path, "params"))}


def exists(path: str) -> bool:
    return os.path.exists(path)
