"""Experiment configuration and parameter search.

Configs are small driver-side objects; the run grid is a DataFrame built by exploding
literal arrays (no join), so every run can be evaluated by a distributed job and the
best run picked with ``min_by`` (A16).
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES — the shipped boosted-tree search space.
TREE_SPACE = {
    "max_depth": [4, 7, 10],
    "n_estimators": [500, 800, 1000],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "subsample": [0.6, 0.7, 0.8, 0.9],
    "colsample_bytree": [0.6, 0.7, 0.8, 0.9],
}
LEVEL_FEATURES = {"semester_phase": ["semester_phase_uni", "semester_phase_hs"],
                  "semester_period": ["semester_uni", "semester_hs"]}


def expand_features(features: list[str], store_ids) -> list[str]:
    """``semester_phase``/``semester_period`` expand to both institutions; ``store_id``
    is a feature when more than one store is modelled."""
    out = []
    for f in features:
        out.extend(LEVEL_FEATURES.get(f, [f]))
    if store_ids is not None and len(store_ids) > 1 and "store_id" not in out:
        out.append("store_id")
    return out


def load_experiment(path: str) -> dict:
    """Read an experiment YAML (``meta``, ``experiment``); missing ``store_ids`` or
    the string "None" become a real null (Q30)."""
    import yaml
    with open(path) as fh:
        cfg = yaml.safe_load(fh)
    exp = cfg.get("experiment", {})
    if exp.get("store_ids") in ("None", "none"):
        exp["store_ids"] = None
    return cfg


def run_grid(spark: SparkSession, data_params: dict[str, list], model_params: dict[str, list],
             features: list[str] | None = None, n_features: int | None = None) -> DataFrame:
    """Cartesian product of data params x model params x feature combinations
    C(n, k), one row per run, built with ``explode`` over literal arrays."""
    df = spark.range(1).select(F.lit(0).alias("_"))
    for name, values in list(data_params.items()) + list(model_params.items()):
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    if features and n_features:
        combos = [list(c) for c in itertools.combinations(features, n_features)]
        df = df.withColumn("features", F.explode(F.array(*[F.array(*[F.lit(x) for x in c]) for c in combos])))
    cols = [c for c in df.columns if c != "_"]
    return df.select(F.monotonically_increasing_id().alias("_mid"), *cols) \
             .withColumn("run_id", F.xxhash64(*[F.col(c).cast("string") for c in cols])).drop("_mid")


def random_runs(grid: DataFrame, n_runs: int, seed: int = 42) -> DataFrame:
    """A seeded sample of exactly ``n_runs`` runs (order by a hash of run id + seed)."""
    return grid.orderBy(F.xxhash64("run_id", F.lit(seed))).limit(n_runs)


def best_run(results: DataFrame, score: str = "mean_mae") -> DataFrame:
    """The run with the lowest score."""
    return results.agg(F.min_by("run_id", score).alias("run_id"), F.min(score).alias(score))
