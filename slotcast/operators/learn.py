"""Model fitting.

Linear models (regression imputation, the seasonal additive model) are fitted for many
groups at once from sufficient statistics: every task folds its rows into a per-group
partial Gram matrix (X'X, X'y, sums, n), the partials are summed by one aggregation, and
each group's small (k+1)x(k+1) system is solved in ``applyInPandas``.
Scoring is a join of the coefficient table back to the rows. This replaces a Python
loop of one Spark ML fit per (store, category) with a fixed number of jobs.

Gradient-boosted trees use ``pyspark.ml`` (one ``GBTRegressor`` per target, Q: Spark
trees are single-output).
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

# --- sufficient statistics + per-group solve ----------------------------------------------------------


def normal_equations(df: DataFrame, groups: list[str], features: list[str], label: str) -> DataFrame:
    """Per group, the augmented Gram matrix Z'Z of Z = [1, x_1..x_k, y] (upper triangle,
    row-major) as ``zz``; it holds n, sums, X'X, X'y and y'y at once.

    Every task folds its rows into one (k+2)^2 partial per group with numpy (so a group
    that holds a third of all rows is pre-aggregated on every partition, never gathered
    into one task); partials are then added element-wise by position. Rows with a null or
    non-finite predictor or label are no observations and are filtered out first."""
    for c in [*features, label]:
        x = F.col(c).cast("double")
        df = df.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    k = len(features)
    m = k + 2
    iu, ju = np.triu_indices(m)
    gfields = [df.schema[g] for g in groups]

    def partial(it):
        acc: dict = {}
        for pdf in it:
            if pdf.empty:
                continue
            z = np.column_stack([np.ones(len(pdf))] + [pdf[f].astype("float64").to_numpy() for f in features]
                                + [pdf[label].astype("float64").to_numpy()])
            for key, rows in pdf.groupby(groups, dropna=False).indices.items():
                key = key if isinstance(key, tuple) else (key,)
                acc[key] = acc.get(key, 0) + z[rows].T @ z[rows]
        if not acc:
            return
        rows = [list(key) + [g[iu, ju].tolist()] for key, g in acc.items()]
        yield pd.DataFrame(rows, columns=groups + ["zz"])

    schema = T.StructType(gfields + [T.StructField("zz", T.ArrayType(T.DoubleType()))])
    ship_package(df.sparkSession)
    parts = df.select(*groups, *features, label).mapInPandas(partial, schema)
    summed = (parts.select(*groups, F.posexplode("zz").alias("pos", "v"))
              .groupBy(*groups, "pos").agg(F.sum("v").alias("v")))
    return summed.groupBy(*groups).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("zz"))


def _unpack(zz, k: int) -> np.ndarray:
    m = k + 2
    g = np.zeros((m, m))
    iu, ju = np.triu_indices(m)
    g[iu, ju] = np.asarray(zz, dtype=float)
    return g + np.triu(g, 1).T


def solve_groups(stats: DataFrame, groups: list[str], features: list[str], ridge: float = 0.0,
                 mask_col: str | None = None, with_sigma: bool = False) -> DataFrame:
    """Solve each group's centred normal equations (intercept unpenalised). ``ridge`` is an
    L2 penalty on standardised features (like Spark ML ``regParam`` with
    standardisation); rank-deficient systems get the minimum-norm solution (as a least
    squares solver would). ``mask_col`` (array<boolean>) selects predictors per group.
    Output: groups + ``intercept`` + ``coef`` (array aligned with ``features``), and with ``with_sigma``
    the root mean squared residual of the fit, from the same sums."""
    k = len(features)
    fields = [stats.schema[g] for g in groups]
    schema = T.StructType(fields + [T.StructField("intercept", T.DoubleType()),
                                    T.StructField("coef", T.ArrayType(T.DoubleType()))]
                          + ([T.StructField("sigma", T.DoubleType())] if with_sigma else []))
    cols = groups + ["zz"] + ([mask_col] if mask_col else [])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():
            g = _unpack(r["zz"], k)
            n = g[0, 0]
            sx, sy = g[0, 1:k + 1], g[0, k + 1]
            mx, my = sx / n, sy / n
            cxx = g[1:k + 1, 1:k + 1] - n * np.outer(mx, mx)      # centred X'X
            cxy = g[1:k + 1, k + 1] - n * mx * my
            sel = np.ones(k, dtype=bool) if mask_col is None else np.asarray(r[mask_col], dtype=bool)
            beta = np.zeros(k)
            if sel.any():
                a = cxx[np.ix_(sel, sel)]
                b = cxy[sel]
                if ridge > 0:
                    var = np.clip(np.diag(a) / max(n - 1, 1), 0, None)
                    a = a + ridge * n * np.diag(var)
                beta_sel, *_ = np.linalg.lstsq(a, b, rcond=None)
                beta[sel] = beta_sel
            inter = my - float(mx @ beta)
            row = [r[c] for c in groups] + [inter, beta.tolist()]
            if with_sigma:
                rss = g[k + 1, k + 1] - n * my * my - 2 * beta @ cxy + beta @ cxx @ beta
                row.append(float(np.sqrt(max(rss, 0.0) / n)))
            out.append(row)
        return pd.DataFrame(out, columns=groups + ["intercept", "coef"] + (["sigma"] if with_sigma else []))

    ship_package(stats.sparkSession)
    return stats.select(*cols).groupBy(*groups).applyInPandas(solve, schema)


def predict(df: DataFrame, coefs: DataFrame, groups: list[str], features: list[str], name: str = "yhat") -> DataFrame:
    """Score rows with their group's coefficients (equi-join on the group keys; the
    coefficient table has one row per group)."""
    j = df.join(coefs, groups, "inner")
    pred = F.col("intercept") + sum((F.col("coef")[i] * F.col(f).cast("double") for i, f in enumerate(features)),
                                    F.lit(0.0))
    return j.withColumn(name, pred).drop("intercept", "coef")


# --- gradient-boosted trees -------------------------------------------------------------------------------

def fit_gbt(train: DataFrame, features: list[str], target: str, max_iter: int = 20, max_depth: int = 5,
            step_size: float = 0.1, subsampling: float = 0.8, feature_subset: str = "all", seed: int = 42):
    """M5: one Spark ML GBT per target. Parameter mapping: n_estimators->maxIter,
    max_depth->maxDepth, learning_rate->stepSize, subsample->subsamplingRate,
    colsample_bytree->featureSubsetStrategy (per node in Spark, per tree in the reference)."""
    asm = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="_features", labelCol=target, predictionCol=f"pred_{target}",
                       maxIter=max_iter, maxDepth=max_depth, stepSize=step_size,
                       subsamplingRate=subsampling, featureSubsetStrategy=feature_subset, seed=seed)
    return Pipeline(stages=[asm, gbt]).fit(train)


def importances(model, features: list[str]) -> list[tuple[str, float]]:
    """M7: feature importances with names (a k-vector from the fitted model)."""
    imp = model.stages[-1].featureImportances.toArray()
    return list(zip(features, [float(v) for v in imp]))


# --- E4 / S12: model interface (fit / predict / eval / save / load) ------------------------------------------

class GroupedLinearModel:
    """Per-group linear model with the fit/predict/eval/save/load surface of the
    reference's model classes, backed by the grouped sufficient-statistics fit. The
    coefficients are a DataFrame (one row per group) persisted as Parquet."""

    def __init__(self, groups: list[str], features: list[str], label: str, ridge: float = 0.0):
        self.groups, self.features, self.label, self.ridge = groups, features, label, ridge
        self.coefs: DataFrame | None = None

    def fit(self, df: DataFrame) -> "GroupedLinearModel":
        stats = normal_equations(df, self.groups, self.features, self.label)
        self.coefs = solve_groups(stats, self.groups, self.features, ridge=self.ridge)
        return self

    def predict(self, df: DataFrame, name: str = "yhat") -> DataFrame:
        return predict(df, self.coefs, self.groups, self.features, name)

    def eval(self, df: DataFrame) -> DataFrame:
        from .metrics import per_target
        return per_target(self.predict(df), self.groups, y=self.label, yhat="yhat")

    def save(self, path: str) -> None:
        self.coefs.withColumn("_features", F.lit(",".join(self.features))) \
            .write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str, groups: list[str], label: str) -> "GroupedLinearModel":
        c = spark.read.parquet(path)
        feats = c.select("_features").first()[0].split(",")
        m = cls(groups, feats, label)
        m.coefs = c.drop("_features")
        return m
