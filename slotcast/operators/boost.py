"""Gradient-boosted trees with vector leaves on binned histograms (M5-M7, H5).

All models of a run (one per hierarchy level, or one per level and target) grow together. Rows are
(model, bins, y, w): the bin of every feature, the targets as an array, the number of equal rows. For every tree
level each task sums, per model, node, feature and bin, the gradients of all targets and the rows' weights; Spark adds
the tasks' sums, and one group per (model, node, feature) finds that feature's best split. The driver holds the
trees only: their number, depth and bins are parameters, so nothing there grows with the data.

The objective is the squared error of all targets together (one tree serves them all; a split's gain adds up
over targets), with the usual second-order gain: G^2 / (H + l2) of the children less that of the parent.
``subsample`` draws rows per tree by hash, ``colsample`` draws features per tree and model by seed.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package

MAX_BINS = 64


@dataclass(frozen=True)
class Params:
    trees: int = 20
    depth: int = 4
    rate: float = 0.3
    l2: float = 1.0
    min_weight: float = 1.0
    min_gain: float = 0.0
    subsample: float = 1.0
    colsample: float = 1.0
    seed: int = 42


@dataclass
class Tree:
    """Arrays over nodes: the children of node i are 2 i + 1 and 2 i + 2; feature -1 marks a leaf."""

    feature: np.ndarray
    split: np.ndarray           # bins up to it go left
    value: np.ndarray           # (nodes, targets)
    gain: np.ndarray

    def place(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node of every row after ``depth`` steps."""
        at = np.zeros(len(bins), dtype=np.int64)
        for _ in range(depth):
            f = self.feature[at]
            go = np.where(bins[np.arange(len(bins)), np.maximum(f, 0)] <= self.split[at], 1, 2)
            at = np.where(f >= 0, 2 * at + go, at)
        return at


@dataclass
class Model:
    base: np.ndarray
    trees: list[Tree] = field(default_factory=list)

    def predict(self, bins: np.ndarray, depth: int) -> np.ndarray:
        out = np.tile(self.base, (len(bins), 1))
        for t in self.trees:
            out += t.value[t.place(bins, depth)]
        return out


def bin_edges(df: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> dict[str, list[float]]:
    """Upper edges of each feature's bins: its values but the largest where there are at most ``max_bins``, else
    approximate quantiles. Two aggregations with bounded results."""
    value = {f: F.col(f).cast("double") for f in features}
    seen = df.agg(*[F.count_distinct(value[f]).alias(f) for f in features]).first()
    probs = [i / max_bins for i in range(1, max_bins)]
    row = df.agg(*[(F.collect_set(value[f]) if seen[f] <= max_bins else F.percentile_approx(value[f], probs, 10_000)).alias(f)
                   for f in features]).first()
    return {f: sorted(set(row[f] or []))[:-1] if seen[f] <= max_bins else sorted(set(row[f])) for f in features}


def with_bins(df: DataFrame, features: list[str], edges: dict[str, list[float]]) -> Column:
    """Array of every feature's bin: the number of edges below it (null: 0)."""
    def one(f: str) -> Column:
        e = F.array(*[F.lit(float(x)) for x in edges[f]]) if edges[f] else F.array().cast("array<double>")
        return F.coalesce(F.size(F.filter(e, lambda x: x < F.col(f).cast("double"))), F.lit(0))

    return F.array(*[one(f) for f in features])


def cells(df: DataFrame, model: Column, bins: Column, targets: list[Column]) -> DataFrame:
    """Rows with equal features are one row: (model, bins, y = mean targets, w = rows). For the squared error the
    fit is the same, and the work is bounded by the feature combinations."""
    rows = df.select(model.alias("model"), bins.alias("bins"), *[t.cast("double").alias(f"y{i}") for i, t in enumerate(targets)])
    for i in range(len(targets)):
        rows = rows.where(F.col(f"y{i}").isNotNull() & ~F.isnan(f"y{i}"))
    grouped = rows.groupBy("model", "bins").agg(*[F.avg(f"y{i}").alias(f"y{i}") for i in range(len(targets))], F.count("*").cast("double").alias("w"))
    return grouped.select("model", "bins", F.array(*[f"y{i}" for i in range(len(targets))]).alias("y"), "w")


def drawn(params: Params, model: str, tree: int, features: int) -> np.ndarray:
    """Features a tree may split on."""
    n = max(1, int(round(params.colsample * features)))
    rng = np.random.default_rng([params.seed, zlib.crc32(str(model).encode()), tree])
    return np.sort(rng.permutation(features)[:n])


def best_splits(total: np.ndarray, params: Params) -> tuple[float, int, np.ndarray, np.ndarray]:
    """(gain, bin, left sums, all sums) of the best split of a histogram (bins, targets + 1): gradients, weight."""
    left = np.cumsum(total, axis=0)
    whole = left[-1]
    right = whole - left

    def score(s: np.ndarray) -> np.ndarray:
        return (s[:, :-1] ** 2).sum(axis=1) / (s[:, -1] + params.l2)

    gain = score(left) + score(right) - score(whole[None])[0]
    gain[(left[:, -1] < params.min_weight) | (right[:, -1] < params.min_weight)] = -np.inf
    at = int(gain.argmax())
    return float(gain[at]), at, left[at], whole


def histograms(rows: DataFrame, models: dict[str, Model], partial: dict[str, Tree], params: Params, depth: int, tree: int,
               n_bins: int, features: int) -> DataFrame:
    """Best split of every (model, node, feature) at ``depth``: gain, bin, left and all sums."""
    targets = len(next(iter(models.values())).base)
    low = 2 ** depth - 1

    def add_up(frames):
        acc: dict[str, np.ndarray] = {}
        for f in frames:
            for name, g in f.groupby("model", sort=False):
                m = models[name]
                bins, y, w = np.vstack(g["bins"]).astype(np.int64), np.vstack(g["y"]), g["w"].to_numpy()
                if params.subsample < 1.0:
                    draw = (g["id"].to_numpy().astype(np.uint64) + np.uint64(tree * 2654435761)) * np.uint64(0x9E3779B97F4A7C15)
                    some = (draw >> np.uint64(40)) < np.uint64(int(params.subsample * (1 << 24)))
                    bins, y, w = bins[some], y[some], w[some]
                at = partial[name].place(bins, depth) - low
                live = at >= 0              # rows in leaves above this depth are done
                bins, y, w, at = bins[live], y[live], w[live], at[live]
                grad = np.column_stack([(m.predict(bins, params.depth) - y) * w[:, None], w])
                hist = acc.setdefault(name, np.zeros((2 ** depth, features, n_bins, targets + 1)))
                for j in drawn(params, name, tree, features):
                    np.add.at(hist[:, j], (at, bins[:, j]), grad)
        for name, hist in acc.items():
            node, j = np.nonzero(hist[:, :, :, -1].sum(axis=2) > 0)
            if not len(node):       # none of the task's rows is drawn or still splitting
                continue
            yield pd.DataFrame({"model": name, "node": node + low, "feature": j, "hist": [hist[a, b].ravel().tolist() for a, b in zip(node, j)]})

    def split(f: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.vstack(f["hist"]), axis=0).reshape(n_bins, targets + 1)
        gain, at, left, whole = best_splits(total, params)
        return pd.DataFrame({"model": [f["model"].iloc[0]], "node": [f["node"].iloc[0]], "feature": [f["feature"].iloc[0]],
                             "gain": [gain], "bin": [at], "left": [left.tolist()], "whole": [whole.tolist()]})

    ship_package(rows.sparkSession)
    parts = rows.mapInPandas(add_up, "model string, node int, feature int, hist array<double>")
    return parts.groupBy("model", "node", "feature").applyInPandas(
        split, "model string, node int, feature int, gain double, bin int, left array<double>, whole array<double>")


def fit(rows: DataFrame, features: int, n_bins: int, params: Params = Params()) -> dict[str, Model]:
    """Models by name from ``cells`` rows. Each tree level is one pass over the rows for all models together."""
    rows = rows.withColumn("id", F.xxhash64("model", "bins"))
    size = rows.select(F.size("y")).first()
    if size is None:
        return {}
    targets = size[0]
    means = rows.groupBy("model").agg(*[(F.sum(F.col("y")[i] * F.col("w")) / F.sum("w")).alias(f"m{i}") for i in range(targets)]).collect()
    models = {r["model"]: Model(np.array([r[f"m{i}"] for i in range(targets)])) for r in means}        # one row per model
    nodes = 2 ** (params.depth + 1) - 1
    for tree in range(params.trees):
        grown = {name: Tree(np.full(nodes, -1), np.zeros(nodes, dtype=np.int64), np.zeros((nodes, targets)), np.zeros(nodes)) for name in models}
        for depth in range(params.depth):
            found = histograms(rows, models, grown, params, depth, tree, n_bins, features).collect()   # models x nodes x features
            best: dict = {}
            for r in found:
                key = (r["model"], r["node"])
                if key not in best or (-r["gain"], r["feature"]) < (-best[key]["gain"], best[key]["feature"]):
                    best[key] = r
            for (name, node), r in best.items():
                t, whole, left = grown[name], np.array(r["whole"]), np.array(r["left"])
                leaf = lambda s: -params.rate * s[:-1] / (s[-1] + params.l2)
                t.value[node] = leaf(whole)
                if r["gain"] > params.min_gain:
                    t.feature[node], t.split[node], t.gain[node] = r["feature"], r["bin"], r["gain"]
                    t.value[2 * node + 1], t.value[2 * node + 2] = leaf(left), leaf(whole - left)
            if not any(t.feature[2 ** depth - 1:2 ** (depth + 1) - 1].max(initial=-1) >= 0 for t in grown.values()):
                break
        for name, t in grown.items():
            models[name].trees.append(t)
    return models


def predict(df: DataFrame, models: dict[str, Model], params: Params, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``pred`` (array of targets) for rows with ``model`` and ``bins``; rows of an unknown model
    get null."""
    from pyspark.sql import types as T

    fields = [df.schema[c] for c in keep]

    def run(frames):
        for f in frames:
            for name, g in f.groupby("model", sort=False, dropna=False):
                m = models.get(name)
                pred = list(m.predict(np.vstack(g["bins"]).astype(np.int64), params.depth)) if m else [None] * len(g)
                yield g[keep].assign(pred=pred)

    ship_package(df.sparkSession)
    schema = T.StructType(fields + [T.StructField("pred", T.ArrayType(T.DoubleType()))])
    return df.select(*dict.fromkeys([*keep, "model", "bins"])).mapInPandas(run, schema)


def importances(models: dict[str, Model], features: list[str]) -> list[tuple[str, str, float]]:
    """M7: (model, feature, share of the mean gain of its splits)."""
    out = []
    for name, m in sorted(models.items()):
        gain, uses = np.zeros(len(features)), np.zeros(len(features))
        for t in m.trees:
            on = t.feature >= 0
            np.add.at(gain, t.feature[on], t.gain[on])
            np.add.at(uses, t.feature[on], 1)
        mean = gain / np.maximum(uses, 1)
        out += [(name, f, float(v)) for f, v in zip(features, mean / (mean.sum() or 1.0))]
    return out


def training_rows(df: DataFrame, model: Column, features: list[str], targets: list[Column], edges: dict[str, list[float]]) -> DataFrame:
    return cut_lineage(cells(df, model, with_bins(df, features, edges), targets))
