"""Forecast reconciliation (H11-H23, R1, R2) on long tables ``(labels..., date, yhat)``.

R1 — diagonal weights (OLS w=1, SS w=leaf count, VS w=mean squared residual): weighted
least squares on a tree equals an upward and a downward pass of group-by/join, one
level at a time, for all dates at once. No matrix is formed.

    up:   leaves m=y, v=w;  parent: M=sum m_c, V=sum v_c, v=1/(1/w+1/V), m=v(y/w+M/V)
    down: root b=m;         child:  b_c = m_c + v_c/V (b_parent - M)

(M and V are the columns ``sum_m``/``sum_v``: Spark column names are case-insensitive.)

R2 — dense weights (MinTSa, MinTSh): W = A + B B' with A = lambda diag(W1), B = sqrt((1 - lambda) / T) E. With P the
tree passes under the diagonal weights A, the reconciled forecasts are P y - P B a, where a solves the T x T
system (I + (RB)' A^-1 (RB)) a = (RB)' A^-1 R y, R = I - P (T = residual dates). So the residual vectors are
reconciled like forecasts, one more pass of group-by/join, and neither W nor G (series x series) is ever
formed: the work grows with series x dates, and only T x T sums, as large as the calendar, meet in one task.
MinTSa takes lambda = ``SAMPLE_SHARE`` instead of 0, which keeps W regular with more series than dates.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, ship_package
from . import hierarchy as H

SAMPLE_SHARE = 1e-6
METHODS = ["BU", "OLS", "SS", "VS", "MinTSa", "MinTSh"]


def check_method(method: str) -> str:
    """Validate every call against the enum."""
    if method not in METHODS:
        raise ValueError(f"unknown reconciliation method {method!r}; expected one of {METHODS}")
    return method


def check_inputs(base: DataFrame, residuals: DataFrame | None = None, keys: list[str] | None = None) -> None:
    """Raise on null keys or values, on duplicate (series, key) rows, and when base forecasts and residuals
    do not cover the same series. Three aggregations, each with a one-row result."""
    keys = ["series_id", *(keys or ["date"])]
    for name, df, value in (("base", base, "yhat"), ("residuals", residuals, "e")):
        if df is None:
            continue
        bad = F.col(value).isNull() | F.isnan(F.col(value).cast("double"))
        for k in keys:
            bad = bad | F.col(k).isNull()
        nulls = df.agg(F.count_if(bad)).first()[0]
        if nulls:
            raise ValueError(f"{name}: {nulls} rows with null keys or values")
        twice = df.groupBy(*keys).agg(F.count("*").alias("c")).agg(F.count_if(F.col("c") > 1)).first()[0]
        if twice:
            raise ValueError(f"{name}: {twice} duplicate keys")
    if residuals is not None:
        ids = base.select("series_id").distinct().withColumn("b", F.lit(1)).join(
            residuals.select("series_id").distinct().withColumn("r", F.lit(1)), "series_id", "full")
        odd = ids.agg(F.count_if(F.col("b").isNull() | F.col("r").isNull())).first()[0]
        if odd:
            raise ValueError(f"{odd} series are in only one of base forecasts and residuals")


# --- weights ----------------------------------------------------------------------------------

def diagonal_weights(method: str, nodes_df: DataFrame, resid: DataFrame | None = None) -> DataFrame:
    """``(series_id, w)`` for OLS/SS/VS. Residuals are required only for VS (Q17)."""
    if method == "OLS":
        return nodes_df.select("series_id", F.lit(1.0).alias("w"))
    if method == "SS":
        return nodes_df.select("series_id", F.col("n_leaves").cast("double").alias("w"))
    if method == "VS":
        if resid is None:
            raise ValueError("VS needs residuals")
        return resid.groupBy("series_id").agg(F.avg(F.col("e") * F.col("e")).alias("w"))
    raise ValueError(method)


# --- R1: tree passes ------------------------------------------------------------------------------

def reconcile_tree(base: DataFrame, weights: DataFrame, labels: list[str] = H.LABELS,
                   keys: list[str] | None = None) -> DataFrame:
    """WLS reconciliation of a prefix hierarchy. ``base`` has the label columns (null =
    aggregated), ``series_id``, ``keys`` (default ``date``) and ``yhat``."""
    keys = keys or ["date"]
    k = len(labels)
    # the weighted input is read by every level of both passes: write it once
    # an aggregate without weight (dropped by P20) carries no information of its own (infinite variance),
    # so its subtree still adds up; a bottom series without weight is left out
    b = base.join(weights, "series_id", "left").withColumn("_d", H.node_depth(labels))
    b = cut_lineage(b.where((F.col("_d") < k) | F.col("w").isNotNull())
                    .withColumn("w", F.coalesce("w", F.lit(float("inf")))))
    up = {k: b.where(F.col("_d") == k).select(*labels, *keys, F.col("yhat").alias("m"), F.col("w").alias("v"))}
    agg = {}
    for m in range(k - 1, -1, -1):
        pk = labels[:m]
        ch = up[m + 1].groupBy(*pk, *keys).agg(F.sum("m").alias("sum_m"), F.sum("v").alias("sum_v"))
        own = b.where(F.col("_d") == m).select(*pk, *keys, "yhat", "w")
        node = own.join(ch, pk + keys)
        v = 1.0 / (1.0 / F.col("w") + 1.0 / F.col("sum_v"))
        node = node.select(*pk, *keys, "sum_m", "sum_v", v.alias("v"),
                           (v * (F.col("yhat") / F.col("w") + F.col("sum_m") / F.col("sum_v"))).alias("m"))
        agg[m] = node
        up[m] = node.select(*pk, *keys, "m", "v")
    down = {0: agg[0].select(*keys, F.col("m").alias("b"))}
    for m in range(1, k + 1):
        pk = labels[: m - 1]
        parent = agg[m - 1].select(*pk, *keys, "sum_m", "sum_v").join(down[m - 1], pk + keys)
        child = up[m].join(parent, pk + keys)
        down[m] = child.select(*labels[:m], *keys,
                               (F.col("m") + F.col("v") / F.col("sum_v") * (F.col("b") - F.col("sum_m"))).alias("b"))
    rec = None
    for m in range(k + 1):
        part = down[m]
        for c in labels[m:]:
            part = part.withColumn(c, F.lit(None).cast(base.schema[c].dataType))
        rec = part if rec is None else rec.unionByName(part)
    rec = rec.select(H.series_id(labels).alias("series_id"), *keys, F.col("b").alias("yhat_rec"))
    return base.join(rec, ["series_id", *keys], "left")


def rollup_bottom(bottom: DataFrame, value: str, labels: list[str] = H.LABELS,
                  keys: list[str] | None = None, name: str = "yhat_rec") -> DataFrame:
    """Sum bottom values to every node (S times the bottom vector) for all keys."""
    keys = keys or ["date"]
    sets = [keys + labels[:m] for m in range(len(labels), -1, -1)]
    g = bottom.groupingSets([[F.col(c) for c in s] for s in sets], *keys, *labels)
    return g.agg(F.sum(value).alias(name)).withColumn("series_id", H.series_id(labels))


def reconcile_bu(base: DataFrame, labels: list[str] = H.LABELS, keys: list[str] | None = None) -> DataFrame:
    """Bottom forecasts unchanged, aggregates are their sums."""
    keys = keys or ["date"]
    bottom = base.where(H.node_depth(labels) == len(labels))
    rec = rollup_bottom(bottom, "yhat", labels, keys).select("series_id", *keys, "yhat_rec")
    return base.join(rec, ["series_id", *keys], "left")


# --- R2: dense weights ----------------------------------------------------------------------------

def series_index(nodes_df: DataFrame) -> DataFrame:
    """Contiguous integer index per node, ordered by series_id. The node table has one
    row per series of the hierarchy (31 here, a few thousand for large hierarchies), so
    a plain ordered window is the cheapest correct plan; the dense MinT solve needs the
    whole hierarchy in one group anyway."""
    w = Window.orderBy("series_id")
    return nodes_df.select("series_id", "gid", (F.row_number().over(w) - 1).cast("int").alias("idx"))

def shrinkage_lambda(gram: DataFrame) -> DataFrame:
    """H17 from the aggregated Gram table: one row ``(lambda, n_dates)``.
    w_ij = sum e_i e_j / T, r_ij = w_ij / sqrt(w_ii w_jj), q_ij = sum e_i^2 e_j^2,
    lambda = sum_{i!=j} (q_ij/(w_ii w_jj) - T r_ij^2)/(T(T-1)) / sum_{i!=j} r_ij^2, clipped."""
    t = gram.where("i = -1").select("w_sum").scalar()
    g = gram.where("i >= 0")
    diag = g.where("i = j").select(F.col("i").alias("k"), F.col("w_sum").alias("dk"))
    off = (g.where("i < j")
           .join(diag.withColumnRenamed("k", "i").withColumnRenamed("dk", "di"), "i")
           .join(diag.withColumnRenamed("k", "j").withColumnRenamed("dk", "dj"), "j"))
    wii, wjj = F.col("di") / t, F.col("dj") / t
    r = (F.col("w_sum") / t) / F.sqrt(wii * wjj)
    v = (F.col("q_sum") / (wii * wjj) - t * r * r) / (t * (t - 1))
    s = off.agg(F.sum(v).alias("sv"), F.sum(r * r).alias("sr"))
    lam = F.greatest(F.least(F.col("sv") / F.col("sr"), F.lit(1.0)), F.lit(0.0))
    return s.select(lam.alias("lambda"), t.cast("bigint").alias("n_dates"))


def dates_in_order(resid: DataFrame, date: str = "date") -> DataFrame:
    """(date, idx): residual dates numbered from 0. One row per date of the calendar, so a plain window does."""
    return resid.select(date).distinct().select(date, (F.row_number().over(Window.orderBy(date)) - 1).cast("int").alias("idx"))


def _sum_rows(parts: DataFrame) -> DataFrame:
    """Element-wise sums of the tasks' partial rows (row, v): one group per row, one entry per task."""
    def add(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"row": [f["row"].iloc[0]], "v": [np.sum(np.vstack(f["v"]), axis=0).tolist()]})

    return parts.groupBy("row").applyInPandas(add, "row int, v array<double>")


def lambda_by_dates(resid: DataFrame, value: str = "e") -> DataFrame:
    """H17 without pairs of series: with z = e / sqrt(w_ii), the sum of r_ij^2 over all pairs is |Z'Z|^2 / T^2 and the
    sum of q_ij / (w_ii w_jj) is, per date, (sum_i z_i^2)^2, both less their diagonal. Z'Z has one row per date."""
    resid = resid.select("series_id", "date", F.col(value).cast("double").alias("e"))
    dates = cut_lineage(dates_in_order(resid))
    t = dates.count()
    whole = resid.groupBy("series_id").agg((F.sum(F.col("e") * F.col("e")) / t).alias("w")).where("w > 0")      # P20
    z = resid.join(dates, "date").join(whole, "series_id").select("series_id", "idx", (F.col("e") / F.sqrt("w")).alias("z"))
    rows = cut_lineage(z.groupBy("series_id").agg(F.collect_list("idx").alias("ix"), F.collect_list("z").alias("z")))

    def partial(frames):
        cross, square, fourth, n = np.zeros((t, t)), np.zeros(t), 0.0, 0
        for f in frames:
            m = _matrix(f["ix"], f["z"], t)
            cross += m.T @ m
            square += (m ** 2).sum(axis=0)
            fourth += float((m ** 4).sum())
            n += len(m)
        if n:
            yield pd.DataFrame({"row": [*range(t), t, t + 1], "v": [*cross.tolist(), square.tolist(), [fourth, float(n)]]})

    ship_package(resid.sparkSession)
    sums = _sum_rows(rows.coalesce(H.GRAM_TASKS).mapInPandas(partial, "row int, v array<double>"))
    add_squares = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)
    one = sums.agg(F.sum(F.when(F.col("row") < t, add_squares)).alias("cross"), F.sum(F.when(F.col("row") == t, add_squares)).alias("dated"),
                   F.max(F.when(F.col("row") == t + 1, F.get("v", F.lit(0)))).alias("fourth"),
                   F.max(F.when(F.col("row") == t + 1, F.get("v", F.lit(1)))).alias("n"))
    sr = F.col("cross") / (t * t) - F.col("n")
    sv = ((F.col("dated") - F.col("fourth")) - t * sr) / (t * (t - 1)) if t > 1 else F.lit(0.0)
    return one.select(F.greatest(F.least(sv / sr, F.lit(1.0)), F.lit(0.0)).alias("lambda"), F.lit(t).cast("bigint").alias("n_dates"))


def _matrix(ix: pd.Series, values: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(ix), width))
    for r, (i, v) in enumerate(zip(ix, values)):
        out[r, np.asarray(i, dtype=int)] = np.asarray(v, dtype=float)
    return out


def reconcile_mint(base: DataFrame, resid: DataFrame, method: str, labels: list[str] = H.LABELS,
                   keys: list[str] | None = None) -> DataFrame:
    """``base`` (labels, series_id, keys, yhat) reconciled under W of ``method``; ``resid`` has the label
    columns, series_id, date and e, one row per series and residual date. Series whose residuals are all zero
    have no weight (P20) and are handled as in ``reconcile_tree``."""
    check_method(method)
    keys = keys or ["date"]
    spark = base.sparkSession
    ship_package(spark)
    resid = resid.select("series_id", *labels, "date", F.col("e").cast("double").alias("e"))
    if method == "MinTSh":
        lam = float(lambda_by_dates(resid).first()["lambda"] or 0.0)       # one row
    else:
        lam = 0.0
    lam = min(max(lam, SAMPLE_SHARE), 1.0)
    dates = cut_lineage(dates_in_order(resid))
    t = dates.count()
    weights = cut_lineage(resid.groupBy("series_id").agg((F.sum(F.col("e") * F.col("e")) / t * lam).alias("w")).where("w > 0"))
    first = cut_lineage(reconcile_tree(base, weights, labels, keys))
    if lam >= 1.0 or t == 0:
        return first
    # P B: every residual date is a vector to reconcile; then one row per series with its dates as arrays
    moved = reconcile_tree(resid.withColumnRenamed("e", "yhat"), weights, labels, ["date"])
    factor = float(np.sqrt((1.0 - lam) / t))
    rows = moved.join(dates, "date").groupBy("series_id").agg(
        F.collect_list("idx").alias("ix"), F.collect_list(F.coalesce("yhat_rec", "yhat") * factor).alias("pb"),
        F.collect_list(F.coalesce(F.col("yhat") - F.col("yhat_rec"), F.lit(0.0)) * factor).alias("rb"))
    rows = cut_lineage(rows.join(weights, "series_id", "left"))
    horizon = cut_lineage(first.select(*keys).distinct().withColumn("h", F.xxhash64(*keys)))
    ahead = first.where("yhat_rec is not null").withColumn("h", F.xxhash64(*keys))
    ry = ahead.groupBy("series_id").agg(F.collect_list("h").alias("h"), F.collect_list(F.col("yhat") - F.col("yhat_rec")).alias("ry"))
    both = cut_lineage(rows.where("w is not null").join(ry, "series_id").select("ix", "rb", "w", "h", "ry"))

    def partial(frames):
        system, right, n = np.zeros((t, t)), {}, 0
        for f in frames:
            m = _matrix(f["ix"], f["rb"], t)
            scaled = m / f["w"].to_numpy()[:, None]
            system += scaled.T @ m
            n += len(f)
            names, place = np.unique(np.concatenate([np.asarray(h) for h in f["h"]]), return_inverse=True)
            y = np.zeros((len(f), len(names)))
            y[np.repeat(np.arange(len(f)), [len(h) for h in f["h"]]), place] = np.concatenate([np.asarray(v, dtype=float) for v in f["ry"]])
            for name, v in zip(names.tolist(), (scaled.T @ y).T):
                right[name] = right.get(name, 0.0) + v
        if n:
            yield pd.DataFrame({"kind": 0, "h": np.arange(t), "v": system.tolist()})
            for part in np.array_split(np.array(list(right)), max(1, len(right) // 1024)):
                yield pd.DataFrame({"kind": 1, "h": part, "v": [right[x].tolist() for x in part.tolist()]})

    def add(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"kind": [f["kind"].iloc[0]], "h": [f["h"].iloc[0]], "v": [np.sum(np.vstack(f["v"]), axis=0).tolist()]})

    sums = both.coalesce(H.GRAM_TASKS).mapInPandas(partial, "kind int, h long, v array<double>")
    sums = sums.groupBy("kind", "h").applyInPandas(add, "kind int, h long, v array<double>")

    def answer(f: pd.DataFrame) -> pd.DataFrame:
        """The T x T system, as large as the calendar, for all horizon dates at once."""
        system = np.vstack(f[f["kind"] == 0].sort_values("h")["v"]) + np.eye(t)
        right = f[f["kind"] == 1]
        a = np.linalg.solve(system, np.vstack(right["v"]).T).T if len(right) else np.zeros((0, t))
        return pd.DataFrame({"h": right["h"], "a": list(a)})

    shares = cut_lineage(sums.groupBy(F.lit(0).alias("g")).applyInPandas(answer, "h long, a array<double>"))
    # blocks of horizon dates meet blocks of series; a row carries arrays as long as the calendar
    block = F.pmod("h", F.lit(8))
    packs = shares.groupBy(block.alias("block")).agg(F.collect_list("h").alias("hs"), F.collect_list("a").alias("as"))
    spread = rows.select("series_id", "ix", "pb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("block"))

    def subtract(frames):
        for f in frames:
            for _, g in f.groupby("block"):
                m = _matrix(g["ix"], g["pb"], t)
                hs, a = np.asarray(g["hs"].iloc[0]), np.vstack(g["as"].iloc[0])
                shift = m @ a.T
                yield pd.DataFrame({"series_id": np.repeat(g["series_id"].to_numpy(), len(hs)), "h": np.tile(hs, len(g)), "shift": shift.ravel()})

    shift = spread.join(packs, "block").mapInPandas(subtract, "series_id string, h long, shift double")
    named = horizon.join(shift, "h").drop("h")
    return first.join(named, ["series_id", *keys], "left").withColumn(
        "yhat_rec", F.col("yhat_rec") - F.coalesce("shift", F.lit(0.0))).drop("shift")
