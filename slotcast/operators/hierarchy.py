"""Hierarchy of series (H1-H10, J9, A20, P20) in long form.

Nodes come from ``GROUPING SETS`` over a label prefix (total -> store -> store x
category); ``grouping_id`` names the level (Q20/Q21 avoided: no row positions). The
summing matrix is kept in coordinate form (node, bottom) and is produced by letting
every bottom series emit its own ancestors (depth + 1 rows each), so no join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package

LABELS = ["store_id", "category"]
OFFSETS = {0: 1.0, 1: 2.0, 3: 4.0}      # level-dependent offset of the test forecast
LAG_DAYS = 7
GRAM_TASKS = 64


def level_name(labels: list[str]) -> Column:
    gid = F.col("gid")
    names = {0: "_".join(labels)}
    for m in range(len(labels) - 1, -1, -1):
        names[(1 << (len(labels) - m)) - 1] = "_".join(labels[:m]) or "total"
    expr = None
    for g, n in names.items():
        expr = F.when(gid == g, n) if expr is None else expr.when(gid == g, n)
    return expr


def series_id(labels: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("*")) for c in labels])


def node_depth(labels: list[str]) -> Column:
    """Number of non-null labels (0 = root)."""
    return sum((F.col(c).isNotNull().cast("int") for c in labels), F.lit(0))


def bottom_grid(df: DataFrame, value: str, labels: list[str] = LABELS, date: str = "date") -> DataFrame:
    """Every bottom series on every day between the global first and last date, 0-filled. The series stay a
    distributed table; the first and last date are one scalar, and every series explodes its own days."""
    span = df.select(F.struct(F.min(date).alias("d0"), F.max(date).alias("d1"))).scalar()
    bottoms = df.select(*labels).distinct()
    g = bottoms.select(F.explode(F.sequence(span["d0"], span["d1"])).alias(date), *labels)
    return g.join(df.select(date, *labels, value), [date, *labels], "left") \
            .withColumn(value, F.coalesce(F.col(value), F.lit(0)).cast("bigint"))


def all_levels(bottom: DataFrame, value: str, labels: list[str] = LABELS, date: str = "date") -> DataFrame:
    """H1: actuals of every node per date with ``GROUPING SETS`` (one Expand + one
    partially aggregated hash aggregate)."""
    sets = [[date] + labels[:m] for m in range(len(labels), -1, -1)]
    g = bottom.groupingSets([[F.col(c) for c in s] for s in sets], date, *labels)
    k = len(labels)
    gid = sum((F.grouping(c).cast("int") * (1 << (k - 1 - i)) for i, c in enumerate(labels)), F.lit(0))
    out = g.agg(F.sum(value).cast("bigint").alias("y"), gid.alias("gid"))
    return out.withColumns({"series_id": series_id(labels), "level": level_name(labels),
                            "gid": F.col("gid").cast("int")})


def with_lag(levels: DataFrame, date: str = "date", days: int = LAG_DAYS) -> DataFrame:
    """Adds ``x``, the value ``days`` rows (= days, series are dense) earlier; rows without one are left out."""
    w = Window.partitionBy("series_id").orderBy(date)
    return levels.withColumn("x", F.lag("y", days).over(w)).where(F.col("x").isNotNull())


def fit_lag_model(lagged: DataFrame, fit_dates: DataFrame, date: str = "date") -> DataFrame:
    """H5/H8: one linear model of ``y`` on ``x`` per series, fitted on ``fit_dates`` for all series of all
    levels in one partial aggregation, predictions for every date cleaned by P19. A series whose
    ``x`` does not vary predicts its mean."""
    from .clean import post_process_predictions

    varies = F.var_pop("x") > 0
    models = lagged.join(fit_dates, date, "left_semi").groupBy("series_id").agg(
        F.when(varies, F.regr_slope("y", "x")).otherwise(F.lit(0.0)).alias("_b"),
        F.when(varies, F.regr_intercept("y", "x")).otherwise(F.avg("y")).alias("_a"))
    yhat = post_process_predictions(F.round(F.col("_a") + F.col("_b") * F.col("x"), 9))
    return lagged.join(models, "series_id").withColumn("yhat", yhat).drop("x", "_a", "_b")


def base_forecast(levels: DataFrame, date: str = "date") -> DataFrame:
    """Test base forecast: the value ``LAG_DAYS`` earlier plus a level-dependent offset so
    levels disagree (series are dense, so a row lag is a day lag)."""
    w = Window.partitionBy("series_id").orderBy(date)
    off = F.lit(0.0)
    for g, o in OFFSETS.items():
        off = F.when(F.col("gid") == g, o).otherwise(off)
    return levels.withColumn("yhat", F.lag("y", LAG_DAYS).over(w).cast("double") + off) \
                 .where(F.col("yhat").isNotNull())


def nodes(levels: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """H1/H3/H4: one row per node with its level and number of leaves below it."""
    n = levels.select("series_id", "gid", "level", *labels).distinct()
    leaves = n.where(F.col("gid") == 0)
    counts = None
    for m in range(len(labels) + 1):
        keys = labels[:m]
        c = leaves.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_leaves")).withColumn("_d", F.lit(m))
        for k in labels[m:]:
            c = c.withColumn(k, F.lit(None).cast(n.schema[k].dataType))
        counts = c if counts is None else counts.unionByName(c)
    return _attach_leaves(n.withColumn("_d", node_depth(labels)), counts, labels)


def _attach_leaves(n: DataFrame, counts: DataFrame, labels: list[str]) -> DataFrame:
    cond = [n["_d"] == counts["_d"]] + [n[c].eqNullSafe(counts[c]) for c in labels]
    return n.join(counts, cond, "left").select(*[n[c] for c in n.columns if c != "_d"],
                                                counts["n_leaves"].cast("bigint").alias("n_leaves"))


def summing_edges(nodes_df: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """(series_id, bottom_id) for every node and every bottom below it. Each
    bottom emits its ancestors: the node with its first m labels kept, m = 0..depth."""
    leaves = nodes_df.where(F.col("gid") == 0).select(F.col("series_id").alias("bottom_id"), *labels)
    anc = []
    for m in range(len(labels) + 1):
        anc.append(F.concat_ws("|", *[F.col(c).cast("string") for c in labels[:m]],
                               *[F.lit("*") for _ in labels[m:]]))
    return leaves.select(F.explode(F.array(*anc)).alias("series_id"), "bottom_id")


def partial_gram(resid: DataFrame, index: DataFrame, date: str = "date", value: str = "e") -> DataFrame:
    """A20 + H17 inputs without emitting series pairs per date: residuals are grouped into
    one vector per date (length = number of series), then every task computes E'E and
    (E*E)'(E*E) for its block of dates with numpy and emits each (i <= j) partial sum
    once; a final aggregation adds the partials. Output ``(i, j, w_sum, q_sum)`` plus
    the date count as ``(i=-1, j=-1)``."""
    import numpy as np
    import pandas as pd

    n = index.agg(F.max("idx")).scalar()
    vec = (resid.join(index, "series_id")
           .groupBy(date)
           .agg(F.sort_array(F.collect_list(F.struct("idx", value))).alias("_v")))
    vec = vec.select(F.transform("_v", lambda s: s[value]).alias("v"),
                     F.transform("_v", lambda s: s["idx"]).alias("ix"))
    # every task returns n^2 / 2 sums, so the number of tasks is bounded too
    ncol = vec.select(n.alias("n"), "v", "ix").coalesce(GRAM_TASKS)

    def gram(it):
        acc_w = acc_q = None
        cnt = 0
        size = None
        for pdf in it:
            if pdf.empty:
                continue
            size = int(pdf["n"].iloc[0]) + 1
            mat = np.zeros((len(pdf), size))
            for r, (v, ix) in enumerate(zip(pdf["v"], pdf["ix"])):
                mat[r, np.asarray(ix, dtype=int)] = np.asarray(v, dtype=float)
            sq = mat * mat
            w, q = mat.T @ mat, sq.T @ sq
            acc_w = w if acc_w is None else acc_w + w
            acc_q = q if acc_q is None else acc_q + q
            cnt += len(pdf)
        if acc_w is None:
            return
        iu, ju = np.triu_indices(size)
        yield pd.DataFrame({"i": iu.astype("int32"), "j": ju.astype("int32"),
                            "w_sum": acc_w[iu, ju], "q_sum": acc_q[iu, ju]})
        yield pd.DataFrame({"i": [-1], "j": [-1], "w_sum": [float(cnt)], "q_sum": [float(cnt)]})

    ship_package(resid.sparkSession)
    parts = ncol.mapInPandas(gram, "i int, j int, w_sum double, q_sum double")
    return parts.groupBy("i", "j").agg(F.sum("w_sum").alias("w_sum"), F.sum("q_sum").alias("q_sum"))
