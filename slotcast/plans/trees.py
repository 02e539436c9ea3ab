"""Queries of the vector-leaf boosted trees (M5-M7, M18, M19, M23, H5, H8, H10): one run fits the models of every
hierarchy level, or of every target."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.timecols import level_time_columns
from ..operators import boost, clean, metrics, splits
from ..operators import hierarchy as H
from ..session import cut_lineage
from ..sources import adapters
from . import hier
from . import learn as L
from .registry import query

SHIFT = adapters.CALENDAR_SHIFT_YEARS
LEVEL_FEATURES = ["store", "year", "month", "week", "weekday", "day", "phase_a", "phase_b", "holiday"]
LEVEL_PARAMS = boost.Params(trees=10, depth=4, rate=0.3, subsample=0.8, colsample=0.8)
EVAL_PARAMS = boost.Params(trees=10, depth=5, rate=0.1, subsample=0.8, colsample=0.8)


# --- H5, H8, H10: per-level models --------------------------------------------------------------------------------

def level_rows(spark, sf_dir):
    """(level, date, store_id, features, y0...): one model per level. The bottom level's model has one target per
    category; the others have one, and zeros that no split can gain from. Also the categories, in order."""
    grid = cut_lineage(H.bottom_grid(adapters.daily_sales_long(spark, sf_dir), "items"))
    cats = [r[0] for r in grid.select("category").distinct().orderBy("category").collect()]        # as many as targets
    sums = [F.sum(F.when(F.col("category") == c, F.col("items")).otherwise(0)).cast("double").alias(f"y{i}") for i, c in enumerate(cats)]
    bottom = grid.groupBy("date", "store_id").agg(*sums)
    rest = [F.lit(0.0).alias(f"y{i}") for i in range(1, len(cats))]
    total = F.sum("items").cast("double").alias("y0")
    rows = bottom.withColumn("level", F.lit("store_id_category"))
    rows = rows.unionByName(grid.groupBy("date", "store_id").agg(total).select("*", *rest, F.lit("store_id").alias("level")))
    rows = rows.unionByName(grid.groupBy("date").agg(total).select("*", *rest, F.lit(None).cast("int").alias("store_id"), F.lit("total").alias("level")))
    day = F.add_months("date", 12 * SHIFT)
    rows = rows.withColumns({"store": F.coalesce("store_id", F.lit(-1)), "year": F.year(day), "month": F.month(day), "week": F.weekofyear(day),
                             "weekday": F.weekday(day), "day": F.dayofmonth(day), "phase_a": cal.phase_rule_a(day),
                             "phase_b": cal.phase_rule_b(day), "holiday": cal.holiday_flag(day)})
    return cut_lineage(rows), cats


def _targets(cats):
    return [F.col(f"y{i}") for i in range(len(cats))]


def _root_sql() -> str:
    from . import sqlparts as S
    shifted = f"CAST(date + INTERVAL {SHIFT} YEAR AS DATE)"
    phase_a = ("CASE WHEN (month(d) = 12 AND day(d) >= 22) OR (month(d) = 1 AND day(d) <= 2) THEN 0 "
               "WHEN d BETWEEN DATE '2024-07-31' AND DATE '2024-09-15' THEN 0 "
               "WHEN month(d) >= 10 OR month(d) <= 3 THEN 1 WHEN month(d) BETWEEN 4 AND 7 THEN 2 ELSE 0 END")
    phase_b = ("CASE WHEN d BETWEEN DATE '2024-10-01' AND DATE '2025-03-31' THEN 1 "
               "WHEN d BETWEEN DATE '2025-04-01' AND DATE '2025-09-30' THEN 2 ELSE 0 END")
    values = {"store": "coalesce(store_id, -1)", "year": "year(d)", "month": "month(d)", "week": "week(d)", "weekday": "isodow(d) - 1",
              "day": "day(d)", "phase_a": phase_a, "phase_b": phase_b, "holiday": f"CAST(d IN ({S.holiday_in_list()}) AS INTEGER)"}
    per_feature = " UNION ALL ".join(f"SELECT level, '{f}' AS feature, CAST({v} AS DOUBLE) AS x, target, y FROM fr" for f, v in values.items())
    return (hier._with(*hier.LEVEL_CTES[:6],
                       f"fr AS (SELECT CASE gid WHEN 0 THEN 'store_id_category' WHEN 1 THEN 'store_id' ELSE 'total' END AS level, store_id, "
                       f"coalesce(category, '') AS target, CAST(y AS DOUBLE) AS y, {shifted} AS d FROM lv)",
                       "mu AS (SELECT level, target, avg(y) AS m FROM fr GROUP BY ALL)",
                       f"ft AS (SELECT f.*, m - y AS g FROM ({per_feature}) f JOIN mu USING (level, target))",
                       "hs AS (SELECT level, feature, x, target, sum(g) AS g, count(*) AS w FROM ft GROUP BY ALL)",
                       "cu AS (SELECT *, sum(g) OVER p AS gl, CAST(sum(w) OVER p AS DOUBLE) AS wl, sum(g) OVER q AS ga, CAST(sum(w) OVER q AS DOUBLE) AS wa FROM hs "
                       "WINDOW p AS (PARTITION BY level, feature, target ORDER BY x), q AS (PARTITION BY level, feature, target))",
                       "ga AS (SELECT level, feature, x, max(wl) AS wl, max(wa) AS wa, sum(gl * gl / (wl + 1) + (ga - gl) * (ga - gl) / (wa - wl + 1) "
                       "- ga * ga / (wa + 1)) AS gain FROM cu WHERE wa - wl >= 1 GROUP BY ALL)")
            + "SELECT level, feature, round(arg_max(x, gain), 6) AS split_value, round(max(gain), 3) AS gain, "
              "CAST(arg_max(wl, gain) AS BIGINT) AS n_left FROM ga GROUP BY level, feature")


@query("tree_root_splits", "M5 H5", _root_sql())
def tree_root_splits(spark, sf_dir):
    """Every level's and feature's best first split over all rows (features with one value have none)."""
    rows, cats = level_rows(spark, sf_dir)
    edges = boost.bin_edges(rows, LEVEL_FEATURES)
    params = boost.Params(trees=1, depth=1)
    c = boost.training_rows(rows, F.col("level"), LEVEL_FEATURES, _targets(cats), edges).withColumn("id", F.lit(0).cast("long"))
    models = boost.fit(c.drop("id"), len(LEVEL_FEATURES), boost.MAX_BINS, boost.Params(trees=0))
    import numpy as np
    empty = {m: boost.Tree(np.full(3, -1), np.zeros(3, dtype=np.int64), np.zeros((3, len(cats))), np.zeros(3)) for m in models}
    if not models:
        return spark.createDataFrame([], "level string, feature string, split_value double, gain double, n_left bigint")
    found = boost.histograms(c, models, empty, params, 0, 0, boost.MAX_BINS, len(LEVEL_FEATURES)).where("gain > double('-infinity')")
    values = F.array(*[F.array(*[F.lit(float(v)) for v in edges[f]]).cast("array<double>") for f in LEVEL_FEATURES])
    names = F.array(*[F.lit(f) for f in LEVEL_FEATURES])
    return found.select(F.col("model").alias("level"), F.get(names, F.col("feature")).alias("feature"),
                        F.round(F.get(F.get(values, F.col("feature")), F.col("bin")), 6).alias("split_value"),
                        F.round("gain", 3).alias("gain"), F.element_at("left", -1).cast("bigint").alias("n_left"))


def tree_fitted(spark, sf_dir, params: boost.Params = LEVEL_PARAMS):
    """Base forecasts of every level from one run: fitted on the sampled half of the dates (O5), predicted for all of
    them, cleaned (P19). The columns of ``hier.levels`` and yhat."""
    rows, cats = level_rows(spark, sf_dir)
    dates = cut_lineage(splits.sample_dates(rows, 0.5, hier.SEED))
    edges = boost.bin_edges(rows, LEVEL_FEATURES)
    train = rows.join(dates, "date", "left_semi")
    c = boost.training_rows(train, F.col("level"), LEVEL_FEATURES, _targets(cats), edges)
    models = boost.fit(c, len(LEVEL_FEATURES), boost.MAX_BINS, params)
    asked = rows.select(F.col("level").alias("model"), "date", "store_id", boost.with_bins(rows, LEVEL_FEATURES, edges).alias("bins"))
    pred = boost.predict(asked, models, params, ["model", "date", "store_id"])
    one = F.when(F.col("model") == "store_id_category", F.arrays_zip(F.array(*[F.lit(x) for x in cats]).alias("category"), F.col("pred").alias("yhat"))) \
           .otherwise(F.array(F.struct(F.lit(None).cast("string").alias("category"), F.get("pred", F.lit(0)).alias("yhat"))))
    flat = pred.select("model", "date", "store_id", F.explode(one).alias("p")).select(
        F.col("model").alias("level"), "date", "store_id", "p.category",
        clean.post_process_predictions(F.round("p.yhat", 9)).alias("yhat"))
    flat = flat.withColumn("series_id", H.series_id(H.LABELS)).select("series_id", "date", "yhat")
    return hier.levels(spark, sf_dir).join(flat, ["series_id", "date"])


@query("tree_level_forecasts", "H5 H8 H10 M5 M6 P19")
def tree_level_forecasts(spark, sf_dir):
    _, _, _, hz = hier.parts(spark, sf_dir, tree_fitted)
    return hz.select("series_id", "level", "date", "y", "yhat")


@query("reconcile_tree_mint", "H10 H16 H5 R2")
def reconcile_tree_mint(spark, sf_dir):
    return hier._out(hier.reconciled(spark, sf_dir, "MinTSh", hier.Context(spark, sf_dir, tree_fitted)))


# --- M5-M7, M19, M23: one model for all targets, or one per target -----------------------------------------------

def evaluated(spark, sf_dir, strategy: str, params: boost.Params = EVAL_PARAMS):
    """(models, features, targets, scored rows (store_id, target, y, yhat)). ``multi``: one model with a leaf value per
    target; ``single``: a model per target, all in one run (M19, M23)."""
    if strategy not in ("multi", "single"):
        raise ValueError(f"unknown strategy {strategy!r}")
    frame = cut_lineage(L.gbt_frame(spark, sf_dir))
    feats = ["store_id"] + level_time_columns("interval") + cal.LEVEL_CALENDAR["interval"]
    train, test = L.gbt_split(frame)
    targets = L.gbt_targets(spark, sf_dir, frame)
    edges = boost.bin_edges(train, feats)
    if strategy == "multi":
        c = boost.training_rows(train, F.lit("all"), feats, [F.col(t) for t in targets], edges)
        asked = test.withColumn("model", F.lit("all"))
    else:
        each = F.explode(F.array(*[F.struct(F.lit(t).alias("model"), F.col(t).cast("double").alias("value")) for t in targets])).alias("s")
        c = boost.training_rows(train.select("*", each), F.col("s.model"), feats, [F.col("s.value")], edges)
        asked = test.select("*", each).withColumn("model", F.col("s.model"))
    models = boost.fit(c, len(feats), boost.MAX_BINS, params)
    asked = asked.withColumn("bins", boost.with_bins(test, feats, edges))
    keep = ["store_id", "model", *targets]
    pred = boost.predict(asked, models, params, keep)
    if strategy == "multi":
        rows = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("y"), F.get("pred", F.lit(i)).alias("yhat"))
                                   for i, t in enumerate(targets)])).alias("r")
        scored = pred.select("store_id", rows).select("store_id", "r.*")
    else:
        actual = F.create_map(*[x for t in targets for x in (F.lit(t), F.col(t).cast("double"))])
        scored = pred.select("store_id", F.col("model").alias("target"), actual[F.col("model")].alias("y"), F.get("pred", F.lit(0)).alias("yhat"))
    return models, feats, targets, scored


@query("multi_tree_eval", "M5 M6 M18 M19 M23 A12 A13")
def multi_tree_eval(spark, sf_dir):
    """Metrics per target and store, per target, and over targets (uniform average) of both strategies."""
    out = None
    for strategy in ("multi", "single"):
        scored = cut_lineage(evaluated(spark, sf_dir, strategy)[3])
        per = metrics.per_target(scored, ["target", "store_id"])
        total = metrics.with_uniform_total(metrics.per_target(scored, ["target"]), "target")
        both = per.unionByName(total.withColumn("store_id", F.lit(None).cast("int")).select(*per.columns)).withColumn("strategy", F.lit(strategy))
        out = both if out is None else out.unionByName(both)
    return metrics.round6(out, ["mae", "mse", "rmse"])


@query("multi_tree_importance", "M7")
def multi_tree_importance(spark, sf_dir):
    models, feats, _, _ = evaluated(spark, sf_dir, "multi")
    rows = [(m, f, round(v, 6)) for m, f, v in boost.importances(models, feats)]     # models x features
    return spark.createDataFrame(rows, "model string, feature string, importance double")
