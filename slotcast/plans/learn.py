"""Imputation, model fitting / evaluation and parameter search queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.timecols import level_time_columns
from ..operators import clean, impute, learn, metrics, splits
from ..session import cut_lineage
from ..sources import adapters, dims
from . import daily as D
from . import slots as SL
from . import sqlparts as S
from .registry import query

CATS = dims.CATEGORIES
LATE = dims.LATE_CATEGORIES


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- M1 with k = 1 (oracle: regr_slope / regr_intercept) ----------------------------------------------

def _impute_top1_sql() -> str:
    cand = [c for c in CATS if c not in LATE]
    cut = " UNION ALL ".join(
        f"SELECT store_id, '{t}' AS target, min(CASE WHEN {t} <> 0 THEN datetime END) AS first_sold FROM fixture GROUP BY store_id"
        for t in LATE)
    ycase = "CASE c.target " + " ".join(f"WHEN '{t}' THEN CAST(f.{t} AS DOUBLE)" for t in LATE) + " END"
    late_sum = " + ".join(LATE)
    tr_cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c != "OTHER" else f"CAST(OTHER + {late_sum} AS DOUBLE) AS OTHER"
                        for c in cand)
    cr = " UNION ALL ".join(f"SELECT store_id, target, '{c}' AS predictor, corr(y, {c}) AS corr, "
                            f"regr_slope(y, {c}) AS slope, regr_intercept(y, {c}) AS icpt FROM tr GROUP BY store_id, target"
                            for c in cand)
    xcase = "CASE b.predictor " + " ".join(f"WHEN '{c}' THEN CAST(lg.{c} AS DOUBLE)" for c in cand) + " END"
    return (_with(S.wide_cte(), S.open_cte(), S.late_fixture_cte(), f"cut AS ({cut})",
                  f"lg AS (SELECT f.*, c.target, c.first_sold, {ycase} AS y FROM fixture f JOIN cut c ON f.store_id = c.store_id)",
                  f"tr AS (SELECT store_id, target, y, {tr_cols} FROM lg WHERE datetime >= first_sold)",
                  f"cr AS ({cr})",
                  "b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store_id, target ORDER BY corr DESC, predictor) AS rk "
                  "FROM cr WHERE corr IS NOT NULL AND NOT isnan(corr)) WHERE rk = 1)")
            + f"SELECT lg.store_id, lg.datetime, lg.target, b.predictor, "
              f"CAST(greatest(round_even(b.icpt + b.slope * {xcase}, 0), 0) AS BIGINT) AS imputed "
              "FROM lg JOIN b ON lg.store_id = b.store_id AND lg.target = b.target WHERE lg.datetime < lg.first_sold")


@query("impute_top1", "M1 P10 P12 P13 O3 A8", _impute_top1_sql())
def impute_top1(spark, sf_dir):
    wide = SL.fixture(spark, sf_dir)
    cuts = clean.first_time_sold(wide, LATE).withColumnRenamed("category", "target")
    long = impute._long_by_target(wide, LATE).join(cuts, ["store_id", "target"], "inner")
    after = F.col("datetime") >= F.col("first_sold")
    train = long.where(after).withColumn("OTHER", F.col("OTHER") + sum(F.col(t) for t in LATE))
    cand = impute.candidates_for(wide, LATE, LATE, include_total=False)
    masks = impute.top_predictors(train, cand, 1, ["store_id", "target"])
    stats = learn.normal_equations(train, ["store_id", "target"], cand, "y").join(
        masks.select("store_id", "target", "mask"), ["store_id", "target"])
    coefs = learn.solve_groups(stats, ["store_id", "target"], cand, mask_col="mask")
    scored = learn.predict(long.where(~after), coefs, ["store_id", "target"], cand, name="pred")
    scored = scored.join(masks.select("store_id", "target", F.col("_chosen")[0].alias("predictor")), ["store_id", "target"])
    return scored.select("store_id", "datetime", "target", "predictor",
                         clean.clip_imputed("pred").cast("bigint").alias("imputed"))


@query("impute_top7_variant_a", "M1 M3 P5 P7 P4 Q1 Q2")
def impute_top7_variant_a(spark, sf_dir):
    return impute.impute_variant_a(SL.fixture(spark, sf_dir), LATE, k=7)


@query("impute_variant_b", "M2 M4 P6 P8 O4 Q32")
def impute_variant_b(spark, sf_dir):
    return impute.impute_variant_b(SL.fixture(spark, sf_dir), LATE, k=6)


# --- M5-M7: gradient-boosted trees on the interval-level model frame ---------------------------------

GBT_TRAIN_PERCENT = 70
GBT_PARAMS = dict(max_iter=10, max_depth=5, step_size=0.1, subsampling=0.8)


def gbt_frame(spark, sf_dir):
    """Interval model frame (M27): time keys, calendar keys, store id, targets."""
    return SL._make_rollup("interval")(spark, sf_dir)


def gbt_split(frame):
    """The first ``GBT_TRAIN_PERCENT`` of the data's days train, the rest test."""
    b = frame.agg(F.min("date").alias("d0"), F.max("date").alias("d1")).first()
    cut = F.date_add(F.lit(b["d0"]).cast("date"), 1 + (b["d1"] - b["d0"]).days * GBT_TRAIN_PERCENT // 100) if b["d0"] else F.lit(None).cast("date")
    return frame.where(F.col("date") < cut), frame.where(F.col("date") >= cut)


def gbt_targets(spark, sf_dir, frame):
    """Targets = categories with any sale (P2: all-zero columns are dropped)."""
    prof = clean.zero_column_profile(frame, CATS).where("kept").select("column_name")
    return [r[0] for r in prof.collect()]          # one row per category (schema-sized)


def gbt_runs(spark, sf_dir):
    """One GBT per target (Spark trees are single-output). The model frame is written once
    (every boosting iteration reads it), and the per-target fits are submitted from a
    thread pool so their Spark jobs share the cluster instead of running one by one."""
    from concurrent.futures import ThreadPoolExecutor

    frame = cut_lineage(gbt_frame(spark, sf_dir).withColumn("store_id", F.col("store_id").cast("double")))
    feats = ["store_id"] + level_time_columns("interval") + cal.LEVEL_CALENDAR["interval"]
    train, test = gbt_split(frame)
    targets = gbt_targets(spark, sf_dir, frame)
    with ThreadPoolExecutor(max_workers=max(1, len(targets))) as pool:
        models = list(pool.map(lambda t: learn.fit_gbt(train, feats, t, **GBT_PARAMS), targets))
    return feats, [(t, m, m.transform(test)) for t, m in zip(targets, models)]


@query("gbt_eval", "M5 M6 M7 M18 M19 A12 A13")
def gbt_eval(spark, sf_dir):
    _, runs = gbt_runs(spark, sf_dir)
    parts = []
    for t, _, pred in runs:
        parts.append(pred.select(F.lit(t).alias("target"), F.col("store_id").cast("int").alias("store_id"),
                                 F.col(t).cast("double").alias("y"), F.col(f"pred_{t}").alias("yhat")))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    per = metrics.per_target(long, ["target", "store_id"])
    tot = metrics.with_uniform_total(metrics.per_target(long, ["target"]), "target")
    out = per.unionByName(tot.withColumn("store_id", F.lit(None).cast("int")).select(*per.columns))
    return metrics.round6(out, ["mae", "mse", "rmse"])


@query("gbt_importance", "M7 S11")
def gbt_importance(spark, sf_dir):
    feats, runs = gbt_runs(spark, sf_dir)
    rows = [(t, f, round(v, 6)) for t, model, _ in runs for f, v in learn.importances(model, feats)]
    return spark.createDataFrame(rows, "target string, feature string, importance double")


# --- M21-M24, A16: parameter grid evaluated on the data --------------------------------------------------

GRID_WINDOWS = [3, 7, 14, 28]


def _grid_sql() -> str:
    parts = []
    for w in GRID_WINDOWS:
        parts.append(
            f"SELECT {w} AS window_days, ser.date, ser.y, avg(y) OVER w AS yhat, count(y) OVER w AS c FROM ser "
            f"WINDOW w AS (PARTITION BY store_id, category ORDER BY date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)")
    return (_with(*D.SERIES_SQL[:4],
                  "rk AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS rank, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM ser))",
                  "q AS (SELECT date, CAST((n - rank - 1) // (n // 6) + 1 AS INTEGER) AS j FROM rk)",
                  "ft AS (SELECT 5 - j AS fold, date FROM q WHERE j BETWEEN 1 AND 5)",
                  "runs AS (" + " UNION ALL ".join(parts) + ")",
                  "pf AS (SELECT window_days, ft.fold, avg(abs(y - yhat)) AS mae FROM runs JOIN ft ON runs.date = ft.date "
                  "WHERE runs.c = window_days GROUP BY window_days, ft.fold)",
                  "s AS (SELECT window_days, avg(mae) AS mean_mae, stddev_pop(mae) AS std_mae FROM pf GROUP BY window_days)")
            + "SELECT window_days, round(mean_mae, 6) AS mean_mae, round(std_mae, 6) AS std_mae, "
              "window_days = (SELECT arg_min(window_days, mean_mae) FROM s) AS is_best FROM s")


@query("best_run", "M21 M23 M24 A15 A16 M17", _grid_sql())
def best_run(spark, sf_dir):
    """Grid of naive-forecast windows evaluated by expanding 5-fold CV on the data; mean
    and population std of fold MAE per run, and the argmin (``min_by``)."""
    ser = D.series_daily(spark, sf_dir)
    folds = splits.expanding_folds(ser, 5).where("role = 'test'").select("fold", "date")
    # all windows share one partitioning and order, so one sort serves them; then one row per run
    base = Window.partitionBy("store_id", "category").orderBy("date")
    wide = ser.select("date", "y", *[F.struct(F.lit(wd).alias("window_days"), F.avg("y").over(base.rowsBetween(-wd, -1)).alias("yhat"),
                                              F.count("y").over(base.rowsBetween(-wd, -1)).alias("c")).alias(f"w{wd}")
                                     for wd in GRID_WINDOWS])
    runs = wide.select("date", "y", F.explode(F.array(*[f"w{wd}" for wd in GRID_WINDOWS])).alias("r")) \
               .where("r.c = r.window_days").select("date", "y", "r.window_days", "r.yhat")
    per_fold = runs.join(folds, "date").groupBy("window_days", "fold").agg(metrics.mae().alias("mae"))
    s = per_fold.groupBy("window_days").agg(F.avg("mae").alias("mean_mae"), F.stddev_pop("mae").alias("std_mae"))
    best = s.agg(F.min_by("window_days", "mean_mae")).scalar()
    return s.select("window_days", F.round("mean_mae", 6).alias("mean_mae"), F.round("std_mae", 6).alias("std_mae"),
                    (F.col("window_days") == best).alias("is_best"))


# --- M17, M19, M23, M24: runs fitted on folds --------------------------------------------------------------

RUN_LAGS = (1, 7, 14, 28)       # the grid: which earlier day predicts (one linear model per store)
RUN_FOLDS = 5


def _run_ctes() -> tuple[str, ...]:
    runs = " UNION ALL ".join(f"SELECT {k} AS lag_days, store_id, date, y, lag(y, {k}) OVER (PARTITION BY store_id ORDER BY date) AS x FROM dense"
                              for k in RUN_LAGS)
    s = RUN_FOLDS
    return (*D.DENSE, f"runs AS (SELECT * FROM ({runs}) WHERE x IS NOT NULL)",
            "rk AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS rank, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM dense))",
            f"q AS (SELECT date, CAST((n - rank - 1) // (n // {s + 1}) + 1 AS INTEGER) AS j, "
            f"CAST(greatest(floor({s} - (n - rank) / (n // {s + 1})) + 1, 0) AS INTEGER) AS ft FROM rk)",
            f"tr AS (SELECT date, CAST(unnest(generate_series(ft, {s - 1})) AS INTEGER) AS fold FROM q WHERE ft <= {s - 1})",
            f"te AS (SELECT date, CAST({s} - j AS INTEGER) AS fold FROM q WHERE j BETWEEN 1 AND {s})",
            "co AS (SELECT lag_days, store_id, fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM runs JOIN tr USING (date) GROUP BY ALL)",
            "pr AS (SELECT r.lag_days, r.store_id, te.fold, r.y, co.a + co.b * r.x AS yhat FROM runs r JOIN te ON te.date = r.date "
            "JOIN co ON co.lag_days = r.lag_days AND co.store_id = r.store_id AND co.fold = te.fold)",
            "rm AS (SELECT lag_days, store_id, fold, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, count(*) AS n "
            "FROM pr GROUP BY ALL)")


def fitted_runs(spark, sf_dir, lags=RUN_LAGS, n_splits: int = RUN_FOLDS):
    """Every run x store x expanding fold, fitted together: each row adds its products to the first fold
    it trains, and a prefix sum over the folds gives every fold's system. Rows are replicated per run
    (the grid), never per fold; the coefficient table has one row per run, store and fold."""
    d = cut_lineage(D.dense(spark, sf_dir))
    w = Window.partitionBy("store_id").orderBy("date")
    wide = d.select("store_id", "date", "y", *[F.lag("y", k).over(w).alias(str(k)) for k in lags])
    runs = wide.unpivot(["store_id", "date", "y"], [str(k) for k in lags], "lag_days", "x").where("x is not null") \
               .withColumn("lag_days", F.col("lag_days").cast("int"))
    folds = cut_lineage(splits.expanding_folds(d, n_splits))
    first = folds.where("role = 'train'").groupBy("date").agg(F.min("fold").alias("ft"))
    tested = folds.where("role = 'test'").select("date", F.col("fold").alias("tf"))
    tagged = cut_lineage(runs.join(first, "date", "left").join(tested, "date", "left"))
    keys = ["lag_days", "store_id"]
    part = tagged.where("ft is not null").groupBy(*keys, "ft").agg(
        F.count("*").alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("x") * F.col("y")).alias("sxy"))
    sums = ["n", "sx", "sy", "sxx", "sxy"]
    total = part.withColumn("fold", F.explode(F.sequence("ft", F.lit(n_splits - 1)))).groupBy(*keys, "fold").agg(
        *[F.sum(c).cast("double").alias(c) for c in sums])
    spread = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = F.when(spread > 0, (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / spread)
    models = total.select(*keys, "fold", slope.alias("b"), ((F.col("sy") - slope * F.col("sx")) / F.col("n")).alias("a"))
    scored = tagged.where("tf is not null").withColumnRenamed("tf", "fold").join(models, [*keys, "fold"]) \
                   .withColumn("yhat", F.col("a") + F.col("b") * F.col("x"))
    return scored.groupBy(*keys, "fold").agg(metrics.mae().alias("mae"), metrics.rmse().alias("rmse"), F.count("*").alias("n"))


@query("run_metrics", "M17 M19 M23 M24",
       _with(*_run_ctes()) + "SELECT lag_days, store_id, fold, round(mae, 6) AS mae, round(rmse, 6) AS rmse, n FROM rm")
def run_metrics(spark, sf_dir):
    return metrics.round6(fitted_runs(spark, sf_dir), ["mae", "rmse"])


@query("best_fitted_run", "M23 A15 A16",
       _with(*_run_ctes(), "s AS (SELECT lag_days, avg(mae) AS mean_mae, stddev_pop(mae) AS std_mae, avg(rmse) AS mean_rmse FROM rm GROUP BY lag_days)")
       + "SELECT lag_days, round(mean_mae, 6) AS mean_mae, round(std_mae, 6) AS std_mae, round(mean_rmse, 6) AS mean_rmse, "
         "lag_days = (SELECT arg_min(lag_days, mean_mae) FROM s) AS is_best FROM s")
def best_fitted_run(spark, sf_dir):
    s = cut_lineage(fitted_runs(spark, sf_dir).groupBy("lag_days").agg(
        F.avg("mae").alias("mean_mae"), F.stddev_pop("mae").alias("std_mae"), F.avg("rmse").alias("mean_rmse")))
    best = s.agg(F.min_by("lag_days", "mean_mae")).scalar()
    return metrics.round6(s, ["mean_mae", "std_mae", "mean_rmse"]).withColumn("is_best", F.col("lag_days") == best)
