"""Queries of the seasonal forecast models (M8-M10, M12, M13, M16, M24-M26, M29, M30) over adapter B: daily store
totals on the 2024+ calendar, where the holiday table and the custom windows lie."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import clean, metrics, seasonal, smooth, splits
from ..session import cut_lineage
from ..sources import adapters, dims
from . import daily as D
from .registry import query

HORIZON = 60
SHIFT = adapters.CALENDAR_SHIFT_YEARS
KEYS = ["store_id"]
ONE = seasonal.Spec(yearly=0, weekly=0, changepoints=0, trend_scale=seasonal.NONE)      # y on t alone, unpenalised

# FIXED VALUES - prior scales of the final and of the multiplicative model.
FINAL = seasonal.Spec(holidays=dims.holiday_terms("A"), regressors=("semester_phase",), changepoint_scale=0.02,
                      season_scale=20.0, holiday_scale=1.0)
MULTIPLICATIVE = seasonal.Spec(daily=2, regressors=("semester_phase",), changepoint_scale=0.025, season_scale=15.0,
                               holiday_scale=7.0)
# FIXED VALUES - the search's prior scales: change points, seasons, holidays (6 x 7 x 5 settings).
GRID = [(c, s, h) for c in (0.001, 0.01, 0.05, 0.025, 0.1, 0.5) for s in (1.0, 2.0, 5.0, 10.0, 20.0, 25.0, 30.0)
        for h in (1.0, 2.0, 5.0, 10.0, 20.0)]
GRID_FOLDS = 10
SEED = 42


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def frame(spark, sf_dir, variant: str = "A", horizon: int = HORIZON):
    """Model rows of every store: its dense days and the next ``horizon`` days (M12, J13) with the day's holiday
    terms and phase. Written once: every model of a query reads it."""
    d = cut_lineage(D.dense(spark, sf_dir, SHIFT))
    span = d.groupBy("store_id").agg(F.min("date").alias("d0"), F.max("date").alias("d1"))
    ahead = span.select("store_id", F.explode(F.sequence(F.date_add("d1", 1), F.date_add("d1", horizon))).alias("date")) \
                .select("store_id", "date", F.lit(None).cast("bigint").alias("y"), F.lit(1).alias("is_future"))
    rows = d.select("store_id", "date", "y", F.lit(0).alias("is_future"))
    rows = rows.unionByName(ahead) if horizon else rows
    rows = rows.join(span, "store_id").join(F.broadcast(dims.holiday_days(spark, variant)), "date", "left")
    return cut_lineage(rows.select(
        "store_id", "date", F.col("y").cast("double").alias("y"), "is_future", F.datediff("date", "d0").alias("t"),
        F.unix_date("date").alias("e"), (F.datediff("d1", "d0") + 1).alias("hist"), "terms",
        cal.phase_rule_a("date").cast("double").alias("semester_phase")))


def lengths(rows):
    return rows.groupBy("store_id").agg(F.max("hist").alias("hist"))


def history(rows):
    return rows.where("is_future = 0")


# --- M8: the design matrix ---------------------------------------------------------------------------------------

DESIGN = seasonal.Spec(yearly=3, weekly=2, changepoints=25, holidays=dims.holiday_terms("B"), regressors=("semester_phase",))


def _design_sql() -> str:
    cols = ["1.0 AS m", "CAST(t AS DOUBLE) AS t"]
    knot = f"round_even(greatest(floor(hist * {DESIGN.changepoint_range}) - 1, 0) * {{j}} / {DESIGN.changepoints}.0, 0)"
    cols += [f"greatest(t - {knot.format(j=j)}, 0.0) AS cp_{j}" for j in range(1, DESIGN.changepoints + 1)]
    for p, n, period in (("y", DESIGN.yearly, seasonal.YEAR_DAYS), ("w", DESIGN.weekly, 7.0)):
        for k in range(1, n + 1):
            cols += [f"round({fn}(e * {2 * math.pi * k / period!r}), 6) AS {p}{c}_{k}" for fn, c in (("sin", "s"), ("cos", "c"))]
    names = dims.holiday_terms("B")
    cols += [f"CAST(coalesce(list_contains(terms, '{n}'), false) AS DOUBLE) AS hol_{i}" for i, n in enumerate(names)]
    public = " UNION ALL ".join(f"SELECT '{n}' AS h, DATE '{d}' AS a, DATE '{d}' AS b, 0 AS u" for d, n in dims.HOLIDAYS)
    custom = " UNION ALL ".join(f"SELECT '{n}', DATE '{a}', DATE '{b}', {u}" for n, a, b, u in dims.HOLIDAY_WINDOWS_B)
    phase = ("CASE WHEN (month(date) = 12 AND day(date) >= 22) OR (month(date) = 1 AND day(date) <= 2) THEN 0 "
             "WHEN date BETWEEN DATE '2024-07-31' AND DATE '2024-09-15' THEN 0 "
             "WHEN month(date) >= 10 OR month(date) <= 3 THEN 1 WHEN month(date) BETWEEN 4 AND 7 THEN 2 ELSE 0 END")
    return (_with(*D.DENSE_SHIFT, f"hw AS ({public} UNION ALL {custom})",
                  "hd AS (SELECT h, u, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS ds FROM hw)",
                  "ho AS (SELECT h, ds, unnest(range(0, u + 1)) AS o FROM hd)",
                  "hl AS (SELECT CAST(ds + o * INTERVAL 1 DAY AS DATE) AS date, list(h || '_' || o) AS terms FROM ho GROUP BY 1)",
                  "sp AS (SELECT store_id, min(date) AS d0, max(date) AS d1 FROM dense GROUP BY 1)",
                  "fr AS (SELECT dense.store_id, dense.date, datediff('day', d0, dense.date) AS t, datediff('day', d0, d1) + 1 AS hist, "
                  "datediff('day', DATE '1970-01-01', dense.date) AS e, terms FROM dense JOIN sp ON sp.store_id = dense.store_id "
                  "LEFT JOIN hl ON hl.date = dense.date)")
            + f"SELECT store_id, date, {', '.join(cols)}, CAST({phase} AS DOUBLE) AS semester_phase FROM fr")


@query("seasonal_design", "M8 C10 C11 U5 S5 J13", _design_sql())
def seasonal_design(spark, sf_dir):
    z = seasonal.design_table(frame(spark, sf_dir, "B", horizon=0), KEYS, DESIGN)
    return z.withColumns({c: F.round(c, 6) for c in z.columns if c[:3] in ("ys_", "yc_", "ws_", "wc_")})


# --- M8, M10, M12, M29: fit, forecast, intervals -------------------------------------------------------------------

def _finish(out):
    return out.select("store_id", "date", "y", "is_future", F.round("yhat", 4).alias("yhat"),
                      F.round("lower", 4).alias("yhat_lower"), F.round("upper", 4).alias("yhat_upper"))


Z80 = 1.2815515655446004        # normal quantile of an 80 % interval


def with_intervals(scored, models):
    """80 % intervals; in the history from the noise alone, after it from simulated trend changes."""
    wide = seasonal.simulate(scored.where("is_future = 1"), models, KEYS, seed=SEED)
    past = history(scored).select("*", (F.col("yhat") - Z80 * F.col("sigma")).alias("lower"),
                                  (F.col("yhat") + Z80 * F.col("sigma")).alias("upper"))
    return past.unionByName(scored.where("is_future = 1").join(wide, [*KEYS, "date"]), allowMissingColumns=True)


@query("seasonal_forecast", "M8 M10 M12 M29 J13 L6")
def seasonal_forecast(spark, sf_dir, spec: seasonal.Spec = FINAL):
    rows = frame(spark, sf_dir)
    stats = seasonal.grams(history(rows).withColumn("bucket", F.lit(0)), KEYS, "bucket", spec)
    models = cut_lineage(seasonal.fit(stats, KEYS, "bucket", spec, lengths(rows)))
    scored = cut_lineage(seasonal.predict(rows, models, KEYS, spec, ["date", "y", "is_future", "t"]))
    return _finish(with_intervals(scored, models))


def prepared(rows):
    """History capped to its 1st and 99th percentile (P21), then a centred median of 7 (W2); the phase smoothed over
    21 days (W1, W4) by rule C."""
    capped = clean.winsorize(history(rows), "y", by=KEYS)
    calm = capped.withColumn("y", smooth.centred_median("y", KEYS, "date", 7)).unionByName(rows.where("is_future = 1"))
    phased = calm.withColumn("_p", cal.phase_rule_c("date").cast("double"))
    phased = phased.withColumn("_m", smooth.centred_mean("_p", KEYS, "date", 21))
    return phased.withColumn("semester_phase", smooth.back_then_forward_fill("_m", KEYS, "date")).drop("_p", "_m")


@query("seasonal_forecast_mult", "M9 M10 M25 W3")
def seasonal_forecast_mult(spark, sf_dir):
    """Multiplicative seasons with a daily term; the forecast is smoothed by a median of 5."""
    rows = cut_lineage(prepared(frame(spark, sf_dir)))
    both = cut_lineage(seasonal.multiplicative(rows, KEYS, MULTIPLICATIVE, ["date", "y", "is_future", "t"]))
    models = both.groupBy(*KEYS).agg(*[F.first(c).alias(c) for c in ("sigma", "jump_rate", "jump_size", "t_last")])
    out = with_intervals(both.drop("jump_rate", "jump_size", "t_last"), models)
    out = out.withColumn("_m", smooth.centred_median("yhat", KEYS, "date", 5, keep_edges=False))
    return _finish(out.withColumn("yhat", smooth.back_then_forward_fill("_m", KEYS, "date")))


# --- M14, M16, M30: folds and rolling origins from bucket sums ------------------------------------------------------

@query("seasonal_cv", "M14 M17 M30 A15 M11")
def seasonal_cv(spark, sf_dir, n_splits: int = 5, spec: seasonal.Spec = FINAL):
    """Expanding folds: a date's bucket is the first fold it trains, so fold f's system is the sum of the buckets up
    to f, and every date is reduced once."""
    rows = history(frame(spark, sf_dir, horizon=0))
    folds = cut_lineage(splits.expanding_folds(rows, n_splits))
    first = folds.where("role = 'train'").groupBy("date").agg(F.min("fold").alias("bucket"))
    stats = seasonal.grams(rows.join(first, "date"), KEYS, "bucket", spec)
    models = cut_lineage(seasonal.fit(stats, KEYS, "bucket", spec, lengths(rows), list(range(n_splits))))
    tests = rows.join(folds.where("role = 'test'").select("date", F.col("fold").alias("bucket")), "date")
    scored = seasonal.predict(tests, models, [*KEYS, "bucket"], spec, ["date", "y"])
    half = F.lit(Z80) * F.col("sigma")
    scored = scored.withColumns({"lo": F.col("yhat") - half, "hi": F.col("yhat") + half})
    per_fold = scored.groupBy("bucket").agg(metrics.mae().alias("mae"), metrics.rmse().alias("rmse"),
                                            metrics.coverage("y", "lo", "hi").alias("coverage"))
    return metrics.round6(metrics.fold_summary(per_fold, ["mae", "rmse", "coverage"]), ["mean", "std"])


def rolling_origin_scores(rows, spec: seasonal.Spec, horizon: int, period: int, initial: int):
    """Metrics per horizon day over all cutoffs. A date's bucket is the last cutoff it trains (cutoffs are
    numbered backwards), so a cutoff's system is the sum of the buckets from its own number on."""
    tests = cut_lineage(splits.rolling_origin_folds(rows, horizon, period, initial))
    end = rows.agg(F.max("date").alias("d1")).first()["d1"]
    start = rows.agg(F.min("date").alias("d0")).first()["d0"]
    last = ((end - start).days - horizon - initial) // period
    behind = F.datediff(F.lit(end), "date")
    bucket = F.least(F.floor((behind - horizon) / period), F.lit(last)).cast("int")
    stats = seasonal.grams(rows.withColumn("bucket", bucket).where("bucket >= 0"), KEYS, "bucket", spec)
    models = cut_lineage(seasonal.fit(stats, KEYS, "bucket", spec, lengths(rows), list(range(last + 1)), seasonal.FROM))
    at = tests.select("date", "cutoff", ((F.datediff(F.lit(end), "cutoff") - horizon) / period).cast("int").alias("bucket"))
    scored = seasonal.predict(rows.join(at, "date"), models, [*KEYS, "bucket"], spec, ["date", "cutoff", "y"])
    return scored.groupBy(F.datediff("date", "cutoff").alias("horizon_day")).agg(
        metrics.mae().alias("mae"), metrics.mse().alias("mse"), metrics.rmse().alias("rmse"), F.count("*").alias("n"))


def _rolling_trend_sql() -> str:
    h, p, i = D.RO["horizon"], D.RO["period"], D.RO["initial"]
    return (_with(*D.DENSE_SHIFT, "b AS (SELECT min(date) AS d0, max(date) AS d1 FROM dense)",
                  f"ct AS (SELECT CAST(d1 - INTERVAL 1 DAY * ({h} + {p} * k) AS DATE) AS cutoff FROM b, "
                  f"(SELECT unnest(range(0, CAST((datediff('day', d0, d1) - {h} - {i}) // {p} + 1 AS BIGINT))) AS k FROM b))",
                  "md AS (SELECT cutoff, store_id, regr_slope(y, datediff('day', DATE '2000-01-01', date)) AS s, "
                  "regr_intercept(y, datediff('day', DATE '2000-01-01', date)) AS c FROM dense, ct WHERE date <= cutoff GROUP BY ALL)",
                  "sc AS (SELECT datediff('day', md.cutoff, d.date) AS horizon_day, d.y - (c + s * datediff('day', DATE '2000-01-01', d.date)) AS r "
                  f"FROM dense d JOIN md ON md.store_id = d.store_id AND d.date > md.cutoff AND d.date <= md.cutoff + INTERVAL {h} DAY)")
            + "SELECT CAST(horizon_day AS INTEGER) AS horizon_day, round(avg(abs(r)), 6) AS mae, round(avg(r * r), 6) AS mse, "
              "round(sqrt(avg(r * r)), 6) AS rmse, count(*) AS n FROM sc GROUP BY 1")


@query("rolling_origin_trend", "M16 M30", _rolling_trend_sql())
def rolling_origin_trend(spark, sf_dir):
    rows = history(frame(spark, sf_dir, horizon=0))
    return metrics.round6(rolling_origin_scores(rows, ONE, **D.RO), ["mae", "mse", "rmse"])


@query("rolling_origin_seasonal", "M16 M30")
def rolling_origin_seasonal(spark, sf_dir):
    rows = history(frame(spark, sf_dir, horizon=0))
    return metrics.round6(rolling_origin_scores(rows, FINAL, **D.RO), ["mae", "mse", "rmse"])


# --- M13, M17: repeated folds --------------------------------------------------------------------------------------

KFOLD, REPEATS, KFOLD_LAG = 5, 3, 7


def _kfold_sql() -> str:
    fold = D._hash_sql("date", f"{SEED} + r")
    return (_with(*D.DENSE, f"x AS (SELECT * FROM (SELECT store_id, date, y, lag(y, {KFOLD_LAG}) OVER (PARTITION BY store_id ORDER BY date) AS x FROM dense) "
                  "WHERE x IS NOT NULL)",
                  f"f AS (SELECT x.*, CAST(r AS INTEGER) AS repeat, CAST({fold} % {KFOLD} AS INTEGER) AS fold FROM x, (SELECT unnest(range(0, {REPEATS})) AS r))",
                  f"m AS (SELECT f.store_id, f.repeat, k.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM f, (SELECT unnest(range(0, {KFOLD})) AS fold) k "
                  "WHERE f.fold <> k.fold GROUP BY ALL)",
                  "e AS (SELECT f.store_id, f.repeat, f.fold, avg(abs(y - a - b * x)) AS mae, sqrt(avg(power(y - a - b * x, 2))) AS rmse, count(*) AS n "
                  "FROM f JOIN m ON m.store_id = f.store_id AND m.repeat = f.repeat AND m.fold = f.fold GROUP BY ALL)")
            + "SELECT store_id, repeat, round(avg(mae), 6) AS mean_mae, round(stddev_pop(mae), 6) AS std_mae, round(avg(rmse), 6) AS mean_rmse, "
              "CAST(sum(n) AS BIGINT) AS n FROM e GROUP BY store_id, repeat")


@query("repeated_kfold_metrics", "M13 M17 M18 A15", _kfold_sql())
def repeated_kfold_metrics(spark, sf_dir):
    """A linear model per store on 5 x 3 folds at once: each fold's sums are taken once, and the system that
    leaves it out is the store's total minus them."""
    d = D.dense(spark, sf_dir)
    lagged = d.withColumn("x", F.lag("y", KFOLD_LAG).over(Window.partitionBy("store_id").orderBy("date"))).where("x is not null")
    folds = F.explode(F.array(*[F.struct(F.lit(r).alias("repeat"), F.pmod(splits.date_hash("date", F.lit(SEED + r)), F.lit(KFOLD)).cast("int").alias("fold"))
                                for r in range(REPEATS)]))
    rows = cut_lineage(lagged.select("store_id", "date", "y", "x", folds.alias("f")).select("store_id", "y", "x", "f.repeat", "f.fold"))
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    own = rows.groupBy("store_id", "repeat", "fold").agg(F.count("*").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
                                                         F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy"))
    every = Window.partitionBy("store_id", "repeat")        # one row per fold
    rest = own.select("store_id", "repeat", "fold", *[(F.sum(c).over(every) - F.col(c)).alias(c) for c in ("n", "sx", "sy", "sxx", "sxy")])
    spread = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = F.when(spread > 0, (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / spread)
    model = rest.select("store_id", "repeat", "fold", slope.alias("b"), ((F.col("sy") - slope * F.col("sx")) / F.col("n")).alias("a"))
    scored = rows.join(model, ["store_id", "repeat", "fold"]).withColumn("yhat", F.col("a") + F.col("b") * F.col("x"))
    per = scored.groupBy("store_id", "repeat", "fold").agg(metrics.mae().alias("mae"), metrics.rmse().alias("rmse"), F.count("*").alias("n"))
    out = per.groupBy("store_id", "repeat").agg(F.avg("mae").alias("mean_mae"), F.stddev_pop("mae").alias("std_mae"),
                                                F.avg("rmse").alias("mean_rmse"), F.sum("n").alias("n"))
    return metrics.round6(out, ["mean_mae", "std_mae", "mean_rmse"])


# --- M24, M26, M29: search of the prior scales, final evaluation and forecast ----------------------------------------

def grid_scores(rows, settings=GRID, folds: int = GRID_FOLDS):
    """Mean over folds and stores of the MAE and RMSE of every setting, on shuffled folds (M15): the system that
    leaves a fold out is the total minus its bucket."""
    tagged = rows.withColumn("bucket", F.pmod(splits.date_hash("date", F.lit(SEED)), F.lit(folds)).cast("int"))
    stats = seasonal.grams(tagged, KEYS, "bucket", FINAL)
    each = seasonal.search(stats, tagged, KEYS, "bucket", "bucket", FINAL, lengths(rows), list(range(folds)), settings,
                           seasonal.OTHERS)
    per_fold = each.groupBy("setting", "bucket").agg(
        (F.sum("abs_error") / F.sum("n")).alias("mae"), F.sqrt(F.sum("sq_error") / F.sum("n")).alias("rmse"))
    scales = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(("changepoint_scale", "season_scale", "holiday_scale"), x)])
                       for x in settings])
    mean = per_fold.groupBy("setting").agg(F.avg("mae").alias("mean_mae"), F.stddev_pop("mae").alias("std_mae"), F.avg("rmse").alias("mean_rmse"))
    return mean.select("setting", F.get(scales, F.col("setting")).alias("s"), "mean_mae", "std_mae", "mean_rmse") \
               .select("setting", "s.*", "mean_mae", "std_mae", "mean_rmse")


@query("prior_grid", "M24 M15 M21 A15 A16")
def prior_grid(spark, sf_dir):
    scores = cut_lineage(grid_scores(history(frame(spark, sf_dir, horizon=0))))
    best = scores.agg(F.min_by("setting", F.struct("mean_mae", "setting"))).scalar()
    return metrics.round6(scores, ["mean_mae", "std_mae", "mean_rmse"]).withColumn("is_best", F.col("setting") == best)


@query("chosen_model_holdout", "M26 M29 M24 A13")
def chosen_model_holdout(spark, sf_dir, holdout: int = HORIZON):
    """The scales that the search on the days before the last 60 chooses, fitted on those days and scored per
    store on the last 60 with the simulated interval's coverage."""
    rows = history(frame(spark, sf_dir, horizon=0))
    rows = rows.withColumn("is_future", (F.col("t") >= F.col("hist") - holdout).cast("int")).withColumn("hist", F.col("hist") - holdout)
    rows = cut_lineage(rows.where("hist > 0"))
    best = grid_scores(history(rows)).agg(F.min_by(F.struct("changepoint_scale", "season_scale", "holiday_scale"),
                                                   F.struct("mean_mae", "setting")).alias("b")).first()["b"]
    if best is None:
        return rows.limit(0).select("store_id", *[F.lit(0.0).alias(c) for c in (
            "mae", "mse", "rmse", "coverage", "changepoint_scale", "season_scale", "holiday_scale")], F.lit(0).cast("long").alias("n"))
    spec = seasonal.replace(FINAL, **best.asDict())
    stats = seasonal.grams(history(rows).withColumn("bucket", F.lit(0)), KEYS, "bucket", spec)
    models = cut_lineage(seasonal.fit(stats, KEYS, "bucket", spec, lengths(rows)))
    scored = cut_lineage(seasonal.predict(rows, models, KEYS, spec, ["date", "y", "is_future", "t"]))
    last = with_intervals(scored, models).where("is_future = 1")
    per = last.groupBy("store_id").agg(metrics.mae().alias("mae"), metrics.mse().alias("mse"), metrics.rmse().alias("rmse"),
                                       metrics.coverage("y", "lower", "upper").alias("coverage"), F.count("*").alias("n"))
    return metrics.round6(per, ["mae", "mse", "rmse", "coverage"]).withColumns({k: F.lit(v) for k, v in best.asDict().items()})
