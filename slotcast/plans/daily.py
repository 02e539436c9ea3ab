"""Daily-series queries over adapter B (orders x customer x nation): winsorizing, phase
rules, month/year roll-ups, store alignment, smoothing, splits, folds and metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import clean, metrics, smooth, splits
from ..sources import adapters, dims
from ..sources.tables import read_table
from . import sqlparts as S
from .registry import query

SHIFT = adapters.CALENDAR_SHIFT_YEARS


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def daily(spark, sf_dir, shift=0):
    return adapters.daily_sales_long(spark, sf_dir, shift)


def dense(spark, sf_dir, shift=0, fill=True):
    return adapters.dense_daily_store_totals(spark, sf_dir, shift, fill)


DENSE = (S.daily_long_cte(), S.store_totals_cte(), S.dense_totals_cte())
DENSE_SHIFT = (S.daily_long_cte(shift_years=SHIFT), S.store_totals_cte(), S.dense_totals_cte())


# --- P21, P19 ------------------------------------------------------------------------------

@query("winsorize_daily", "P21",
       _with(S.daily_long_cte(),
             "b AS (SELECT category, quantile_cont(items, 0.01) AS lo, quantile_cont(items, 0.99) AS hi FROM daily GROUP BY category)")
       + "SELECT d.date, d.store_id, d.category, d.items, "
       + S.r6("least(greatest(d.items, b.lo), b.hi)") + " AS items_capped FROM daily d JOIN b ON d.category = b.category")
def winsorize_daily(spark, sf_dir):
    out = clean.winsorize(daily(spark, sf_dir), "items", by=["category"], name="items_capped")
    return out.withColumn("items_capped", F.round(F.col("items_capped").cast("double"), 6)) \
              .select("date", "store_id", "category", "items", "items_capped")


@query("post_process_predictions", "P19 F14",
       "SELECT l_orderkey, l_linenumber, raw_pred, "
       "CAST(round_even(greatest(raw_pred, 0.0), 0) AS DOUBLE) + 0.0 AS pred_clean, "
       "greatest(CAST(round_even(raw_pred, 0) AS DOUBLE), 0.0) + 0.0 AS pred_imputed "
       "FROM (SELECT l_orderkey, l_linenumber, (l_quantity - 25.0) / 2 AS raw_pred FROM lineitem)")
def post_process_predictions(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    raw = ((F.col("l_quantity") - 25.0) / 2).alias("raw_pred")
    return li.select("l_orderkey", "l_linenumber", raw).select(
        "l_orderkey", "l_linenumber", "raw_pred",
        (clean.post_process_predictions("raw_pred") + F.lit(0.0)).alias("pred_clean"),
        (clean.clip_imputed("raw_pred") + F.lit(0.0)).alias("pred_imputed"))


# --- C7-C10 ----------------------------------------------------------------------------------

def _dates_shifted(spark, sf_dir):
    return daily(spark, sf_dir, SHIFT).select("date").distinct()


@query("semester_rules_abc", "C7 C8 C9 F15",
       _with(S.daily_long_cte(shift_years=SHIFT), "dd AS (SELECT DISTINCT date FROM daily)")
       + "SELECT date, "
         "CAST(CASE WHEN (month(date) = 12 AND day(date) >= 22) OR (month(date) = 1 AND day(date) <= 2) THEN 0 "
         "WHEN date BETWEEN DATE '2024-07-31' AND DATE '2024-09-15' THEN 0 "
         "WHEN month(date) >= 10 OR month(date) <= 3 THEN 1 WHEN month(date) BETWEEN 4 AND 7 THEN 2 ELSE 0 END AS INTEGER) AS phase_a, "
         "CAST(CASE WHEN date BETWEEN DATE '2024-10-01' AND DATE '2025-03-31' THEN 1 "
         "WHEN date BETWEEN DATE '2025-04-01' AND DATE '2025-09-30' THEN 2 ELSE 0 END AS INTEGER) AS phase_b, "
         "CAST(CASE WHEN month(date) >= 10 OR month(date) <= 3 THEN 1 ELSE 2 END AS INTEGER) AS phase_c FROM dd")
def semester_rules_abc(spark, sf_dir):
    d = _dates_shifted(spark, sf_dir)
    return d.select("date", cal.phase_rule_a("date").cast("int").alias("phase_a"),
                    cal.phase_rule_b("date").cast("int").alias("phase_b"),
                    cal.phase_rule_c("date").cast("int").alias("phase_c"))


def _window_values(rows) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS holiday, CAST(unnest(generate_series(DATE '{a}', DATE '{b}' + INTERVAL {u} DAY, INTERVAL 1 DAY)) AS DATE) AS ds"
        for n, a, b, u in rows)


@query("holiday_windows", "C10 C11 U5",
       _with(S.daily_long_cte(shift_years=SHIFT), "dd AS (SELECT DISTINCT date FROM daily)",
             f"wa AS ({_window_values(dims.HOLIDAY_WINDOWS_A)})", f"wb AS ({_window_values(dims.HOLIDAY_WINDOWS_B)})")
       + "SELECT dd.date, wa.holiday AS window_a, wb.holiday AS window_b FROM dd "
         "LEFT JOIN wa ON wa.ds = dd.date LEFT JOIN wb ON wb.ds = dd.date")
def holiday_windows(spark, sf_dir):
    d = _dates_shifted(spark, sf_dir)
    spark_ = d.sparkSession
    # windows exploded by their upper offset; both are fixed literal tables (< 100 rows)
    wa = dims.holiday_window_df(spark_, "A")
    wb = dims.holiday_window_df(spark_, "B")
    wa = wa.select(F.col("holiday").alias("window_a"),
                   F.explode(F.sequence(F.col("ds"), F.date_add("ds", F.col("upper_window")))).alias("date")).distinct()
    wb = wb.select(F.col("holiday").alias("window_b"),
                   F.explode(F.sequence(F.col("ds"), F.date_add("ds", F.col("upper_window")))).alias("date")).distinct()
    return d.join(F.broadcast(wa), "date", "left").join(F.broadcast(wb), "date", "left").select("date", "window_a", "window_b")


# --- A2 at month / year on the daily table ---------------------------------------------------

@query("level_rollup_month", "A2 F8",
       _with(S.daily_long_cte()) + "SELECT CAST(date_trunc('month', date) AS DATE) AS date, store_id, "
       "CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, category, "
       "CAST(sum(items) AS BIGINT) AS items FROM daily GROUP BY ALL")
def level_rollup_month(spark, sf_dir):
    d = daily(spark, sf_dir)
    return d.groupBy(F.trunc("date", "month").alias("date"), "store_id", F.year("date").alias("year"),
                     F.month("date").alias("month"), "category").agg(F.sum("items").cast("bigint").alias("items"))


@query("level_rollup_year", "A2 F8",
       _with(S.daily_long_cte()) + "SELECT CAST(date_trunc('year', date) AS DATE) AS date, store_id, "
       "CAST(year(date) AS INTEGER) AS year, category, CAST(sum(items) AS BIGINT) AS items FROM daily GROUP BY ALL")
def level_rollup_year(spark, sf_dir):
    d = daily(spark, sf_dir)
    return d.groupBy(F.trunc("date", "year").alias("date"), "store_id", F.year("date").alias("year"),
                     "category").agg(F.sum("items").cast("bigint").alias("items"))


# --- J7 ---------------------------------------------------------------------------------------

STORE_PAIR = (0, 1)     # the two stores that are compared; a parameter of the operator


@query("store_align_outer", "J7 A7",
       _with(S.daily_long_cte(), S.store_totals_cte(),
             "wk AS (SELECT * FROM tot WHERE isodow(date) <= 5)")
       + "SELECT coalesce(a.date, b.date) AS date, a.y AS store_0_items, b.y AS store_1_items FROM "
         f"(SELECT date, y FROM wk WHERE store_id = {STORE_PAIR[0]}) a FULL OUTER JOIN "
         f"(SELECT date, y FROM wk WHERE store_id = {STORE_PAIR[1]}) b ON a.date = b.date")
def store_align_outer(spark, sf_dir, pair: tuple[int, int] = STORE_PAIR):
    """Full outer alignment of two stores as ONE conditional aggregation (no join)."""
    t = adapters.daily_store_totals(spark, sf_dir).where((F.weekday("date") < 5) & F.col("store_id").isin(*pair))
    return t.groupBy("date").agg(*[F.sum(F.when(F.col("store_id") == s, F.col("y"))).cast("bigint").alias(f"store_{s}_items")
                                   for s in pair])


# --- W1-W5 ------------------------------------------------------------------------------------

W21 = "(PARTITION BY store_id ORDER BY date ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING)"


@query("rolling_mean_21", "W1 W4",
       _with(*DENSE, f"rm AS (SELECT *, CASE WHEN count(y) OVER {W21} = 21 THEN avg(y) OVER {W21} END AS m FROM dense)")
       + "SELECT store_id, date, y, round(m, 6) AS y_rm21, round(coalesce("
         "first_value(m IGNORE NULLS) OVER (PARTITION BY store_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), "
         "last_value(m IGNORE NULLS) OVER (PARTITION BY store_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) "
         "AS y_rm21_filled FROM rm")
def rolling_mean_21(spark, sf_dir):
    d = dense(spark, sf_dir).withColumn("m", smooth.centred_mean("y", ["store_id"], "date", 21))
    d = d.withColumn("f", smooth.back_then_forward_fill("m", ["store_id"], "date"))
    return d.select("store_id", "date", "y", F.round("m", 6).alias("y_rm21"), F.round("f", 6).alias("y_rm21_filled"))


def _median_sql(width: int, fill_edges: bool) -> str:
    h = width // 2
    w = f"(PARTITION BY store_id ORDER BY date ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)"
    if not fill_edges:
        return (_with(*DENSE) + f"SELECT store_id, date, y, round(CASE WHEN count(y) OVER {w} = {width} "
                f"THEN quantile_cont(y, 0.5) OVER {w} ELSE CAST(y AS DOUBLE) END, 6) AS y_med{width} FROM dense")
    return (_with(*DENSE, f"md AS (SELECT *, CASE WHEN count(y) OVER {w} = {width} THEN quantile_cont(y, 0.5) OVER {w} END AS m FROM dense)")
            + "SELECT store_id, date, y, round(coalesce("
            "first_value(m IGNORE NULLS) OVER (PARTITION BY store_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), "
            "last_value(m IGNORE NULLS) OVER (PARTITION BY store_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) "
            f"AS y_med{width} FROM md")


def _make_median(width, fill_edges):
    """W2 keeps raw values where the window is not full; W3 back-fills, then forward-fills there."""
    def q(spark, sf_dir):
        d = dense(spark, sf_dir)
        m = smooth.centred_median("y", ["store_id"], "date", width, keep_edges=not fill_edges)
        d = d.withColumn("_m", m)
        if fill_edges:
            d = d.withColumn("_m", smooth.back_then_forward_fill("_m", ["store_id"], "date"))
        return d.select("store_id", "date", "y", F.round("_m", 6).alias(f"y_med{width}"))
    return q


query("rolling_median_7", "W2 M25", _median_sql(7, False))(_make_median(7, False))
query("rolling_median_5", "W3", _median_sql(5, True))(_make_median(5, True))

EMA_SPAN = 7


def _aligned_weekday_totals(spark, sf_dir):
    """Weekday daily totals of every store on the union of dates (J7 generalised): a
    store missing on a date gets a null (a gap for the EMA)."""
    t = adapters.daily_store_totals(spark, sf_dir).where(F.weekday("date") < 5)
    dates = t.select(F.array_sort(F.collect_set("date"))).scalar()        # as long as the calendar
    grid = t.select("store_id").where("store_id is not null").distinct().select(F.explode(dates).alias("date"), "store_id")
    return grid.join(t, ["store_id", "date"], "left")


def _ema_sql() -> str:
    a = 2.0 / (EMA_SPAN + 1)
    return ("WITH RECURSIVE " + ",\n".join([
        S.daily_long_cte(), S.store_totals_cte(),
        "wk AS (SELECT * FROM tot WHERE isodow(date) <= 5)",
        "g AS (SELECT s.store_id, d.date FROM (SELECT DISTINCT date FROM wk) d, (SELECT DISTINCT store_id FROM wk) s)",
        "base AS (SELECT g.store_id, g.date, w.y, row_number() OVER (PARTITION BY g.store_id ORDER BY g.date) AS rn "
        "FROM g LEFT JOIN wk w ON g.store_id = w.store_id AND g.date = w.date)",
        f"""rec(store_id, rn, date, y, v, p) AS (
  SELECT store_id, rn, date, y, CAST(y AS DOUBLE), CAST(1.0 AS DOUBLE) FROM base WHERE rn = 1
  UNION ALL
  SELECT b.store_id, b.rn, b.date, b.y,
    CASE WHEN b.y IS NULL THEN r.v WHEN r.v IS NULL THEN CAST(b.y AS DOUBLE)
         ELSE (r.p * {1 - a} * r.v + {a} * b.y) / (r.p * {1 - a} + {a}) END,
    CASE WHEN b.y IS NULL THEN r.p * {1 - a} ELSE 1.0 END
  FROM rec r JOIN base b ON b.store_id = r.store_id AND b.rn = r.rn + 1)"""])
        + "\nSELECT store_id, date, y, round(v, 6) AS ema FROM rec")


@query("ema_span7", "W5 J7", _ema_sql())
def ema_span7(spark, sf_dir):
    out = smooth.ema(_aligned_weekday_totals(spark, sf_dir), "y", ["store_id"], "date", EMA_SPAN)
    return out.withColumn("ema", F.round("ema", 6))




# --- W6, P14-P16, M13-M16 -----------------------------------------------------------------------

HOLDOUT = 60


@query("last_n_holdout", "W6 M26",
       _with(*DENSE) + f"SELECT store_id, date, y, CAST(row_number() OVER (PARTITION BY store_id ORDER BY date DESC) <= {HOLDOUT} AS INTEGER) AS is_holdout FROM dense")
def last_n_holdout(spark, sf_dir):
    d = dense(spark, sf_dir)
    return d.withColumn("is_holdout", splits.last_n_flag(["store_id"], "date", HOLDOUT))


@query("time_split", "P14 P15",
       _with(*DENSE_SHIFT) + "SELECT store_id, date, y, CAST(date <= DATE '2024-12-31' AS INTEGER) AS in_cv, "
       "CASE WHEN date <= DATE '2024-12-31' AND date < DATE '2024-09-01' THEN 'train' WHEN date <= DATE '2024-12-31' THEN 'test' END AS p14_role, "
       "CASE WHEN date < DATE '2025-01-01' THEN 'train' ELSE 'score' END AS p15_role FROM dense")
def time_split(spark, sf_dir):
    return splits.date_split(dense(spark, sf_dir, SHIFT))


def _hash_sql(d: str, seed: str) -> str:
    return S.date_hash_sql(d, seed)


SAMPLE_SEED = 42


@query("date_sample_split", "P16 O5 O6",
       _with(*DENSE, "dd AS (SELECT DISTINCT date FROM dense)",
             f"rk AS (SELECT date, row_number() OVER (ORDER BY {_hash_sql('date', str(SAMPLE_SEED))}, date) AS r, count(*) OVER () AS n FROM dd)",
             "tr AS (SELECT date FROM rk WHERE r <= floor(n * 0.5))")
       + "SELECT store_id, date, y, CASE WHEN date IN (SELECT date FROM tr) THEN 'train' ELSE 'test' END AS role FROM dense")
def date_sample_split(spark, sf_dir):
    d = dense(spark, sf_dir)
    train_dates = splits.sample_dates(d, 0.5, SAMPLE_SEED)
    tr, te = splits.split_by_dates(d, train_dates)
    return tr.withColumn("role", F.lit("train")).unionByName(te.withColumn("role", F.lit("test")))


@query("expanding_folds", "M14 W7 Q31",
       _with(*DENSE, "rk AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS rank, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM dense))",
             "p AS (SELECT date, n, rank, n // 6 AS m FROM rk)",
             "q AS (SELECT date, CAST((n - rank - 1) // m + 1 AS INTEGER) AS j, CAST(greatest(floor(5 - (n - rank) / m) + 1, 0) AS INTEGER) AS ft FROM p)")
       + "SELECT CAST(5 - j AS INTEGER) AS fold, date, 'test' AS role FROM q WHERE j BETWEEN 1 AND 5 "
         "UNION ALL SELECT CAST(unnest(generate_series(ft, 4)) AS INTEGER) AS fold, date, 'train' AS role FROM q WHERE ft <= 4")
def expanding_folds(spark, sf_dir):
    return splits.expanding_folds(dense(spark, sf_dir), 5)


RO = dict(horizon=30, period=15, initial=400)


def _rolling_origin_sql() -> str:
    h, p, i = RO["horizon"], RO["period"], RO["initial"]
    return (_with(*DENSE, "dd AS (SELECT DISTINCT date FROM dense)",
                  "b AS (SELECT min(date) AS d0, max(date) AS d1 FROM dd)",
                  f"x AS (SELECT dd.date, b.d1, datediff('day', dd.date, b.d1) AS delta, "
                  f"CAST(floor((datediff('day', b.d0, b.d1) - {h} - {i}) / {p}) AS INTEGER) AS kmax FROM dd, b)",
                  f"t AS (SELECT date, d1, CAST(unnest(generate_series(CAST(greatest(floor((delta - {h}) / {p}) + 1, 0) AS INTEGER), "
                  f"CAST(least(floor(delta / {p}), kmax) AS INTEGER))) AS INTEGER) AS k FROM x "
                  f"WHERE greatest(floor((delta - {h}) / {p}) + 1, 0) <= least(floor(delta / {p}), kmax))",
                  f"nt AS (SELECT k, CAST((SELECT count(*) FROM x WHERE datediff('day', x.date, x.d1) >= {h} + k * {p}) AS BIGINT) AS n_train "
                  f"FROM (SELECT DISTINCT k FROM t))")
            + f"SELECT CAST(t.d1 - INTERVAL ({h} + t.k * {p}) DAY AS DATE) AS cutoff, t.date, 'test' AS role, nt.n_train "
              "FROM t JOIN nt ON t.k = nt.k")


@query("rolling_origin_folds", "M16", _rolling_origin_sql())
def rolling_origin_folds(spark, sf_dir):
    return splits.rolling_origin_folds(dense(spark, sf_dir), **RO)


@query("hash_kfold", "M13 M15",
       _with(*DENSE, "dd AS (SELECT DISTINCT date FROM dense)")
       + f"SELECT date, CAST(r AS INTEGER) AS repeat, CAST({_hash_sql('date', '42 + r')} % 5 AS INTEGER) AS fold "
         "FROM dd, (SELECT unnest(generate_series(0, 2)) AS r)")
def hash_kfold(spark, sf_dir):
    return splits.hash_kfold(dense(spark, sf_dir), 5, 3, 42).withColumn("repeat", F.col("repeat").cast("int"))


# --- A10-A15: naive forecast (mean of the previous 7 days) --------------------------------------

def series_daily(spark, sf_dir):
    """Dense daily series per (store, category), first to last day of each series."""
    d = daily(spark, sf_dir)
    b = d.groupBy("store_id", "category").agg(F.min("date").alias("d0"), F.max("date").alias("d1"))
    g = b.select("store_id", "category", F.explode(F.sequence("d0", "d1")).alias("date"))
    return g.join(d, ["store_id", "category", "date"], "left") \
            .withColumn("y", F.coalesce("items", F.lit(0)).cast("bigint")).drop("items")


def naive_forecast(spark, sf_dir):
    w = Window.partitionBy("store_id", "category").orderBy("date").rowsBetween(-7, -1)
    s = series_daily(spark, sf_dir)
    s = s.select("*", F.avg("y").over(w).alias("yhat"), F.min("y").over(w).alias("lo"),
                 F.max("y").over(w).alias("hi"), F.count("y").over(w).alias("_c"))
    return s.where(F.col("_c") == 7).drop("_c")


SERIES_SQL = (S.daily_long_cte(),
              "sb AS (SELECT store_id, category, min(date) AS d0, max(date) AS d1 FROM daily GROUP BY ALL)",
              "sg AS (SELECT store_id, category, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS date FROM sb)",
              "ser AS (SELECT g.store_id, g.category, g.date, CAST(coalesce(d.items, 0) AS BIGINT) AS y FROM sg g LEFT JOIN daily d "
              "ON g.store_id = d.store_id AND g.category = d.category AND g.date = d.date)",
              "nf0 AS (SELECT *, avg(y) OVER w AS yhat, min(y) OVER w AS lo, max(y) OVER w AS hi, count(y) OVER w AS c FROM ser "
              "WINDOW w AS (PARTITION BY store_id, category ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))",
              "nf AS (SELECT * FROM nf0 WHERE c = 7)")

MET = "avg(abs(y - yhat)) AS mae, avg((y - yhat) * (y - yhat)) AS mse, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, count(*) AS n"


@query("naive_metrics", "A10 A11 A12",
       _with(*SERIES_SQL, f"pc AS (SELECT category, {MET} FROM nf GROUP BY category)",
             "allr AS (SELECT 'ALL' AS category, avg(mae) AS mae, avg(mse) AS mse, sqrt(avg(mse)) AS rmse, sum(n) AS n FROM pc)",
             "u AS (SELECT * FROM pc UNION ALL SELECT * FROM allr)")
       + "SELECT category, round(mae, 6) AS mae, round(mse, 6) AS mse, round(rmse, 6) AS rmse, CAST(n AS BIGINT) AS n FROM u")
def naive_metrics(spark, sf_dir):
    per = metrics.per_target(naive_forecast(spark, sf_dir), ["category"])
    out = metrics.with_uniform_total(per, "category")
    return metrics.round6(out, ["mae", "mse", "rmse"]).withColumn("n", F.col("n").cast("bigint"))


@query("store_metrics", "A13",
       _with(*SERIES_SQL) + "SELECT store_id, category, round(avg(abs(y - yhat)), 6) AS mae, round(avg((y - yhat) * (y - yhat)), 6) AS mse, "
       "round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse, count(*) AS n FROM nf GROUP BY store_id, category")
def store_metrics(spark, sf_dir):
    per = metrics.per_target(naive_forecast(spark, sf_dir), ["store_id", "category"])
    return metrics.round6(per, ["mae", "mse", "rmse"])


@query("fold_summary", "A15 M14 M17",
       _with(*SERIES_SQL,
             "rk AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS rank, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM ser))",
             "q AS (SELECT date, CAST((n - rank - 1) // (n // 6) + 1 AS INTEGER) AS j FROM rk)",
             "ft AS (SELECT 5 - j AS fold, date FROM q WHERE j BETWEEN 1 AND 5)",
             "pf AS (SELECT ft.fold, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse FROM nf JOIN ft ON nf.date = ft.date GROUP BY ft.fold)")
       + "SELECT 'mae' AS metric, round(avg(mae), 6) AS mean, round(stddev_pop(mae), 6) AS std FROM pf "
         "UNION ALL SELECT 'rmse', round(avg(rmse), 6), round(stddev_pop(rmse), 6) FROM pf")
def fold_summary(spark, sf_dir):
    nf = naive_forecast(spark, sf_dir)
    folds = splits.expanding_folds(series_daily(spark, sf_dir), 5).where("role = 'test'").select("fold", "date")
    per_fold = nf.join(folds, "date").groupBy("fold").agg(metrics.mae().alias("mae"), metrics.rmse().alias("rmse"))
    return metrics.round6(metrics.fold_summary(per_fold, ["mae", "rmse"]), ["mean", "std"])


@query("coverage", "A14 M11",
       _with(*SERIES_SQL) + "SELECT category, round(avg(CAST(y BETWEEN lo AND hi AS DOUBLE)), 6) AS coverage, count(*) AS n "
       "FROM nf GROUP BY category")
def coverage(spark, sf_dir):
    nf = naive_forecast(spark, sf_dir)
    return nf.groupBy("category").agg(F.round(metrics.coverage(), 6).alias("coverage"), F.count(F.lit(1)).alias("n"))


# --- S8, A17, A18, A24: lenient date parsing and data-range profile ---------------------------------------

@query("date_quality", "S8 A17 A18 A24 F13",
       "WITH raw AS (SELECT o.o_orderkey, CASE WHEN o.o_orderstatus = 'P' THEN 'pending' ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS raw_date, "
       "CAST(n.n_regionkey AS INTEGER) AS store_id FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
       "JOIN nation n ON c.c_nationkey = n.n_nationkey), p AS (SELECT *, CAST(try_strptime(raw_date, '%Y-%m-%d') AS DATE) AS d FROM raw)\n"
       "SELECT count(*) FILTER (WHERE d IS NULL) AS bad_dates, min(d) AS min_date, max(d) AS max_date, "
       "CAST(datediff('day', min(d), max(d)) + 1 AS INTEGER) AS span_days, count(DISTINCT d) AS distinct_dates, "
       "count(DISTINCT store_id) AS distinct_stores, CAST(datediff('day', min(d), max(d)) + 1 - count(DISTINCT d) AS BIGINT) AS missing_dates FROM p")
def date_quality(spark, sf_dir):
    """Dates arrive as strings (pending orders carry a placeholder); parse leniently with
    ``try_to_date`` (ANSI-safe) and profile the range in one aggregation."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    raw = F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    p = j.select(F.try_to_date(raw, "yyyy-MM-dd").alias("d"), F.col("n_regionkey").cast("int").alias("store_id"))
    span = F.datediff(F.max("d"), F.min("d")) + 1
    return p.agg(F.count_if(F.col("d").isNull()).alias("bad_dates"), F.min("d").alias("min_date"),
                 F.max("d").alias("max_date"), span.cast("int").alias("span_days"),
                 F.countDistinct("d").alias("distinct_dates"), F.countDistinct("store_id").alias("distinct_stores"),
                 (span - F.countDistinct("d")).cast("bigint").alias("missing_dates"))


# --- A21: pivot for export, first value wins ------------------------------------------------------------

STORES_B = [0, 1, 2, 3, 4]        # regions of the driver tables = stores of adapter B; others share a column


@query("store_pivot_daily", "A21 J7 F19",
       _with(S.daily_long_cte(), S.store_totals_cte())
       + "SELECT date, " + ", ".join(f"first(y) FILTER (WHERE store_id = {s}) AS store_{s}" for s in STORES_B)
       + f", CAST(sum(y) FILTER (WHERE store_id IS NULL OR store_id NOT IN ({', '.join(map(str, STORES_B))})) AS BIGINT) AS store_other"
       + " FROM tot GROUP BY date")
def store_pivot_daily(spark, sf_dir, stores: list[int] = STORES_B):
    """Daily totals with one column per listed store (one row per store and date, so the sum is
    that row) and one for all others together, in one conditional aggregation."""
    t = adapters.daily_store_totals(spark, sf_dir)
    rest = F.col("store_id").isNull() | ~F.col("store_id").isin(*stores)
    return t.groupBy("date").agg(*[F.sum(F.when(F.col("store_id") == s, F.col("y"))).cast("bigint").alias(f"store_{s}") for s in stores],
                                 F.sum(F.when(rest, F.col("y"))).cast("bigint").alias("store_other"))
