"""Slot-level queries over adapter A (``events``): clean, grid, calendar, roll-up, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.timecols import add_time_columns, level_time_columns, slot_label
from ..operators import clean, explore, grid, rollup
from ..sources import adapters, dims
from . import sqlparts as S
from .registry import query

CATS = dims.CATEGORIES
MEAS = CATS + [dims.TOTAL]
ADAPTER_CATS = [c for _, c in adapters.EVENT_CATEGORY]   # categories adapter A fills


def wide(spark, sf_dir):
    return adapters.slot_sales_wide(spark, sf_dir)


def wide_open(spark, sf_dir):
    return clean.opening_hours(wide(spark, sf_dir))


def fixture(spark, sf_dir):
    return clean.late_intro_fixture(wide_open(spark, sf_dir))


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- S1/S4/P3/F17 -------------------------------------------------------------------------

@query("slot_sales_wide", "S1 S4 P3 F17",
       _with(S.wide_cte()) + "SELECT * FROM wide")
def slot_sales_wide(spark, sf_dir):
    return wide(spark, sf_dir)


@query("slot_sales_long", "F17 U1",
       _with(S.wide_cte()) + "SELECT store_id, datetime, category, items FROM wide "
       f"UNPIVOT (items FOR category IN ({', '.join(CATS)})) WHERE items <> 0")
def slot_sales_long(spark, sf_dir):
    """Wide -> long with ``unpivot`` (explicit value list), zero cells dropped."""
    w = wide(spark, sf_dir)
    return w.unpivot(["store_id", "datetime"], CATS, "category", "items").where("items <> 0")


@query("combined_store_sales", "S2 A1",
       _with(S.wide_cte()) + "SELECT datetime, " + ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in MEAS)
       + " FROM wide GROUP BY datetime")
def combined_store_sales(spark, sf_dir):
    return rollup.combine_stores(wide(spark, sf_dir), MEAS)


@query("opening_hours_filter", "P1 P18",
       _with(S.wide_cte(), S.open_cte()) + "SELECT *, strftime(datetime, '%H:%M') AS slot_label FROM wopen")
def opening_hours_filter(spark, sf_dir):
    return clean.opening_hours(wide(spark, sf_dir)).withColumn("slot_label", slot_label("datetime"))


@query("zero_column_profile", "P2",
       _with(S.wide_cte(), S.open_cte()) + " UNION ALL ".join(
           f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL OR {c} <> 0) AS BIGINT) AS nonzero_rows, "
           f"count(*) FILTER (WHERE {c} IS NULL OR {c} <> 0) > 0 AS kept FROM wopen" for c in CATS))
def zero_column_profile(spark, sf_dir):
    return clean.zero_column_profile(wide_open(spark, sf_dir), CATS)


def _adjust_sql() -> str:
    seq = "greatest(greatest(OTHER - CONDIMENT, 0) - BAKED_GOOD, 0)"
    late = ["CONDIMENT", "BAKED_GOOD"]
    z = {c: f"CASE WHEN TOTAL_SALES = 0 THEN 0 ELSE greatest({c}, 0) END" for c in late}
    total = " + ".join(c if c != "OTHER" else "OTHER_seq" for c in CATS)
    return (_with(S.wide_cte(), S.open_cte(),
                  "adj AS (SELECT store_id, datetime, " + ", ".join(c for c in CATS if c not in late)
                  + ", " + ", ".join(f"CAST({z[c]} AS BIGINT) AS {c}" for c in late) + " FROM wopen)",
                  f"adj2 AS (SELECT *, CAST({seq} AS BIGINT) AS OTHER_seq, "
                  f"CAST(greatest(OTHER - CONDIMENT - BAKED_GOOD, 0) AS BIGINT) AS OTHER_joint FROM adj)")
            + f"SELECT store_id, datetime, CONDIMENT, BAKED_GOOD, OTHER_seq, OTHER_joint, CAST({total} AS BIGINT) AS TOTAL_SALES FROM adj2")


@query("adjust_other_total", "P4 P5 P6 P7 P8", _adjust_sql())
def adjust_other_total(spark, sf_dir):
    late = dims.LATE_CATEGORIES
    df = wide_open(spark, sf_dir)
    for c in late:                                   # P5 + P6 clip
        df = clean.adjust_zero_sales(df, c).withColumn(c, F.greatest(F.col(c), F.lit(0)).cast("bigint"))
    df = clean.adjust_other_joint(df.withColumn("OTHER_joint", F.col("OTHER")), late, other="OTHER_joint")  # P8
    df = clean.add_total(clean.adjust_other_sequential(df, late), CATS)                                   # P7, P4
    return df.select("store_id", "datetime", "CONDIMENT", "BAKED_GOOD", F.col("OTHER").cast("bigint").alias("OTHER_seq"),
                     F.col("OTHER_joint").cast("bigint"), dims.TOTAL)


@query("first_time_sold", "P10 Q3",
       _with(S.wide_cte(), S.open_cte(), S.late_fixture_cte()) + " UNION ALL ".join(
           f"SELECT store_id, '{c}' AS category, min(CASE WHEN {c} <> 0 THEN datetime END) AS first_sold "
           f"FROM fixture GROUP BY store_id" for c in CATS))
def first_time_sold(spark, sf_dir):
    return clean.first_time_sold(fixture(spark, sf_dir), CATS)


@query("trim_after_first_sold", "P11 P12 P13",
       _with(S.wide_cte(), S.open_cte(), S.late_fixture_cte(),
             "cut AS (SELECT store_id, min(CASE WHEN CONDIMENT <> 0 THEN datetime END) AS cutoff FROM fixture GROUP BY store_id)")
       + "SELECT f.store_id, f.datetime, f.CONDIMENT, f.BAKED_GOOD, f.OTHER, "
         "CAST(CASE WHEN f.datetime >= c.cutoff THEN f.OTHER + f.CONDIMENT + f.BAKED_GOOD ELSE f.OTHER END AS BIGINT) AS OTHER_inflated, "
         "CAST(f.datetime >= c.cutoff AS INTEGER) AS after_cutoff "
         "FROM fixture f JOIN cut c ON f.store_id = c.store_id WHERE f.datetime >= c.cutoff")
def trim_after_first_sold(spark, sf_dir):
    df = clean.with_cutoff(fixture(spark, sf_dir), "CONDIMENT")
    after = F.col("datetime") >= F.col("cutoff")
    df = clean.inflate_other(df, dims.LATE_CATEGORIES, after, name="OTHER_inflated")
    return (df.where(after)
              .select("store_id", "datetime", "CONDIMENT", "BAKED_GOOD", "OTHER",
                      F.col("OTHER_inflated").cast("bigint"), after.cast("int").alias("after_cutoff")))


# --- grids (J1, J4-J6) --------------------------------------------------------------------

GRID_PAD = 31       # days added before the first and after the last observed day


@query("calendar_grid_fill", "J1 F9 F10",
       _with(S.wide_cte(), S.open_cte(), S.grid_sql("wopen", "g", "day", "2023-01-01", "2024-12-31", dims.OPENING_SLOTS, cover=True))
       + "SELECT * FROM g")
def calendar_grid_fill(spark, sf_dir):
    return grid.calendar_grid_fill(wide_open(spark, sf_dir), MEAS)


@query("grid_interval", "J4 F10", _with(S.wide_cte(), S.grid_sql("wide", "g", "interval")) + "SELECT * FROM g")
def grid_interval(spark, sf_dir):
    return grid.dense_grid(wide(spark, sf_dir), "interval", MEAS)


@query("grid_day", "J5 F10",
       _with(S.wide_cte(), S.open_cte(), S.grid_sql("wopen", "g", "day", pad=GRID_PAD)) + "SELECT * FROM g")
def grid_day(spark, sf_dir):
    return grid.dense_grid(wide_open(spark, sf_dir), "day", MEAS, pad_days=GRID_PAD)


@query("grid_period", "J6 U4",
       _with(S.wide_cte(), S.open_cte(), S.grid_sql("wopen", "g", "period", pad=GRID_PAD)) + "SELECT * FROM g")
def grid_period(spark, sf_dir):
    return grid.dense_grid(wide_open(spark, sf_dir), "period", MEAS, pad_days=GRID_PAD)


# --- calendar and time features (C1-C6, C12, F1-F7) -----------------------------------------

@query("calendar_features", "C1 C2 C3 C4 C5 C6 J2 J3",
       _with(S.wide_cte(), S.grid_sql("wide", "g", "interval"), S.semester_values_cte())
       + f"SELECT g.store_id, g.datetime, {S.calendar_select('g.datetime')} FROM g {S.calendar_joins('g')}")
def calendar_features(spark, sf_dir):
    g = grid.dense_grid(wide(spark, sf_dir), "interval", MEAS).select("store_id", "datetime")
    return cal.add_calendar_columns(g, "datetime")


@query("time_features", "C12 F1 F2 F3 F4 F5 F6 F7",
       _with(S.wide_cte(), S.open_cte())
       + "SELECT store_id, datetime, CAST(year(datetime) AS INTEGER) AS year, CAST(month(datetime) AS INTEGER) AS month, "
         "CAST(week(datetime) AS INTEGER) AS week, CAST(isodow(datetime) - 1 AS INTEGER) AS weekday, "
         "CAST(day(datetime) AS INTEGER) AS day, CAST(hour(datetime) AS INTEGER) AS hour, "
         "CAST(minute(datetime) AS INTEGER) AS minute, CAST(hour(datetime) * 4 + minute(datetime) // 15 AS INTEGER) AS interval, "
         "CAST((hour(datetime) * 4 + minute(datetime) // 15) % 4 AS INTEGER) AS slot_of_hour, "
         "CAST(datetime AS DATE) AS date, strftime(datetime, '%H:%M') AS slot_label FROM wopen")
def time_features(spark, sf_dir):
    df = add_time_columns(wide_open(spark, sf_dir).select("store_id", "datetime"), "datetime")
    return df.withColumns({"slot_of_hour": F.pmod("interval", F.lit(4)).cast("int"),
                           "date": F.to_date("datetime"), "slot_label": slot_label("datetime")})


# --- level roll-ups (A2, F8, P25) -----------------------------------------------------------

def _rollup_frame(spark, sf_dir, start: str | None = None, end: str | None = None):
    """Reference order (F20): cleaned slots -> 96-slot densify -> period densify. The bounds default to
    the data's own first and last day, so no sale is left out; given bounds cut and extend."""
    return grid.model_grid(wide_open(spark, sf_dir), MEAS, add_missing_intervals=True,
                           add_missing_days=False, start=start, end=end)


def _rollup_sql(level: str) -> str:
    tcols = level_time_columns(level)
    ccols = cal.LEVEL_CALENDAR[level]
    tex = {"year": "year(datetime)", "month": "month(datetime)", "week": "week(datetime)",
           "weekday": "isodow(datetime) - 1", "day": "day(datetime)", "hour": "hour(datetime)",
           "interval": "hour(datetime) * 4 + minute(datetime) // 15"}
    date = "CAST(datetime AS DATE)" if level in ("interval", "hour", "day") else "CAST(date_trunc('month', datetime) AS DATE)"
    sel = ", ".join(f"CAST({tex[c]} AS INTEGER) AS {c}" for c in tcols)
    keys = ["date", "store_id"] + tcols + ccols
    sums = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in MEAS)
    return (_with(S.wide_cte(), S.open_cte(),
                  S.grid_sql("wopen", "g1", "interval"),
                  S.grid_sql("g1", "g2", "period"),
                  S.semester_values_cte(),
                  f"feat AS (SELECT g2.*, {date} AS pdate, {sel}, {S.calendar_select('g2.datetime')} FROM g2 {S.calendar_joins('g2')})")
            + f"SELECT pdate AS date, {', '.join(keys[1:])}, {sums} FROM feat GROUP BY pdate, {', '.join(keys[1:])}")


def _make_rollup(level):
    def q(spark, sf_dir):
        return rollup.level_rollup(_rollup_frame(spark, sf_dir), level, MEAS)
    q.__name__ = f"level_rollup_{level}"
    return q


for _lvl in ("interval", "hour", "day", "week"):
    query(f"level_rollup_{_lvl}", "A2 F8 P25 M27", _rollup_sql(_lvl))(_make_rollup(_lvl))


# --- profiles and correlations (A3-A9, O3, O4) -----------------------------------------------

CORR_COLS = MEAS
SUM_CATS = " + ".join(CATS)


@query("daily_totals", "A3",
       _with(S.wide_cte(), S.open_cte()) + "SELECT store_id, CAST(datetime AS DATE) AS date, "
       + ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in MEAS) + " FROM wopen GROUP BY ALL")
def daily_totals(spark, sf_dir):
    return explore.daily_totals(wide_open(spark, sf_dir), MEAS)


@query("weekday_profile", "A4 Q14",
       _with(S.wide_cte(), S.open_cte()) + f"SELECT store_id, CAST(isodow(datetime) - 1 AS INTEGER) AS weekday, "
       f"round(avg({SUM_CATS}), 6) AS mean_total FROM wopen GROUP BY ALL")
def weekday_profile(spark, sf_dir):
    return explore.weekday_profile(wide_open(spark, sf_dir), CATS).withColumn("weekday", F.col("weekday").cast("int"))


@query("weekday_slot_profile", "A5 P18",
       _with(S.wide_cte(), S.open_cte(),
             f"p AS (SELECT store_id, CAST(isodow(datetime) - 1 AS INTEGER) AS weekday, strftime(datetime, '%H:%M') AS slot_label, "
             f"avg({SUM_CATS}) AS m FROM wopen WHERE strftime(datetime, '%H:%M') IN ({S.slots_in_list()}) GROUP BY ALL)",
             f"fr AS (SELECT s.store_id, CAST(w.weekday AS INTEGER) AS weekday, l.slot_label FROM (SELECT DISTINCT store_id FROM wopen) s, "
             f"(SELECT unnest(generate_series(0, 6)) AS weekday) w, (SELECT unnest([{S.slots_in_list()}]) AS slot_label) l)")
       + "SELECT fr.store_id, fr.weekday, fr.slot_label, round(coalesce(p.m, 0.0), 6) AS mean_total FROM fr LEFT JOIN p "
         "ON fr.store_id = p.store_id AND fr.weekday = p.weekday AND fr.slot_label = p.slot_label")
def weekday_slot_profile(spark, sf_dir):
    return explore.weekday_slot_profile(wide_open(spark, sf_dir), CATS).withColumn("weekday", F.col("weekday").cast("int"))


@query("category_daily", "A6 P17",
       _with(S.wide_cte(), S.open_cte(),
             "d AS (SELECT store_id, CAST(datetime AS DATE) AS date, " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in CATS)
             + " FROM wopen WHERE isodow(datetime) <= 5 GROUP BY ALL)")
       + f"SELECT store_id, date, category, items FROM d UNPIVOT (items FOR category IN ({', '.join(CATS)}))")
def category_daily(spark, sf_dir):
    return explore.category_daily(wide_open(spark, sf_dir), CATS)


@query("weekday_daily_total", "A7 P17",
       _with(S.wide_cte(), S.open_cte()) + f"SELECT store_id, CAST(datetime AS DATE) AS date, CAST(sum({SUM_CATS}) AS BIGINT) AS total_sales "
       "FROM wopen WHERE isodow(datetime) <= 5 GROUP BY ALL")
def weekday_daily_total(spark, sf_dir):
    return explore.weekday_daily_total(wide_open(spark, sf_dir), CATS)


def _corr_sql() -> str:
    parts = [f"SELECT store_id, '{a}' AS col_a, '{b}' AS col_b, "
             f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN round(corr({a}, {b}), 6) END AS corr FROM wopen GROUP BY store_id"
             for a in CORR_COLS for b in CORR_COLS]
    return _with(S.wide_cte(), S.open_cte()) + " UNION ALL ".join(parts)


@query("correlation_long", "A8 S14 P23", _corr_sql())
def correlation_long(spark, sf_dir):
    return explore.correlation_long(wide_open(spark, sf_dir), CORR_COLS)


def _top_sql() -> str:
    body = _corr_sql().split("\n")[-1]
    ctes = _with(S.wide_cte(), S.open_cte(), f"cl AS ({body})")
    late = ", ".join(f"'{c}'" for c in dims.LATE_CATEGORIES)
    sel = []
    for variant, k, excl in (("A", 7, late), ("B", 6, "''")):
        sel.append(f"""SELECT store_id, target, '{variant}' AS variant, CAST(rank AS INTEGER) AS rank, predictor, corr FROM (
  SELECT store_id, col_a AS target, col_b AS predictor, corr,
         row_number() OVER (PARTITION BY store_id, col_a ORDER BY corr DESC NULLS LAST, col_b) AS rank
  FROM cl WHERE col_a IN ({late}) AND col_b <> col_a AND col_b NOT IN ({excl})) WHERE rank <= {k}""")
    return ctes + " UNION ALL ".join(sel)


@query("top_correlates", "O3 O4", _top_sql())
def top_correlates(spark, sf_dir):
    cl = explore.correlation_long(wide_open(spark, sf_dir), CORR_COLS)
    a = explore.top_correlates(cl, dims.LATE_CATEGORIES, 7, dims.LATE_CATEGORIES, "A")
    b = explore.top_correlates(cl, dims.LATE_CATEGORIES, 6, [], "B")
    return a.unionByName(b)


@query("category_moments", "A9",
       _with(S.wide_cte(), S.open_cte()) + " UNION ALL ".join(
           f"SELECT store_id, '{c}' AS column_name, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std_samp, "
           f"round(stddev_pop({c}), 6) AS std_pop FROM wopen GROUP BY store_id" for c in CORR_COLS))
def category_moments(spark, sf_dir):
    return explore.moments(wide_open(spark, sf_dir), CORR_COLS)


# --- S7: daily series per store (ds, y) -----------------------------------------------------------------

@query("daily_store_series", "S7 S3",
       _with(S.wide_cte(), S.open_cte()) + "SELECT store_id, CAST(datetime AS DATE) AS ds, CAST(sum(TOTAL_SALES) AS BIGINT) AS y "
       "FROM wopen WHERE store_id = 1 GROUP BY ALL")
def daily_store_series(spark, sf_dir, store_id: int = 1):
    """Daily total of one store renamed to (ds, y); the store filter sits right after the
    scan (on a store-partitioned table it prunes partitions)."""
    w = wide_open(spark, sf_dir).where(F.col("store_id") == store_id)
    return w.groupBy("store_id", F.to_date("datetime").alias("ds")).agg(F.sum(dims.TOTAL).cast("bigint").alias("y"))


def _total_rollup_sql() -> str:
    tcols = level_time_columns("day")
    ccols = cal.LEVEL_CALENDAR["day"]
    tex = {"year": "year(datetime)", "month": "month(datetime)", "week": "week(datetime)",
           "weekday": "isodow(datetime) - 1", "day": "day(datetime)"}
    sel = ", ".join(f"CAST({tex[c]} AS INTEGER) AS {c}" for c in tcols)
    sums = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in MEAS)
    comb = "comb AS (SELECT datetime, " + ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in MEAS) + " FROM wopen GROUP BY datetime)"
    return (_with(S.wide_cte(), S.open_cte(), comb,
                  S.grid_sql("comb", "g1", "interval", stores=False),
                  S.grid_sql("g1", "g2", "period", stores=False),
                  S.semester_values_cte(),
                  f"feat AS (SELECT g2.*, {sel}, {S.calendar_select('g2.datetime')} FROM g2 {S.calendar_joins('g2')})")
            + f"SELECT date, {', '.join(tcols + ccols)}, {sums} FROM feat GROUP BY date, {', '.join(tcols + ccols)}")


@query("level_rollup_day_total", "S2 F20 M20 M27 A2", _total_rollup_sql())
def level_rollup_day_total(spark, sf_dir):
    """Model frame with ``store_ids=None``: the summed-store scan (S2), then the reference's
    densify order (F20), time + calendar keys, day roll-up."""
    return rollup.model_frame(wide_open(spark, sf_dir), rollup.FrameSpec("day", targets=tuple(MEAS), stores=rollup.SUMMED))
