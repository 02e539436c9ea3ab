"""Fixed dimension data: holidays, academic calendar, opening slots, categories.

All lists below are FIXED VALUES that must equal the reference's calendar data for
right results. They are tiny constants (30 + 6 + 11 rows), so broadcasting them or
inlining them as IN-lists has a proven size bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES — public holidays in Lower Saxony, 2023-2025 (date, name).
# ---------------------------------------------------------------------------
HOLIDAYS = [
    ("2023-01-01", "Neujahr"),
    ("2023-04-07", "Karfreitag"),
    ("2023-04-10", "Ostermontag"),
    ("2023-05-01", "Maifeiertag"),
    ("2023-05-18", "Christi Himmelfahrt"),
    ("2023-05-29", "Pfingstmontag"),
    ("2023-10-03", "Tag der Deutschen Einheit"),
    ("2023-10-31", "Reformationstag"),
    ("2023-12-25", "1. Weihnachtstag"),
    ("2023-12-26", "2. Weihnachtstag"),
    ("2024-01-01", "Neujahr"),
    ("2024-03-29", "Karfreitag"),
    ("2024-04-01", "Ostermontag"),
    ("2024-05-01", "Maifeiertag"),
    ("2024-05-09", "Christi Himmelfahrt"),
    ("2024-05-20", "Pfingstmontag"),
    ("2024-10-03", "Tag der Deutschen Einheit"),
    ("2024-10-31", "Reformationstag"),
    ("2024-12-25", "1. Weihnachtstag"),
    ("2024-12-26", "2. Weihnachtstag"),
    ("2025-01-01", "Neujahr"),
    ("2025-04-18", "Karfreitag"),
    ("2025-04-21", "Ostermontag"),
    ("2025-05-01", "Maifeiertag"),
    ("2025-05-29", "Christi Himmelfahrt"),
    ("2025-06-09", "Pfingstmontag"),
    ("2025-10-03", "Tag der Deutschen Einheit"),
    ("2025-10-31", "Reformationstag"),
    ("2025-12-25", "1. Weihnachtstag"),
    ("2025-12-26", "2. Weihnachtstag"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — academic calendar per (institution, year).
# Columns: institution, year, Wb_end, WL_end, WS_end, SS_begin, SL_begin, SL_end,
#          SS_end, WS_begin, WL_begin, Wb_begin
# ---------------------------------------------------------------------------
SEMESTER_COLUMNS = ["institution", "year", "Wb_end", "WL_end", "WS_end", "SS_begin", "SL_begin",
                    "SL_end", "SS_end", "WS_begin", "WL_begin", "Wb_begin"]
SEMESTER_ROWS = [
    ("uni", 2023, "2023-01-07", "2023-02-11", "2023-03-31", "2023-04-01", "2023-04-11", "2023-07-15", "2023-09-30", "2023-10-01", "2023-10-16", "2023-12-23"),
    ("uni", 2024, "2024-01-06", "2024-02-03", "2024-03-31", "2024-04-01", "2024-04-02", "2024-07-06", "2024-09-30", "2024-10-01", "2024-10-28", "2024-12-21"),
    ("uni", 2025, "2025-01-04", "2025-02-15", "2025-03-31", "2025-04-01", "2025-04-14", "2025-07-19", "2025-09-30", "2025-10-01", "2025-10-13", "2025-12-20"),
    ("hs", 2023, "2023-01-07", "2023-01-31", "2023-02-28", "2023-03-01", "2023-03-03", "2023-07-05", "2023-08-31", "2023-09-01", "2023-09-22", "2023-12-23"),
    ("hs", 2024, "2024-01-07", "2024-01-31", "2024-02-29", "2024-03-01", "2024-03-03", "2024-07-05", "2024-08-31", "2024-09-01", "2024-09-22", "2024-12-23"),
    ("hs", 2025, "2025-01-07", "2025-01-31", "2025-02-28", "2025-03-01", "2025-03-03", "2025-07-05", "2025-08-31", "2025-09-01", "2025-09-22", "2025-12-23"),
]
INSTITUTIONS = ["uni", "hs"]

# FIXED VALUES — the eleven opening slots (11:30 to 14:00, every 15 minutes).
OPENING_SLOTS = ["11:30", "11:45", "12:00", "12:15", "12:30", "12:45",
                 "13:00", "13:15", "13:30", "13:45", "14:00"]
OPEN_FIRST_MINUTE = 11 * 60 + 30   # 690
OPEN_LAST_MINUTE = 14 * 60         # 840

# FIXED VALUES — the nine modelled sales categories, in the reference's order.
CATEGORIES = ["MAIN", "SIDE", "SOUP", "DESSERT", "SALAD", "BOTTLE", "BAKED_GOOD", "CONDIMENT", "OTHER"]
TOTAL = "TOTAL_SALES"
# The two categories introduced late and imputed by regression.
LATE_CATEGORIES = ["CONDIMENT", "BAKED_GOOD"]

# FIXED VALUES — custom holiday windows of the seasonal model (name, first, last, upper_window).
HOLIDAY_WINDOWS_A = [("Semester_Break", "2024-07-31", "2024-09-15", 0),
                     ("Christmas_Break", "2024-12-22", "2025-01-02", 0)]
HOLIDAY_WINDOWS_B = [("semester_break", "2024-07-15", "2024-09-15", 1),
                     ("christmas_break", "2024-12-22", "2025-01-02", 1)]


def holiday_df(spark: SparkSession) -> DataFrame:
    return (spark.createDataFrame(HOLIDAYS, "d string, name string")
            .select(F.to_date("d").alias("date"), "name"))


def semester_df(spark: SparkSession) -> DataFrame:
    schema = ", ".join(f"{c} {'int' if c == 'year' else 'string'}" for c in SEMESTER_COLUMNS)
    df = spark.createDataFrame(SEMESTER_ROWS, schema)
    return df.select("institution", "year",
                     *[F.to_date(c).alias(c) for c in SEMESTER_COLUMNS[2:]])


def semester_wide(spark: SparkSession) -> DataFrame:
    """One row per year with ``<column>_<institution>`` boundary columns, so all four
    semester features need a single broadcast join instead of four."""
    # joined here in Python: the result is a local relation, broadcast without any shuffle
    by_year: dict[int, dict[str, str]] = {}
    for row in SEMESTER_ROWS:
        inst, year = row[0], row[1]
        rec = by_year.setdefault(year, {})
        for c, v in zip(SEMESTER_COLUMNS[2:], row[2:]):
            rec[f"{c}_{inst}"] = v
    cols = [f"{c}_{inst}" for inst in INSTITUTIONS for c in SEMESTER_COLUMNS[2:]]
    rows = [(y, *[by_year[y].get(c) for c in cols]) for y in sorted(by_year)]
    df = spark.createDataFrame(rows, "year int, " + ", ".join(f"{c} string" for c in cols))
    return df.select("year", *[F.to_date(c).alias(c) for c in cols])


def holiday_window_df(spark: SparkSession, variant: str = "A") -> DataFrame:
    """Custom holiday windows exploded to one row per day."""
    rows = HOLIDAY_WINDOWS_A if variant == "A" else HOLIDAY_WINDOWS_B
    df = spark.createDataFrame(rows, "holiday string, first string, last string, upper_window int")
    return df.select(
        "holiday",
        F.explode(F.sequence(F.to_date("first"), F.to_date("last"))).alias("ds"),
        F.lit(0).alias("lower_window"), "upper_window")


def holiday_table(spark: SparkSession, variant: str = "A") -> DataFrame:
    """Public holidays and the custom windows in one table (holiday, ds, lower_window, upper_window)."""
    public = holiday_df(spark).select(F.col("name").alias("holiday"), F.col("date").alias("ds"),
                                      F.lit(0).alias("lower_window"), F.lit(0).alias("upper_window"))
    return public.unionByName(holiday_window_df(spark, variant))


def holiday_terms(variant: str = "A") -> tuple[str, ...]:
    """Names of the holiday terms: one per holiday and day of its window."""
    custom = HOLIDAY_WINDOWS_A if variant == "A" else HOLIDAY_WINDOWS_B
    return tuple(sorted({f"{n}_0" for _, n in HOLIDAYS} | {f"{n}_{d}" for n, _, _, up in custom for d in range(up + 1)}))


def holiday_days(spark: SparkSession, variant: str = "A") -> DataFrame:
    """(date, terms): the places in ``holiday_terms`` of the terms that hold on a day. Fixed, a few hundred rows."""
    day = F.explode(F.sequence("lower_window", "upper_window")).alias("d")
    names = F.array(*[F.lit(n) for n in holiday_terms(variant)])
    rows = holiday_table(spark, variant).select("holiday", "ds", day).select(
        F.date_add("ds", F.col("d")).alias("date"), F.concat_ws("_", "holiday", F.col("d").cast("string")).alias("term"))
    return rows.groupBy("date").agg(F.array_sort(F.collect_set((F.array_position(names, F.col("term")) - 1).cast("int"))).alias("terms"))
