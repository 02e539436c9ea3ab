"""Calendar features.

Holiday membership is an IN-list over 30 fixed dates (no join at all). The semester
features need one broadcast join of a 3-row literal table on ``year``; a missing year
raises an error inside the query (as the reference raises ValueError).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import dims
from .timecols import col, slot_label

CALENDAR_COLUMNS = ["holiday", "open", "semester_uni", "semester_hs", "semester_phase_uni", "semester_phase_hs"]
# Calendar keys kept per hierarchy level.
LEVEL_CALENDAR = {
    "interval": ["semester_phase_uni", "semester_phase_hs", "semester_uni", "semester_hs", "holiday", "open"],
    "hour": ["semester_phase_uni", "semester_phase_hs", "semester_uni", "semester_hs", "holiday", "open"],
    "day": ["semester_phase_uni", "semester_phase_hs", "semester_uni", "semester_hs", "holiday"],
    "week": ["semester_phase_uni", "semester_phase_hs", "semester_uni", "semester_hs"],
}


def holiday_flag(ts) -> Column:
    """1 when the day is a public holiday."""
    return F.to_date(col(ts)).isin([d for d, _ in dims.HOLIDAYS]).cast("int")


def open_flag(ts) -> Column:
    """Exact opening slot and not a holiday (weekends count as open, Q33)."""
    return (slot_label(ts).isin(dims.OPENING_SLOTS) & (holiday_flag(ts) == 0)).cast("int")


def _bounds(inst: str, literal: bool):
    """Boundary accessor. Default compares DATEs (Q5); ``literal`` compares the raw
    timestamp with midnight boundaries as the reference does."""
    def b(name):
        c = F.col(f"{name}_{inst}")
        return c.cast("timestamp_ntz") if literal else c
    return b


def semester_period(point: Column, inst: str, literal: bool = False) -> Column:
    """2 inside [SS_begin, SS_end], else 1."""
    b = _bounds(inst, literal)
    return F.when((point >= b("SS_begin")) & (point <= b("SS_end")), 2).otherwise(1)


def semester_phase(point: Column, inst: str, literal: bool = False) -> Column:
    """C4 as coded (Q4): 1 summer lectures, 2 winter lectures, 0 break."""
    b = _bounds(inst, literal)
    return (F.when((point >= b("SL_begin")) & (point <= b("SL_end")), 1)
            .when((point >= b("WL_begin")) & (point < b("Wb_begin")), 2)
            .when((point > b("Wb_end")) & (point <= b("WL_end")), 2)
            .otherwise(0))


def add_calendar_columns(df: DataFrame, ts: str = "datetime", literal: bool = False,
                         names: list[str] | None = None) -> DataFrame:
    """All six calendar columns with one broadcast join (3 literal rows)."""
    names = names or CALENDAR_COLUMNS
    spark = df.sparkSession
    sem = F.broadcast(dims.semester_wide(spark).withColumnRenamed("year", "_cal_year"))
    point = F.col(ts) if literal else F.to_date(F.col(ts))
    joined = df.join(sem, F.year(F.col(ts)) == F.col("_cal_year"), "left")
    missing = F.col("_cal_year").isNull()
    guard = F.raise_error(F.concat(F.lit("year "), F.year(F.col(ts)).cast("string"),
                                   F.lit(" not found in semester data")))
    exprs = {
        "holiday": holiday_flag(ts),
        "open": open_flag(ts),
        "semester_uni": semester_period(point, "uni", literal),
        "semester_hs": semester_period(point, "hs", literal),
        "semester_phase_uni": semester_phase(point, "uni", literal),
        "semester_phase_hs": semester_phase(point, "hs", literal),
    }
    out = joined.withColumns({
        n: (F.when(missing, guard.cast("int")).otherwise(exprs[n]) if n.startswith("semester") else exprs[n]).cast("int")
        for n in names})
    return out.drop(*[c for c in joined.columns if c not in df.columns])


# --- seasonal-model phase rules (C7-C9), pure month/day predicates ------------

def phase_rule_a(d) -> Column:
    d = F.to_date(col(d))
    m, day = F.month(d), F.dayofmonth(d)
    return (F.when(((m == 12) & (day >= 22)) | ((m == 1) & (day <= 2)), 0)
            .when(d.between(F.lit("2024-07-31").cast("date"), F.lit("2024-09-15").cast("date")), 0)
            .when((m >= 10) | (m <= 3), 1)
            .when(m.between(4, 7), 2)
            .otherwise(0))


def phase_rule_b(d) -> Column:
    d = F.to_date(col(d))
    return (F.when(d.between(F.lit("2024-10-01").cast("date"), F.lit("2025-03-31").cast("date")), 1)
            .when(d.between(F.lit("2025-04-01").cast("date"), F.lit("2025-09-30").cast("date")), 2)
            .otherwise(0))


def phase_rule_c(d) -> Column:
    """C9 with the unreachable last branch dropped (Q29): winter months -> 1, rest -> 2."""
    m = F.month(F.to_date(col(d)))
    return F.when((m >= 10) | (m <= 3), 1).otherwise(2)
