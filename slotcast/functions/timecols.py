"""Time-key column expressions (F1-F16, C12). All built-in, codegen friendly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIME_COLUMNS = ["year", "month", "week", "weekday", "day", "hour", "interval"]
LEVEL_ALIASES = {"int": "interval"}
# Period a level's ``date`` key is truncated to (F8); semester/year keep the year.
DATE_LEVEL = {"interval": "day", "hour": "day", "day": "day", "week": "month",
              "month": "month", "semester": "year", "year": "year"}


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def slot_start(ts) -> Column:
    """Floor a TIMESTAMP_NTZ to its 15-minute slot (stays NTZ, no time-zone hop)."""
    return F.window(col(ts), "15 minutes").start


def minute_of_day(ts) -> Column:
    return F.hour(col(ts)) * 60 + F.minute(col(ts))


def slot_of_day(ts) -> Column:
    """hour*4 + minute//15, 0..95."""
    return (F.hour(col(ts)) * 4 + F.floor(F.minute(col(ts)) / 15)).cast("int")


def slot_label(ts) -> Column:
    """``HH:mm``."""
    return F.date_format(col(ts), "HH:mm")


def slot_timestamp(date, slot) -> Column:
    """date + slot-of-day -> TIMESTAMP_NTZ."""
    return F.timestamp_add("MINUTE", col(slot) * 15, col(date).cast("timestamp_ntz"))


def half_even(x) -> Column:
    """Round half to even (numpy/pandas ``round``); Spark ``round`` is half-up."""
    return F.rint(col(x))


def time_columns(ts) -> dict[str, Column]:
    """Every time column of the model frame, by name."""
    t = col(ts)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "week": F.weekofyear(t),          # ISO week
        "weekday": F.weekday(t),          # Monday = 0
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "minute": F.minute(t),
        "interval": slot_of_day(t),
    }


def add_time_columns(df: DataFrame, ts: str = "datetime", names: list[str] | None = None) -> DataFrame:
    cols = time_columns(ts)
    names = names or list(cols)
    return df.withColumns({n: cols[n].cast("int") for n in names})


def level_time_columns(level: str) -> list[str]:
    """Time keys of a level: prefix of year..interval up to the level."""
    level = LEVEL_ALIASES.get(level, level)
    return TIME_COLUMNS[: TIME_COLUMNS.index(level) + 1]


def period_start(ts, level: str) -> Column:
    """F8 re-aimed (Q9): DATE of the period start instead of a ``%Y-%m`` string."""
    unit = DATE_LEVEL[LEVEL_ALIASES.get(level, level)]
    if unit == "day":
        return F.to_date(col(ts))
    return F.to_date(F.date_trunc(unit, col(ts)))


def parse_model_name(name: str) -> dict:
    """F16: ``{temporal}_{location}_{category}`` -> level spec."""
    temporal, location, category = name.split("_")
    temporal = LEVEL_ALIASES.get(temporal, temporal)
    return {"temporal": temporal, "per_store": location == "all", "per_category": category == "all"}
