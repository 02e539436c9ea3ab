"""Batch forecast lookup (L1-L6, J10-J12, C13), re-aimed from a one-request web handler to
a request TABLE: every request is a row, so millions of look-ups are one job.

The as-of step (closest previous opening slot) has a closed form over the eleven fixed
slots, so it is an expression, not a join. History and forecast look-ups are equi-joins
on (store_id, slot_start) / (store_id, weekday, slot label).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.timecols import minute_of_day, slot_label, time_columns
from ..sources import dims

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
# The ISO forms that a request may have: date alone, minutes, seconds, fractions; 'T' or a space between.
ISO_FORMATS = [ISO_FORMAT, "yyyy-MM-dd"] + [f"yyyy-MM-dd{sep}{time}" for sep in ("'T'", " ")
                                           for time in ("HH:mm:ss.SSSSSS", "HH:mm:ss.SSS", "HH:mm:ss", "HH:mm", "HH")
                                           if (sep, time) != ("'T'", "HH:mm:ss")]


def _shape(form: str) -> str:
    """What every text of an ISO format looks like: the year may have a sign and more digits, a fraction fewer."""
    fraction = re.sub(r"S+$", r"\\d+", form.replace("'T'", "[Tt]").replace(".S", "[.]S"))
    return "^" + re.sub(r"MM|dd|HH|mm|ss", r"\\d\\d", fraction.replace("yyyy", r"[+-]?\d+")) + "$"


def parse_request(request: Column) -> tuple[Column, Column]:
    """(is_valid, TIMESTAMP_NTZ) for an ISO timestamp string; invalid -> null, no error. A format is tried
    only on texts of its shape: a failed try costs an exception, which is far slower than a match."""
    ts = None
    for form in ISO_FORMATS:
        alike = F.when(request.rlike(_shape(form)), request)
        fits = F.try_to_timestamp(alike, F.lit(form)).isNotNull()
        one = F.to_timestamp_ntz(F.when(fits, alike), F.lit(form))
        ts = one if ts is None else F.coalesce(ts, one)
    return ts.isNotNull(), ts


def closest_previous_slot(ts: Column) -> Column:
    """Latest opening slot <= ts; before 11:30 it is the previous day's 14:00."""
    m = minute_of_day(ts)
    day = F.to_date(ts).cast("timestamp_ntz")
    last = dims.OPEN_LAST_MINUTE
    minutes = (F.when(m < dims.OPEN_FIRST_MINUTE, F.lit(last - 24 * 60))
               .when(m >= last, F.lit(last))
               .otherwise(F.floor(m / 15) * 15))
    return F.timestamp_add("MINUTE", minutes.cast("int"), day)


def resolve(requests: DataFrame, request_col: str = "request") -> DataFrame:
    _, ts = parse_request(F.col(request_col))
    parsed = requests.withColumn("_ts", ts)         # a column of its own, so that a row is parsed once for all its uses
    return parsed.withColumns({"is_valid": F.col("_ts").isNotNull().cast("int"), "slot_start": closest_previous_slot(F.col("_ts"))}) \
                 .drop("_ts").withColumn("slot_end", F.timestamp_add("MINUTE", F.lit(15), F.col("slot_start")))


def attach_forecast(resolved: DataFrame, history: DataFrame, profile: DataFrame, value: str = dims.TOTAL) -> DataFrame:
    """J11 + J12 + L4 (Q34): history value when the slot exists in history, else the
    weekday x slot profile; ``available`` says whether any value was found."""
    h = history.select("store_id", F.col("datetime").alias("slot_start"), F.col(value).cast("double").alias("_hist"))
    p = profile.select("store_id", "weekday", "slot_label", F.col("mean_total").alias("_prof"))
    r = resolved.withColumns({"weekday": F.weekday("slot_start"), "slot_label": slot_label("slot_start")})
    # invalid requests have no slot: they would all meet in one task of the joins. They get keys that spread them and
    # that no history or profile row has; filters would parse every request once more each.
    lone = F.pmod(F.xxhash64(F.to_json(F.struct("*"))), F.lit(1 << 30)).cast("int")
    r = r.withColumns({"_slot": F.coalesce("slot_start", F.timestamp_add("SECOND", lone, F.lit("0001-01-01").cast("timestamp_ntz"))),
                       "weekday": F.coalesce("weekday", -1 - lone), "slot_label": F.coalesce("slot_label", F.lit(""))})
    h = h.select(F.col("store_id").alias("_store"), F.col("slot_start").alias("_at"), "_hist")
    j = r.join(h, (F.col("store_id") == F.col("_store")) & (F.col("_slot") == F.col("_at")) & F.col("slot_start").isNotNull(), "left")
    j = j.join(p, ["store_id", "weekday", "slot_label"], "left")
    j = j.select("store_id", "slot_start", *[c for c in resolved.columns if c not in ("store_id", "slot_start")], "_hist", "_prof")
    src = F.when(F.col("_hist").isNotNull(), "history").when(F.col("_prof").isNotNull(), "profile")
    val = F.coalesce("_hist", "_prof")
    return j.withColumns({"source": src, "value": F.round(val, 6), "available": val.isNotNull().cast("int")}) \
            .drop("_hist", "_prof")


def serve(requests: DataFrame, forecast: DataFrame, history: DataFrame, keys: tuple[str, ...] = ("store_id", "date")) -> DataFrame:
    """The written forecast (``_f``) by key, else the actual (``_h``), else not available.
    Both sides have one row per key, so the request side alone can be skewed and AQE splits it."""
    j = requests.join(forecast, list(keys), "left").join(history, list(keys), "left")
    source = F.when(F.col("_f").isNotNull(), "forecast").when(F.col("_h").isNotNull(), "history")
    value = F.coalesce("_f", "_h")
    return j.select(*requests.columns, source.alias("source"), F.round(value, 6).alias("value"),
                    value.isNotNull().cast("int").alias("available"))


def feature_record(df: DataFrame, ts: str = "slot_start") -> DataFrame:
    """Time and calendar features of the (floored, Q33) request slot, including
    the slot index the reference forgot (Q26)."""
    tc = time_columns(ts)
    out = df.withColumns({n: tc[n].cast("int") for n in ["year", "month", "week", "day", "weekday", "hour", "interval"]})
    return cal.add_calendar_columns(out, ts)
