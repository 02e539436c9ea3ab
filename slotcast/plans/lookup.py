"""Batch look-up queries: every event becomes a timestamp request (error events carry a
malformed string, so validation is exercised)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof, explore, lookup
from ..session import cut_lineage
from ..sources import dims
from ..sources.tables import read_table
from . import slots as SL
from . import sqlparts as S
from .registry import query


def requests(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    req = F.concat(F.date_format("ts", lookup.ISO_FORMAT), F.when(F.col("event_type") == "error", "x").otherwise(""))
    return ev.select(F.col("event_id").alias("request_id"), (F.col("user_id") % 2 + 1).cast("int").alias("store_id"),
                     req.alias("request"))


REQ_SQL = ("req AS (SELECT event_id AS request_id, CAST(user_id % 2 + 1 AS INTEGER) AS store_id, "
           "strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_type = 'error' THEN 'x' ELSE '' END AS request FROM events)")
RES_SQL = ("rq AS (SELECT *, try_strptime(request, '%Y-%m-%dT%H:%M:%S') AS ts FROM req)",
           f"rs AS (SELECT request_id, store_id, request, CAST(ts IS NOT NULL AS INTEGER) AS is_valid, "
           f"CAST(ts AS DATE) + to_minutes(CAST(CASE WHEN hour(ts) * 60 + minute(ts) < {dims.OPEN_FIRST_MINUTE} "
           f"THEN {dims.OPEN_LAST_MINUTE - 1440} WHEN hour(ts) * 60 + minute(ts) >= {dims.OPEN_LAST_MINUTE} THEN {dims.OPEN_LAST_MINUTE} "
           "ELSE (hour(ts) * 60 + minute(ts)) // 15 * 15 END AS BIGINT)) AS slot_start FROM rq)",
           "rs2 AS (SELECT *, slot_start + INTERVAL 15 MINUTE AS slot_end FROM rs)")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


@query("lookup_closest_slot", "J10 L1 L2 F12 F13", _with(REQ_SQL, *RES_SQL) + "SELECT * FROM rs2")
def lookup_closest_slot(spark, sf_dir):
    return lookup.resolve(requests(spark, sf_dir))


@query("lookup_asof_sales", "J10 J11",
       _with(S.wide_cte(), S.open_cte())
       + "SELECT e.event_id AS request_id, e.store_id, e.ts AS request_time, w.datetime AS slot_time, w.TOTAL_SALES AS slot_total FROM "
         "(SELECT event_id, CAST(user_id % 2 + 1 AS INTEGER) AS store_id, ts FROM events) e "
         "ASOF LEFT JOIN wopen w ON e.store_id = w.store_id AND e.ts >= w.datetime")
def lookup_asof_sales(spark, sf_dir):
    """Every event asks for its store's latest slot with sales in opening hours, whatever the slots are."""
    asked = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"), (F.col("user_id") % 2 + 1).cast("int").alias("store_id"), F.col("ts").alias("request_time"))
    slots = SL.wide_open(spark, sf_dir).select("store_id", F.col("datetime").alias("slot_time"), F.col(dims.TOTAL).alias("slot_total"))
    return asof.asof_join(asked, slots, ["store_id"], "request_time", "slot_time")


SUM_CATS = " + ".join(dims.CATEGORIES)
PROFILE_SQL = (
    f"p AS (SELECT store_id, CAST(isodow(datetime) - 1 AS INTEGER) AS weekday, strftime(datetime, '%H:%M') AS slot_label, "
    f"avg({SUM_CATS}) AS m FROM wopen WHERE strftime(datetime, '%H:%M') IN ({S.slots_in_list()}) GROUP BY ALL)",
    f"fr AS (SELECT s.store_id, CAST(w.weekday AS INTEGER) AS weekday, l.slot_label FROM (SELECT DISTINCT store_id FROM wopen) s, "
    f"(SELECT unnest(generate_series(0, 6)) AS weekday) w, (SELECT unnest([{S.slots_in_list()}]) AS slot_label) l)",
    "prof AS (SELECT fr.store_id, fr.weekday, fr.slot_label, round(coalesce(p.m, 0.0), 6) AS mean_total FROM fr LEFT JOIN p "
    "ON fr.store_id = p.store_id AND fr.weekday = p.weekday AND fr.slot_label = p.slot_label)",
    "fc AS (SELECT rs2.*, CAST(w.TOTAL_SALES AS DOUBLE) AS hist, prof.mean_total AS pr FROM rs2 "
    "LEFT JOIN wide w ON w.store_id = rs2.store_id AND w.datetime = rs2.slot_start "
    "LEFT JOIN prof ON prof.store_id = rs2.store_id AND prof.weekday = isodow(rs2.slot_start) - 1 "
    "AND prof.slot_label = strftime(rs2.slot_start, '%H:%M'))",
    "fc2 AS (SELECT * EXCLUDE (hist, pr), CASE WHEN hist IS NOT NULL THEN 'history' WHEN pr IS NOT NULL THEN 'profile' END AS source, "
    "round(coalesce(hist, pr), 6) AS value, CAST(coalesce(hist, pr) IS NOT NULL AS INTEGER) AS available FROM fc)")


def _forecast(spark, sf_dir):
    res = lookup.resolve(requests(spark, sf_dir))
    prof = explore.weekday_slot_profile(SL.wide_open(spark, sf_dir), dims.CATEGORIES)
    return lookup.attach_forecast(res, SL.wide(spark, sf_dir), prof)


@query("lookup_forecast", "J11 J12 L4 L6 Q34",
       _with(REQ_SQL, *RES_SQL, S.wide_cte(), S.open_cte(), *PROFILE_SQL) + "SELECT * FROM fc2")
def lookup_forecast(spark, sf_dir):
    return _forecast(spark, sf_dir)


@query("lookup_response", "L3 L5 C13 H24",
       _with(REQ_SQL, *RES_SQL, S.wide_cte(), S.open_cte(), *PROFILE_SQL, S.semester_values_cte())
       + "SELECT fc2.request_id, fc2.store_id, fc2.is_valid, fc2.slot_start, fc2.slot_end, fc2.source, fc2.value, fc2.available, "
         "CAST(year(slot_start) AS INTEGER) AS year, CAST(month(slot_start) AS INTEGER) AS month, CAST(week(slot_start) AS INTEGER) AS week, "
         "CAST(day(slot_start) AS INTEGER) AS day, CAST(isodow(slot_start) - 1 AS INTEGER) AS weekday, CAST(hour(slot_start) AS INTEGER) AS hour, "
         "CAST(hour(slot_start) * 4 + minute(slot_start) // 15 AS INTEGER) AS interval, "
         f"{S.calendar_select('fc2.slot_start')} FROM fc2 {S.calendar_joins('fc2', 'slot_start')} WHERE fc2.is_valid = 1 "
         "UNION ALL BY NAME SELECT request_id, store_id, is_valid, slot_start, slot_end, source, value, available FROM fc2 WHERE is_valid = 0")
def lookup_response(spark, sf_dir):
    """One answer per request: an invalid one has is_valid = 0, available = 0 and no features."""
    fc = cut_lineage(_forecast(spark, sf_dir).drop("request"))
    valid = lookup.feature_record(fc.where("is_valid = 1"))
    return valid.unionByName(fc.where("is_valid = 0"), allowMissingColumns=True)
