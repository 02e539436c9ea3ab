"""Reusable DuckDB SQL fragments for the oracles, generated from the same fixed values
the Spark side uses (dims, adapter mapping)."""

from __future__ import annotations

from ..sources import adapters, dims

CATS = dims.CATEGORIES
TOTAL_EXPR = " + ".join(CATS)


def case_category(col: str = "event_type") -> str:
    whens = " ".join(f"WHEN '{ev}' THEN '{cat}'" for ev, cat in adapters.EVENT_CATEGORY)
    return f"CASE {col} {whens} END"


def wide_cte() -> str:
    """``wide``: adapter A slot table, one column per category + TOTAL_SALES."""
    counts = ",\n    ".join(f"CAST(count(*) FILTER (WHERE category = '{c}') AS BIGINT) AS {c}" for c in CATS)
    return f"""ev AS (
  SELECT CAST(user_id % 2 + 1 AS INTEGER) AS store_id,
         time_bucket(INTERVAL '15 minutes', ts) AS datetime,
         {case_category()} AS category
  FROM events),
wide0 AS (
  SELECT store_id, datetime,
    {counts}
  FROM ev GROUP BY store_id, datetime),
wide AS (SELECT *, CAST({TOTAL_EXPR} AS BIGINT) AS TOTAL_SALES FROM wide0)"""


def open_cte(src: str = "wide", name: str = "wopen") -> str:
    return (f"{name} AS (SELECT * FROM {src} "
            f"WHERE hour(datetime) * 60 + minute(datetime) BETWEEN {dims.OPEN_FIRST_MINUTE} AND {dims.OPEN_LAST_MINUTE})")


def late_fixture_cte(src: str = "wopen", name: str = "fixture", start: str = "2024-01-16") -> str:
    late = dims.LATE_CATEGORIES
    before = f"datetime < TIMESTAMP '{start} 00:00:00'"
    cols = []
    for c in CATS:
        if c in late:
            cols.append(f"CASE WHEN {before} THEN CAST(0 AS BIGINT) ELSE {c} END AS {c}")
        elif c == "OTHER":
            cols.append(f"CASE WHEN {before} THEN OTHER + {' + '.join(late)} ELSE OTHER END AS OTHER")
        else:
            cols.append(c)
    return f"{name} AS (SELECT store_id, datetime, {', '.join(cols)}, TOTAL_SALES FROM {src})"


def daily_long_cte(name: str = "daily", shift_years: int = 0) -> str:
    day = "CAST(o.o_orderdate AS DATE)"
    if shift_years:
        day = f"CAST({day} + INTERVAL {shift_years} YEAR AS DATE)"
    return f"""{name} AS (
  SELECT {day} AS date, CAST(n.n_regionkey AS INTEGER) AS store_id, o.o_orderpriority AS category,
         CAST(count(*) AS BIGINT) AS items
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY ALL)"""


def store_totals_cte(src: str = "daily", name: str = "tot") -> str:
    return f"{name} AS (SELECT store_id, date, CAST(sum(items) AS BIGINT) AS y FROM {src} GROUP BY store_id, date)"


def dense_totals_cte(src: str = "tot", name: str = "dense", fill: bool = True) -> str:
    y = "CAST(coalesce(t.y, 0) AS BIGINT)" if fill else "t.y"
    return f"""{name}_b AS (SELECT store_id, min(date) AS d0, max(date) AS d1 FROM {src} GROUP BY store_id),
{name}_g AS (SELECT store_id, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS date FROM {name}_b),
{name} AS (SELECT g.store_id, g.date, {y} AS y FROM {name}_g g LEFT JOIN {src} t
           ON g.store_id = t.store_id AND g.date = t.date)"""


def holiday_in_list() -> str:
    return ", ".join(f"DATE '{d}'" for d, _ in dims.HOLIDAYS)


def slots_in_list() -> str:
    return ", ".join(f"'{s}'" for s in dims.OPENING_SLOTS)


def semester_values_cte(name: str = "sem") -> str:
    rows = []
    for r in dims.SEMESTER_ROWS:
        vals = [f"'{r[0]}'", str(r[1])] + [f"DATE '{d}'" for d in r[2:]]
        rows.append("(" + ", ".join(vals) + ")")
    cols = ", ".join(dims.SEMESTER_COLUMNS)
    return f"{name}(" + cols + ") AS (VALUES " + ",\n  ".join(rows) + ")"


def calendar_select(ts: str = "datetime", alias_u: str = "su", alias_h: str = "sh") -> str:
    """SELECT-list fragment for the six calendar columns (date comparison mode); needs
    joins ``sem`` as su (uni) and sh (hs) on year."""
    d = f"CAST({ts} AS DATE)"
    hol = f"CAST({d} IN ({holiday_in_list()}) AS INTEGER)"
    opn = f"CAST(strftime({ts}, '%H:%M') IN ({slots_in_list()}) AND NOT ({d} IN ({holiday_in_list()})) AS INTEGER)"

    def period(a):
        return f"CASE WHEN {d} >= {a}.SS_begin AND {d} <= {a}.SS_end THEN 2 ELSE 1 END"

    def phase(a):
        return (f"CASE WHEN {d} >= {a}.SL_begin AND {d} <= {a}.SL_end THEN 1 "
                f"WHEN {d} >= {a}.WL_begin AND {d} < {a}.Wb_begin THEN 2 "
                f"WHEN {d} > {a}.Wb_end AND {d} <= {a}.WL_end THEN 2 ELSE 0 END")
    return (f"{hol} AS holiday, {opn} AS open, CAST({period(alias_u)} AS INTEGER) AS semester_uni, "
            f"CAST({period(alias_h)} AS INTEGER) AS semester_hs, CAST({phase(alias_u)} AS INTEGER) AS semester_phase_uni, "
            f"CAST({phase(alias_h)} AS INTEGER) AS semester_phase_hs")


def calendar_joins(src_alias: str, ts: str = "datetime") -> str:
    return (f"LEFT JOIN sem su ON su.institution = 'uni' AND su.year = year({src_alias}.{ts}) "
            f"LEFT JOIN sem sh ON sh.institution = 'hs' AND sh.year = year({src_alias}.{ts})")


def grid_sql(src: str, name: str, mode: str, start: str | None = None, end: str | None = None,
             slots: list[str] | None = None, measures: list[str] | None = None, stores: bool = True,
             pad: int = 0, cover: bool = False) -> str:
    """Dense grid CTEs mirroring operators.grid.dense_grid."""
    measures = measures or CATS + ["TOTAL_SALES"]
    first, last = (f"(SELECT {f}(CAST(datetime AS DATE)) FROM {src})" for f in ("min", "max"))
    lo = f"{first} - {pad}" if start is None else f"least(DATE '{start}', {first})" if cover else f"DATE '{start}'"
    hi = f"{last} + {pad}" if end is None else f"greatest(DATE '{end}', {last})" if cover else f"DATE '{end}'"
    if mode == "interval":
        dates = f"SELECT DISTINCT CAST(datetime AS DATE) AS date FROM {src}"
    elif mode == "day":
        dates = f"SELECT CAST(unnest(generate_series({lo}, {hi}, INTERVAL 1 DAY)) AS DATE) AS date"
    else:
        dates = f"""SELECT date FROM (SELECT DISTINCT CAST(datetime AS DATE) AS date FROM {src}) o
            WHERE date BETWEEN {lo} AND {hi}
          UNION
          SELECT CAST(unnest(generate_series({lo}, d0 - 1, INTERVAL 1 DAY)) AS DATE)
            FROM (SELECT min(CAST(datetime AS DATE)) AS d0 FROM {src}) b WHERE d0 > {lo}
          UNION
          SELECT CAST(unnest(generate_series(d1 + 1, {hi}, INTERVAL 1 DAY)) AS DATE)
            FROM (SELECT max(CAST(datetime AS DATE)) AS d1 FROM {src}) b WHERE d1 < {hi}"""
    if slots is not None:
        mins = ", ".join(str(int(s[:2]) * 60 + int(s[3:])) for s in slots)
        times = f"SELECT unnest([{mins}]) AS tmin"
    elif mode == "interval":
        times = "SELECT CAST(range AS INTEGER) AS tmin FROM range(0, 1440, 15)"
    else:
        times = f"SELECT DISTINCT CAST(hour(datetime) * 60 + minute(datetime) AS INTEGER) AS tmin FROM {src}"
    fills = ", ".join(f"CAST(coalesce(s.{m}, 0) AS BIGINT) AS {m}" for m in measures)
    if not stores:
        return f"""{name}_d AS ({dates}),
{name}_t AS ({times}),
{name}_g AS (SELECT d.date, CAST(d.date AS TIMESTAMP) + to_minutes(CAST(t.tmin AS BIGINT)) AS datetime
             FROM {name}_d d, {name}_t t),
{name} AS (SELECT g.date, g.datetime, {fills} FROM {name}_g g LEFT JOIN {src} s ON g.datetime = s.datetime)"""
    return f"""{name}_d AS ({dates}),
{name}_t AS ({times}),
{name}_s AS (SELECT DISTINCT store_id FROM {src}),
{name}_g AS (SELECT st.store_id, d.date, CAST(d.date AS TIMESTAMP) + to_minutes(CAST(t.tmin AS BIGINT)) AS datetime
             FROM {name}_d d, {name}_t t, {name}_s st),
{name} AS (SELECT g.store_id, g.date, g.datetime, {fills}
           FROM {name}_g g LEFT JOIN {src} s ON g.store_id = s.store_id AND g.datetime = s.datetime)"""


def date_hash_sql(d: str, seed: str) -> str:
    """operators.splits.date_hash."""
    return f"CAST('0x' || substr(md5(CAST(({seed}) AS VARCHAR) || ':' || CAST({d} AS VARCHAR)), 1, 8) AS BIGINT)"


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"
