"""Roll-ups (A1, A2, F8, F16, P25) and the model frame.

A level roll-up is a hash aggregation with partial (map-side) aggregation on the
level keys; the number of output groups is bounded by the calendar, not the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.timecols import add_time_columns, level_time_columns, period_start
from ..session import cut_lineage
from ..sources import dims
from . import grid


def combine_stores(df: DataFrame, measures: list[str], ts: str = "datetime") -> DataFrame:
    """Sum every measure across stores per timestamp."""
    return df.groupBy(ts).agg(*[F.sum(m).cast("bigint").alias(m) for m in measures])


def level_rollup(df: DataFrame, level: str, measures: list[str], per_store: bool = True,
                 time_columns: list[str] | None = None, calendar_columns: list[str] | None = None,
                 ts: str = "datetime") -> DataFrame:
    """A2: sum measures by period-start date, store, time keys, calendar keys and the level
    column itself (made explicit, P25/Q8). Calendar keys split a period when they change
    inside it, exactly like the reference's group-by."""
    time_columns = time_columns if time_columns is not None else level_time_columns(level)
    calendar_columns = calendar_columns if calendar_columns is not None else cal.LEVEL_CALENDAR.get(level, [])
    keys = ["date"] + (["store_id"] if per_store else []) + list(dict.fromkeys(time_columns + [level]))
    keys += [c for c in calendar_columns if c not in keys]
    framed = df.withColumn("date", period_start(ts, level))
    missing = [c for c in keys if c not in framed.columns]
    if missing:
        framed = add_time_columns(framed, ts, [c for c in missing if c not in cal.CALENDAR_COLUMNS])
        cal_missing = [c for c in missing if c in cal.CALENDAR_COLUMNS]
        if cal_missing:
            framed = cal.add_calendar_columns(framed, ts, names=cal_missing)
    return framed.groupBy(*keys).agg(*[F.sum(m).cast("bigint").alias(m) for m in measures])


ALL_STORES = "all"
SUMMED = "summed"


@dataclass(frozen=True)
class FrameSpec:
    """What a model frame is made of. The level fixes the time and calendar columns; ``stores`` is
    ``ALL_STORES``, ``SUMMED`` (one series over all stores) or the ids to keep; ``bounds`` (first and
    last day) default to the data's own, and ``gaps`` also adds the days missing inside them;
    ``cap`` gives lower and upper percentiles to which targets are clipped."""
    level: str
    targets: tuple[str, ...] = tuple(dims.CATEGORIES)
    stores: str | tuple[int, ...] = ALL_STORES
    bounds: tuple[str | None, str | None] = (None, None)
    gaps: bool = False
    cap: tuple[float, float] | None = None


def model_frame(wide: DataFrame, spec: FrameSpec) -> DataFrame:
    """Select stores (or sum them, S2), densify (F20), add time and calendar
    columns, roll up to the level, optionally clip the targets to percentiles."""
    targets = list(spec.targets)
    if spec.stores == SUMMED:
        base = combine_stores(wide, targets)
    else:
        base = wide.select("store_id", "datetime", *targets)
        if spec.stores != ALL_STORES:
            base = base.where(F.col("store_id").isin(*spec.stores))
    dense = grid.model_grid(base, targets, True, spec.gaps, *spec.bounds)
    out = level_rollup(dense, spec.level, targets, per_store=spec.stores != SUMMED)
    return cap_targets(out, targets, *spec.cap) if spec.cap else out


def cap_targets(frame: DataFrame, targets: list[str], lower: float = 1, upper: float = 99) -> DataFrame:
    """P21 for many columns: one aggregation gives the percentile pair of every target."""
    probs = F.array(F.lit(lower / 100), F.lit(upper / 100))
    frame = cut_lineage(frame)
    pairs = frame.agg(F.struct(*[F.percentile(t, probs).alias(t) for t in targets]).alias("b")).scalar()
    out = frame.withColumn("_b", pairs)
    return out.withColumns({t: F.least(F.greatest(F.col(t), F.col(f"_b.{t}")[0]), F.col(f"_b.{t}")[1])
                            for t in targets}).drop("_b")
