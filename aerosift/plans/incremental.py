"""Exact incremental update of the stored marts after new raw rows arrive.

The upstream models recompute a fixed look-back slice and lose the climb
rate of the first row per aircraft in the slice, and the dimension's
first-seen/count (SURVEY §3.5 X1/X2). Here the update is exact:

1. ``touched`` = the (icao24, 30 s window) pairs of the new clean rows, as one bit
   mask for each aircraft and block of ``BLOCK`` windows: the masks are or-ed in the
   tasks, so neither rows nor memory follow the number of windows.
2. A change in window W can alter that window's winner and the previous
   position of rows up to 120 s later: *emit* windows W .. W+120. Their
   winners and predecessors depend on raw rows in W-120 .. W+120:
   *context* windows (the masks shifted; an equi-join by block and one bit tested,
   no range join). The NULL-time bucket of a touched aircraft is recomputed whole.
3. Raw rows of the context windows are selected by a semi-join on the hours of the
   raw table's ``event_date`` / ``event_hour`` partitions, so dynamic partition pruning
   reads only those, and one on the masks; dedup + climb rate run on
   that slice and only emit windows are kept. Parquet keeps masks small, which says little
   about their size in memory, so many of them are never sent whole to driver and tasks.
4. int and fact are upserted by key in the touched date partitions.
5. The dimension's hourly partial aggregates are recomputed for the touched
   hours only (from int's touched hour partitions), the daily partials for
   the touched days only (from their 24 hourly partials), the monthly
   partials for the touched months (from their daily partials), and the
   dimension rows of touched aircraft are re-derived from the monthly
   partials (``vol_sk`` depends only on icao24, so no fact row changes key). The
   dimension, one row per aircraft, is written anew as a further version.

The result equals a full rebuild for any split of the input into batches.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import epoch_to_ntz, ntz_to_epoch
from ..operators.dedup import dedup, windowed
from ..operators.marts import dim_from_groups, merge_groups, position_fact
from ..operators.sinks import (EVENT_DATE, EVENT_HOUR, EVENT_PARTITIONS, in_partitions, replace_partitions, upsert,
                               with_event_date, write_version)
from ..operators.staging import stage
from ..session import materialize
from .tables import (DAY_PARTITION, FACT_PARTITIONS, INT_PARTITIONS, MONTH_PARTITION, daily_groups, hourly_groups,
                     monthly_groups, paths, read_dim, read_dim_daily, read_dim_hourly, read_dim_monthly,
                     read_int_partitioned, with_int_partition)


BLOCK = 30              # windows of a mask: a quarter of an hour
BROADCAST_MASKS = 100_000
_ALL = (1 << BLOCK) - 1


def _place(epoch: Column, window_s: int) -> tuple[Column, Column]:
    """Block of a time and its window's bit there (NULL: the NULL block's only bit)."""
    number = F.floor(epoch / window_s).cast("long")
    block = F.floor(number / BLOCK).cast("long")
    return block, F.coalesce(number - block * BLOCK, F.lit(0)).cast("int")


def touched_windows(new_raw: DataFrame, window_s: int = 30) -> DataFrame:
    """(icao24, block, mask) of the clean rows' windows."""
    block, bit = _place(ntz_to_epoch("window_30s"), window_s)
    rows = windowed(stage(new_raw), window_s).select("icao24", block.alias("block"), bit.alias("_bit"))
    return rows.groupBy("icao24", "block").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("mask"))


def _expand(touched: DataFrame, lo: int, hi: int, window_s: int) -> DataFrame:
    """Masks of the windows in [W + lo*window_s, W + hi*window_s]; NULL stays NULL."""
    near = {}
    for step in range(lo, hi + 1):
        over, by = divmod(step, BLOCK)
        moved = F.shiftleft("mask", by)
        near.setdefault(over, []).append(moved.bitwiseAND(_ALL))
        near.setdefault(over + 1, []).append(F.shiftright(moved, BLOCK))
    shifted = [F.struct((F.col("block") + over).alias("block"), reduce(Column.bitwiseOR, masks).alias("mask"))
               for over, masks in sorted(near.items())]
    own = F.array(F.struct("block", "mask"))
    rows = touched.select("icao24", F.explode(F.when(F.col("block").isNull(), own).otherwise(F.array(*shifted))).alias("_m"))
    return rows.select("icao24", "_m.*").where("mask <> 0").groupBy("icao24", "block").agg(F.bit_or("mask").alias("mask"))


def _in_masks(rows: DataFrame, aircraft: Column, epoch: Column, masks: DataFrame, window_s: int, many: bool) -> DataFrame:
    """Rows with an aircraft and time whose window is in ``masks``. ``many`` masks are shuffled, whatever their file's size."""
    block, bit = _place(epoch, window_s)
    own = rows.columns
    rows = rows.withColumns({"_i": aircraft, "_b": block, "_bit": bit})
    m = masks.select(F.col("icao24").alias("_mi"), F.col("block").alias("_mb"), F.col("mask").alias("_mask"))
    hit = (rows["_i"] == m["_mi"]) & rows["_b"].eqNullSafe(m["_mb"]) & F.expr("shiftright(_mask, _bit) & 1L = 1")
    return rows.join(m.hint("merge") if many else m, hit, "left_semi").select(*own)


def affected_raw(raw: DataFrame, context: DataFrame, window_s: int = 30, many: bool = False) -> DataFrame:
    """Raw rows whose (icao24, window) is a context window.

    Timed rows: the hours of the masks, a few rows, select the raw table's
    ``event_date`` / ``event_hour`` partitions, so dynamic partition pruning reads
    only the touched hours; the masks then select rows. Rows without a
    time (NULL bucket) live in the NULL partition (static pruning) and are
    matched on icao24.
    """
    r = raw if EVENT_DATE in raw.columns and EVENT_HOUR in raw.columns else with_event_date(raw)
    start, span = F.col("block") * BLOCK * window_s, BLOCK * window_s
    hour = F.explode(F.sequence(F.floor(start / 3600).cast("long"), F.floor((start + span - 1) / 3600).cast("long")))
    timed_ctx = context.where("block IS NOT NULL")
    at = epoch_to_ntz(F.col("_hour") * 3600)
    hours = timed_ctx.select("block").distinct().select(hour.alias("_hour")).distinct().select(
        F.to_date(at).alias(EVENT_DATE), F.hour(at).alias(EVENT_HOUR))
    key_i, epoch = F.lower(F.trim("icao24")), F.col("time_position")
    timed = _in_masks(r.join(F.broadcast(hours), EVENT_PARTITIONS, "left_semi"), key_i, epoch, timed_ctx, window_s, many)
    untimed = _in_masks(r.where(F.col(EVENT_DATE).isNull()), key_i, epoch, context.where("block IS NULL"), window_s, False)
    return timed.unionByName(untimed).drop(*EVENT_PARTITIONS)


def incremental_update(spark: SparkSession, root: str, raw: DataFrame, new_raw: DataFrame, as_of: datetime,
                       window_s: int = 30, max_gap_s: int = 120, max_rate: int = 100,
                       on_delta: Callable[[DataFrame], object] | None = None) -> dict:
    """Apply the new raw rows (already merged into ``raw``) to int, dim and fact.

    ``on_delta`` gets the stored fact rows that were replaced or added, after all tables are written."""
    p = paths(root)
    k = max(1, math.ceil(max_gap_s / window_s))
    touched = materialize(touched_windows(new_raw, window_s), "touched")      # read five times below
    n_masks = touched.count()
    if not n_masks:                # nothing new (or only flagged rows): the tables are already current
        return {"recomputed_positions": 0}
    many = n_masks > BROADCAST_MASKS
    emit = _expand(touched, 0, k, window_s)
    context = _expand(touched, -k, k, window_s)
    slice_rows = affected_raw(raw, context, window_s, many)
    recomputed = dedup(stage(slice_rows), window_s, max_gap_s, max_rate)
    new_int = _in_masks(recomputed, F.col("icao24"), ntz_to_epoch("window_30s"), emit, window_s, many)
    # the delta is read three times below: store it once (lineage cut)
    new_int = materialize(new_int, "int-delta")
    upsert(spark, with_int_partition(new_int), p["int"], "position_id", INT_PARTITIONS, "icao24")

    # dimension partials: touched hours re-aggregated from int's touched hour partitions,
    # touched days re-rolled from their hourly partials (both partition-pruned reads)
    hours = with_int_partition(new_int).select(*INT_PARTITIONS).distinct()
    int_hours = in_partitions(read_int_partitioned(spark, root), hours, INT_PARTITIONS)
    replace_partitions(spark, hourly_groups(int_hours), p["dim_hourly"], INT_PARTITIONS, "icao24")
    days = hours.select(*DAY_PARTITION).distinct()
    replace_partitions(spark, daily_groups(in_partitions(read_dim_hourly(spark, root), days, DAY_PARTITION)),
                       p["dim_daily"], DAY_PARTITION, "icao24")
    # touched months: their days listed (<= 31 per month) so the daily read is partition-pruned
    month = F.trunc(DAY_PARTITION[0], "month")
    month_days = days.select(F.explode(F.when(F.col(DAY_PARTITION[0]).isNull(), F.array(F.lit(None).cast("date")))
                                       .otherwise(F.sequence(month, F.last_day(DAY_PARTITION[0]))))
                             .alias(DAY_PARTITION[0])).distinct()
    replace_partitions(spark, monthly_groups(in_partitions(read_dim_daily(spark, root), month_days, DAY_PARTITION)),
                       p["dim_monthly"], MONTH_PARTITION, "icao24")

    # dimension: touched aircraft re-derived from the monthly partials
    aircraft = touched.select("icao24").distinct()
    partials = read_dim_monthly(spark, root).join(aircraft, "icao24", "left_semi")
    dim_new = dim_from_groups(merge_groups(partials), as_of)
    # a new version: a run that dies here leaves the old one, and its rerun repeats the same steps
    write_version(spark, read_dim(spark, root).join(aircraft, "icao24", "left_anti").unionByName(dim_new), p["dim"])

    # fact rows of the emitted windows (their keys and partitions are fixed by position_id)
    fact_new = materialize(position_fact(new_int, read_dim(spark, root), as_of), "fact-delta")
    upsert(spark, fact_new, p["fact"], "position_sk", FACT_PARTITIONS, "vol_sk")
    if on_delta:
        on_delta(fact_new)
    return {"recomputed_positions": new_int.count()}


def lookback_slice(raw: DataFrame, as_of: datetime, hours: float = 2) -> DataFrame:
    """The upstream incremental selection (``ingested_at >= as_of - lookback``),
    usable as the ``new_raw`` input of ``incremental_update``: the update stays
    exact whatever slice it is given."""
    from datetime import timedelta

    from ..functions.timecols import ntz_literal

    return raw.filter(F.col("ingested_at") >= ntz_literal(as_of - timedelta(hours=hours)))
