"""Track segments in batch: partial sessions that merge associatively (STR7).

A segment joins positions of one aircraft that lie at most ``gap_s`` seconds apart. A session window sorts an aircraft's
whole history in one task; here an aircraft is as many tasks as it has hours:

1. ``hour_segments`` counts positions by (aircraft, second), combined before the shuffle, and cuts each hour's seconds into
   partial segments (first and last second, positions). A group holds at most 3,600 rows, however many positions an aircraft sends.
2. ``merge_hours`` merges partial segments of the same hours from any number of deliveries. Segments are the connected
   intervals of a line, so partials of any split of the rows merge into those of all rows: stored partials are kept up to date
   by merging a delivery's own partials, without its older positions.
3. ``join_segments`` joins them across hours inside days, then across days inside months, then across months. A segment that no
   position of a neighbouring period can reach is finished and leaves; at most two for each aircraft and period go on.

Rows without a time or an aircraft belong to no segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import epoch_to_ntz, ntz_to_epoch
from .dedup import clean_rows

GAP_S = 120
HOUR = 3600
#: Lengths in seconds of the periods inside which segments join, each a whole number of the one before.
PERIODS = (HOUR, 24 * HOUR, 32 * 24 * HOUR)

PARTIAL = ["icao24", "first_s", "last_s", "n"]


def _joined(parts: DataFrame, period_s: int | None, gap_s: int) -> DataFrame:
    """Partials that lie within the gap of each other, inside one (aircraft, period), as one; no period: the aircraft."""
    keys = ["icao24"]
    if period_s:
        parts, keys = parts.withColumn("_period", F.floor(F.col("first_s") / period_s)), ["icao24", "_period"]
    in_order = Window.partitionBy(*keys).orderBy("first_s", "last_s")
    reach = F.max("last_s").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("first_s") - reach > gap_s, F.lit(True)).cast("int")
    numbered = parts.withColumn("_starts", starts).withColumn(
        "_segment", F.sum("_starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_segment").agg(
        F.min("first_s").alias("first_s"), F.max("last_s").alias("last_s"), F.sum("n").alias("n")).select(*PARTIAL)


def hour_segments(stg: DataFrame, gap_s: int = GAP_S) -> DataFrame:
    """Partial segments of clean staged rows inside each hour: ``icao24, first_s, last_s, n``."""
    seconds = (clean_rows(stg).where("icao24 IS NOT NULL AND timestamp_position_utc IS NOT NULL")
               .groupBy("icao24", ntz_to_epoch("timestamp_position_utc").alias("first_s")).agg(F.count(F.lit(1)).alias("n"))
               .select("icao24", "first_s", F.col("first_s").alias("last_s"), "n"))
    return _joined(seconds, HOUR, gap_s)


def merge_hours(*parts: DataFrame, gap_s: int = GAP_S) -> DataFrame:
    """Partials of the same hours from several deliveries (disjoint rows) as those of all their rows."""
    every = parts[0].select(*PARTIAL)
    for part in parts[1:]:
        every = every.unionByName(part.select(*PARTIAL))
    return _joined(every, HOUR, gap_s)


def join_segments(parts: DataFrame, gap_s: int = GAP_S) -> DataFrame:
    """Track segments ``icao24, debut, fin, nb_positions`` from merged hour partials; ``fin`` is the last position plus the gap."""
    if gap_s >= HOUR:
        raise ValueError("the gap must be shorter than an hour")
    finished, going_on = [], parts.select(*PARTIAL)
    for period, above in zip(PERIODS, (*PERIODS[1:], None)):
        begin = F.col("first_s") - F.pmod("first_s", F.lit(period))
        alone = (F.col("first_s") - begin > gap_s) & (begin + period - F.col("last_s") > gap_s)
        finished.append(going_on.where(alone))
        going_on = _joined(going_on.where(~alone), above, gap_s)
    for part in finished:
        going_on = going_on.unionByName(part)
    return going_on.select("icao24", epoch_to_ntz("first_s").alias("debut"), epoch_to_ntz(F.col("last_s") + gap_s).alias("fin"),
                           F.col("n").alias("nb_positions"))


def track_segments(stg: DataFrame, gap_s: int = GAP_S) -> DataFrame:
    """Track segments of staged rows in one go."""
    return join_segments(hour_segments(stg, gap_s), gap_s)
