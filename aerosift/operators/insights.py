"""Traffic questions answered over the position fact (no upstream query exists;
definitions are ours, stated per function)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import bucket_start, epoch_to_ntz, ntz_to_epoch
from .continuity import attach_previous

CELL_DEG = 0.5      # corridor grid cell
SECTOR_DEG = 45     # heading sector


def airborne(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("au_sol") == F.lit(False))


def aircraft_in_air(fact: DataFrame, bucket_s: int = 600) -> DataFrame:
    """Distinct airborne flights and positions per 10-minute bucket (INS1).

    ``countDistinct`` is planned as a two-level aggregation keyed by
    (bucket, flight) first, so a busy bucket is spread over many tasks.
    """
    return (airborne(fact)
            .groupBy(bucket_start("timestamp_utc", bucket_s).alias("tranche_10min"))
            .agg(F.countDistinct("vol_sk").alias("avions_en_vol"),
                 F.count(F.lit(1)).alias("nb_positions")))


def busiest_corridors(fact: DataFrame, top: int = 20) -> DataFrame:
    """Top ``top`` (0.5° cell, 45° heading sector) by distinct airborne flights (INS2).

    Top-k is a ``orderBy().limit()`` = TakeOrderedAndProject: each task keeps
    its own k best rows, only k rows per task reach the final merge.
    """
    f = airborne(fact).filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
                              & F.col("cap_degres").isNotNull())
    cells = f.select(
        (F.floor(F.col("latitude") / CELL_DEG) * CELL_DEG).alias("cellule_lat"),
        (F.floor(F.col("longitude") / CELL_DEG) * CELL_DEG).alias("cellule_lon"),
        (F.pmod(F.floor(F.col("cap_degres") / SECTOR_DEG), F.lit(360 // SECTOR_DEG)) * SECTOR_DEG)
        .cast("int").alias("secteur_cap"),
        "vol_sk",
    )
    g = cells.groupBy("cellule_lat", "cellule_lon", "secteur_cap").agg(
        F.countDistinct("vol_sk").alias("avions"), F.count(F.lit(1)).alias("nb_positions"))
    return g.orderBy(F.col("avions").desc(), F.col("nb_positions").desc(), "cellule_lat",
                     "cellule_lon", "secteur_cap").limit(top)


def traffic_by_country(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Flights and positions per registration country, with a grand total row
    (``niveau`` = 1) from ROLLUP (INS3).

    The fact is first reduced to one row per flight (partial aggregation
    before the shuffle); only that per-flight frame -- bounded by the number
    of aircraft -- meets the dimension and the rollup, where each flight
    counts once, so no distinct aggregation is needed.
    """
    per_flight = fact.groupBy("vol_sk").agg(F.count(F.lit(1)).alias("_n"))
    j = per_flight.join(dim.select("vol_sk", "origine_pays"), "vol_sk")
    return j.rollup("origine_pays").agg(
        F.count(F.lit(1)).alias("avions"),
        F.sum("_n").alias("nb_positions"),
        F.grouping("origine_pays").cast("int").alias("niveau"),
    )


def traffic_by_hour(fact: DataFrame) -> DataFrame:
    """Positions and distinct flights by (day of week, hour of day) (INS4)."""
    return fact.groupBy("jour_semaine", "heure_journee").agg(
        F.count(F.lit(1)).alias("nb_positions"), F.countDistinct("vol_sk").alias("avions"))


def aircraft_in_air_sliding(fact: DataFrame, size_s: int = 3600, slide_s: int = 600) -> DataFrame:
    """INS1 over sliding windows (1 hour, every 10 minutes): distinct airborne
    flights per window. Each row is emitted for the size/slide windows that
    hold it (what ``window()`` expands to), in epoch arithmetic on
    ``timestamp_ntz`` so window edges do not depend on the session zone."""
    if size_s % slide_s:
        raise ValueError("size_s must be a multiple of slide_s")
    e = ntz_to_epoch("timestamp_utc")
    first = e - F.pmod(e, F.lit(slide_s))
    rows = (airborne(fact).filter(F.col("timestamp_utc").isNotNull())
            .select("vol_sk", first.alias("_first"),
                    F.explode(F.sequence(F.lit(0), F.lit(size_s // slide_s - 1))).alias("_k"))
            .select("vol_sk", (F.col("_first") - F.col("_k") * slide_s).alias("_s")))
    return (rows.groupBy("_s")
            .agg(F.countDistinct("vol_sk").alias("avions_en_vol"), F.count(F.lit(1)).alias("nb_positions"))
            .select(epoch_to_ntz("_s").alias("debut"), epoch_to_ntz(F.col("_s") + size_s).alias("fin"),
                    "avions_en_vol", "nb_positions"))


MICRO = 1_000_000           # legs are traced in whole millionths of a degree, which staging rounds to
CELL_MICRO = 500_000        # 0.5 degrees
TURN = 360 * MICRO


def _floor_div(a, b):
    """Exact floor(a / b) of whole numbers, b > 0."""
    return F.call_function("div", a - F.pmod(a, b), b)


def legs(fact: DataFrame, max_gap_s: int = 120, bucket_s: int = 30) -> DataFrame:
    """Legs between an airborne position and the one before it, at most ``max_gap_s`` older: ``vol_sk, x0, y0, x1, y1`` in
    millionths of a degree and the later position's heading. A leg takes the short way over the antimeridian (x1 beyond 180 degrees)."""
    points = airborne(fact).where("timestamp_utc IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL").select(
        "vol_sk", "timestamp_utc", "cap_degres", bucket_start("timestamp_utc", bucket_s).alias("_bucket"),
        F.round(F.col("longitude") * MICRO).cast("long").alias("x1"), F.round(F.col("latitude") * MICRO).cast("long").alias("y1"))
    p = attach_previous(points, "vol_sk", "_bucket", "timestamp_utc", ["x1", "y1"], bucket_s, max_gap_s)
    dt = ntz_to_epoch("timestamp_utc") - ntz_to_epoch("prev_timestamp_utc")
    dx = F.col("x1") - F.col("prev_x1")
    x1 = F.when(dx > TURN // 2, F.col("x1") - TURN).when(dx < -(TURN // 2), F.col("x1") + TURN).otherwise(F.col("x1"))
    return p.where((dt > 0) & (dt <= max_gap_s)).select(
        "vol_sk", "cap_degres", F.col("prev_x1").alias("x0"), F.col("prev_y1").alias("y0"), x1.alias("x1"), "y1")


def leg_cells(traced: DataFrame, cell: int = CELL_MICRO) -> DataFrame:
    """Every grid cell that a straight leg passes, once a leg: the columns of ``traced`` and ``i, j`` (cells east and north).

    Row by row in whole numbers: in a row of cells the leg passes the columns between those where it enters and leaves the row.
    A leg through a corner passes the cell east of it on the row that it leaves when it goes east, none besides when it goes west."""
    c = F.lit(cell)
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    up = dy > 0
    rows = traced.withColumns({"_j0": _floor_div(F.col("y0"), c), "_j1": _floor_div(F.col("y1"), c)}).withColumn(
        "j", F.explode(F.sequence(F.least("_j0", "_j1"), F.greatest("_j0", "_j1"))))

    def column_at(y):
        """Column of cells where the leg is at height y (dy is not 0 where this is used)."""
        sign = F.when(up, F.lit(1)).otherwise(F.lit(-1)).cast("long")
        return _floor_div((F.col("x0") * dy + (y - F.col("y0")) * dx) * sign, F.greatest(F.abs(dy), F.lit(1)) * c)

    below, above = F.col("j") * c, (F.col("j") + 1) * c
    enters = F.when(F.col("j") == F.col("_j0"), _floor_div(F.col("x0"), c)).otherwise(column_at(F.when(up, below).otherwise(above)))
    leaves = F.when(F.col("j") == F.col("_j1"), _floor_div(F.col("x1"), c)).otherwise(column_at(F.when(up, above).otherwise(below)))
    ends = rows.withColumns({"_a": enters, "_b": leaves})
    cells = ends.withColumn("i", F.explode(F.sequence(F.least("_a", "_b"), F.greatest("_a", "_b"))))
    around = TURN // cell
    return cells.select(*traced.columns, (F.pmod(F.col("i") + around // 2, F.lit(around)) - around // 2).alias("i"), "j")


def corridor_legs(fact: DataFrame, top: int = 20) -> DataFrame:
    """INS2 by what aircraft fly through, not only where they report: top ``top`` (0.5 degree cell, 45 degree heading sector) by
    distinct flights among the cells of all legs."""
    cells = leg_cells(legs(fact).where("cap_degres IS NOT NULL"))
    per = cells.select(
        (F.col("j") * CELL_DEG).alias("cellule_lat"), (F.col("i") * CELL_DEG).alias("cellule_lon"),
        (F.pmod(F.floor(F.col("cap_degres") / SECTOR_DEG), F.lit(360 // SECTOR_DEG)) * SECTOR_DEG).cast("int").alias("secteur_cap"), "vol_sk")
    g = per.groupBy("cellule_lat", "cellule_lon", "secteur_cap").agg(
        F.countDistinct("vol_sk").alias("avions"), F.count(F.lit(1)).alias("nb_trajets"))
    return g.orderBy(F.col("avions").desc(), F.col("nb_trajets").desc(), "cellule_lat", "cellule_lon", "secteur_cap").limit(top)
