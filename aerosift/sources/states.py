"""Landed state payloads -> typed positions (+ rejects), and batch files.

A landed file holds ``{"time": epoch, "states": [[17 values], ...]}``.
Reading every value as text and typing it with ``try_cast`` keeps malformed
values from failing the job (ANSI casts raise). Nothing vanishes: a row with a
value that is present but does not type is a reject, and a file that is no valid
payload is one reject that carries the file's text.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import BATCH_CLOCK_PATTERN, position_id
from ..functions.keys import batch_id as batch_id_col
from ..functions.timecols import epoch_to_ntz, ntz_literal
from ..schemas import RAW_COLUMNS, RAW_POSITIONS, STATE_FIELDS, STATE_PAYLOAD

# Default bounding box (fixed values): metropolitan France.
FRANCE = {"lat_min": 41.0, "lat_max": 51.5, "lon_min": -5.5, "lon_max": 10.0}

TYPES = {
    "time_position": "bigint", "last_contact": "bigint", "longitude": "double", "latitude": "double",
    "baro_altitude": "double", "au_sol": "boolean", "vitesse": "double", "cap": "double",
    "taux_montee": "double", "geo_altitude": "double", "source_position": "int",
}
AU_SOL_INDEX = STATE_FIELDS.index("au_sol")
CORRUPT = "_corrupt_record"


def read_states(spark: SparkSession, path: str, streaming: bool = False,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed payload files (JSON) with an explicit schema, one row per state vector.

    A file that does not parse gives one row without a state and with its text in ``corrupt``."""
    reader = spark.readStream if streaming else spark.read
    schema = T.StructType([*STATE_PAYLOAD.fields, T.StructField(CORRUPT, T.StringType())])
    reader = reader.schema(schema).option("multiLine", "true").option("columnNameOfCorruptRecord", CORRUPT)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    payload = reader.json(path)
    nothing = F.array(F.lit(None).cast("array<string>"))
    states = F.when(F.col(CORRUPT).isNotNull(), nothing).otherwise(F.col("states"))
    return payload.select(F.col("time").alias("payload_time"), F.col(CORRUPT).alias("corrupt"), F.explode(states).alias("state"))


def typed_states(states: DataFrame) -> DataFrame:
    """Positional array -> named, typed columns (NULL past a short array's end)."""
    cols = []
    for i, name in enumerate(STATE_FIELDS):
        raw = F.get(F.col("state"), i)
        cols.append(raw.alias("_txt_" + name))
        if name in TYPES:
            # JSON numbers arrive as text such as "12.5" or "true"
            cols.append(raw.try_cast(TYPES[name]).alias(name))
        elif name not in ("sensors", "spi"):
            cols.append(raw.alias(name))
    corrupt = F.col("corrupt") if "corrupt" in states.columns else F.lit(None).cast("string")
    return states.select("payload_time", corrupt.alias("corrupt"), F.size(F.col("state")).alias("_len"), *cols)


def in_bbox(df: DataFrame, bbox: dict | None = None) -> DataFrame:
    """Bounding-box predicate (inclusive); pushed into the scan when read from Parquet."""
    b = bbox or FRANCE
    return df.filter(F.col("latitude").between(b["lat_min"], b["lat_max"])
                     & F.col("longitude").between(b["lon_min"], b["lon_max"]))


def parse_states(states: DataFrame, as_of: datetime | None = None, bbox: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """State vectors -> (raw positions, rejects).

    * rows without latitude or longitude text are dropped (no GPS fix);
    * rows with any value that is present but does not type are rejects, and so
      are files that do not parse (``corrupt`` holds their text);
    * callsign is stripped of leading/trailing whitespace;
    * id = SHA-256 position key; batch id / ingest stamp from ``as_of``, or from
      each row's own payload time when ``as_of`` is not given;
    * ``au_sol`` defaults to FALSE only when the field is absent (short array),
      an explicit null stays NULL;
    * ``bbox`` keeps the positions inside a box.
    """
    t = typed_states(states)
    bad = F.col("corrupt").isNotNull()
    for c in TYPES:
        bad = bad | (F.col("_txt_" + c).isNotNull() & F.col(c).isNull())
    has_fix = F.col("_txt_latitude").isNotNull() & F.col("_txt_longitude").isNotNull()
    rejects = t.filter(bad & (has_fix | F.col("corrupt").isNotNull())).select(
        "payload_time", "corrupt", *[F.col("_txt_" + n).alias(n) for n in STATE_FIELDS])
    ok = t.filter(has_fix & ~bad)
    if bbox is not None:
        ok = in_bbox(ok, bbox)
    if as_of is None:
        stamp = epoch_to_ntz("payload_time")
        batch = F.md5(F.date_format(stamp, BATCH_CLOCK_PATTERN))
    else:
        stamp, batch = ntz_literal(as_of), batch_id_col(as_of)
    cs = F.regexp_replace(F.regexp_replace(F.col("callsign"), r"^\s+", ""), r"\s+$", "")
    pos = ok.select(
        position_id("icao24", "time_position", "latitude", "longitude").alias("id"),
        "icao24",
        cs.alias("callsign"),
        "origine_pays", "time_position", "last_contact", "longitude", "latitude", "geo_altitude",
        "baro_altitude",
        F.when(F.col("_len") <= AU_SOL_INDEX, F.lit(False)).otherwise(F.col("au_sol")).alias("au_sol"),
        "vitesse", "cap", "taux_montee", "squawk", "source_position",
        stamp.alias("ingested_at"),
        batch.alias("batch_id"),
    )
    return pos.select(*[F.col(f.name).cast(f.dataType) for f in RAW_POSITIONS.fields]), rejects


def write_batch(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Land a position batch (SRC3); returns its row count from an observation."""
    from pyspark.sql.observation import Observation

    obs = Observation("landed")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").format(fmt).save(path)
    return obs.get["n"]


def read_batch(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a landed batch (SRC4); a missing path gives an empty frame, any other error is raised."""
    from ..operators.sinks import read_if_exists

    found = read_if_exists(spark, path, RAW_POSITIONS, fmt)
    return spark.createDataFrame([], RAW_POSITIONS) if found is None else found.select(*RAW_COLUMNS)
