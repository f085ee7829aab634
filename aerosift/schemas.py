"""StructTypes of the stored tables."""

from pyspark.sql import types as T

RAW_POSITIONS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("icao24", T.StringType()),
    T.StructField("callsign", T.StringType()),
    T.StructField("origine_pays", T.StringType()),
    T.StructField("time_position", T.LongType()),
    T.StructField("last_contact", T.LongType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("geo_altitude", T.DoubleType()),
    T.StructField("baro_altitude", T.DoubleType()),
    T.StructField("au_sol", T.BooleanType()),
    T.StructField("vitesse", T.DoubleType()),
    T.StructField("cap", T.DoubleType()),
    T.StructField("taux_montee", T.DoubleType()),
    T.StructField("squawk", T.StringType()),
    T.StructField("source_position", T.IntegerType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
    T.StructField("batch_id", T.StringType()),
])
RAW_COLUMNS = [f.name for f in RAW_POSITIONS.fields]

# Landed state payload: {"time": epoch, "states": [[17 mixed values], ...]}.
# Every state value is read as text and typed with try_cast afterwards.
STATE_PAYLOAD = T.StructType([
    T.StructField("time", T.LongType()),
    T.StructField("states", T.ArrayType(T.ArrayType(T.StringType()))),
])

# Positional order of a state vector (fixed by the upstream feed).
STATE_FIELDS = [
    "icao24", "callsign", "origine_pays", "time_position", "last_contact",
    "longitude", "latitude", "baro_altitude", "au_sol", "vitesse", "cap",
    "taux_montee", "sensors", "geo_altitude", "squawk", "spi", "source_position",
]

INT_COLUMNS = [
    "position_id", "icao24", "callsign", "origine_pays", "timestamp_position_utc", "window_30s",
    "ingested_at", "batch_id", "latitude", "longitude", "altitude_baro_m", "altitude_geo_m",
    "altitude_baro_ft", "vitesse_ms", "vitesse_kmh", "cap_degres", "taux_montee_declare_ms",
    "taux_montee_calcule_ms", "au_sol", "squawk", "source_capteur", "quality_score",
    "flag_changement_altitude_suspect",
]

DIM_COLUMNS = [
    "vol_sk", "icao24", "callsign_principal", "origine_pays", "code_compagnie", "compagnie_nom",
    "premiere_vue_utc", "derniere_vue_utc", "nb_positions_total", "dbt_updated_at",
]

FACT_COLUMNS = [
    "position_sk", "vol_sk", "timestamp_utc", "heure_utc", "date_utc", "heure_journee", "jour_semaine",
    "latitude", "longitude", "altitude_baro_m", "altitude_baro_ft", "tranche_vol", "vitesse_ms",
    "vitesse_kmh", "cap_degres", "taux_montee_declare_ms", "taux_montee_calcule_ms", "phase_vol",
    "au_sol", "squawk", "source_capteur", "flag_changement_altitude_suspect", "ingested_at",
    "batch_id", "dbt_updated_at",
]


def _struct(columns: list[str], kinds: str) -> T.StructType:
    """Fields by name, with one letter a type: s string, i int, l long, d double, b boolean, t timestamp_ntz, y date."""
    of = {"s": T.StringType(), "i": T.IntegerType(), "l": T.LongType(), "d": T.DoubleType(), "b": T.BooleanType(),
          "t": T.TimestampNTZType(), "y": T.DateType()}
    return T.StructType([T.StructField(c, of[k]) for c, k in zip(columns, kinds, strict=True)])


_GROUP = ["icao24", "callsign", "origine_pays"]
_GROUP_STATS = ["premiere_vue_utc", "derniere_vue_utc", "nb_positions_total"]

#: Stored tables; a test compares them with what the operators return.
TABLE_SCHEMAS = {
    "int": _struct([*INT_COLUMNS, "window_date", "window_hour"], "ssssttts" "dddddddd" "dd" "bs" "ii" "b" "yi"),
    "dim": _struct(DIM_COLUMNS, "ssssssttlt"),
    "fact": _struct(FACT_COLUMNS, "sstty" "ii" "dddd" "s" "ddddd" "s" "bs" "i" "b" "tst"),
    "dim_hourly": _struct([*_GROUP, "window_date", "window_hour", *_GROUP_STATS], "sss" "yi" "ttl"),
    "dim_daily": _struct([*_GROUP, "window_date", *_GROUP_STATS], "sss" "y" "ttl"),
    "dim_monthly": _struct([*_GROUP, "window_month", *_GROUP_STATS], "sss" "y" "ttl"),
}
