"""Serving queries over the marts: live positions, anomalies, KPIs, map points.

All results are bounded by the number of aircraft (live set) or by the
anomaly count; the inputs are the full fact table, read with the date
partition filter first so that a partitioned fact table is pruned to the
last day(s).
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import phase_color
from ..functions.timecols import ntz_literal

ALL_AIRLINES = "Toutes"   # fixed value: the "no filter" choice
UNKNOWN = "?"
MISSING = "—"             # fixed value: shown for NULL numbers in the anomaly table

LIVE_COLUMNS = [
    "icao24", "callsign_principal", "compagnie_nom", "origine_pays", "latitude", "longitude",
    "altitude_baro_ft", "vitesse_kmh", "cap_degres", "phase_vol", "taux_montee_calcule_ms",
    "taux_montee_declare_ms", "flag_changement_altitude_suspect", "timestamp_utc",
]
ANOMALY_COLUMNS = [
    "callsign_principal", "compagnie_nom", "origine_pays", "timestamp_utc", "altitude_baro_ft",
    "vitesse_kmh", "taux_montee_calcule_ms", "taux_montee_declare_ms", "phase_vol",
]


def recent(fact: DataFrame, as_of: datetime, hours: float) -> DataFrame:
    since = as_of - timedelta(hours=hours)
    f = fact
    if "date_utc" in fact.columns:  # partition columns of the stored fact: prune days and hours
        day = F.lit(since.date())
        keep = F.col("date_utc") > day
        keep = keep | ((F.col("date_utc") == day) & (F.col("heure_journee") >= since.hour)) \
            if "heure_journee" in fact.columns else keep | (F.col("date_utc") == day)
        f = f.filter(keep)
    return f.filter(F.col("timestamp_utc") >= ntz_literal(since))


def live_positions(fact: DataFrame, dim: DataFrame, as_of: datetime, hours: float = 1) -> DataFrame:
    """Latest airborne position per flight over the last ``hours`` (SRV1).

    Top-1 per flight is ``row_number() = 1``: a partial group limit runs
    before the shuffle, so a flight with many positions costs one row per
    map task.
    """
    f = recent(fact, as_of, hours).filter(
        (F.col("au_sol") == F.lit(False)) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    )
    w = Window.partitionBy("vol_sk").orderBy(F.col("timestamp_utc").desc_nulls_last())
    latest = f.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    d = dim.select("vol_sk", "icao24", "callsign_principal", "compagnie_nom", "origine_pays")
    return latest.join(d, "vol_sk").select(*LIVE_COLUMNS).orderBy(F.col("altitude_baro_ft").desc_nulls_last())


def anomalies(fact: DataFrame, dim: DataFrame, as_of: datetime, hours: float = 24) -> DataFrame:
    """Altitude-jump positions over the last ``hours``, newest first (SRV2)."""
    f = recent(fact, as_of, hours).filter(F.col("flag_changement_altitude_suspect") == F.lit(True))
    d = dim.select("vol_sk", "callsign_principal", "compagnie_nom", "origine_pays")
    return f.join(d, "vol_sk").select(*ANOMALY_COLUMNS).orderBy(F.col("timestamp_utc").desc_nulls_last())


def airlines(live: DataFrame) -> DataFrame:
    """Distinct non-NULL airline names, sorted (SRV3)."""
    return (live.select("compagnie_nom").filter(F.col("compagnie_nom").isNotNull())
            .distinct().orderBy("compagnie_nom"))


def filter_airline(live: DataFrame, name: str | None = None) -> DataFrame:
    """Equality filter unless no airline / "Toutes" is chosen (SRV4)."""
    if name is None or name == ALL_AIRLINES:
        return live
    return live.filter(F.col("compagnie_nom") == F.lit(name))


def kpis(live: DataFrame, anomalies_24h: DataFrame, airline: str | None = None) -> DataFrame:
    """One row of KPIs (SRV5 + SRV10), computed in a single aggregation pass.

    The live rows (filtered or not) and the 24 h anomaly rows are tagged and
    unioned, then every figure is a conditional aggregate: no join. Means
    are truncated like ``int(mean)``; 0 when there is no row. The 24 h count
    ignores the airline filter, as upstream. Means use exact integer sums
    (feet are whole, km/h has one decimal) so the value does not depend on
    summation order.
    """
    sel = F.lit(True) if airline in (None, ALL_AIRLINES) else (F.col("compagnie_nom") == F.lit(airline))
    lv = live.select(
        F.lit(1).alias("_live"),
        F.coalesce(sel, F.lit(False)).alias("_in"),
        "compagnie_nom", "altitude_baro_ft", "vitesse_kmh", "flag_changement_altitude_suspect",
    )
    an = anomalies_24h.select(F.lit(0).alias("_live"))
    u = lv.unionByName(an, allowMissingColumns=True)
    is_live = F.col("_live") == 1
    inn = is_live & F.col("_in")
    alt = F.when(inn, F.col("altitude_baro_ft"))
    spd = F.when(inn, F.round(F.col("vitesse_kmh") * 10, 0).cast("long"))
    agg = u.agg(
        F.count(F.when(inn, 1)).alias("n_avions"),
        F.count(F.when(is_live, 1)).alias("n_avions_total"),
        F.countDistinct(F.when(inn, F.col("compagnie_nom"))).alias("n_compagnies"),
        F.sum(alt.cast("long")).alias("_alt_sum"), F.count(alt).alias("_alt_n"),
        F.sum(spd).alias("_spd_sum"), F.count(spd).alias("_spd_n"),
        F.count(F.when(inn & (F.col("flag_changement_altitude_suspect") == F.lit(True)), 1))
        .alias("anomalies_actives"),
        F.count(F.when(~is_live, 1)).alias("anomalies_24h"),
    )
    return agg.select(
        "n_avions", "n_avions_total", "n_compagnies",
        F.coalesce((F.col("_alt_sum") / F.col("_alt_n")).cast("long"), F.lit(0)).alias("altitude_moyenne_ft"),
        F.coalesce((F.col("_spd_sum") / (F.col("_spd_n") * 10)).cast("long"), F.lit(0)).alias("vitesse_moyenne_kmh"),
        "anomalies_actives", "anomalies_24h",
    )


def _label():
    cs = F.nullif(F.col("callsign_principal"), F.lit(""))
    ic = F.nullif(F.col("icao24"), F.lit(""))
    return F.coalesce(cs, ic, F.lit(UNKNOWN))


def _int0(col: str):
    return F.coalesce(F.col(col).cast("long"), F.lit(0))


def map_points(live: DataFrame) -> DataFrame:
    """Marker attributes per live aircraft (SRV6): colour by phase, rotation,
    whole feet / km/h (NULL -> 0), label callsign -> icao24 -> '?', tooltip, and the
    popup's airline, country, phase and climb rates. The tooltip's wording is a fixed value."""
    p = live.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    anom = F.coalesce(F.col("flag_changement_altitude_suspect"), F.lit(False))
    alt, spd = _int0("altitude_baro_ft"), _int0("vitesse_kmh")
    return p.select(
        "icao24", "latitude", "longitude",
        phase_color("phase_vol").alias("couleur"),
        F.coalesce(F.col("cap_degres"), F.lit(0.0)).alias("rotation_deg"),
        alt.alias("altitude_ft"),
        spd.alias("vitesse_kmh"),
        anom.alias("anomalie"),
        _label().alias("libelle"),
        F.concat(F.when(anom, F.lit("⚠️ ")).otherwise(F.lit("")), _label(), F.lit(" — "),
                 F.format_number(alt, 0), F.lit(" ft — "), F.format_number(spd, 0), F.lit(" km/h"))
        .alias("infobulle"),
        # the popup's further attributes
        *[F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c) for c in ("compagnie_nom", "origine_pays", "phase_vol")],
        "taux_montee_calcule_ms", "taux_montee_declare_ms",
    )


def active_anomalies(live: DataFrame) -> DataFrame:
    """Live aircraft with the altitude-jump flag, plus |computed - declared| (SRV7)."""
    a = live.filter(F.col("flag_changement_altitude_suspect") == F.lit(True))
    calc, decl = F.col("taux_montee_calcule_ms"), F.col("taux_montee_declare_ms")
    return a.select(
        "icao24",
        _label().alias("libelle"),
        F.coalesce(F.col("compagnie_nom"), F.lit(UNKNOWN)).alias("compagnie_nom"),
        F.coalesce(F.col("origine_pays"), F.lit(UNKNOWN)).alias("origine_pays"),
        F.coalesce(F.col("phase_vol"), F.lit(UNKNOWN)).alias("phase_vol"),
        _int0("altitude_baro_ft").alias("altitude_ft"),
        _int0("vitesse_kmh").alias("vitesse_kmh"),
        calc.alias("taux_montee_calcule_ms"),
        decl.alias("taux_montee_declare_ms"),
        F.when(calc.isNotNull() & decl.isNotNull(), F.abs(calc - decl)).alias("ecart_taux_ms"),
    )


def _one_decimal(col: str):
    # Python's "{:.1f}": correctly rounded, half-even on exact binary ties, no grouping.
    return F.regexp_replace(F.format_number(F.col(col), 1), ",", "")


def anomaly_table(anomalies_24h: DataFrame) -> DataFrame:
    """Display table of the 24 h anomalies (SRV8): thousands-separated whole
    numbers, one-decimal rates, '—' for NULL."""
    def whole(col):
        return F.when(F.col(col).isNotNull(), F.format_number(F.col(col).cast("long"), 0)).otherwise(F.lit(MISSING))

    def dec1(col):
        return F.when(F.col(col).isNotNull(), _one_decimal(col)).otherwise(F.lit(MISSING))

    return anomalies_24h.select(
        F.col("callsign_principal").alias("callsign"),
        F.col("compagnie_nom").alias("compagnie"),
        F.col("origine_pays").alias("pays"),
        F.col("timestamp_utc").alias("horodatage"),
        whole("altitude_baro_ft").alias("alt_ft"),
        whole("vitesse_kmh").alias("vit_kmh"),
        dec1("taux_montee_calcule_ms").alias("taux_calc_ms"),
        dec1("taux_montee_declare_ms").alias("taux_decl_ms"),
        F.col("phase_vol").alias("phase"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per mart and whether it is non-empty (SRV9): one aggregate per
    table, unioned into one small frame. ``assert_non_empty`` raises."""
    parts = [t.agg(F.count(F.lit(1)).alias("nb_lignes")).select(F.lit(name).alias("table_name"), "nb_lignes")
             for name, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("non_vide", F.col("nb_lignes") > 0)


def assert_non_empty(counts: DataFrame) -> None:
    empty = [r["table_name"] for r in counts.filter(~F.col("non_vide")).select("table_name").collect()]
    if empty:
        raise RuntimeError(f"empty mart tables: {empty}")
