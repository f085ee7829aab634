"""Classification rules: airline from callsign, flight-level band, flight phase."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values (must equal the reference) -------------------------------
# Airline by callsign prefix, checked in this order; otherwise "Autre".
AIRLINES = [
    ("AFR", "Air France"),
    ("EZY", "EasyJet"),
    ("RYR", "Ryanair"),
    ("BAW", "British Airways"),
    ("DLH", "Lufthansa"),
    ("IBE", "Iberia"),
    ("HOP", "HOP! Air France"),
    ("TVF", "Transavia France"),
    ("VLG", "Vueling"),
    ("AEE", "Aegean Airlines"),
]
OTHER_AIRLINE = "Autre"
NO_AIRLINE_CODE = "XXX"

# Flight-level bands in feet: (upper bound exclusive, label); above the last: TRES_HAUTE_ALTITUDE.
BANDS = [
    (10000, "BASSE_ALTITUDE"),
    (18000, "TRANSITION"),
    (29000, "CROISIERE_BASSE"),
    (41000, "CROISIERE_HAUTE"),
]
TOP_BAND = "TRES_HAUTE_ALTITUDE"
GROUND = "SOL"
BAND_VALUES = ["SOL", "BASSE_ALTITUDE", "TRANSITION", "CROISIERE_BASSE", "CROISIERE_HAUTE", "TRES_HAUTE_ALTITUDE"]

# Flight phases: altitude limits in feet, and the climb rate in m/s beyond which a flight climbs or sinks.
PHASE_LOW_FT, PHASE_MID_FT, PHASE_CRUISE_FT, PHASE_RATE = 1500, 10000, 25000, 2
PHASE_VALUES = ["SOL", "DECOLLAGE", "MONTEE", "CROISIERE", "DESCENTE", "ATTERRISSAGE", "TRANSITION"]
PHASE_COLORS = {
    "CROISIERE": "#1a73e8",
    "MONTEE": "#34a853",
    "DECOLLAGE": "#34a853",
    "DESCENTE": "#ea4335",
    "ATTERRISSAGE": "#ea4335",
    "TRANSITION": "#fbbc04",
    "SOL": "#9e9e9e",
}
DEFAULT_COLOR = "#fbbc04"
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def airline_code(callsign) -> Column:
    cs = _c(callsign)
    return F.when(F.length(cs) >= 3, F.substring(cs, 1, 3)).otherwise(F.lit(NO_AIRLINE_CODE))


def airline_name(callsign) -> Column:
    cs = _c(callsign)
    expr = None
    for prefix, name in AIRLINES:
        cond = cs.startswith(prefix)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OTHER_AIRLINE))


def flight_band(au_sol, alt_ft) -> Column:
    ft = _c(alt_ft)
    expr = F.when(_c(au_sol) == F.lit(True), F.lit(GROUND))
    for bound, label in BANDS:
        expr = expr.when(ft < bound, F.lit(label))
    return expr.otherwise(F.lit(TOP_BAND))


def flight_phase(au_sol, alt_ft, rate) -> Column:
    ft, r = _c(alt_ft), _c(rate)
    return (
        F.when(_c(au_sol) == F.lit(True), F.lit("SOL"))
        .when((ft < PHASE_LOW_FT) & (r > PHASE_RATE), F.lit("DECOLLAGE"))
        .when((ft < PHASE_LOW_FT) & (r < -PHASE_RATE), F.lit("ATTERRISSAGE"))
        .when((ft < PHASE_MID_FT) & (r > PHASE_RATE), F.lit("MONTEE"))
        .when((ft < PHASE_MID_FT) & (r < -PHASE_RATE), F.lit("DESCENTE"))
        .when((ft >= PHASE_CRUISE_FT) & (F.abs(F.coalesce(r, F.lit(0.0))) <= PHASE_RATE), F.lit("CROISIERE"))
        .otherwise(F.lit("TRANSITION"))
    )


def phase_color(phase) -> Column:
    m = F.create_map(*[F.lit(x) for kv in PHASE_COLORS.items() for x in kv])
    return F.coalesce(F.try_element_at(m, F.upper(_c(phase).cast("string"))), F.lit(DEFAULT_COLOR))
