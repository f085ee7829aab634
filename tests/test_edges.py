"""Hand-made edge frames (FIXTURES.md §5)."""

from datetime import datetime, timedelta
from fractions import Fraction
import decimal

from pyspark.sql import functions as F

from tests.conftest import AS_OF, raw_df

T0 = 1704067200  # 2024-01-01 00:00:00


def _round_half_away(fr: Fraction, places: int) -> float:
    q = decimal.Decimal(fr.numerator) / decimal.Decimal(fr.denominator)
    return float(q.quantize(decimal.Decimal(1).scaleb(-places), rounding=decimal.ROUND_HALF_UP))


# ---- classification ------------------------------------------------------------------

def _band(au_sol, ft):
    if au_sol is True:
        return "SOL"
    for bound, label in [(10000, "BASSE_ALTITUDE"), (18000, "TRANSITION"), (29000, "CROISIERE_BASSE"),
                         (41000, "CROISIERE_HAUTE")]:
        if ft is not None and ft < bound:
            return label
    return "TRES_HAUTE_ALTITUDE"


def _phase(au_sol, ft, r):
    def lt(a, b):
        return a is not None and b is not None and a < b

    if au_sol is True:
        return "SOL"
    if lt(ft, 1500) and r is not None and r > 2:
        return "DECOLLAGE"
    if lt(ft, 1500) and r is not None and r < -2:
        return "ATTERRISSAGE"
    if lt(ft, 10000) and r is not None and r > 2:
        return "MONTEE"
    if lt(ft, 10000) and r is not None and r < -2:
        return "DESCENTE"
    if ft is not None and ft >= 25000 and abs(r if r is not None else 0) <= 2:
        return "CROISIERE"
    return "TRANSITION"


def test_band_and_phase_thresholds(spark):
    from aerosift.functions.classify import flight_band, flight_phase

    fts = [1499.0, 1500.0, 9999.0, 10000.0, 17999.0, 18000.0, 24999.0, 25000.0, 28999.0, 29000.0,
           40999.0, 41000.0, None]
    rates = [-2.01, -2.0, 0.0, 2.0, 2.01, None]
    rows = [(a, f, r) for a in (True, False, None) for f in fts for r in rates]
    df = spark.createDataFrame(rows, "au_sol boolean, ft double, r double")
    got = df.select("au_sol", "ft", "r", flight_band("au_sol", "ft").alias("b"),
                    flight_phase("au_sol", "ft", "r").alias("p")).collect()
    assert len(got) == len(rows)
    for g in got:
        assert g["b"] == _band(g["au_sol"], g["ft"]), g
        assert g["p"] == _phase(g["au_sol"], g["ft"], g["r"]), g


def test_staging_flags(spark):
    from aerosift.operators.staging import stage

    cases = [
        dict(baro_altitude=-0.1), dict(baro_altitude=0.0), dict(baro_altitude=45000.0),
        dict(baro_altitude=45000.1), dict(baro_altitude=None),
        dict(vitesse=-0.1), dict(vitesse=0.0), dict(vitesse=340.0), dict(vitesse=340.1), dict(vitesse=None),
        dict(latitude=90.0), dict(latitude=-90.0), dict(latitude=90.1), dict(latitude=-90.1),
        dict(longitude=180.0), dict(longitude=-180.0), dict(longitude=180.1), dict(longitude=-180.1),
        dict(latitude=None), dict(icao24=None),
    ]
    out = {r["position_id_raw"]: r for r in stage(raw_df(spark, cases)).collect()}
    exp_alt = [True, False, False, True, False]
    exp_speed = [True, False, False, True, False]
    exp_coord = [False, False, True, True, False, False, True, True]
    for i, e in enumerate(exp_alt):
        assert out[f"id{i:05d}"]["flag_altitude_suspecte"] is e
    for i, e in enumerate(exp_speed):
        assert out[f"id{5 + i:05d}"]["flag_vitesse_suspecte"] is e
    for i, e in enumerate(exp_coord):
        assert out[f"id{10 + i:05d}"]["flag_coords_invalides"] is e
    assert "id00018" not in out and "id00019" not in out  # no latitude / no icao24: dropped
    r = out["id00000"]
    assert r["icao24"] == "abc123" and r["callsign"] == "AFR100"


def test_window_borders(spark):
    from aerosift.functions.timecols import bucket_start, epoch_to_ntz

    secs = [0, 29, 30, 59, 60, 86399, 86400, None]
    df = spark.createDataFrame([(None if s is None else T0 + s,) for s in secs], "e long")
    got = [r[0] for r in df.select(bucket_start(epoch_to_ntz("e"), 30)).collect()]
    base = datetime(2024, 1, 1)
    exp = [base, base, base + timedelta(seconds=30), base + timedelta(seconds=30), base + timedelta(seconds=60),
           base + timedelta(seconds=86370), base + timedelta(days=1), None]
    assert got == exp


# ---- dedup ------------------------------------------------------------------------------

def _winners(spark, rows):
    from aerosift.operators.dedup import dedup
    from aerosift.operators.staging import stage

    return {r["icao24"]: r for r in dedup(stage(raw_df(spark, rows))).collect()}


def test_dedup_ties(spark):
    ing = datetime(2024, 1, 1, 0, 10)
    rows = [
        # a1: better sensor wins over higher altitude
        dict(icao24="a00001", source_position=1, baro_altitude=5000.0, id="z1"),
        dict(icao24="a00001", source_position=0, baro_altitude=1000.0, time_position=T0 + 5, id="z2"),
        # a2: equal quality -> higher altitude
        dict(icao24="a00002", baro_altitude=1000.0, id="y1"),
        dict(icao24="a00002", baro_altitude=2000.0, time_position=T0 + 3, id="y2"),
        # a3: NULL altitude loses to a value
        dict(icao24="a00003", baro_altitude=None, id="x1"),
        dict(icao24="a00003", baro_altitude=10.0, time_position=T0 + 3, id="x2"),
        # a4: equal altitude -> earliest ingest
        dict(icao24="a00004", ingested_at=ing + timedelta(minutes=10), id="w1"),
        dict(icao24="a00004", ingested_at=ing, time_position=T0 + 7, id="w2"),
        # a5: everything equal -> smallest raw id
        dict(icao24="a00005", id="v2", time_position=T0 + 1),
        dict(icao24="a00005", id="v1", time_position=T0 + 2),
        # a6: unknown sensor (score 99) loses
        dict(icao24="a00006", source_position=None, baro_altitude=9000.0, id="u1"),
        dict(icao24="a00006", source_position=3, baro_altitude=10.0, time_position=T0 + 4, id="u2"),
    ]
    from aerosift.operators.dedup import dedup
    from aerosift.operators.staging import stage

    got = {r["icao24"]: r for r in dedup(stage(raw_df(spark, rows))).collect()}
    ts = {k: int(v["timestamp_position_utc"].timestamp()) - T0 for k, v in got.items()}
    assert ts == {"a00001": 5, "a00002": 3, "a00003": 3, "a00004": 7, "a00005": 2, "a00006": 4}
    assert got["a00006"]["quality_score"] == 3


def test_dedup_unique_and_order_independent(spark):
    from aerosift.operators.dedup import dedup
    from aerosift.operators.staging import stage
    from aerosift.sources.events_adapter import raw_positions

    raw = raw_positions(spark, "/root/testdata/sf0.001")
    a = dedup(stage(raw))
    b = dedup(stage(raw.repartition(7, "batch_id").sortWithinPartitions(F.rand(3))))
    assert a.count() == a.select("icao24", "window_30s").distinct().count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# ---- continuity: climb rate and jump flag ---------------------------------------------

CONTINUITY = [
    # (aircraft, [(second, altitude_m)], expected (rate, flag) of the last row)
    ("c00001", [(29, 1000.0), (30, 1000.5)], (0.5, False)),          # Δt = 1
    ("c00002", [(0, 1000.0), (119, 1119.0)], (1.0, False)),          # Δt = 119
    ("c00003", [(0, 1000.0), (120, 1240.0)], (2.0, False)),          # Δt = 120
    ("c00004", [(0, 1000.0), (121, 1121.0)], (None, False)),         # Δt = 121: out of reach
    ("c00005", [(25, 1000.0), (35, 2000.0)], (100.0, False)),        # exactly 100 m/s: not suspect
    ("c00006", [(25, 1000.0), (35, 2000.1)], (100.01, True)),        # 100.01 m/s
    ("c00007", [(20, 7060.0), (60, 26926.6)], (496.67, True)),       # 496.665 -> half away from zero
    ("c00008", [(20, 26926.6), (60, 7060.0)], (-496.67, True)),
    ("c00009", [(29, 1000.0), (149, 1120.0)], (1.0, False)),         # predecessor 4 windows back, Δt = 120
    ("c00010", [(0, 1000.0), (149, 1120.0)], (None, False)),         # 4 windows back, Δt = 149
    ("c00011", [(0, 1000.0), (300, 1000.0)], (None, False)),         # far predecessor
    ("c00012", [(0, None), (60, 1000.0)], (None, False)),            # NULL previous altitude
    ("c00013", [(0, 1000.0), (40, 1500.0), (70, 1400.0)], (-3.33, False)),  # LAG = latest window, not first
]


def test_continuity(spark):
    from aerosift.operators.dedup import dedup
    from aerosift.operators.staging import stage

    rows = []
    for ac, pts, _ in CONTINUITY:
        for s, alt in pts:
            rows.append(dict(icao24=ac, time_position=T0 + s, last_contact=T0 + s, baro_altitude=alt))
    got = dedup(stage(raw_df(spark, rows))).collect()
    last = {}
    for r in got:
        if r["icao24"] not in last or r["timestamp_position_utc"] > last[r["icao24"]]["timestamp_position_utc"]:
            last[r["icao24"]] = r
    for ac, pts, (rate, flag) in CONTINUITY:
        r = last[ac]
        assert r["taux_montee_calcule_ms"] == rate, (ac, r["taux_montee_calcule_ms"])
        assert r["flag_changement_altitude_suspect"] is flag, ac


def test_rounding_formula_matches_exact_rational():
    """The integer climb-rate formula equals ROUND(Δ/Δt, 2) half away from zero on exact values."""
    import itertools

    def formula(d, dt):
        q = (20 * abs(d) + dt) // (2 * dt)
        return (1 if d > 0 else -1 if d < 0 else 0) * q / 100

    for d, dt in itertools.product(range(-3000, 3001, 7), range(1, 121, 13)):
        assert formula(d, dt) == _round_half_away(Fraction(d, 10 * dt), 2)


def test_coherence_uses_previous_airborne_row(spark):
    from aerosift.operators.quality import altitude_coherence
    from aerosift.plans.transform import build_marts

    rows = [
        dict(icao24="d00001", time_position=T0, baro_altitude=1000.0, au_sol=False),
        dict(icao24="d00001", time_position=T0 + 30, baro_altitude=0.0, au_sol=True),
        dict(icao24="d00001", time_position=T0 + 60, baro_altitude=9000.0, au_sol=False),
    ]
    m = build_marts(raw_df(spark, rows), AS_OF)
    out = altitude_coherence(m.fact).collect()
    assert len(out) == 1
    assert out[0]["delta_secondes"] == 60 and out[0]["altitude_precedente_m"] == 1000.0
    # the int layer's own LAG sees the ground row (Δ 9000 m in 30 s)
    assert m.inter.filter("flag_changement_altitude_suspect").count() == 1


# ---- dimension ------------------------------------------------------------------------

def test_callsigns_and_airlines(spark):
    from aerosift.plans.transform import build_marts

    rows = []
    for ac, cs in [("e00001", None), ("e00002", ""), ("e00003", "AB"), ("e00004", "AFR"), ("e00005", "afr12 "),
                   ("e00006", "HOP77"), ("e00007", "klm9")]:
        rows.append(dict(icao24=ac, callsign=cs))
    # two callsigns with equal counts: the one seen last wins
    rows += [dict(icao24="e00008", callsign="EZY1", time_position=T0),
             dict(icao24="e00008", callsign="RYR1", time_position=T0 + 60)]
    dim = {r["icao24"]: r for r in build_marts(raw_df(spark, rows), AS_OF).dim.collect()}
    assert (dim["e00001"]["code_compagnie"], dim["e00001"]["compagnie_nom"]) == ("XXX", "Autre")
    assert (dim["e00002"]["code_compagnie"], dim["e00002"]["compagnie_nom"]) == ("XXX", "Autre")
    assert (dim["e00003"]["code_compagnie"], dim["e00003"]["compagnie_nom"]) == ("XXX", "Autre")
    assert (dim["e00004"]["code_compagnie"], dim["e00004"]["compagnie_nom"]) == ("AFR", "Air France")
    assert (dim["e00005"]["callsign_principal"], dim["e00005"]["compagnie_nom"]) == ("AFR12", "Air France")
    assert dim["e00006"]["compagnie_nom"] == "HOP! Air France"
    assert (dim["e00007"]["code_compagnie"], dim["e00007"]["compagnie_nom"]) == ("KLM", "Autre")
    assert dim["e00008"]["callsign_principal"] == "RYR1"
    assert dim["e00008"]["nb_positions_total"] == 1


# ---- empties ----------------------------------------------------------------------------

def test_empty_batch_flows_through(spark):
    from aerosift.operators import serving
    from aerosift.operators.quality import FACT_SUITE, run_suite
    from aerosift.plans.transform import build_marts

    m = build_marts(raw_df(spark, []), AS_OF)
    assert m.fact.count() == 0 and m.dim.count() == 0
    live = serving.live_positions(m.fact, m.dim, AS_OF)
    k = serving.kpis(live, serving.anomalies(m.fact, m.dim, AS_OF)).first().asDict()
    assert k == dict(n_avions=0, n_avions_total=0, n_compagnies=0, altitude_moyenne_ft=0, vitesse_moyenne_kmh=0,
                     anomalies_actives=0, anomalies_24h=0)
    res = {r["check_name"] + str(r["column_name"]): r for r in run_suite(m.fact, FACT_SUITE).collect()}
    assert res["row_count_betweenNone"]["success"] is False
    assert res["expect_unique_proportionvol_sk"]["success"] is False


def test_map_points_defaults(spark):
    from aerosift.operators.serving import map_points

    rows = [("a1", None, "", 45.0, 2.0, None, None, None, "MONTEE", True),
            ("", None, None, 45.0, 2.0, 1234.0, 812.7, 10.0, "weird", False)]
    df = spark.createDataFrame(rows, "icao24 string, callsign_principal string, compagnie_nom string, "
                                     "latitude double, longitude double, altitude_baro_ft double, vitesse_kmh double, "
                                     "cap_degres double, phase_vol string, flag_changement_altitude_suspect boolean")
    # the live set's further columns, which the popup shows
    df = df.withColumns({"origine_pays": F.lit(None).cast("string"), "taux_montee_calcule_ms": F.lit(1.5),
                         "taux_montee_declare_ms": F.lit(None).cast("double")})
    got = map_points(df).collect()
    a, b = got[0], got[1]
    assert (a["libelle"], a["altitude_ft"], a["vitesse_kmh"], a["rotation_deg"], a["couleur"]) == \
        ("a1", 0, 0, 0.0, "#34a853")
    assert a["infobulle"] == "⚠️ a1 — 0 ft — 0 km/h"
    assert (b["libelle"], b["couleur"], b["infobulle"]) == ("?", "#fbbc04", "? — 1,234 ft — 812 km/h")
    assert (a["compagnie_nom"], a["origine_pays"], a["phase_vol"], a["taux_montee_calcule_ms"], a["taux_montee_declare_ms"]) == \
        ("", "?", "MONTEE", 1.5, None)


def test_orphan_positions(spark):
    from aerosift.operators.marts import orphan_count, orphan_positions
    from aerosift.plans.transform import build_marts

    rows = [dict(icao24="g00001"), dict(icao24="g00002", time_position=T0 + 40)]
    m = build_marts(raw_df(spark, rows), AS_OF)
    partial_dim = m.dim.filter(F.col("icao24") == "g00001")
    assert [r["icao24"] for r in orphan_positions(m.inter, partial_dim).collect()] == ["g00002"]
    assert orphan_count(m.inter, partial_dim).first()[0] == 1
    assert orphan_count(m.inter, m.dim).first()[0] == 0
    assert m.fact.count() == 2 and set(r["vol_sk"] for r in m.fact.collect()) == set(
        r["vol_sk"] for r in m.dim.collect())
