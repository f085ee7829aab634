"""Golden counts of FIXTURES.md §4 (computed independently in two engines)."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, SF_MID, SF_SMALL

SF_BIG = "/root/testdata/sf0.1"

GOLDEN = {
    SF_SMALL: dict(raw=1000, raw_null_icao=6, stg=985, flags=(13, 15, 3), inter=875, rates=376, jumps=11,
                   dim=15, dim_positions=704, fact=875, live=15, anomalies=11, af=2, ezy=2,
                   tranche=dict(SOL=6, BASSE_ALTITUDE=193, TRANSITION=162, CROISIERE_BASSE=230,
                                CROISIERE_HAUTE=254, TRES_HAUTE_ALTITUDE=30),
                   phase=dict(SOL=6, DECOLLAGE=1, ATTERRISSAGE=2, MONTEE=45, DESCENTE=34, CROISIERE=305,
                              TRANSITION=482)),
    SF_MID: dict(raw=10000, raw_null_icao=51, stg=9850, flags=(137, 166, 32), inter=8727, rates=3923, jumps=142,
                 dim=150, dim_positions=7108, fact=8727, live=150, anomalies=142, af=12, ezy=12,
                 tranche=dict(SOL=63, BASSE_ALTITUDE=1945, TRANSITION=1674, CROISIERE_BASSE=2340,
                              CROISIERE_HAUTE=2421, TRES_HAUTE_ALTITUDE=284),
                 phase=dict(SOL=63, DECOLLAGE=40, ATTERRISSAGE=50, MONTEE=403, DESCENTE=399, CROISIERE=2925,
                            TRANSITION=4847)),
    SF_BIG: dict(raw=100000, raw_null_icao=508, stg=98507, flags=(1355, 1632, 321), inter=87413, rates=38994,
                 jumps=1492, dim=1500, dim_positions=71531, fact=87413, live=1500, anomalies=1492, af=116, ezy=116,
                 tranche=dict(SOL=741, BASSE_ALTITUDE=20701, TRANSITION=16922, CROISIERE_BASSE=23670,
                              CROISIERE_HAUTE=22511, TRES_HAUTE_ALTITUDE=2868),
                 phase=dict(SOL=741, DECOLLAGE=454, ATTERRISSAGE=563, MONTEE=4011, DESCENTE=4250, CROISIERE=27452,
                            TRANSITION=49942)),
}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID, SF_BIG])
def test_golden_counts(spark, sf):
    from aerosift.operators import serving
    from aerosift.plans.transform import build_marts
    from aerosift.sources.events_adapter import raw_positions

    g = GOLDEN[sf]
    raw = raw_positions(spark, sf)
    m = build_marts(raw, AS_OF, materialize=True)
    assert raw.count() == g["raw"]
    assert raw.select("id").distinct().count() == g["raw"]
    assert raw.filter(F.col("icao24").isNull()).count() == g["raw_null_icao"]
    assert m.stg.count() == g["stg"]
    flags = m.stg.agg(*[F.sum(F.col(c).cast("int")) for c in
                        ("flag_altitude_suspecte", "flag_vitesse_suspecte", "flag_coords_invalides")]).first()
    assert tuple(flags) == g["flags"]
    assert m.inter.count() == g["inter"]
    assert m.inter.select("position_id").distinct().count() == g["inter"]
    assert m.inter.filter(F.col("taux_montee_calcule_ms").isNotNull()).count() == g["rates"]
    assert m.inter.filter("flag_changement_altitude_suspect").count() == g["jumps"]
    assert m.dim.count() == g["dim"]
    assert m.dim.agg(F.sum("nb_positions_total")).first()[0] == g["dim_positions"]
    assert m.dim.filter(F.col("compagnie_nom") == "Air France").count() == g["af"]
    assert m.dim.filter(F.col("compagnie_nom") == "EasyJet").count() == g["ezy"]
    assert m.fact.count() == g["fact"]
    assert {r[0]: r[1] for r in m.fact.groupBy("tranche_vol").count().collect()} == g["tranche"]
    assert {r[0]: r[1] for r in m.fact.groupBy("phase_vol").count().collect()} == g["phase"]
    assert serving.live_positions(m.fact, m.dim, AS_OF).count() == g["live"]
    assert serving.anomalies(m.fact, m.dim, AS_OF).count() == g["anomalies"]


def test_quality_findings_sf001(spark):
    """FIXTURES.md §4 quality figures at sf 0.01: both passing and failing checks."""
    from aerosift.operators.quality import FACT_SUITE, FACT_TESTS, RAW_SUITE, run_suite
    from aerosift.plans.transform import build_marts
    from aerosift.sources.events_adapter import raw_positions

    raw = raw_positions(spark, SF_MID)
    m = build_marts(raw, AS_OF, materialize=True)
    fs = {(r["check_name"], r["column_name"]): r for r in run_suite(m.fact, FACT_SUITE).collect()}
    alt = fs[("expect_between", "altitude_baro_ft")]
    assert round(alt["observed"] * 100, 2) == 98.12 and not alt["success"]
    assert fs[("expect_between", "vitesse_kmh")]["unexpected"] == 0
    assert fs[("expect_between", "latitude")]["unexpected"] == 0
    assert fs[("expect_between", "longitude")]["unexpected"] == 0
    prop = fs[("expect_unique_proportion", "vol_sk")]
    assert round(prop["observed"], 4) == 0.0172 and prop["success"]
    ft = {(r["check_name"], r["column_name"]): r for r in
          run_suite(m.fact, FACT_TESTS, refs={"dim_vols": m.dim}).collect()}
    warn = ft[("accepted_range", "altitude_baro_ft")]
    assert warn["unexpected"] == 162 and warn["status"] == "warn"
    rs = {(r["check_name"], r["column_name"]): r for r in run_suite(raw, RAW_SUITE).collect()}
    rx = rs[("expect_match_regex", "icao24")]
    assert round(rx["observed"] * 100, 1) == 85.7 and not rx["success"]
