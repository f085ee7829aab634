import os
import sys
import tempfile
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
AS_OF = datetime(2024, 1, 1, 3, 0, 0)


@pytest.fixture(scope="session")
def spark():
    from aerosift.session import get_session

    s = get_session("local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "4g"})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="aerosift-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="aerosift-test-")


BASE_ROW = dict(
    id="x", icao24="abc123", callsign="AFR100 ", origine_pays="France", time_position=1704067200,
    last_contact=1704067200, longitude=2.0, latitude=46.0, geo_altitude=1000.0, baro_altitude=1000.0,
    au_sol=False, vitesse=200.0, cap=90.0, taux_montee=0.0, squawk="1000", source_position=0,
    ingested_at=datetime(2024, 1, 1, 0, 10), batch_id="b1",
)


def raw_df(spark, rows):
    """Raw-position frame from partial dicts (missing keys take BASE_ROW values; ids made unique)."""
    from aerosift.schemas import RAW_COLUMNS, RAW_POSITIONS

    full = []
    for i, r in enumerate(rows):
        d = dict(BASE_ROW)
        d["id"] = f"id{i:05d}"
        d.update(r)
        full.append(tuple(d[c] for c in RAW_COLUMNS))
    return spark.createDataFrame(full, RAW_POSITIONS)
