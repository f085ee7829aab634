"""Print the formatted physical plans of the headline operators over stored tables.

    python scripts/show_plans.py [sf_dir]
"""

import os
import sys
import tempfile
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aerosift.operators import insights, quality, serving  # noqa: E402
from aerosift.operators.dedup import dedup  # noqa: E402
from aerosift.operators.staging import stage  # noqa: E402
from aerosift.plans.tables import build_tables, read_dim, read_fact  # noqa: E402
from aerosift.session import get_session  # noqa: E402
from aerosift.sources.events_adapter import raw_positions  # noqa: E402

AS_OF = datetime(2024, 1, 1, 3, 0, 0)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    root = tempfile.mkdtemp(prefix="aerosift-plans-")
    raw = raw_positions(spark, sf_dir)
    build_tables(spark, raw, root, AS_OF)
    fact, dim = read_fact(spark, root), read_dim(spark, root)
    live = serving.live_positions(fact, dim, AS_OF)
    for name, df in [
        ("dedup (30 s winners + previous position, one aggregation)", dedup(stage(raw))),
        ("live positions over the stored fact", live),
        ("KPIs (one aggregation over live + 24 h anomalies)", serving.kpis(live, serving.anomalies(fact, dim, AS_OF))),
        ("fact quality suite (one pass + one grouped count per unique column)", quality.run_suite(fact, quality.FACT_SUITE)),
        ("altitude coherence (bounded previous airborne row)", quality.altitude_coherence(fact)),
        ("traffic by country (per-flight pre-aggregation, rollup)", insights.traffic_by_country(fact, dim)),
    ]:
        print("=" * 100)
        print(name)
        print("=" * 100)
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
