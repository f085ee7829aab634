"""Job entry points, run in-process on the test session."""

import os

from pyspark.sql import functions as F

from tests.conftest import AS_OF, SF_SMALL


def test_build_update_check_serve(spark, tmp_dir):
    from aerosift.cli import main
    from aerosift.operators.sinks import merge_raw
    from aerosift.plans.tables import read_fact
    from aerosift.sources.events_adapter import raw_positions

    raw_path, root, out = (os.path.join(tmp_dir, n) for n in ("raw", "marts", "serve"))
    raw = raw_positions(spark, SF_SMALL)
    early = F.col("ingested_at") < F.lit("2024-01-01 02:00:00").cast("timestamp_ntz")
    merge_raw(spark, raw.filter(early), raw_path)
    main(["build", "--raw", raw_path, "--root", root, "--as-of", "2024-01-01 02:00:00"], spark)
    n_before = read_fact(spark, root).count()
    merge_raw(spark, raw.filter(~early), raw_path)
    main(["update", "--raw", raw_path, "--root", root, "--as-of", "2024-01-01 03:00:00"], spark)
    assert read_fact(spark, root).count() == 875 > n_before
    summary = main(["check", "--root", root, "--on-failure", "warn",
                    "--store", os.path.join(tmp_dir, "dq"), "--run-id", "t1"], spark)
    assert summary["checks"] == 31
    main(["serve", "--root", root, "--as-of", "2024-01-01 03:00:00", "--out", out], spark)
    assert spark.read.parquet(os.path.join(out, "live_positions")).count() == 15
    assert spark.read.parquet(os.path.join(out, "kpis")).first()["n_avions"] == 15
