"""Checkpoint-folder policy: the shared folder named by the session, else one inside the warehouse."""

import pytest


class _Conf(dict):
    def get(self, k, default=None):
        return dict.get(self, k, default)

    def set(self, k, v):
        self[k] = v


class _FakeSession:
    def __init__(self, conf):
        self.conf = _Conf(conf)

    @property
    def sparkContext(self):   # noqa: N802 - mirrors the real attribute
        raise RuntimeError("no SparkContext view")


@pytest.mark.parametrize("master", ["yarn", "local[2]", "local-cluster[1,1,1024]"])
def test_checkpoint_folder_does_not_depend_on_the_master(master):
    from aerosift.session import checkpoint_dir

    conf = {"spark.master": master, "spark.sql.warehouse.dir": "hdfs://x/wh"}
    session = _FakeSession(conf)
    assert checkpoint_dir(session) == "hdfs://x/wh/_scratch"
    assert "spark.checkpoint.dir" not in session.conf          # the caller's settings stay as they are
    assert checkpoint_dir(_FakeSession({**conf, "spark.checkpoint.dir": "hdfs://x/ckpt/"})) == "hdfs://x/ckpt"


def test_public_api_resolves():
    import aerosift

    assert all(callable(getattr(aerosift, n)) for n in aerosift.__all__)
    with pytest.raises(AttributeError):
        aerosift.not_there  # noqa: B018


def test_generated_methods_stay_small_enough_to_be_compiled(spark):
    """HotSpot never compiles methods beyond 8,000 bytes; a limit that the session set itself stays."""
    from aerosift.session import METHOD_LIMIT
    from aerosift.sources.events_adapter import raw_positions
    from tests.conftest import SF_SMALL

    before = spark.conf.get(METHOD_LIMIT)
    try:
        spark.conf.unset(METHOD_LIMIT)
        raw_positions(spark, SF_SMALL)
        assert spark.conf.get(METHOD_LIMIT) == "8000"
        spark.conf.set(METHOD_LIMIT, "12345")
        raw_positions(spark, SF_SMALL)
        assert spark.conf.get(METHOD_LIMIT) == "12345"
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def test_slices_of_a_stored_frame_read_their_own_files(spark):
    """Rows read slice by slice are stored by slice: one slice's scan lists its partition only, with all columns in place."""
    from pyspark.sql import functions as F

    from aerosift.session import materialize

    df = spark.range(90).select((F.col("id") % 3).cast("string").alias("part"), "id", F.when(F.col("id") > 80, None).otherwise(1).alias("x"))
    df = df.withColumn("part", F.when(F.col("id") != 7, F.concat(F.lit("2024-01-01 00:0"), "part", F.lit(":00"))))
    stored = materialize(df, "sliced", ["part"])
    assert stored.columns == df.columns and sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    one = stored.where("part = '2024-01-01 00:01:00'")
    assert one.count() == 29 and one.select(F.input_file_name()).where("input_file_name() NOT LIKE '%00%3A01%3A00%'").isEmpty()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_released_shuffles_are_deleted_and_the_setting_returns(spark):
    import time

    from pyspark.sql import functions as F

    from aerosift.session import SHUFFLE_CLEANUP, materialize, shuffles_released

    def files():
        found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(",").split(",")
        return {f for f in found if "/shuffle_" in f}

    before, known = spark.conf.get(SHUFFLE_CLEANUP), files()
    with pytest.raises(ZeroDivisionError), shuffles_released(spark):
        held = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "released")
        until = time.time() + 20
        while files() - known and time.time() < until:
            time.sleep(0.1)
        assert not files() - known
        raise ZeroDivisionError
    assert spark.conf.get(SHUFFLE_CLEANUP) == before
    assert held.count() == 7
