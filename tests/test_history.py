"""Schema drift and the change feed: types, policies, deaths between steps."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerosift.operators import drift, feed
from aerosift.operators.sinks import RAW_TABLE
from tests.conftest import AS_OF, SF_SMALL, raw_df

I, L, D, S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


def struct(**kinds):
    return T.StructType([T.StructField(n, t) for n, t in kinds.items()])


@pytest.mark.parametrize("a, b, want", [
    (I, L, L), (T.ShortType(), T.ByteType(), T.ShortType()), (I, D, D), (T.FloatType(), I, D), (T.FloatType(), T.ShortType(), T.FloatType()),
    (L, D, S), (I, S, S), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()), (T.NullType(), I, I),
    (T.DecimalType(10, 2), I, T.DecimalType(12, 2)), (T.DecimalType(38, 10), L, T.DecimalType(38, 10)), (T.DecimalType(30, 0), T.DecimalType(20, 15), S),
    (T.ArrayType(I), T.ArrayType(L), T.ArrayType(L)), (struct(x=I), struct(y=S, x=D), struct(x=D, y=S)), (T.BooleanType(), I, S)])
def test_widest_is_symmetric_and_loses_nothing(a, b, want):
    assert drift.widest(a, b) == want
    if not isinstance(a, T.StructType):
        assert drift.widest(b, a) == want


def test_no_common_type_of_nested_and_flat():
    with pytest.raises(drift.SchemaDriftError):
        drift.widest(T.ArrayType(I), I)


@pytest.mark.parametrize("policy, columns, removed", [
    ("sync_all_columns", ["k", "w", "n"], ["gone"]), ("append_new_columns", ["k", "gone", "w", "n"], []), ("ignore", ["k", "gone", "w"], [])])
def test_policies(policy, columns, removed):
    change = drift.reconcile(struct(k=S, gone=I, w=I), struct(n=D, k=S, w=L), policy)
    assert change.schema.names == columns and change.removed == removed
    assert change.schema["w"].dataType == (I if policy == "ignore" else L)


def test_policy_fail():
    same = struct(k=S)
    assert not drift.reconcile(same, same, "fail").any
    with pytest.raises(drift.SchemaDriftError):
        drift.reconcile(same, struct(k=S, n=I), "fail")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_columns_come_go_widen_and_come_back_empty(spark, tmp_path):
    path = str(tmp_path / "t")

    def write(schema, *rows):
        return drift.upsert_drifting(spark, spark.createDataFrame(rows, schema), path, "k", "p", "k")

    write("k string, p int, x int, s struct<a:int>", ("a", 1, 1, (7,)), ("b", 2, 2, None))
    write("k string, p int, x string, s struct<a:bigint,b:string>", ("c", 2, "three", (8, "u")))
    got = drift.read_drifting(spark, path, "p")
    assert got.schema.names == ["k", "p", "x", "s"]
    assert _rows(got.select("k", "x", "s.a", "s.b")) == [("a", "1", 7, None), ("b", "2", None, None), ("c", "three", 8, "u")]
    write("k string, p int", ("a", 1))                                   # x and s go
    write("k string, p int, x int", ("d", 1, 4))                         # a new x: the old values stay gone
    assert _rows(drift.read_drifting(spark, path, "p").select("k", "p", "x")) == [("a", 1, None), ("b", 2, None), ("c", 2, None), ("d", 1, 4)]
    history = [(r.version, r.added, r.removed, r.widened) for r in drift.schema_history(spark, path).collect()]
    assert history == [(1, ["k", "p", "x", "s"], [], []), (2, [], [], ["x", "s"]), (3, [], ["x", "s"], []), (4, ["x"], [], [])]


def test_a_change_rewrites_no_file_and_a_death_after_the_log_reads_well(spark, tmp_path):
    path = str(tmp_path / "t")
    drift.append_drifting(spark, spark.createDataFrame([("a", 1, 1)], "k string, p int, x int"), path, "p", "k")
    files = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    drift.sync_schema(spark, path, struct(k=S, p=I, x=D, y=S), "p")      # the writer dies here: no data under the new schema
    assert _rows(drift.read_drifting(spark, path, "p")) == [("a", 1, 1.0, None)]
    assert files == {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    drift.append_drifting(spark, spark.createDataFrame([("b", 1, 2.5, "z")], "k string, p int, x double, y string"), path, "p", "k")
    assert _rows(drift.read_drifting(spark, path, "p")) == [("a", 1, 1.0, None), ("b", 1, 2.5, "z")]
    with pytest.raises(drift.SchemaDriftError):
        drift.sync_schema(spark, path, struct(k=S, p=S, x=D, y=S), "p")  # partition columns cannot change
    assert drift.read_drifting(spark, str(tmp_path / "none"), "p") is None


# ---- change feed --------------------------------------------------------------

def _batches(spark):
    t0 = 1704067200
    rows = [dict(icao24=f"f0000{i % 3}", time_position=t0 + 40 * i, last_contact=t0 + 40 * i, baro_altitude=900.0 + 30 * i) for i in range(60)]
    raw = raw_df(spark, rows)
    return [raw.where(F.col("id") < "id00020"), raw.where(F.col("id").between("id00015", "id00039")), raw.where(F.col("id") > "id00035")]


def _ids(df):
    return sorted(r.id for r in df.select("id").collect())


class Died(Exception):
    pass


@pytest.mark.parametrize("at", ["rows", "append", "half"])
def test_a_merge_that_dies_is_finished_by_the_next_run(spark, tmp_path, monkeypatch, at):
    table, log = str(tmp_path / "raw"), str(tmp_path / "feed")
    one, two, three = _batches(spark)
    assert feed.merge_to_feed(spark, one, table, log, "b1") == {"inserted": 20, "skipped": 0, "total": 20}
    write = feed.write_clustered

    def dying(rows, path, *a, **b):
        if at == "half":                     # the append's commit had moved some of its files
            write(rows.where("id < 'id00030'"), path, *a, **b)
        raise Died

    with monkeypatch.context() as m:
        m.setattr(feed, "write_clustered", dying)
        if at == "rows":
            m.setattr(feed, "_append", lambda *a, **b: (_ for _ in ()).throw(Died))
        with pytest.raises(Died):
            feed.merge_to_feed(spark, two, table, log, "b2")
    assert feed.pending(spark, log, "marts") == ["b1"]
    assert feed.merge_to_feed(spark, three, table, log, "b3") == {"inserted": 20, "skipped": 4, "total": 24}
    assert feed.entries(spark, log) == feed.pending(spark, log, "marts") == ["b1", "b2", "b3"]
    assert _ids(spark.read.schema(RAW_TABLE).parquet(table)) == [f"id{i:05d}" for i in range(60)]
    assert {r.batch_key: r.n for r in feed.read_feed(spark, log, ["b1", "b2", "b3"]).groupBy("batch_key").agg(
        F.count("*").alias("n")).collect()} == {"b1": 20, "b2": 20, "b3": 20}
    assert feed.merge_to_feed(spark, two, table, log, "b2")["inserted"] == 0      # the same batch again
    with pytest.raises(ValueError):
        feed.merge_to_feed(spark, raw_df(spark, [dict(id="other")]), table, log, "b2")


def test_an_update_that_dies_or_never_runs_is_made_up_whatever_its_age(spark, tmp_path):
    from aerosift.plans.incremental import incremental_update
    from aerosift.plans.tables import build_tables, read_dim, read_fact, read_int

    root = str(tmp_path / "marts")
    table, log = f"{root}/raw", f"{root}/feed"
    batches = _batches(spark)
    feed.merge_to_feed(spark, batches[0], table, log, "b1")
    assert feed.apply_feed(spark, table, log, "marts", lambda rows: build_tables(spark, rows, root, AS_OF)) == ["b1"]

    def update(rows):
        incremental_update(spark, root, spark.read.schema(RAW_TABLE).parquet(table), rows, AS_OF)

    def dies(rows):
        update(rows)
        raise Died

    feed.merge_to_feed(spark, batches[1], table, log, "b2")
    with pytest.raises(Died):                # between the update and its marker
        feed.apply_feed(spark, table, log, "marts", dies)
    feed.merge_to_feed(spark, batches[2], table, log, "b3")
    assert feed.apply_feed(spark, table, log, "marts", update) == ["b2", "b3"]
    assert feed.apply_feed(spark, table, log, "marts", dies) == []
    full = str(tmp_path / "full")
    build_tables(spark, batches[0].unionByName(batches[1]).unionByName(batches[2]).dropDuplicates(["id"]), full, AS_OF)
    for read in (read_int, read_dim, read_fact):
        a, b = read(spark, full), read(spark, root)
        assert a.count() == b.count() and a.exceptAll(b).isEmpty(), read.__name__
    assert feed.forget(spark, log, ["marts"]) == ["b1", "b2", "b3"]
    assert feed.merge_to_feed(spark, batches[1], table, log, "b2")["inserted"] == 0
    with pytest.raises(ValueError):          # a new reader cannot start from a forgotten feed
        feed.apply_feed(spark, table, log, "other", update)


# ---- rates from state -----------------------------------------------------------

def test_state_rates_agree_with_the_batch_formula_over_any_split():
    import numpy as np

    from aerosift.streaming.rates import climb_rates

    rng = np.random.default_rng(1)
    seconds = np.cumsum(rng.choice([1, 30, 60, 119, 120, 121, 200], 300))
    altitude = np.round(rng.uniform(0, 12000, 300), 1)
    altitude[rng.random(300) < 0.1] = np.nan
    rate, flag = climb_rates(seconds, altitude, 120, 100)
    for i in range(1, 300):
        dt, known = int(seconds[i] - seconds[i - 1]), not np.isnan(altitude[i - 1:i + 1]).any()
        if dt <= 120 and known:
            d = int(round(altitude[i] * 10)) - int(round(altitude[i - 1] * 10))
            assert rate[i] == np.sign(d) * ((20 * abs(d) + dt) // (2 * dt)) / 100 and flag[i] == (abs(d) > 1000 * dt)
        else:
            assert np.isnan(rate[i]) and not flag[i]
    assert np.isnan(rate[0]) and not flag[0]


def test_state_survives_a_restart_and_a_silent_aircraft_starts_anew(spark, tmp_path):
    from aerosift.operators.staging import stage
    from aerosift.schemas import RAW_POSITIONS
    from aerosift.streaming.rates import rocksdb_state, state_rates_stream

    t0, path = 1704067200, str(tmp_path)
    batches = [[("a00001", 0, 1000.0), ("a00002", 5, 500.0)], [("a00001", 60, 1600.0)], [("a00001", 400, 1000.0), ("a00002", 65, 500.0)],
               [("a00001", 430, 1090.0)], [("closing", 90_000, 0.0)]]
    with rocksdb_state(spark):
        for i, rows in enumerate(batches):
            raw_df(spark, [dict(icao24=a, time_position=t0 + s, last_contact=t0 + s, baro_altitude=h) for a, s, h in rows]).write.mode(
                "append").parquet(f"{path}/in")
            src = spark.readStream.schema(RAW_POSITIONS).parquet(f"{path}/in")
            q = (state_rates_stream(stage(src), "10 minutes").writeStream.format("parquet").option("path", f"{path}/out")
                 .option("checkpointLocation", f"{path}/ck").outputMode("append").trigger(availableNow=True).start())
            q.awaitTermination()
    got = {(r.icao24, r.timestamp_position_utc.minute * 60 + r.timestamp_position_utc.second): r.taux_montee_calcule_ms
           for r in spark.read.parquet(f"{path}/out").collect()}
    assert got == {("a00001", 0): None, ("a00002", 5): None, ("a00001", 60): 10.0, ("a00002", 65): 0.0,
                   ("a00001", 400): None, ("a00001", 430): 3.0}
    rows = q.lastProgress["stateOperators"]
    assert sum(op["numRowsTotal"] for op in rows) <= 6      # timers have dropped the silent aircraft


# ---- incremental suites and rollups ------------------------------------------------

def _small_fact(spark, rows):
    from aerosift.schemas import TABLE_SCHEMAS

    names = [f.name for f in TABLE_SCHEMAS["fact"]]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], TABLE_SCHEMAS["fact"])


def _fact_rows(seed, hours=(0, 1, 2), n=40):
    import random
    from datetime import date, datetime

    rng = random.Random(seed)
    return [dict(position_sk=f"p{h}-{rng.randrange(n) if rng.random() < 0.2 else i}-{seed if h == 2 else 0}", vol_sk=rng.choice([None, *"abcdefg"]),
                 timestamp_utc=datetime(2024, 1, 1, h, rng.randrange(60)), date_utc=date(2024, 1, 1), heure_journee=h, jour_semaine=1,
                 latitude=rng.choice([None, 45.0, 60.0]), longitude=2.0, altitude_baro_ft=rng.choice([None, 100.0, 90000.0]),
                 vitesse_kmh=300.0, tranche_vol=rng.choice(["SOL", "??", None]), phase_vol="MONTEE", au_sol=rng.choice([None, False, True]),
                 flag_changement_altitude_suspect=False) for h in hours for i in range(n)]


@pytest.mark.parametrize("suite, pinned", [("FACT_SUITE", ("position_sk",)), ("FACT_SUITE", ()), ("FACT_TESTS", ())])
def test_suite_states_equal_the_suite_and_touch_only_their_hours(spark, tmp_path, suite, pinned):
    from aerosift.operators import quality
    from aerosift.operators.quality_state import suite_results, update_states

    suite, parts, root = getattr(quality, suite), ["date_utc", "heure_journee"], str(tmp_path / "dq")
    dim = spark.createDataFrame([(x,) for x in "abcdx"], "vol_sk string")
    one = _small_fact(spark, _fact_rows(1))
    two = _small_fact(spark, [r for r in _fact_rows(1) if r["heure_journee"] < 2] + _fact_rows(9, hours=(2,)))

    def same(fact):
        want = quality.run_suite(fact, suite, refs={"dim_vols": dim})
        got = suite_results(spark, fact, root, suite, parts, pinned, {"dim_vols": dim})
        assert _rows(got) == _rows(want)

    same(one.limit(0))
    update_states(spark, one, one.select(*parts).distinct(), root, suite, parts, pinned)
    same(one)
    before = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "dq").rglob("heure_journee=[01]/*.parquet")}
    assert before
    update_states(spark, two, two.where("heure_journee = 2").select(*parts).distinct(), root, suite, parts, pinned)
    same(two)
    assert before == {str(f): f.stat().st_mtime_ns for f in (tmp_path / "dq").rglob("heure_journee=[01]/*.parquet")}


def test_rollups_count_any_range_exactly_and_keep_numbers(spark, tmp_path):
    from datetime import datetime

    from aerosift.functions.timecols import ntz_literal
    from aerosift.operators import rollups

    root, fact = str(tmp_path / "r"), _small_fact(spark, _fact_rows(3))
    assert _rows(rollups.distinct_aircraft(rollups.read_rollup(spark, root))) == [(0, 0)]
    parts = fact.select(*rollups.PARTITIONS).distinct()
    rollups.update_rollups(spark, fact, parts, root)
    known = _rows(rollups.numbers(spark, root))
    rollups.update_rollups(spark, fact, parts.where("heure_journee = 1"), root)       # again: nothing changes
    assert _rows(rollups.numbers(spark, root)) == known and sorted(n for _, n in known) == list(range(1, 8))
    rollup = rollups.read_rollup(spark, root)
    for start, stop in ((0, 180), (10, 130), (50, 60), (170, 180)):
        a, b = (datetime(2024, 1, 1, m // 60, m % 60) if m < 180 else datetime(2024, 1, 1, 3) for m in (start, stop))
        rows = [r for r in _fact_rows(3) if a <= r["timestamp_utc"] < b and r["vol_sk"]]
        got = rollups.distinct_aircraft(rollups.in_range(rollup, ntz_literal(a), ntz_literal(b))).collect()
        assert [(r.avions, r.nb_positions) for r in got] == [(len({r["vol_sk"] for r in rows}), len(rows))]


# ---- upsert ------------------------------------------------------------------------

@pytest.mark.parametrize("at", ["swap", "staging"])
def test_an_upsert_that_dies_loses_no_row(spark, tmp_path, monkeypatch, at):
    import shutil

    from aerosift.operators import sinks

    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(r, "k string, p int, x int")
    sinks.upsert(spark, rows(("a", 1, 1), ("b", 1, 2), ("c", 2, 3)), path, "k", "p")
    write = sinks.write_clustered

    def dying(df, target, *a, **b):
        if at == "swap":                     # the commit had removed the old partition
            shutil.rmtree(f"{path}/p=1")
        else:                                # the staged rows are not complete
            (tmp_path / "t" / "_upsert" / "_SUCCESS").unlink()
        raise Died

    with monkeypatch.context() as m:
        m.setattr(sinks, "write_clustered", dying)
        with pytest.raises(Died):
            sinks.upsert(spark, rows(("a", 1, 10)), path, "k", "p")
    assert sinks.write_clustered is write
    sinks.upsert(spark, rows(("d", 2, 4)), path, "k", "p")          # another batch finishes or clears it
    got = _rows(spark.read.schema("k string, p int, x int").parquet(path).select("k", "p", "x"))
    assert got == [("a", 1, 10 if at == "swap" else 1), ("b", 1, 2), ("c", 2, 3), ("d", 2, 4)]
    assert not (tmp_path / "t" / "_upsert").exists()
