"""What a merge of window winners costs: one shuffle of the touched hours, one write, and no micro-batch that only closes windows."""

from __future__ import annotations

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import raw_df

T0 = 1704067200
SCHEMA = "k string, p int, c string, x int"


class Died(Exception):
    pass


def _rows(frame):
    return sorted(map(tuple, frame.select("k", "p", "c", "x").collect()), key=str)


def _table(spark, path):
    return _rows(spark.read.schema(SCHEMA).parquet(path))


def _winners(spark, seed, hours, n=120):
    from aerosift.operators.staging import stage
    from aerosift.streaming.late import winners_of

    r = random.Random(seed)
    return winners_of(stage(raw_df(spark, [
        {"id": f"{seed}-{i}", "icao24": f"a{r.randrange(4)}", "time_position": T0 + 3600 * r.choice(hours) + r.randrange(40) * 30,
         "baro_altitude": float(r.randrange(0, 3000, 50)), "source_position": r.choice([None, 0, 1])} for i in range(n)])))


def test_rows_of_a_key_meet_in_the_shuffle_that_clusters_them(spark):
    from aerosift.operators.sinks import best_clustered

    df = spark.createDataFrame([("a", 1, "u", 3), ("a", 1, "u", 2), ("b", 1, "v", 1), ("c", None, "u", 1), ("c", None, "u", 0)], SCHEMA)
    best = best_clustered(df, "k", ["x"], ["p"], "c")
    assert _rows(best) == sorted([("a", 1, "u", 2), ("b", 1, "v", 1), ("c", None, "u", 0)], key=str)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == plan.count("Exchange rangepartitioning") == 1 and "Join" not in plan


def test_a_merge_writes_the_touched_hours_once(spark, tmp_path, monkeypatch):
    from aerosift.operators import sinks
    from aerosift.streaming.late import WINNER, _best, merge_winners

    written, write = [], sinks.write_clustered
    monkeypatch.setattr(sinks, "write_clustered", lambda *a, **b: written.append(a) or write(*a, **b))
    table, first, second = str(tmp_path / "w"), _winners(spark, 1, [0, 1]), _winners(spark, 2, [1, 2])
    for rows in (first, second, second):
        merge_winners(spark, rows, table)
    assert written == []            # the staged folders are moved, their rows are not written again
    want, got = _best(first.unionByName(second)).select(*WINNER), spark.read.parquet(table).select(*WINNER)
    assert got.count() == want.count() > max(first.count(), second.count())
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    assert not os.path.exists(f"{table}/_upsert")


def test_an_ordered_upsert_keeps_the_better_row(spark, tmp_path):
    from aerosift.operators.sinks import upsert

    path = str(tmp_path / "t")
    df = lambda *r: spark.createDataFrame(r, SCHEMA)
    batches = [(("a", 1, "u", 5), ("b", 1, "u", 5), ("n", None, "u", 5)), (("a", 1, "u", 7), ("b", 1, "u", 3), ("d", 2, "v", 1)),
               (("n", None, "u", 4),), (("d", 2, "v", 1),)]
    for batch in batches:
        upsert(spark, df(*batch), path, "k", "p", "c", order=["x"])
    assert _table(spark, path) == sorted([("a", 1, "u", 5), ("b", 1, "u", 3), ("d", 2, "v", 1), ("n", None, "u", 4)], key=str)
    upsert(spark, df(("a", 1, "u", 9)), path, "k", "p", "c")         # without an order the new row replaces the stored one
    assert ("a", 1, "u", 9) in _table(spark, path)


@pytest.mark.parametrize("at", ["before", "deleted", "moved", "staging"])
def test_an_ordered_upsert_that_dies_loses_no_row(spark, tmp_path, monkeypatch, at):
    import shutil

    from aerosift.operators import sinks

    path = str(tmp_path / "t")
    df = lambda *r: spark.createDataFrame(r, SCHEMA)
    sinks.upsert(spark, df(("a", 1, "u", 5), ("b", 2, "u", 5), ("c", 3, "u", 5)), path, "k", "p", "c", order=["x"])
    move = sinks._move_folder

    def dying(spark, source, target):
        if at == "deleted":
            shutil.rmtree(target)
        elif at == "moved":
            move(spark, source, target)
        elif at == "staging":               # the staged rows are not complete
            os.remove(f"{path}/_upsert/_SUCCESS")
        raise Died

    with monkeypatch.context() as m:
        m.setattr(sinks, "_move_folder", dying)
        with pytest.raises(Died):
            sinks.upsert(spark, df(("a", 1, "u", 1), ("b", 2, "u", 2)), path, "k", "p", "c", order=["x"])
    sinks.upsert(spark, df(("d", 3, "u", 4)), path, "k", "p", "c", order=["x"])          # another batch finishes or clears it
    a, b = (5, 5) if at == "staging" else (1, 2)
    assert _table(spark, path) == [("a", 1, "u", a), ("b", 2, "u", b), ("c", 3, "u", 5), ("d", 3, "u", 4)]
    assert not os.path.exists(f"{path}/_upsert")


def test_late_corrected_closes_windows_with_the_next_slice(spark, tmp_path, monkeypatch):
    """One micro-batch for each of the five deliveries, and one more that closes the last windows."""
    from aerosift.functions.timecols import epoch_to_ntz
    from aerosift.operators.dedup import dedup
    from aerosift.operators.staging import stage
    from aerosift.plans import catalog_streams as cs
    from aerosift.sources.events_adapter import raw_positions

    spark.range(400).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"),
                            epoch_to_ntz(F.lit(T0) + F.col("id") * 6480).alias("ts")).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(cs, "scratch_path", lambda spark, name: str(tmp_path / name))
    got = cs.q_late_corrected(spark, str(tmp_path))
    want = dedup(stage(cs.with_late_rows(raw_positions(spark, str(tmp_path), keep_event_id=True))))
    assert got.count() == want.count() > 200
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    assert got.select(F.max("window_30s")).first()[0] > datetime(2024, 1, 1, 2, 50)
    assert sorted(int(f) for f in os.listdir(tmp_path / "corrected" / "ck-winners" / "commits") if f.isdigit()) == list(range(6))
