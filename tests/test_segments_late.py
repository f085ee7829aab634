"""Batch segments, live slots and corrected late rows against brute force, splits and replays."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import raw_df

T0 = 1704067200


def _stg(spark, rows):
    from aerosift.operators.staging import stage

    return stage(raw_df(spark, rows))


def _random_rows(seed, n=400, hours=60):
    """Positions near period ends, repeated seconds, and one aircraft that flies through several days."""
    r = random.Random(seed)
    rows = [{"icao24": f"a{r.randrange(6)}", "time_position": T0 + r.randrange(hours) * 3600 + r.choice([0, 1, 60, 119, 120, 121, 1800, 3480, 3540, 3599])}
            for _ in range(n)]
    rows += [{"icao24": "long", "time_position": T0 + 100 * k} for k in range(0, 36 * 60)]
    rows += [{"icao24": "long", "time_position": None}, {"icao24": None, "time_position": T0}]
    return rows


def _brute(rows, gap=120):
    out, by = [], {}
    for r in rows:
        if r["icao24"] and r["time_position"] is not None:
            by.setdefault(r["icao24"], []).append(r["time_position"])
    for icao, times in by.items():
        times.sort()
        first = last = times[0]
        n = 0
        for t in times:
            if t - last > gap:
                out.append((icao, first, last + gap, n))
                first, n = t, 0
            last, n = t, n + 1
        out.append((icao, first, last + gap, n))
    return sorted(out)


def _segments(frame):
    from aerosift.functions.timecols import ntz_to_epoch

    return sorted(tuple(r) for r in frame.select("icao24", ntz_to_epoch("debut"), ntz_to_epoch("fin"), "nb_positions").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_segments_equal_brute_force_and_any_split_merges(spark, seed):
    from aerosift.operators.segments import hour_segments, join_segments, merge_hours, track_segments

    rows = _random_rows(seed)
    want = _brute(rows)
    assert _segments(track_segments(_stg(spark, rows))) == want
    r = random.Random(seed)
    dealt = [[], [], []]
    for row in rows:
        r.choice(dealt).append(row)
    parts = [hour_segments(_stg(spark, d)) for d in dealt]
    merged = merge_hours(merge_hours(parts[2], parts[0]), parts[1])
    assert _segments(join_segments(merged)) == want
    assert _segments(track_segments(_stg(spark, rows).limit(0))) == []


def test_a_long_track_is_many_groups(spark):
    """No group of the joins holds more than an hour's seconds or two partials for each period below."""
    from aerosift.operators.segments import hour_segments

    stg = _stg(spark, [{"icao24": "long", "time_position": T0 + 60 * k} for k in range(60 * 30)])
    parts = hour_segments(stg).collect()
    assert len(parts) == 30 and all(p.last_s - p.first_s < 3600 for p in parts)
    with pytest.raises(ValueError):
        from aerosift.operators.segments import join_segments
        join_segments(hour_segments(stg), gap_s=3600)


# ---- late rows -------------------------------------------------------------------------

def _late_frame(spark, seed, n=250):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        t = T0 + r.randrange(90 * 60)
        late = r.random() < 0.2
        rows.append({"icao24": f"a{r.randrange(5)}", "time_position": t, "baro_altitude": float(r.randrange(0, 3000, 50)) if r.random() < 0.9 else None,
                     "source_position": r.choice([None, 0, 1]), "ingested_at": datetime(2024, 1, 1) + timedelta(seconds=t - T0 + (4 * 3600 if late else 300))})
    return raw_df(spark, rows)


def _same(a, b):
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_winners_merge_in_any_order_and_repeatedly(spark, tmp_path):
    from aerosift.operators.dedup import dedup
    from aerosift.operators.staging import stage
    from aerosift.streaming.late import WINNER, is_late, merge_winners, rated_winners, winners_of

    stg = stage(_late_frame(spark, 5))
    on_time, late = stg.where(~is_late(7200)), stg.where(is_late(7200))
    assert on_time.count() and late.count()
    want = dedup(stg)
    for name, order in (("a", [on_time, late, late]), ("b", [late, on_time, late, on_time])):
        table = str(tmp_path / name)
        for rows in order:
            merge_winners(spark, winners_of(rows), table)
        _same(rated_winners(spark.read.parquet(table).select(*WINNER)), want)
    merge_winners(spark, winners_of(stg.limit(0)), str(tmp_path / "a"))      # an empty correction
    _same(rated_winners(spark.read.parquet(str(tmp_path / "a")).select(*WINNER)), want)


def test_a_correction_touches_its_own_hours_only(spark, tmp_path):
    from aerosift.streaming.late import merge_winners, winners_of

    table = str(tmp_path / "w")
    stg = _stg(spark, [{"icao24": f"a{k % 3}", "time_position": T0 + 600 * k} for k in range(18)])
    merge_winners(spark, winners_of(stg), table)
    before = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "w").rglob("window_hour=[01]/*.parquet")}
    assert before
    merge_winners(spark, winners_of(_stg(spark, [{"icao24": "a9", "time_position": T0 + 2 * 3600 + 5}])), table)
    assert before == {str(f): f.stat().st_mtime_ns for f in (tmp_path / "w").rglob("window_hour=[01]/*.parquet")}
    assert spark.read.parquet(table).count() == 19


def test_an_untimed_or_unstamped_row_is_not_late(spark):
    from aerosift.streaming.late import late_rows_stream

    stg = _stg(spark, [{"time_position": None}, {"ingested_at": None}, {"ingested_at": datetime(2024, 1, 1, 2, 0, 1)},
                       {"ingested_at": datetime(2024, 1, 1, 2, 0, 0)}])
    assert late_rows_stream(stg, 7200).select("ingested_at").collect()[0][0] == datetime(2024, 1, 1, 2, 0, 1)
    assert late_rows_stream(stg, 7200).count() == 1


# ---- live slots ----------------------------------------------------------------------------

def test_live_slots_equal_the_batch_answer_at_any_time(spark, tmp_path):
    from aerosift.operators import serving
    from aerosift.plans.transform import Marts
    from aerosift.session import materialize
    from aerosift.streaming.traffic import live_from_slots, store_slots

    as_of = datetime(2024, 1, 1, 1, 30)
    r = random.Random(3)
    rows = [{"icao24": f"b{r.randrange(9)}", "time_position": T0 + r.randrange(90 * 60), "au_sol": r.random() < 0.3,
             "baro_altitude": float(r.randrange(1000, 9000, 10))} for _ in range(150)]
    m = Marts(raw_df(spark, rows), as_of)
    fact, dim = materialize(m.fact, "t-fact"), materialize(m.dim, "t-dim")
    table = str(tmp_path / "slots")
    assert live_from_slots(spark, table, as_of).count() == 0
    flying = fact.where("NOT au_sol AND latitude IS NOT NULL AND longitude IS NOT NULL")
    slot = F.floor(F.minute("timestamp_utc") / 10)
    for half in (0, 1):                  # two micro-batches: the newest position of each flight and slot so far
        seen = flying if half else flying.where(F.minute("timestamp_utc") % 10 < 5)
        newest = seen.groupBy("vol_sk", "heure_utc", slot).agg(F.max_by(F.struct(*[c for c in fact.columns if c != "vol_sk"]), "timestamp_utc").alias("r"))
        store_slots(spark, newest.select("vol_sk", "r.*"), dim, table)
    for hours in (0.1, 0.5, 1, 24):
        want = serving.live_positions(fact, dim, as_of, hours)
        got = live_from_slots(spark, table, as_of, hours)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


# ---- cells of a leg --------------------------------------------------------------------------

def _walked(x0, y0, x1, y1, c):
    """From cell to cell over the edge that the leg meets first."""
    from fractions import Fraction

    i, j, i1, j1 = x0 // c, y0 // c, x1 // c, y1 // c
    out = {(i, j)}
    while (i, j) != (i1, j1):
        tx = Fraction((i + (x1 > x0)) * c - x0, x1 - x0) if i != i1 else None
        ty = Fraction((j + (y1 > y0)) * c - y0, y1 - y0) if j != j1 else None
        if ty is None or (tx is not None and (tx < ty or (tx == ty and x1 > x0))):
            i += 1 if i1 > i else -1
        else:
            j += 1 if j1 > j else -1
        out.add((i, j))
    return out


def test_leg_cells_equal_a_walk_from_cell_to_cell(spark):
    from aerosift.operators.insights import CELL_MICRO, leg_cells

    r = random.Random(4)
    coarse = lambda lo, hi: r.randrange(lo, hi) * CELL_MICRO // 4  # noqa: E731  (many corners and edges)
    legs = [tuple(coarse(-20, 20) for _ in range(4)) for _ in range(300)]
    legs += [tuple(r.randrange(-5_000_000, 5_000_000) for _ in range(4)) for _ in range(200)] + [(7, 7, 7, 7)]
    frame = spark.createDataFrame([(n, *leg) for n, leg in enumerate(legs)], "leg int, x0 long, y0 long, x1 long, y1 long")
    got = {}
    for row in leg_cells(frame).collect():
        assert (row.i, row.j) not in got.setdefault(row.leg, set())
        got[row.leg].add((row.i, row.j))
    assert got == {n: _walked(*leg, CELL_MICRO) for n, leg in enumerate(legs)}


def test_a_leg_over_the_antimeridian_takes_the_short_way(spark):
    from aerosift.operators.insights import leg_cells, legs
    from aerosift.plans.transform import Marts

    rows = [{"icao24": "pac", "time_position": T0, "longitude": 179.7, "latitude": 10.1},
            {"icao24": "pac", "time_position": T0 + 60, "longitude": -179.3, "latitude": 10.2}]
    cells = leg_cells(legs(Marts(raw_df(spark, rows), datetime(2024, 1, 1, 3)).fact)).select("i", "j").collect()
    assert sorted(map(tuple, cells)) == [(-360, 20), (-359, 20), (359, 20)]
