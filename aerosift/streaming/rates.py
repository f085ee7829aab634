"""Climb rates on a stream with per-aircraft state (STR5): one value and one timer for each aircraft in the air.

``state_rates_stream`` chains two stateful operators: the 30 s dedup emits a window's winner once the watermark has
passed it, and a ``transformWithState`` operator keyed by aircraft holds the last winner (time and altitude) as value
state. Winners of one aircraft leave the first operator in the order of their windows over micro-batches; inside one
micro-batch they are sorted. A rate only uses a previous position at most ``max_gap_s`` old, so an event-time timer
drops the state of an aircraft that has been silent for longer: state follows the aircraft in the air, not all that ever flew.

The operator needs the RocksDB state store; ``rocksdb_state`` sets it for queries started inside the block.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.timecols import ntz_to_epoch
from ..session import python_workers_import
from .pipeline import window_winners_stream

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; the session's setting is as before afterwards."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def climb_rates(seconds: np.ndarray, altitude_m: np.ndarray, max_gap_s: int, max_rate: int):
    """(rates in m/s or NaN, jump flags) of positions in time order, the first without a predecessor.

    In whole decimetres, as ``functions.kinematics`` has it; a missing altitude (NaN) gives no rate on either side."""
    rate, flag = np.full(len(seconds), np.nan), np.zeros(len(seconds), bool)
    dm = np.round(altitude_m * 10)
    dt, step = np.diff(seconds), np.diff(dm)
    known = (dt > 0) & (dt <= max_gap_s) & ~np.isnan(step)
    d, t = np.abs(step[known]).astype(np.int64), dt[known]
    rate[1:][known] = np.sign(step[known]) * ((20 * d + t) // (2 * t)) / 100
    flag[1:][known] = d > max_rate * 10 * t
    return rate, flag


OUTPUT = ("position_id string, icao24 string, timestamp_position_utc timestamp_ntz, altitude_baro_m double, "
          "taux_montee_calcule_ms double, flag_changement_altitude_suspect boolean")


class ClimbRates(StatefulProcessor):
    """State of one aircraft: the second and the altitude of its last winner, until its timer."""

    def __init__(self, window_s: int, max_gap_s: int, max_rate: int):
        self.window_s, self.max_gap_s, self.max_rate = window_s, max_gap_s, max_rate

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "second bigint, altitude double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("second", ignore_index=True)
        seconds, altitude = new["second"].to_numpy(np.int64), new["altitude_baro_m"].to_numpy(float)
        held = self.last.get() if self.last.exists() else None
        if held is not None:
            seconds = np.concatenate([[held[0]], seconds])
            altitude = np.concatenate([[np.nan if held[1] is None else held[1]], altitude])
        rate, flag = climb_rates(seconds, altitude, self.max_gap_s, self.max_rate)
        skip = int(held is not None)
        self.last.update((int(seconds[-1]), None if np.isnan(altitude[-1]) else float(altitude[-1])))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((int(seconds[-1]) + self.max_gap_s + self.window_s) * 1000)
        yield pd.DataFrame({"position_id": new["position_id"], "icao24": key[0], "timestamp_position_utc": new["timestamp_position_utc"],
                            "altitude_baro_m": new["altitude_baro_m"], "taux_montee_calcule_ms": rate[skip:],
                            "flag_changement_altitude_suspect": flag[skip:]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def state_rates_stream(stg: DataFrame, watermark: str = "2 hours", window_s: int = 30, max_gap_s: int = 120,
                       max_rate: int = 100) -> DataFrame:
    """Window winners of a stream of staged rows with their computed climb rate and jump flag (append mode)."""
    python_workers_import(stg.sparkSession)
    winners = window_winners_stream(stg, watermark, window_s, event_time=True)
    rows = winners.select("icao24", "event_time", "position_id", "timestamp_position_utc", "altitude_baro_m",
                          ntz_to_epoch("timestamp_position_utc").alias("second"))
    return rows.groupBy("icao24").transformWithStateInPandas(
        ClimbRates(window_s, max_gap_s, max_rate), OUTPUT, "Append", "EventTime")
