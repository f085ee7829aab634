"""Epoch seconds <-> timestamp_ntz, and tumbling-bucket starts.

The stored types are naive UTC timestamps (``timestamp_ntz``). Every
conversion here is plain wall-clock arithmetic on ``timestamp_ntz``
(epoch literal + day-time interval, ``timestamp_diff``), so results do not
depend on the session time zone; literals are built from text, never from
Python datetimes (those are converted through the session zone).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


EPOCH_TEXT = "1970-01-01 00:00:00"


def epoch_ntz() -> Column:
    return F.lit(EPOCH_TEXT).cast("timestamp_ntz")


def epoch_to_ntz(col) -> Column:
    """``TO_TIMESTAMP_NTZ(epoch_seconds)``; NULL stays NULL."""
    return epoch_ntz() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _c(col))


def ntz_to_epoch(col) -> Column:
    """Whole epoch seconds of a naive UTC timestamp (whole seconds since the epoch)."""
    return F.timestamp_diff("SECOND", epoch_ntz(), _c(col))


def bucket_start(col, seconds: int) -> Column:
    """Start of the ``seconds``-wide tumbling bucket holding ``col``.

    Same value as ``window(col, 'N seconds').start`` but keeps NULL rows
    (NULL in, NULL out) and stays ``timestamp_ntz``.
    """
    e = ntz_to_epoch(col)
    return epoch_to_ntz(e - F.pmod(e, F.lit(seconds)))


def shift_seconds(col, seconds) -> Column:
    """``col + seconds`` for a timestamp_ntz column (seconds may be a Column)."""
    s = seconds if isinstance(seconds, Column) else F.lit(int(seconds))
    return epoch_to_ntz(ntz_to_epoch(col) + s)


def ntz_literal(ts: datetime) -> Column:
    return F.lit(ts.replace(tzinfo=None).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")

