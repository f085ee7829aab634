"""Hash keys: surrogate keys (MD5), position id (SHA-256), batch id (MD5)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for identical keys:
#   surrogate-key NULL placeholder "NULL_PLACEHOLDER", separator "|"
#   position-id separator "_", NULL text "None", coordinates at 4 decimals
#   batch-id clock text format "%Y%m%d_%H%M%S" (UTC)
NULL_PLACEHOLDER = "NULL_PLACEHOLDER"
KEY_SEPARATOR = "|"
POSITION_ID_SEPARATOR = "_"
PY_NONE = "None"
BATCH_CLOCK_FORMAT = "%Y%m%d_%H%M%S"
BATCH_CLOCK_PATTERN = "yyyyMMdd_HHmmss"     # the same for date_format


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def surrogate_key(*cols) -> Column:
    """MD5 over the pipe-joined text of each field, NULL -> placeholder."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_PLACEHOLDER)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def _coord_text(col) -> Column:
    return F.coalesce(_c(col).try_cast("decimal(9,4)").cast("string"), F.lit(PY_NONE))


def position_id(icao24, time_position, latitude, longitude) -> Column:
    """SHA-256 of ``icao24_time_lat4_lon4`` (coordinates as decimal(9,4) text)."""
    return F.sha2(
        F.concat_ws(
            POSITION_ID_SEPARATOR,
            F.coalesce(_c(icao24).cast("string"), F.lit(PY_NONE)),
            F.coalesce(_c(time_position).cast("string"), F.lit(PY_NONE)),
            _coord_text(latitude),
            _coord_text(longitude),
        ),
        256,
    )


def batch_id(as_of: datetime) -> Column:
    """MD5 of the UTC second of the ingest run (one value per batch)."""
    return F.md5(F.lit(as_of.strftime(BATCH_CLOCK_FORMAT)))
