"""Unix seconds and timestamp text to zone-free UTC timestamps.

Results are TIMESTAMP_NTZ and do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LAST_SECOND = 253402300799  # 9999-12-31 23:59:59


def _since_epoch(unit: str, amount: Column) -> Column:
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_add(unit, amount, epoch)


def epoch_datetime(seconds: Column) -> Column:
    """Unix seconds to timestamp; out of range is NULL."""
    s = seconds.try_cast("bigint")
    return F.when(F.abs(s) <= _LAST_SECOND, _since_epoch("SECOND", s))


def as_datetime(value: Column) -> Column:
    """Unix seconds as number or text, or ISO text with or without a zone."""
    text = value.cast("string")
    seconds = F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    zoned = _since_epoch("MICROSECOND", F.unix_micros(text.try_cast("timestamp")))
    has_zone = text.rlike("[0-9](Z|[+-][0-9]{2}:?[0-9]{2})$")
    from_text = F.when(has_zone, zoned).otherwise(text.try_cast("timestamp_ntz"))
    # A failed cast is costly, so the kind of text is told apart first.
    is_number = text.rlike("^[+-]?[0-9.]+([eE][+-]?[0-9]+)?$")
    return F.when(is_number, epoch_datetime(seconds)).otherwise(from_text)
