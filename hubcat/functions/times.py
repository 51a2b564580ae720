"""Instants in UTC, whatever the zone of the session or of the driver's machine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
# A time of day with something behind it that names a zone.
_ZONED = r":[0-9]{1,2}(\.[0-9]*)?\s*[A-Za-z+-]"


def instant(stamp) -> Column:
    """A timestamp literal of a datetime, date or ISO text; without a zone it is UTC. A column comes back as a timestamp."""
    if isinstance(stamp, Column) or stamp is None:
        return (F.lit(None) if stamp is None else stamp).cast("timestamp")
    if isinstance(stamp, str):
        stamp = dt.datetime.fromisoformat(stamp)
    if not isinstance(stamp, dt.datetime):
        stamp = dt.datetime.combine(stamp, dt.time())
    if stamp.tzinfo is None:
        stamp = stamp.replace(tzinfo=dt.timezone.utc)
    since = stamp - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit(since // dt.timedelta(microseconds=1)).cast("long"))


def _wall_micros(c: Column) -> Column:
    """Microseconds since 1970 of a time without a zone."""
    seconds = F.extract(F.lit("second"), c).cast("decimal(8,6)")
    return (F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000_000 + F.hour(c).cast("long") * 3_600_000_000
            + F.minute(c).cast("long") * 60_000_000 + (seconds * 1_000_000).cast("long"))


def utc_instant(c: Column, dtype: T.DataType) -> Column:
    """Timestamp of a column of text, dates or times: zoneless ones are UTC; null where text is no time."""
    wall = F.timestamp_micros(_wall_micros(c.try_cast("timestamp_ntz")))
    if isinstance(dtype, T.StringType):
        return F.when(c.rlike(_ZONED), c.try_cast("timestamp")).otherwise(wall)
    return wall if isinstance(dtype, (T.TimestampNTZType, T.DateType)) else c.try_cast("timestamp")


def utc_text(c: Column) -> Column:
    """A timestamp as text in UTC, to the second or as fine as it is."""
    seconds = (F.unix_micros(c).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return (F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).cast("string")
