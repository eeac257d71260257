"""Time helpers that do not depend on the session time zone.

Trip timestamps are wall-clock values (``timestamp_ntz``). Epoch arithmetic
is built from the wall-clock fields (date, hour, minute, second), so results
are identical on every cluster whatever ``spark.sql.session.timeZone`` says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c) -> Column:
    """Text or timestamp -> ``timestamp_ntz``; unparseable text -> null.

    Accepts ``yyyy-MM-dd HH:mm:ss`` and the other ISO-8601 forms the default
    cast understands (fractional seconds, ``T`` separator), never raising.
    """
    return _c(c).try_cast("timestamp_ntz")


def _epoch_whole_seconds(ts: Column) -> Column:
    day = F.unix_date(ts.cast("date")).cast("long")
    return (day * F.lit(86_400) + F.hour(ts).cast("long") * F.lit(3_600)
            + F.minute(ts).cast("long") * F.lit(60) + F.second(ts).cast("long"))


def epoch_micros(c) -> Column:
    """Microseconds since 1970-01-01 00:00:00 of a wall-clock (``timestamp_ntz``) value.

    Built from the wall-clock fields, so no session time zone is involved.
    """
    ts = _c(c)
    frac = ((F.date_part(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("long")) % F.lit(1_000_000)
    return _epoch_whole_seconds(ts) * F.lit(1_000_000) + frac


def epoch_seconds(c) -> Column:
    """Whole seconds since the epoch, floored (the sub-second part is dropped)."""
    return _epoch_whole_seconds(_c(c))


def duration_seconds(pickup, dropoff) -> Column:
    """Each timestamp truncated to whole seconds, then subtracted."""
    return epoch_seconds(dropoff) - epoch_seconds(pickup)


def day_of_week(ts, numbering: str = "monday") -> Column:
    """0..6. ``monday``: Monday = 0 (documented meaning);
    ``reference``: Sunday = 0 (what the evaluated SQL computed)."""
    if numbering == "monday":
        return F.weekday(_c(ts))
    if numbering == "reference":
        return F.dayofweek(_c(ts)) - 1
    raise ValueError(f"unknown weekday numbering {numbering!r}")
