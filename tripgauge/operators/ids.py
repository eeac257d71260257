"""Dense trip numbering in pickup order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.operators.ranking import attach_row_numbers, numbered_table, row_numbers
from tripgauge.schema import TRIP_ID

ORDER = ("pickup_datetime", "pickup_latitude", "pickup_longitude")


def assign_trip_id(df: DataFrame, order: Sequence[str] = ORDER,
                   tiebreak: Sequence[str] | None = None, name: str = "trips_numbered") -> DataFrame:
    """trip_id = 1..n in ``order`` (ascending); ties broken by ``tiebreak``, then by a hash of every
    column, so only fully identical rows can swap ids (which changes nothing observable)."""
    return row_numbers(df, _sort_keys(df, order, tiebreak), TRIP_ID, start=1, name=name)


def _sort_keys(df: DataFrame, order: Sequence[str], tiebreak: Sequence[str] | None) -> list:
    return [F.col(c) for c in [*order, *(tiebreak or ())]] + [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]


def assign_trip_id_with_offsets(df: DataFrame, order: Sequence[str] = ORDER,
                                tiebreak: Sequence[str] | None = None, name: str = "trips_numbered",
                                after_sort: Callable[[DataFrame], DataFrame] | None = None):
    """Like ``assign_trip_id`` but keeps ``_mid`` and returns the partition offsets,
    so rank lookups can be pushed down to the materialised table as ``_mid`` filters.
    ``after_sort``: order-preserving steps (derive, filter) applied before numbering."""
    t, offs = numbered_table(df, _sort_keys(df, order, tiebreak), name, after_sort=after_sort)
    return attach_row_numbers(t, offs, TRIP_ID), offs
