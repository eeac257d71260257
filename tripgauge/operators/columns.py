"""Schema normalisation and derived trip columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

from tripgauge.functions import (
    day_of_week, distance_bucket, duration_seconds, haversine_km, parse_timestamp,
)
from tripgauge.schema import (
    BUCKET, COLUMN_SPELLINGS, DISTANCE, DOW, DURATION, HOUR, REQUIRED_COLUMNS, TRIP_ID,
)


def normalize_columns(df: DataFrame,
                      spellings: Mapping[str, Sequence[str]] = COLUMN_SPELLINGS) -> DataFrame:
    """Rename the first present spelling of each standard column, in one projection.

    Other spellings of the same column stay as they are; extra columns pass
    through. A rename that would collide with an existing column is refused.
    """
    renames: dict[str, str] = {}
    for std, names in spellings.items():
        for name in names:
            if name in df.columns:
                renames[name] = std
                break
    targets = set(renames.values())
    for c in df.columns:
        if c in targets and renames.get(c, c) != c and c not in renames:
            raise ValueError(f"renaming onto existing column {c!r} would duplicate it")
    return df.select(*[F.col(f"`{c}`").alias(renames.get(c, c)) for c in df.columns])


def require_columns(df: DataFrame, names: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"trip table lacks {missing}; it has {df.columns}")
    return df


def parse_timestamps(df: DataFrame, cols: Sequence[str] = ("pickup_datetime", "dropoff_datetime")) -> DataFrame:
    """Bring pickup/dropoff to ``timestamp_ntz``; bad text becomes null (rejected later)."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    out = {}
    for c in cols:
        t = types.get(c)
        if isinstance(t, TimestampNTZType):
            continue
        if isinstance(t, (StringType, TimestampType)):
            out[c] = parse_timestamp(c)
        else:
            out[c] = F.col(c).cast("string").try_cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def derive_measures(df: DataFrame) -> DataFrame:
    """Trip duration (whole seconds) and haversine distance (km).

    Both are produced by a one-element ``inline`` generator rather than a
    projection: the optimizer substitutes projected expressions into every
    later predicate, and filters have no common-subexpression elimination,
    so the quality rules would evaluate the trigonometry up to five times per
    row. A generator's output is computed once and referenced by the rules;
    predicates on the raw columns are still pushed into the scan.
    """
    measures = F.struct(
        duration_seconds("pickup_datetime", "dropoff_datetime").alias(DURATION),
        haversine_km("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude").alias(DISTANCE))
    keep = [c for c in df.columns if c not in (DURATION, DISTANCE)]
    return df.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(measures)))


def segment_columns(numbering: str = "monday") -> dict:
    return {
        HOUR: F.hour("pickup_datetime"),
        DOW: day_of_week("pickup_datetime", numbering),
        BUCKET: distance_bucket(DISTANCE),
    }


def derive_segments(df: DataFrame, numbering: str = "monday") -> DataFrame:
    """hour_of_day, day_of_week (0 = Monday by default), distance_bucket."""
    return df.withColumns(segment_columns(numbering))


def add_columns_if_absent(df: DataFrame, numbering: str = "monday") -> DataFrame:
    """Add the derived segment columns (and a null trip_id) only where missing."""
    types = {HOUR: "int", DOW: "int", BUCKET: "string", TRIP_ID: "long"}
    add = {c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}
    return df.withColumns(add) if add else df


def fill_derived(df: DataFrame, numbering: str = "monday") -> DataFrame:
    """Recompute all three segment columns on rows where any of them is null."""
    df = add_columns_if_absent(df, numbering)
    any_null = F.col(HOUR).isNull() | F.col(DOW).isNull() | F.col(BUCKET).isNull()
    new = segment_columns(numbering)
    return df.withColumns({c: F.when(any_null, e).otherwise(F.col(c)) for c, e in new.items()})
