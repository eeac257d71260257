"""Temporal train/evaluation split and the validation split inside training."""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.functions import epoch_micros
from tripgauge.operators.ranking import exact_percentiles, row_numbers
from tripgauge.schema import BUCKET, DISTANCE, DOW, DURATION, HOUR, SPLIT_QUANTILE, TRIP_ID, VALIDATION_FRACTION

PICKUP = "pickup_datetime"


def _interpolate(lo: float, hi: float, h: float) -> float:
    return lo + (h - math.floor(h)) * (hi - lo)


def split_time_micros(clean: DataFrame, q: float = SPLIT_QUANTILE,
                      pickup_ordered_id: str | None = None, offsets=None) -> float | None:
    """``percentile_cont(q)`` of pickup time in epoch microseconds (one driver scalar).

    With ``pickup_ordered_id`` (a dense 1..n id in pickup order, as made by
    ``assign_trip_id``) only the two bracketing rows are read; otherwise an
    exact distributed percentile is computed. With the numbering's partition
    ``offsets`` as well (``clean`` then carries ``_mid``), the two rows are
    fetched by a ``_mid IN (..)`` filter the Parquet scan pushes down.
    """
    if pickup_ordered_id is None:
        row = exact_percentiles(clean, epoch_micros(PICKUP), [q], names=["split"],
                                name="split").collect()
        return row[0]["split"] if row else None
    n = sum(o[3] for o in offsets) if offsets is not None else clean.count()
    if n == 0:
        return None
    h = q * (n - 1)
    ranks = sorted({math.floor(h) + 1, math.ceil(h) + 1})
    if offsets is not None:
        from tripgauge.operators.ranking import mids_for_ranks

        hit = clean.where(F.col("_mid").isin(mids_for_ranks(offsets, [r - 1 for r in ranks])))
    else:
        hit = clean.where(F.col(pickup_ordered_id).isin(ranks))
    rows = dict(hit.select(pickup_ordered_id, epoch_micros(PICKUP).alias("us")).collect())
    return _interpolate(float(rows[ranks[0]]), float(rows[ranks[-1]]), h)


def ntz_literal(micros: int):
    ts = _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=micros)
    return F.expr(f"TIMESTAMP_NTZ'{ts.isoformat(sep=' ')}'")


def temporal_split(clean: DataFrame, split_us: float) -> tuple[DataFrame, DataFrame]:
    """(training: pickup <= split, evaluation: pickup > split).

    Pickups are whole microseconds, so ``us <= split`` equals
    ``pickup <= floor(split)``: a plain timestamp literal the Parquet scan
    can push down and use for row-group skipping.
    """
    if split_us is None:  # no clean trips: both sides empty
        return clean.where(F.lit(False)), clean.where(F.lit(False))
    cut = ntz_literal(math.floor(split_us))
    return clean.where(F.col(PICKUP) <= cut), clean.where(F.col(PICKUP) > cut)


def split_labels(clean: DataFrame, split_us: float | None) -> DataFrame:
    if split_us is None:
        return clean.withColumn("split", F.lit(None).cast("string"))
    cut = ntz_literal(math.floor(split_us))
    return clean.withColumn("split", F.when(F.col(PICKUP) <= cut, "training").otherwise("evaluation"))


def dataset_summary(clean: DataFrame, split_us: float | None) -> DataFrame:
    """(metric, value) rows for total / training / evaluation counts, one scan."""
    cut = ntz_literal(math.floor(split_us)) if split_us is not None else F.lit(None).cast("timestamp_ntz")
    agg = clean.agg(F.count(F.lit(1)).alias("t"),
                    F.count(F.when(F.col(PICKUP) <= cut, 1)).alias("a"),
                    F.count(F.when(F.col(PICKUP) > cut, 1)).alias("b"))
    return agg.select(F.expr(
        "stack(3, 'Total trips', CAST(t AS STRING), 'Training trips', CAST(a AS STRING), "
        "'Evaluation trips', CAST(b AS STRING)) AS (metric, value)"))


MODEL_COLUMNS = [TRIP_ID, DURATION, DISTANCE, HOUR, DOW, BUCKET,
                 "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude", PICKUP]


def model_rows(df: DataFrame) -> DataFrame:
    """Validity filter used for training and scoring (all columns kept)."""
    return df.where((F.col(DURATION) > 0) & (F.col(DISTANCE) > 0) & F.col(HOUR).isNotNull()
                    & F.col(DOW).isNotNull() & F.col(BUCKET).isNotNull())


def model_input(df: DataFrame) -> DataFrame:
    """Projection + validity filter used for training and scoring."""
    return model_rows(df.select(*[c for c in MODEL_COLUMNS if c in df.columns]))


def temporal_validation_split(training: DataFrame, v: float = VALIDATION_FRACTION,
                              order_col: str = TRIP_ID) -> DataFrame:
    """Adds ``is_val``: rows in ``order_col`` order, the first ``int(n*(1-v))`` train.

    When the ids are already dense (max - min + 1 == n) the rank is the id
    itself and no sort is needed.
    """
    st = training.agg(F.count(F.lit(1)).alias("n"), F.min(order_col).alias("lo"),
                      F.max(order_col).alias("hi")).collect()[0]
    n = st["n"]
    cut = int(n * (1 - v))
    if n and st["hi"] - st["lo"] + 1 == n:
        return training.withColumn("is_val", (F.col(order_col) - F.lit(st["lo"])) >= F.lit(cut))
    ranked = row_numbers(training, [order_col], "_rank", start=0, name="val_ranked")
    return ranked.withColumn("is_val", F.col("_rank") >= F.lit(cut)).drop("_rank")
