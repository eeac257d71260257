"""The 16-feature set of the duration model, and a population-std scaler."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge import schema as S


def feature_columns() -> dict:
    """The 16 feature expressions by name (doubles). Unknown bucket labels get all-zero one-hot columns."""
    two_pi = F.lit(2 * math.pi)
    h = F.col(S.HOUR).cast("double")
    d = F.col(S.DOW).cast("double")
    feats = {
        S.DISTANCE: F.col(S.DISTANCE).cast("double"),
        S.HOUR: h,
        S.DOW: d,
        "hour_sin": F.sin(two_pi * h / 24),
        "hour_cos": F.cos(two_pi * h / 24),
        "day_sin": F.sin(two_pi * d / 7),
        "day_cos": F.cos(two_pi * d / 7),
    }
    for label in S.BUCKET_LABELS:
        feats[f"dist_{label}"] = F.when(F.col(S.BUCKET) == label, 1.0).otherwise(0.0)
    for side in ("pickup", "dropoff"):
        feats[f"{side}_lat_norm"] = (F.col(f"{side}_latitude") - F.lit(S.LAT_CENTER)) / F.lit(S.COORD_SCALE)
        feats[f"{side}_lon_norm"] = (F.col(f"{side}_longitude") - F.lit(S.LON_CENTER)) / F.lit(S.COORD_SCALE)
    return feats


def trip_features(df: DataFrame, keep: tuple[str, ...] = (S.TRIP_ID, S.DURATION)) -> DataFrame:
    """Row-preserving projection to ``keep`` + the 16 features (doubles, fixed order)."""
    feats = feature_columns()
    kept = [c for c in keep if c in df.columns and c not in feats]
    return df.select(*kept, *[feats[c].alias(c) for c in S.FEATURE_COLUMNS])


def scaler_fit(features: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(feature, mean, std, scale): population std; zero variance -> scale 1.0. One aggregation."""
    cols = S.FEATURE_COLUMNS if cols is None else cols
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(F.col(f"`{c}`")).alias(f"m{i}"), F.stddev_pop(F.col(f"`{c}`")).alias(f"s{i}")]
    wide = features.agg(*aggs)
    entries = F.array(*[F.struct(F.lit(i).alias("idx"), F.lit(c).alias("feature"),
                                 F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
                        for i, c in enumerate(cols)])
    return (wide.select(F.inline(entries))
            .withColumn("scale", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std"))))


def standardize(features: DataFrame, stats: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(x - mean) / scale with the fitted statistics (16 pairs of driver scalars)."""
    cols = S.FEATURE_COLUMNS if cols is None else cols
    fitted = {r["feature"]: (r["mean"], r["scale"]) for r in stats.collect()}
    return features.withColumns({
        c: (F.col(f"`{c}`") - F.lit(fitted[c][0])) / F.lit(fitted[c][1]) for c in cols})
