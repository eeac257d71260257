"""Data-quality cascade: first failing rule per row, counted in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgauge import schema as S

OK = "ok"


def quality_rules(bbox: bool = False) -> list[tuple[str, Column]]:
    """Ordered (name, keep-condition) pairs; a row is kept when every condition is true.

    Conditions are written so that null evaluates to "reject" (``coalesce(.., false)``).
    """
    c = F.col
    coords = ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]
    rules = [
        ("missing_datetime", c("pickup_datetime").isNotNull() & c("dropoff_datetime").isNotNull()),
        ("invalid_duration", (c(S.DURATION) > S.MIN_DURATION_SEC) & (c(S.DURATION) <= S.MAX_DURATION_SEC)),
        ("missing_coordinates",
         c(coords[0]).isNotNull() & c(coords[1]).isNotNull() & c(coords[2]).isNotNull() & c(coords[3]).isNotNull()),
        ("invalid_coordinate_range",
         c("pickup_latitude").between(*S.LAT_RANGE) & c("pickup_longitude").between(*S.LON_RANGE)
         & c("dropoff_latitude").between(*S.LAT_RANGE) & c("dropoff_longitude").between(*S.LON_RANGE)),
        ("invalid_distance", c(S.DISTANCE).isNotNull() & ~F.isnan(c(S.DISTANCE))
         & (c(S.DISTANCE) >= S.MIN_DISTANCE_KM) & (c(S.DISTANCE) <= S.MAX_DISTANCE_KM)),
    ]
    if bbox:
        rules.append(("outside_bbox",
                      c("pickup_latitude").between(*S.CITY_LAT_RANGE) & c("pickup_longitude").between(*S.CITY_LON_RANGE)
                      & c("dropoff_latitude").between(*S.CITY_LAT_RANGE) & c("dropoff_longitude").between(*S.CITY_LON_RANGE)))
    return [(name, F.coalesce(cond, F.lit(False))) for name, cond in rules]


def reason_expr(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first failing rule, or 'ok'."""
    expr = None
    for name, keep in rules:
        expr = F.when(~keep, name) if expr is None else expr.when(~keep, name)
    return expr.otherwise(OK)


def reject_reason(df: DataFrame, rules: Sequence[tuple[str, Column]] | None = None,
                  col: str = "reject_reason") -> DataFrame:
    """Name of the first failing rule, or 'ok'. Sequential filter counts equal first-failure counts."""
    rules = quality_rules() if rules is None else rules
    return df.withColumn(col, reason_expr(rules))


def observe_reasons(df: DataFrame, observation, rules: Sequence[tuple[str, Column]] | None = None) -> DataFrame:
    """Attach first-failure counts per rule to ``df`` as an ``Observation``.

    Filled by whichever action first runs the plan; place it after any
    exchange whose partitioner samples its input (the sampling pass would
    count rows twice) and before the rule filter.
    """
    rules = quality_rules() if rules is None else rules
    reason = reason_expr(rules)
    names = [n for n, _ in rules] + [OK]
    return df.observe(observation, *[F.count(F.when(reason == n, 1)).alias(n) for n in names])


def clean(df: DataFrame, rules: Sequence[tuple[str, Column]] | None = None) -> DataFrame:
    rules = quality_rules() if rules is None else rules
    cond = F.lit(True)
    for _, keep in rules:
        cond = cond & keep
    return df.where(cond)


def filter_stats(df: DataFrame, rules: Sequence[tuple[str, Column]] | None = None) -> DataFrame:
    """One row per rule plus 'ok': (step, reject_reason, n), rules in cascade order, zeros kept.

    One aggregation (map-side combined) instead of one count job per rule.
    """
    rules = quality_rules() if rules is None else rules
    names = [n for n, _ in rules] + [OK]
    counts = reject_reason(df, rules).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))
    order = F.array(*[F.lit(n) for n in names])
    domain = counts.sparkSession.range(1).select(F.posexplode(order).alias("step", "reject_reason"))
    # At most len(rules)+1 counts: broadcasting them is size-bounded.
    return (domain.join(F.broadcast(counts), "reject_reason", "left")
            .select(F.col("step").cast("int").alias("step"), "reject_reason",
                    F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def retention_summary(df: DataFrame, rules: Sequence[tuple[str, Column]] | None = None) -> DataFrame:
    """initial_count, final_count, filtered_out, retention_rate (0 when empty) in one row."""
    rules = quality_rules() if rules is None else rules
    r = reject_reason(df, rules)
    total = F.count(F.lit(1))
    kept = F.count(F.when(F.col("reject_reason") == OK, 1))
    return r.agg(total.alias("initial_count"), kept.alias("final_count")).select(
        "initial_count", "final_count",
        (F.col("initial_count") - F.col("final_count")).alias("filtered_out"),
        F.when(F.col("initial_count") > 0, F.col("final_count") / F.col("initial_count"))
        .otherwise(F.lit(0.0)).alias("retention_rate"))
