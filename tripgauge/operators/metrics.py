"""Accuracy metrics overall and per segment, in one pass over the error rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgauge.functions import bucket_rank, weekday_label
from tripgauge.operators.ranking import exact_percentiles, group_sketches, merge_sketches
from tripgauge.schema import BUCKET, BUCKET_LABELS, DOW, DURATION, HOUR, METRIC_COLUMNS, WEEKDAY_LABELS, WITHIN_THRESHOLDS

OVERALL = ("overall", "all")


def default_segments() -> list[tuple[str, Column]]:
    return [
        ("distance_bucket", F.col(BUCKET)),
        ("hour_of_day", F.col(HOUR).cast("string")),
        ("day_of_week", weekday_label(DOW)),
    ]


# 1 overall + 5 buckets + 24 hours + 7 weekdays.
DEFAULT_MAX_SEGMENTS = 37


# 0 and 1 are the exact minimum and maximum (histogram ranges).
ERROR_QUANTILES = (0.0, 0.5, 0.9, 0.95, 1.0)


def _qname(q: float) -> str:
    return f"q{round(q * 100, 4):g}".replace(".", "_")


MEASURES = ["sec", "pct", "duration"]


def _within_name(t: float) -> str:
    return f"n_within_{int(round(t * 100))}"


def _stacked(errors: DataFrame, segments: Sequence[tuple[str, Column]] | None) -> tuple[DataFrame, list[str]]:
    """(_m, _t, segment_value, x) rows, one per error row, measure and segmentation, and the segmentations' names."""
    coded = segments is None
    segments = default_segments() if coded else segments
    types = [OVERALL[0]] + [name for name, _ in segments]
    if coded:
        # Default segmentations: carry the small integer behind each label
        # (bucket rank, hour, weekday) and decode on the result rows only.
        values = [F.lit(0), bucket_rank(F.col(BUCKET)), F.col(HOUR), F.col(DOW)]
        values = [v.cast("byte").alias("segment_value") for v in values]
    else:
        values = [F.lit(OVERALL[1])] + [expr.cast("string") for _, expr in segments]
    entry = lambda m, t, x: F.struct(F.lit(MEASURES.index(m)).cast("byte").alias("_m"),
                                     F.lit(t).cast("byte").alias("_t"), values[t].alias("segment_value"),
                                     x.cast("double").alias("x"))
    entries = []
    for t in range(len(types)):
        entries.append(entry("sec", t, F.col("abs_error_sec")))
        entries.append(entry("pct", t, F.col("abs_pct_error")))
    entries.append(entry("duration", 0, F.col(DURATION)))
    return errors.select(F.inline(F.array(*entries))), types


STACK_KEYS = ["_m", "_t", "segment_value"]


def _stack_sums(within: Sequence[float]) -> dict:
    sums = {"sum_x": lambda x: x}
    for w in within:
        sums[_within_name(w)] = lambda x, w=w: F.when(x <= F.lit(float(w)), F.lit(1.0)).otherwise(F.lit(0.0))
    return sums


def error_sketches(errors: DataFrame, segments: Sequence[tuple[str, Column]] | None = None,
                   within: Sequence[float] = WITHIN_THRESHOLDS) -> DataFrame:
    """The mergeable part of ``error_quantiles``, to be stored beside a load of error rows (a row per measure and segment)."""
    return group_sketches(_stacked(errors, segments)[0], "x", STACK_KEYS, _stack_sums(within))


def merged_error_sketches(tables: Sequence[DataFrame]) -> DataFrame:
    """The stored ``error_sketches`` of several loads as those of all their rows."""
    return merge_sketches(tables, STACK_KEYS)


def error_quantiles(errors: DataFrame, segments: Sequence[tuple[str, Column]] | None = None,
                    quantiles: Sequence[float] = ERROR_QUANTILES, approx: bool = False,
                    max_segments: int | None = DEFAULT_MAX_SEGMENTS,
                    within: Sequence[float] = WITHIN_THRESHOLDS, sketches: DataFrame | None = None) -> DataFrame:
    """Every statistic over the error rows, by bracket selection (see ``exact_percentiles``).

    Rows (measure, segment_type, segment_value, q50, q90, q95, n, sum_x,
    n_within_10, n_within_20): ``sec`` (abs_error_sec) and ``pct``
    (abs_pct_error) for overall and every segment - also the histogram
    markers - and ``duration`` (actual seconds) overall only, for the
    calibration range. Each error row feeds one group per (measure,
    segmentation), combined inside its task: only sketches, counts and the few
    rows inside a bracket are shuffled. Measure and segmentation are carried as
    small integers. ``sketches``: stored ``error_sketches`` of all the rows,
    made with the same ``segments`` and ``within``; they save the first scan.
    """
    coded = segments is None
    if not coded and max_segments == DEFAULT_MAX_SEGMENTS:
        max_segments = None  # the caller's own segmentations have no proven bound
    stacked, types = _stacked(errors, segments)
    groups = None if max_segments is None else 2 * max_segments + 1
    sums = _stack_sums(within)
    q = exact_percentiles(stacked, "x", quantiles, by=STACK_KEYS, names=[_qname(p) for p in quantiles],
                          approx=approx, max_groups=groups, count_col="n", sums=sums, name="error_quantiles", sketches=sketches)
    measure = F.element_at(F.array(*[F.lit(m) for m in MEASURES]), F.col("_m").cast("int") + 1)
    seg_type = F.element_at(F.array(*[F.lit(t) for t in types]), F.col("_t").cast("int") + 1)
    seg_value = F.col("segment_value")
    if coded:
        t, v = F.col("_t"), F.col("segment_value").cast("int")
        seg_value = (F.when(t == 0, F.lit(OVERALL[1]))
                     .when(t == 1, F.element_at(F.array(*[F.lit(b) for b in BUCKET_LABELS]), v))
                     .when(t == 2, v.cast("string"))
                     .otherwise(weekday_label(v)))
    return q.select(measure.alias("measure"), seg_type.alias("segment_type"), seg_value.alias("segment_value"),
                    *[_qname(p) for p in quantiles], F.col("n").cast("long").alias("n"), *sums)


def segment_metrics(errors: DataFrame, segments: Sequence[tuple[str, Column]] | None = None,
                    quantiles: Sequence[float] = (0.5, 0.9), within: Sequence[float] = WITHIN_THRESHOLDS,
                    approx: bool = False, max_segments: int | None = DEFAULT_MAX_SEGMENTS,
                    qtable: DataFrame | None = None) -> DataFrame:
    """The 11-column metric rows for 'overall' and every segmentation.

    Everything comes from ``error_quantiles`` (pass ``qtable`` to reuse one
    already computed). Error rows
    have no null error values, so per-measure counts equal ``COUNT(*)``.
    """
    needed = [_qname(q) for q in quantiles] + ["n", "sum_x"] + [_within_name(w) for w in within]
    if qtable is None or any(c not in qtable.columns for c in needed):
        qtable = error_quantiles(errors, segments, sorted(set(quantiles) | set(ERROR_QUANTILES)), approx,
                                 max_segments, within)
    keys = ["segment_type", "segment_value"]
    labels = {0.5: "medae", 0.9: "p90_abs_error"}
    pick = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c)))
    cols = [pick("sec", "n").alias("trip_count"),
            (pick("sec", "sum_x") / pick("sec", "n")).alias("mae_sec"),
            (pick("pct", "sum_x") / pick("pct", "n")).alias("mae_pct")]
    for m in ("sec", "pct"):
        for q in quantiles:
            label = labels.get(q, f"p{round(q * 100, 4):g}_abs_error")
            cols.append(pick(m, _qname(q)).alias(f"{label}_{m}"))
    for w in within:
        cols.append((pick("pct", _within_name(w)) / pick("sec", "n")).alias(f"pct_within_{int(round(w * 100))}pct"))
    out = qtable.where(F.col("measure").isin("sec", "pct")).groupBy(*keys).agg(*cols)
    ordered = [c for c in METRIC_COLUMNS if c in out.columns]
    return out.select(*ordered, *[c for c in out.columns if c not in ordered])


def compare_methods(errors: Mapping[str, DataFrame]) -> DataFrame:
    """The metric rows of several estimators over the same trips, with a leading ``method`` column."""
    out = None
    for method, rows in errors.items():
        part = segment_metrics(rows)
        part = part.select(F.lit(method).alias("method"), *part.columns)
        out = part if out is None else out.unionByName(part)
    return out


def segment_order(metrics: DataFrame) -> DataFrame:
    """Presentation order: overall, buckets short to long, hours, weekdays."""
    t = F.col("segment_type")
    v = F.col("segment_value")
    kind = (F.when(t == "overall", 0).when(t == "distance_bucket", 1)
            .when(t == "hour_of_day", 2).when(t == "day_of_week", 3).otherwise(4))
    within = (F.when(t == "distance_bucket", bucket_rank(v))
              .when(t == "hour_of_day", v.try_cast("int"))
              .when(t == "day_of_week", F.array_position(F.array(*[F.lit(d) for d in WEEKDAY_LABELS]), v)))
    return metrics.orderBy(kind, within, v)


def metrics_tables(metrics: DataFrame) -> dict[str, DataFrame]:
    """The five published tables, as filtered views of one metric result."""
    t = F.col("segment_type")
    return {
        "metrics_overall": metrics.where(t == "overall"),
        "metrics_by_distance": segment_order(metrics.where(t == "distance_bucket")),
        "metrics_by_hour": segment_order(metrics.where(t == "hour_of_day")),
        "metrics_by_day_of_week": segment_order(metrics.where(t == "day_of_week")),
        "metrics_combined": segment_order(metrics),
    }


def error_by_segment(metrics: DataFrame, segment_type: str) -> DataFrame:
    """Chart data per segment: median and P90 in seconds and relative, with counts."""
    return (metrics.where(F.col("segment_type") == segment_type)
            .select(F.col("segment_value").alias(segment_type), "medae_sec",
                    F.col("p90_abs_error_sec").alias("p90_sec"), "medae_pct",
                    F.col("p90_abs_error_pct").alias("p90_pct"), "trip_count"))
