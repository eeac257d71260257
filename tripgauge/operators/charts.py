"""Chart data: error histograms with median/P90 markers, calibration bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgauge.operators.ranking import exact_percentiles
from tripgauge.schema import CALIBRATION_EDGES, CALIBRATION_QUANTILE, DURATION, ESTIMATE, HISTOGRAM_BINS

def histogram_metrics() -> dict[str, Column]:
    return {
        "abs_error_sec": F.col("abs_error_sec"),
        "abs_pct_error_x100": F.col("abs_pct_error") * F.lit(100.0),
    }


def _bin_domain(df: DataFrame, bins: int) -> DataFrame:
    return df.sparkSession.range(bins).select(F.col("id").alias("bin"))


def _ranges_from_quantiles(qtable: DataFrame) -> dict | None:
    """Histogram ranges from the 0 and 1 quantiles of the error-quantile table
    (``abs_pct_error`` scaled by 100: scaling is monotone and per value, so the
    extremes of ``x * 100`` are exactly ``100 * extremes``)."""
    if "q0" not in qtable.columns or "q100" not in qtable.columns:
        return None
    rows = qtable.where(F.col("measure").isin("sec", "pct") & (F.col("segment_type") == "overall")).collect()
    out = {}
    for r in rows:
        scale = 1.0 if r["measure"] == "sec" else 100.0
        name = "abs_error_sec" if r["measure"] == "sec" else "abs_pct_error_x100"
        out[name] = (None if r["q0"] is None else r["q0"] * scale, None if r["q100"] is None else r["q100"] * scale)
    return out


def error_histograms(errors: DataFrame, bins: int = HISTOGRAM_BINS, qtable: DataFrame | None = None) -> DataFrame:
    """Both error histograms in one binning pass over the stacked metrics.

    The ranges come from ``qtable`` (the error-quantile table: its 0 and 1
    quantiles) when given, otherwise from one min/max pass.
    """
    metrics = histogram_metrics()
    stacked = errors.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), v.cast("double").alias("x")) for m, v in metrics.items()])))
    stacked = stacked.where(F.col("x").isNotNull())
    ranges = _ranges_from_quantiles(qtable) if qtable is not None else None
    if ranges is None:
        ranges = {r["metric"]: (r["lo"], r["hi"]) for r in
                  stacked.groupBy("metric").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect()}
    edges = {}
    for m in metrics:
        lo, hi = ranges.get(m, (None, None))
        if lo is None:
            lo, hi = 0.0, 1.0
        elif lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        edges[m] = (float(lo), float(hi), (float(hi) - float(lo)) / bins)
    lo_c = F.lit(None).cast("double")
    w_c = F.lit(None).cast("double")
    for m, (lo, _, w) in edges.items():
        lo_c = F.when(F.col("metric") == m, F.lit(lo)).otherwise(lo_c)
        w_c = F.when(F.col("metric") == m, F.lit(w)).otherwise(w_c)
    b = F.greatest(F.least(F.floor((F.col("x") - lo_c) / w_c).cast("long"), F.lit(bins - 1)), F.lit(0))
    counts = stacked.groupBy("metric", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    domain = errors.sparkSession.createDataFrame(
        [(m, i, lo + i * w, lo + (i + 1) * w) for m, (lo, _, w) in edges.items() for i in range(bins)],
        "metric string, bin long, lo double, hi double")
    # metrics x bins counts at most: safe to broadcast.
    return (domain.join(F.broadcast(counts), ["metric", "bin"], "left")
            .select("metric", "bin", "lo", "hi", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def histogram_markers(errors: DataFrame, approx: bool = False, qtable: DataFrame | None = None) -> DataFrame:
    """(metric, median, p90) drawn over each histogram; the relative-error
    markers are 100 x the quantiles of ``abs_pct_error``."""
    from tripgauge.operators.metrics import error_quantiles

    qtable = error_quantiles(errors, approx=approx) if qtable is None else qtable
    sec = F.col("measure") == "sec"
    scale = F.when(sec, F.lit(1.0)).otherwise(F.lit(100.0))
    metric = F.when(sec, "abs_error_sec").otherwise("abs_pct_error_x100")
    return (qtable.where(F.col("measure").isin("sec", "pct") & (F.col("segment_type") == "overall"))
            .select(metric.alias("metric"), (F.col("q50") * scale).alias("median"),
                    (F.col("q90") * scale).alias("p90")))


def calibration_bins(errors: DataFrame, edges: int = CALIBRATION_EDGES, q: float = CALIBRATION_QUANTILE,
                     approx: bool = False, qtable: DataFrame | None = None) -> DataFrame:
    """(bin, n, mean_actual, mean_estimated) over ``edges - 1`` right-closed bins on (0, P_q].

    Actual durations of 0 or above the q-quantile fall outside every bin.
    Empty bins are kept with n = 0 and null means.
    """
    qname = f"q{round(q * 100, 4):g}".replace(".", "_")
    if qtable is not None and qname in qtable.columns:
        row = (qtable.where((F.col("measure") == "duration") & (F.col("segment_type") == "overall"))
               .select(F.col(qname).alias("q")).collect())
    else:
        row = exact_percentiles(errors, DURATION, [q], names=["q"], approx=approx,
                                name="calibration_q").collect()
    nb = edges - 1
    domain = _bin_domain(errors, nb)
    if not row or row[0]["q"] is None:
        empty = errors.sparkSession.createDataFrame([], "bin long, n long, mean_actual double, mean_estimated double")
        return domain.join(empty, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"),
                                                        "mean_actual", "mean_estimated")
    top = float(row[0]["q"])
    width = top / nb
    x = F.col(DURATION).cast("double")
    b = F.least(F.ceil(x / F.lit(width)).cast("long") - 1, F.lit(nb - 1))
    agg = (errors.where((x > 0) & (x <= F.lit(top)))
           .groupBy(b.alias("bin"))
           .agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean_actual"),
                F.avg(F.col(ESTIMATE)).alias("mean_estimated")))
    return (domain.join(agg, "bin", "left")
            .select("bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "mean_actual", "mean_estimated"))
