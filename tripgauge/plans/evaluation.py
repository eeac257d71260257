"""End-to-end trip evaluation: raw records -> clean trips -> estimates -> metrics.

Stages are lazy DataFrames; three are materialised in the shared folder
because several branches reuse them (clean trips, error rows, metric rows).
Scalars computed once on the driver (split time, global median speed) enter
later plans as literals, so scans can push filters down.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripgauge import schema as S
from tripgauge.operators.columns import derive_measures, derive_segments, fill_derived, normalize_columns, parse_timestamps, require_columns
from tripgauge.operators.errors import eta_errors
from tripgauge.operators.estimate import global_speed, median_speed_eta, median_speeds, predictions_join, speed_medians
from tripgauge.operators.ids import assign_trip_id_with_offsets
from tripgauge.operators.metrics import error_quantiles, metrics_tables, segment_metrics
from tripgauge.operators.quality import clean as apply_rules
from tripgauge.operators.quality import observe_reasons, quality_rules, reject_reason
from tripgauge.operators.split import split_time_micros, temporal_split
from tripgauge.session import materialize
from tripgauge.sources.sinks import register_views
from tripgauge.sources.fixture import load_raw_trips


class TripEvaluation:
    def __init__(self, spark: SparkSession, raw: DataFrame, numbering: str = "monday",
                 approx: bool = False, bbox: bool = False, tiebreak: tuple[str, ...] = ()):
        self.spark = spark
        self.raw = raw
        self.numbering = numbering
        self.approx = approx
        self.rules = quality_rules(bbox=bbox)
        self.tiebreak = tiebreak

    @classmethod
    def from_sf_dir(cls, spark: SparkSession, sf_dir: str, **kw) -> "TripEvaluation":
        return cls(spark, load_raw_trips(spark, sf_dir), tiebreak=("event_id",), **kw)

    @classmethod
    def from_clean(cls, spark: SparkSession, clean: DataFrame, **kw) -> "TripEvaluation":
        """Start from a stored trips_clean table; segment columns that are absent or null are filled in.

        The split comes from the pickup times themselves: after an append the
        ids no longer follow them.
        """
        ev = cls(spark, clean, **kw)
        ev._from_clean = True
        ev.__dict__["clean"] = fill_derived(clean, ev.numbering)
        ev.__dict__["split_us"] = split_time_micros(clean, S.SPLIT_QUANTILE)
        return ev

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        """Small result tables reused by several branches are materialised once."""
        return materialize(df, name)

    # -- ingest -------------------------------------------------------------
    @cached_property
    def normalized(self) -> DataFrame:
        return parse_timestamps(require_columns(normalize_columns(self.raw)))

    @cached_property
    def measured(self) -> DataFrame:
        return derive_measures(self.normalized)

    @cached_property
    def labelled(self) -> DataFrame:
        return reject_reason(self.measured, self.rules)

    @cached_property
    def _numbered(self):
        # Sort the rows whose raw columns are complete (the keys are raw
        # columns), then derive the measures and apply the rules once, after the
        # shuffle: the range sampling pass and the map pass only read the
        # source, and blank rows, all equal, never meet in one partition. The
        # first-failure counts are observed on the same pass.
        rules = self.rules
        self._quality = Observation("quality_report")

        def after_sort(rows: DataFrame) -> DataFrame:
            return apply_rules(observe_reasons(derive_measures(rows), self._quality, rules), rules)

        return assign_trip_id_with_offsets(self.normalized.where(self._complete), tiebreak=self.tiebreak,
                                           name="trips_clean", after_sort=after_sort)

    @property
    def _complete(self):
        cond = F.lit(True)
        for c in ("pickup_datetime", "dropoff_datetime", "pickup_latitude", "pickup_longitude",
                  "dropoff_latitude", "dropoff_longitude"):
            cond = cond & F.col(c).isNotNull()
        return cond

    def quality_report(self) -> dict[str, int]:
        """First-failure counts per rule and 'ok': observed while numbering the
        complete rows, plus one count of the rows with blanks."""
        if getattr(self, "_from_clean", False):
            raise ValueError("built from a stored clean table: use filter_stats on the raw trips")
        self._numbered
        out = {k: int(v) for k, v in self._quality.get.items()}
        blank = reject_reason(derive_measures(self.normalized.where(~self._complete)), self.rules)
        for reason, n in blank.groupBy("reject_reason").count().collect():  # one row per rule
            out[reason] += n
        return out

    @cached_property
    def clean(self) -> DataFrame:
        """trips_clean: kept rows numbered in pickup order, with segment columns."""
        return derive_segments(self._numbered[0].drop("_mid"), self.numbering)

    # -- split --------------------------------------------------------------
    @cached_property
    def split_us(self) -> float | None:
        numbered, offsets = self._numbered
        return split_time_micros(numbered, S.SPLIT_QUANTILE, pickup_ordered_id=S.TRIP_ID, offsets=offsets)

    @cached_property
    def _split(self) -> tuple[DataFrame, DataFrame]:
        return temporal_split(self.clean, self.split_us)

    @property
    def training(self) -> DataFrame:
        return self._split[0]

    @property
    def evaluation(self) -> DataFrame:
        return self._split[1]

    # -- median-speed estimate ---------------------------------------------
    @cached_property
    def speed_medians(self) -> DataFrame:
        """Segment and overall median speeds of the training trips (one job, materialised)."""
        return self._keep(speed_medians(self.training, approx=self.approx), "speed_medians")

    @cached_property
    def median_speeds(self) -> DataFrame:
        return median_speeds(self.training, medians=self.speed_medians)

    @cached_property
    def global_speed(self) -> float | None:
        return global_speed(self.training, medians=self.speed_medians)

    @cached_property
    def with_eta(self) -> DataFrame:
        return median_speed_eta(self.evaluation, self.median_speeds, self.global_speed)

    ERROR_COLUMNS = [S.TRIP_ID, "pickup_datetime", S.DURATION, S.DISTANCE, S.HOUR, S.DOW, S.BUCKET,
                     "estimated_speed_kmh", S.ESTIMATE, "error_sec", "abs_error_sec", "pct_error", "abs_pct_error"]

    @cached_property
    def errors(self) -> DataFrame:
        """Error rows, materialised with the columns every downstream step reads
        (the full evaluation row stays available lazily as ``with_eta``)."""
        errs = eta_errors(self.with_eta)
        return materialize(errs.select(*[c for c in self.ERROR_COLUMNS if c in errs.columns]), "eta_errors")

    @cached_property
    def error_quantiles(self) -> DataFrame:
        """Every order statistic over the error rows, from one sort (materialised, small)."""
        return self._keep(error_quantiles(self.errors, approx=self.approx), "error_quantiles")

    @cached_property
    def metrics(self) -> DataFrame:
        return materialize(segment_metrics(self.errors, qtable=self.error_quantiles), "metrics_combined")

    def tables(self) -> dict[str, DataFrame]:
        return metrics_tables(self.metrics)

    def register_views(self) -> list[str]:
        """Publish every stage as a temp view under its conventional name, so SQL
        written against those relations runs unchanged on Spark SQL."""
        stages = {
            "trips_clean": self.clean, "trips_training": self.training, "trips_evaluation": self.evaluation,
            "median_speeds": self.median_speeds, "trips_with_eta": self.with_eta, "eta_errors": self.errors,
            **self.tables(),
        }
        return register_views(self.spark, stages)

    # -- model estimate -------------------------------------------------------
    def errors_from_predictions(self, preds: DataFrame) -> DataFrame:
        """Error rows for a stored prediction table (inner join on trip_id)."""
        return eta_errors(predictions_join(self.evaluation, preds))

    def model_errors(self, model) -> DataFrame:
        """Error rows of a fitted model, scored in-plan on the evaluation trips (no join)."""
        from tripgauge.operators.model import score_rows
        from tripgauge.operators.split import model_rows

        return materialize(eta_errors(score_rows(model, model_rows(self.evaluation))), "model_errors")


_CACHE: dict[tuple, TripEvaluation] = {}


def evaluation_for(spark: SparkSession, sf_dir: str, **kw) -> TripEvaluation:
    """One pipeline per (session, data dir, options), so registered queries share stages."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, tuple(sorted(kw.items())))
    ev = _CACHE.get(key)
    if ev is None:
        ev = _CACHE[key] = TripEvaluation.from_sf_dir(spark, sf_dir, **kw)
    return ev
