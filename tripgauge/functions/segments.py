"""Segment columns: distance bucket, bucket order, weekday label, speed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripgauge.schema import BUCKET_EDGES_KM, BUCKET_LABELS, WEEKDAY_LABELS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def distance_bucket(km) -> Column:
    """Half-open buckets: [0,1.609) '<1mi', [1.609,4.828) '1-3mi', ...; null km -> '10+mi'
    exactly like the CASE chain it mirrors (null fails every ``<`` test)."""
    km = _c(km)
    expr = None
    for edge, label in zip(BUCKET_EDGES_KM, BUCKET_LABELS):
        cond = km < F.lit(float(edge))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(BUCKET_LABELS[-1])


def bucket_rank(bucket) -> Column:
    """Business order 1..5 of a bucket label (null for unknown labels)."""
    b = _c(bucket)
    expr = None
    for i, label in enumerate(BUCKET_LABELS, start=1):
        expr = F.when(b == label, i) if expr is None else expr.when(b == label, i)
    return expr


def weekday_label(dow) -> Column:
    """0..6 -> Monday..Sunday; other values -> null."""
    d = _c(dow)
    expr = None
    for i, label in enumerate(WEEKDAY_LABELS):
        expr = F.when(d == i, label) if expr is None else expr.when(d == i, label)
    return expr


def speed_kmh(km, seconds) -> Column:
    """km / NULLIF(seconds, 0) * 3600."""
    return _c(km) / F.nullif(_c(seconds), F.lit(0)) * F.lit(3600)
