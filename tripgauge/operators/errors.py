"""Error columns of an estimate against the actual duration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.schema import DURATION, ESTIMATE


def eta_errors(df: DataFrame) -> DataFrame:
    err = F.col(ESTIMATE) - F.col(DURATION)
    dur = F.nullif(F.col(DURATION), F.lit(0))
    return (df.where(F.col(ESTIMATE).isNotNull() & (F.col(DURATION) > 0))
            .withColumns({"error_sec": err, "abs_error_sec": F.abs(err),
                          "pct_error": err / dur, "abs_pct_error": F.abs(err) / dur}))
