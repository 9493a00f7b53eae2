"""Row-local parts on streams: normalization and the review tables need no state, so a stream gives the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import normalize, reports


def junk_ssn_stream(rows: DataFrame) -> DataFrame:
    return reports.junk_ssn(rows)


def unknown_stream(rows: DataFrame) -> DataFrame:
    return normalize.unknown(normalize.normalized(rows))


def arrivals(rows: DataFrame, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Rows received and numbers rejected per window of received_at; rows later than ``late`` are dropped by the watermark."""
    from ..functions import text

    bad = (text.ssn_issue("social_security_number") != "").cast("long")
    rows = rows.withColumn("received_at", F.col("received_at").cast("timestamp"))
    out = rows.withWatermark("received_at", late).groupBy(F.window("received_at", width)).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(bad).alias("n_junk_ssn"))
    return out.select(F.col("window.start").alias("start"), "n_rows", "n_junk_ssn")
