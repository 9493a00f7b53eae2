"""Review tables and top-k reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text

LARGE = 50


def junk_ssn(df: DataFrame, idx: str = "rec_id") -> DataFrame:
    """Rows whose nine-sign masked number has fewer than four known digits; row-local, so it also runs on a stream."""
    out = df.select(idx, F.col("docids").alias("docid"), "first_name", "last_name", F.col("social_security_number").alias("original_ssn"), text.ssn_issue("social_security_number").alias("remarks"))
    return out.where("remarks <> ''")


def junk_dob(df: DataFrame, idx: str = "rec_id", columns: tuple[str, ...] = ("full_date_of_birth", "dobs")) -> DataFrame:
    """One row per rejected cell; the alternate cell's remark begins with '[DOBs] '."""
    cells = [F.struct(F.lit("" if i == 0 else "[DOBs] ").alias("mark"), F.lit(i).alias("at"), F.col(c).alias("v")) for i, c in enumerate(columns) if c in df.columns]
    out = df.select(idx, F.col("docids").alias("docid"), "first_name", "last_name", F.explode(F.array(*cells)).alias("x"))
    out = out.withColumn("original_dob", F.col("x.v")).withColumn("why", dates.dob_issue("original_dob")).where("why <> ''")
    return out.select(idx, "docid", "first_name", "last_name", "original_dob", F.concat("x.mark", "why").alias("remarks"))


def large_groups(merged: DataFrame, most: int = LARGE) -> DataFrame:
    return merged.where(F.col("rows_merged") > most).orderBy(F.desc("rows_merged"), "root")


def sampler(df: DataFrame, n: int = 10_000, idx: str = "rec_id") -> DataFrame:
    """The first ``n`` rows with both names known, by first name, last name and number; ties by ``idx``."""
    keep = ~text.blank_or_unknown("first_name") & ~text.blank_or_unknown("last_name")
    order = [F.coalesce(c, F.lit("")) for c in ("first_name", "last_name", "social_security_number")]
    return df.where(keep).orderBy(*order, idx).limit(n)


def summary(merged: DataFrame) -> DataFrame:
    return merged.agg(
        F.count(F.lit(1)).alias("n_persons"), F.sum((F.col("rows_merged") > 1).cast("long")).alias("n_merged"),
        F.max("rows_merged").alias("largest"), F.sum("rows_merged").alias("n_rows"),
    )
