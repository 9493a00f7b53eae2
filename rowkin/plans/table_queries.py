"""Sources and sinks: whole tables through text files and back, and the SQL over the tables that they must equal."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import whole_number_text
from ..operators.survivorship import chunks
from ..schema import VF3_COLUMNS
from ..sources import readers, writers
from ..workspace import shared_dir, table

# Headers as source files have them, with stray blanks.
HEADERS = {
    "docids": "DOCIDs ", "first_name": " First Name", "last_name": "Last Name", "full_date_of_birth": "Full Date of Birth (MM/DD/YYYY)", "dobs": "DOBs",
    "state_of_residence": "State of Residence (if US)", "province_of_residence": "Province of Residence (if Canada)", "drivers_license_number": "Driver's License Number",
    "government_issued_identification": "Government- Issued Identification", "access_credentials_non_financial": "Access Credentials (Non-Financial Account)",
}
SHOWN = ("docids", "first_name", "last_name", "social_security_number", "residential_address", "state_of_residence", "drivers_license_number", "access_credentials_non_financial")


def through_csv(spark: SparkSession, df: DataFrame, **options) -> DataFrame:
    path = f"{shared_dir(spark)}/rowkin-csv-{uuid.uuid4().hex}"
    writers.write_csv(df, path)
    return readers.read_csv(spark, path, **options)


def _vf3(spark: SparkSession, d: str, literals: bool) -> DataFrame:
    rows = table(spark, d, "vf3_records")
    rows = rows.select("rec_id", *[F.col(c).alias(HEADERS.get(c, c)) for c in VF3_COLUMNS])
    return through_csv(spark, rows, required=VF3_COLUMNS, keep_literals=literals).select(F.col("rec_id").cast("long").alias("rec_id"), *SHOWN)


def csv_scan(spark: SparkSession, d: str) -> DataFrame:
    """The person table through CSV with source headers; 'NA' and its like are missing."""
    return _vf3(spark, d, False)


def csv_scan_literals(spark: SparkSession, d: str) -> DataFrame:
    """The same with 'NA' and its like kept as values."""
    return _vf3(spark, d, True)


def csv_sink(spark: SparkSession, d: str) -> DataFrame:
    """Forum posts with line breaks, quotes and commas through CSV and back."""
    rows = through_csv(spark, table(spark, d, "documents").select("doc_id", "text", "author"), keep_literals=True)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "author")


def whole_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numeric cells as a spreadsheet reader gives them, '123.0', as text without the fraction."""
    cells = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("string").alias("q"), F.col("l_discount").cast("string").alias("x"))
    return cells.select("l_orderkey", "l_linenumber", whole_number_text("q").alias("quantity"), whole_number_text("x").alias("discount"))


def long_cells(spark: SparkSession, d: str) -> DataFrame:
    """Texts cut at line ends into cells of at most 20,000 characters."""
    return table(spark, d, "documents").select("doc_id", F.posexplode(chunks("text", sep="\n")).alias("piece", "cell"))


def _blanked(c: str) -> str:
    return f"CASE WHEN {c} IN (" + ", ".join(f"'{x}'" for x in _MISSING) + f") THEN '' ELSE coalesce({c}, '') END AS {c}"


# Stated apart from the reader's list.
_MISSING = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
QUERIES = {f.__name__: f for f in (csv_scan, csv_scan_literals, csv_sink, whole_numbers, long_cells)}
SQL = {
    "csv_scan": f"SELECT rec_id, {', '.join(map(_blanked, SHOWN))} FROM vf3_records",
    "csv_scan_literals": f"SELECT rec_id, {', '.join(f"coalesce({c}, '') AS {c}" for c in SHOWN)} FROM vf3_records",
    "csv_sink": "SELECT doc_id, coalesce(text, '') AS text, coalesce(author, '') AS author FROM documents",
    "whole_numbers": "SELECT l_orderkey, l_linenumber, regexp_replace(CAST(l_quantity AS VARCHAR), '\\.0$', '') AS quantity, regexp_replace(CAST(l_discount AS VARCHAR), '\\.0$', '') AS discount FROM lineitem",
    # greedy by a walk over the lines of long texts: w is the length of the cell so far
    "long_cells": """WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), o AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t,
 generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d WHERE length(text) > 20000),
g AS (SELECT doc_id, k, CAST(0 AS INT) AS piece, length(t) AS w FROM o WHERE k = 1
 UNION ALL SELECT g.doc_id, o.k, CASE WHEN g.w + 1 + length(o.t) <= 20000 THEN piece ELSE piece + 1 END, CASE WHEN g.w + 1 + length(o.t) <= 20000 THEN g.w + 1 + length(o.t) ELSE length(o.t) END
  FROM g JOIN o ON o.doc_id = g.doc_id AND o.k = g.k + 1)
SELECT doc_id, 0 AS piece, text AS cell FROM d WHERE length(text) <= 20000
UNION ALL SELECT doc_id, piece, string_agg(t, chr(10) ORDER BY k) AS cell FROM g JOIN o USING (doc_id, k) GROUP BY doc_id, piece""",
}
