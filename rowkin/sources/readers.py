"""Text sources: every column is a string, headers become column names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import whole_number_text
from ..schema import require

# Cells that a table reader takes as missing.
NA = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def column_name(header: str) -> str:
    """'Government- Issued Identification' as government_issued_identification; what stands in brackets is dropped,
    except for the credentials' kind."""
    h = header.strip().lower().replace("'", "").replace("’", "")
    if "non-financial" in h:
        return "access_credentials_non_financial"
    h = re.sub(r"\(.*?\)", " ", h)
    return re.sub(r"[^a-z0-9]+", "_", h).strip("_")


def read_csv(spark: SparkSession, path: str, required: tuple[str, ...] = (), keep_literals: bool = False, number: str | None = None, multi_line: bool = True) -> DataFrame:
    """A CSV file with header as strings; blank headers' blanks are trimmed and missing required columns raise.

    ``keep_literals``: 'NA' and its like stay values.  ``number``: name of a column that numbers the rows in file order
    from 0: row numbers within a split plus the offsets of the splits before it, one row per split on the driver's side.
    Cells may hold line breaks, so a file is one task; ``multi_line`` off splits large files that are known to have none.
    """
    df = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').option("nullValue", "\u0000").csv(path)
    df = df.toDF(*[column_name(c) for c in df.columns])
    require(df.columns, required)
    df = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if keep_literals else F.when(F.col(c).isin(*NA), F.lit("")).otherwise(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in df.columns])
    return numbered(df, number) if number else df


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Dense row numbers in the order of the splits."""
    ids = df.withColumn("_m", F.monotonically_increasing_id()).withColumn("_p", F.shiftright("_m", 33).cast("int"))
    sizes = ids.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_b"))
    at = (F.col("_m").bitwiseAND((1 << 33) - 1) + F.col("_b")).alias(name)
    return ids.join(F.broadcast(before), "_p").select(at, *df.columns)


def excel_engine(path: str) -> str | None:
    """The reader of a workbook: calamine if installed, else pyxlsb for .xlsb, else pandas' own choice."""
    import importlib.util

    if importlib.util.find_spec("python_calamine"):
        return "calamine"
    return "pyxlsb" if path.lower().endswith(".xlsb") else None


def read_excel(spark: SparkSession, path: str, sheet: str | int = 0, required: tuple[str, ...] = ()) -> DataFrame:
    """One sheet of a workbook as strings; needs one of pandas' Excel readers and the file on the driver."""
    import pandas as pd

    pdf = pd.read_excel(path, sheet_name=sheet, dtype=str, engine=excel_engine(path)).fillna("")
    df = spark.createDataFrame(pdf.rename(columns=column_name))
    require(df.columns, required)
    return df.select(*[whole_number_text(c).alias(c) for c in df.columns])
