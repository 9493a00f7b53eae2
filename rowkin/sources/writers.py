"""Sinks: one table per directory, or the tabs of a workbook."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

EXCEL_ROWS = 1_048_575  # data rows that fit below the header of a sheet


BOM = "\ufeff"


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """CSV files with header, cells as they are (blanks at their ends too); ``bom`` marks each file as UTF-8 for spreadsheet programs."""
    if bom and df.columns:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_tables(tables: dict[str, DataFrame], path: str, form: str = "parquet") -> None:
    """Each table in its own directory below ``path``, as parquet or CSV."""
    for name, df in tables.items():
        if form == "csv":
            write_csv(df, f"{path}/{name}")
        else:
            df.write.mode("overwrite").format(form).save(f"{path}/{name}")


def write_workbook(tables: dict[str, DataFrame], path: str) -> None:
    """One tab per table; a table with more rows than a sheet holds goes to CSV and leaves a note.  Needs xlsxwriter or openpyxl."""
    import pandas as pd

    with pd.ExcelWriter(path) as book:
        for name, df in tables.items():
            if df.limit(EXCEL_ROWS + 1).count() > EXCEL_ROWS:
                out = f"{os.path.splitext(path)[0]} - {name}"
                write_csv(df, out, bom=True)
                pd.DataFrame({"note": [f"too many rows for a sheet, see {out}"]}).to_excel(book, sheet_name=name[:31], index=False)
            else:
                df.toPandas().to_excel(book, sheet_name=name[:31], index=False)


def convert_to_xlsb(xlsx: str, xlsb: str) -> bool:
    """Binary workbooks need a desktop spreadsheet program; here the .xlsx stays and False says so."""
    return False
