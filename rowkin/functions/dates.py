"""Dates of birth: 'YYYYMMDD' keys, '' where a cell holds no usable date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col, squeezed

# Shapes of a date cell in plain form (see ``_plain``), and the notations tried in order for each.
FORMATS = (
    (r"^\d{1,2}/\d{1,2}/\d{4}$", ("M/d/yyyy", "d/M/yyyy")),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", ("yyyy/M/d",)),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", ("d MMM yyyy",)),
    (r"^[A-Za-z]{3} \d{1,2} \d{4}$", ("MMM d yyyy",)),
    (r"^\d{4} [A-Za-z]{3} \d{1,2}$", ("yyyy MMM d",)),
    (r"^\d{8}$", ("yyyyMMdd",)),
)
TIME = r"[T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?[AaPp][Mm])?( ?(Z|UTC|[+-]\d{2}:?\d{2}))?$"
MONTH = r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)(?:uary|ruary|ch|il|e|y|ust|t|tember|ober|ember)?\b"
WEEKDAY = r"(?i)^(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\.?,? (?=.*\d)"
CENTURY = 69  # two-digit years from this one on are of the last century

SERIAL = r"^\d{1,6}(\.\d+)?$"
SERIAL_MAX = 60000
YEAR_FLOOR = 1900


def _plain(text: Column) -> Column:
    """A squeezed cell without time and weekday; months as three letters between blanks, numbers between slashes, and years of
    four digits.  The commonest notation stays as it is without further work."""
    t = F.regexp_replace(F.regexp_replace(text, TIME, ""), WEEKDAY, "")
    named = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"(?i)(\d)(?:st|nd|rd|th)\b", "$1"), MONTH, "$1"), r"[-/,. ]+", " ")
    t = F.when(t.rlike(MONTH), F.trim(named)).when(t.rlike(r"^\d{1,4}([-/.])\d{1,2}\1\d{1,4}$"), F.translate(t, "-.", "//")).otherwise(t)
    short = r"^(\d{1,2}/\d{1,2}/|\d{1,2} [A-Za-z]{3} |[A-Za-z]{3} \d{1,2} )(\d{2})$"
    year = lambda x: F.when(F.substring(x, -2, 2).cast("int") >= CENTURY, F.lit("19")).otherwise(F.lit("20"))
    long = lambda x: F.when(x.rlike(short), F.concat(F.regexp_extract(x, short, 1), year(x), F.substring(x, -2, 2))).otherwise(x)
    return F.when(text.rlike(FORMATS[0][0]), text).otherwise(F.get(F.transform(F.array(t), long), 0))


def _date(text: Column) -> Column:
    """The date of squeezed text: a spreadsheet serial number first, then FORMATS of its plain form; null if none fits."""
    n = text.cast("double")

    def told(plain: Column) -> Column:
        out = F.when(F.lit(False), F.lit(None).cast("date"))
        for shape, forms in FORMATS:
            out = out.when(plain.rlike(shape), F.coalesce(*[F.try_to_timestamp(plain, F.lit(x)) for x in forms]).cast("date"))
        return out

    serial = F.when((n >= 1) & (n <= SERIAL_MAX), F.date_add(F.to_date(F.lit("1899-12-30")), F.floor(n).cast("int")))
    return F.when(text.rlike(SERIAL), serial).otherwise(F.get(F.transform(F.array(_plain(text)), told), 0))


def parsed_date(c: Column | str) -> Column:
    """The date of a cell; the cleaned text is bound once by a one-element transform, however often the notations read it."""
    return F.get(F.transform(F.array(squeezed(c)), _date), 0)


def with_date(df: DataFrame, source: str, out: str) -> DataFrame:
    return df.withColumn(out, parsed_date(source))


def _key(date: Column, floor: bool) -> Column:
    ok = date.isNotNull() & (F.year(date) > YEAR_FLOOR) if floor else date.isNotNull()
    return F.when(ok, F.date_format(date, "yyyyMMdd")).otherwise(F.lit(""))


def dob_key(c: Column | str, floor: bool = True) -> Column:
    """'YYYYMMDD' of a cell, or '' if blank, unparseable or (``floor``) of a year up to 1900."""
    return F.get(F.transform(F.array(parsed_date(c)), lambda d: _key(d, floor)), 0)


def with_dob(df: DataFrame, source: str, out: str, floor: bool = True) -> DataFrame:
    return df.withColumn(out, dob_key(source, floor))


def dob_issue(c: Column | str) -> Column:
    """Why a filled cell gives no key, else ''."""

    def why(x: Column) -> Column:
        text, date = x["t"], x["d"]
        low = date.isNotNull() & (F.year(date) <= YEAR_FLOOR)
        return (
            F.when(F.lower(text).isin("", "nan", "none", "null"), F.lit(""))
            .when(low & text.rlike(SERIAL), F.lit("serial number of a day up to 1900"))
            .when(low, F.lit("year up to 1900"))
            .when(date.isNull(), F.lit("not a date"))
            .otherwise(F.lit(""))
        )

    return F.get(F.transform(F.array(F.struct(squeezed(c).alias("t"), parsed_date(c).alias("d"))), why), 0)


def shown(key: Column | str) -> Column:
    """'YYYYMMDD' as 'MM/DD/YYYY'."""
    k = col(key)
    return F.when(k == "", F.lit("")).otherwise(F.concat_ws("/", F.substring(k, 5, 2), F.substring(k, 7, 2), F.substring(k, 1, 4)))
