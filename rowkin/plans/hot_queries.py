"""Queries on keys that hold most rows, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators.hotkeys import key_rollup
from ..workspace import table

SHARE = 100  # a value is frequent if it holds one row in SHARE


def ssn_key() -> F.Column:
    k = text.ssn_pattern("social_security_number")
    return F.when(F.length(k) == 9, k)


def city_key() -> F.Column:
    return F.upper(text.squeezed("city"))


def with_person(rows: DataFrame) -> DataFrame:
    """``rows`` with the person: first name, last name and date of birth; '' without a name."""
    rows = dates.with_dob(text.with_names(rows, first="first_name", last="last_name"), "full_date_of_birth", "dob")
    person = F.when((F.col("first") == "") & (F.col("last") == ""), F.lit("")).otherwise(F.concat_ws("|", "first", "last", "dob"))
    return rows.withColumn("person", person)


USED = ("rec_id", "received_at", "first_name", "last_name", "full_date_of_birth")


def rollup(spark: SparkSession, d: str, name: str, field: str, key: F.Column) -> DataFrame:
    slim = table(spark, d, name).select(*USED, key.alias("key"))
    rows = key_rollup(with_person(slim), F.col("key"), F.col("person"), F.col("received_at"), F.col("rec_id"))
    return rows.select(F.lit(field).alias("field_name"), "key_value", "n_rows", "n_persons", "first_received", "last_received")


def p5_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Rows, distinct persons, first and last received_at of every value of both fields."""
    ssn = rollup(spark, d, "new_records", "social_security_number", ssn_key())
    return ssn.unionByName(rollup(spark, d, "old_records", "city", city_key()))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Values held by at least one row in a hundred of all rows, blank ones included in that total."""
    out = []
    for name, field, key in (("new_records", "social_security_number", ssn_key()), ("old_records", "city", city_key())):
        total = table(spark, d, name).count()
        out.append(rollup(spark, d, name, field, key).where(F.col("n_rows") * SHARE >= total).select("field_name", "key_value"))
    return out[0].unionByName(out[1])


QUERIES = {"p5_found": p5_found, "p5_rollup": p5_rollup}

BLANK = r"[\s\x{00A0}\x{00AD}\x{1680}\x{2000}-\x{200D}\x{2028}\x{2029}\x{202F}\x{205F}\x{2060}\x{3000}\x{FEFF}]+"


def sql_squeezed(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{BLANK}', ' ', 'g'))"


SSN = "regexp_replace(translate(upper(coalesce(social_security_number, '')), '*#?', 'XXX'), '[^0-9X]', '', 'g')"
CITY = f"upper({sql_squeezed('city')})"


def sql_text(c: str) -> str:
    return f"CASE WHEN upper({sql_squeezed(c)}) IN ('NAN','NONE','NULL') THEN '' ELSE upper({sql_squeezed(c)}) END"


# Stated apart from the list of functions.text.
_NO_NAMES = ("UNKNOWN", "UNK", "UNKN", "NA", "NONE", "NULL", "NIL", "XXX", "XX", "X", "NMN", "NONAME", "NOTGIVEN", "NOTPROVIDED")


def sql_name(c: str) -> str:
    core = f"regexp_replace({sql_text(c)}, '[^A-Z0-9]', '', 'g')"
    return f"CASE WHEN {core} IN ('', {', '.join(repr(x) for x in _NO_NAMES)}) THEN '' ELSE {sql_text(c)} END"


# Shapes and notations as the SQL reads them, stated apart from those of functions.dates.
_SQL_DATES = (
    ("\\d{1,2}/\\d{1,2}/\\d{4}", ("%m/%d/%Y", "%d/%m/%Y")),
    ("\\d{4}-\\d{1,2}-\\d{1,2}", ("%Y-%m-%d",)),
    ("\\d{4}/\\d{1,2}/\\d{1,2}", ("%Y/%m/%d",)),
    ("\\d{1,2}-\\d{1,2}-\\d{4}", ("%m-%d-%Y", "%d-%m-%Y")),
    ("\\d{1,2}\\.\\d{1,2}\\.\\d{4}", ("%m.%d.%Y", "%d.%m.%Y")),
    ("\\d{1,2}/\\d{1,2}/\\d{2}", ("%m/%d/%y", "%d/%m/%y")),
    ("\\d{1,2}-\\d{1,2}-\\d{2}", ("%m-%d-%y", "%d-%m-%y")),
    ("\\d{1,2}-[A-Za-z]{3}-\\d{4}", ("%d-%b-%Y",)),
    ("\\d{1,2}-[A-Za-z]{3}-\\d{2}", ("%d-%b-%y",)),
    ("\\d{1,2} [A-Za-z]{3} \\d{4}", ("%d %b %Y",)),
    ("\\d{1,2} [A-Za-z]{4,9} \\d{4}", ("%d %B %Y",)),
    ("[A-Za-z]{3}\\.? \\d{1,2},? \\d{4}", ("%b %d, %Y", "%b %d %Y", "%b. %d, %Y", "%b. %d %Y")),
    ("[A-Za-z]{4,9} \\d{1,2},? \\d{4}", ("%B %d, %Y", "%B %d %Y")),
    ("\\d{8}", ("%Y%m%d",)),
)
_SQL_TIME = "[T ][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\\.[0-9]+)?)?( ?[AaPp][Mm])?( ?(Z|UTC|[+-][0-9]{2}:?[0-9]{2}))?$"


def sql_date(c: str) -> str:
    """The date of a cell."""
    t = sql_squeezed(c)
    day = f"regexp_replace({t}, '{_SQL_TIME}', '')"
    serial = f"CASE WHEN regexp_full_match({t}, '\\d{{1,6}}(\\.\\d+)?') AND TRY_CAST({t} AS DOUBLE) BETWEEN 1 AND 60000 THEN DATE '1899-12-30' + CAST(floor(TRY_CAST({t} AS DOUBLE)) AS INT) END"
    tries = [f"CASE WHEN regexp_full_match({day}, '{shape}') THEN CAST(try_strptime({day}, {list(forms)}) AS DATE) END" for shape, forms in _SQL_DATES]
    return f"coalesce({serial}, {', '.join(tries)})"


def sql_dob(c: str) -> str:
    return f"CASE WHEN year({sql_date(c)}) > 1900 THEN strftime({sql_date(c)}, '%Y%m%d') ELSE '' END"


def sql_rollup(name: str, field: str, key: str) -> str:
    return f"""SELECT '{field}' AS field_name, k AS key_value, count(*) AS n_rows, count(DISTINCT nullif(p, '')) AS n_persons,
       min(received_at) AS first_received, max(received_at) AS last_received
FROM (SELECT k, received_at, CASE WHEN f = '' AND l = '' THEN '' ELSE f || '|' || l || '|' || b END AS p
      FROM (SELECT {key} AS k, received_at, {sql_name('first_name')} AS f, {sql_name('last_name')} AS l,
                   coalesce({sql_dob('full_date_of_birth')}, '') AS b FROM {name}) x) y
WHERE k <> '' GROUP BY k"""


_SSN_KEY = f"CASE WHEN length({SSN}) = 9 THEN {SSN} END"
_BOTH = (("new_records", "social_security_number", _SSN_KEY), ("old_records", "city", CITY))
SQL = {
    "p5_rollup": "\nUNION ALL\n".join(sql_rollup(*x) for x in _BOTH),
    "p5_found": "\nUNION ALL\n".join(
        f"SELECT '{field}' AS field_name, k AS key_value FROM (SELECT {key} AS k FROM {name}) x WHERE k <> '' "
        f"GROUP BY k HAVING count(*) * {SHARE} >= (SELECT count(*) FROM {name})"
        for name, field, key in _BOTH
    ),
}
