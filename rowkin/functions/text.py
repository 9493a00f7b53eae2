"""Names, identifiers and plain text.  Blank is '' or null on input and '' on output."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points that are shown as nothing or as a blank.
BLANKS = r"\s\x{00A0}\x{00AD}\x{1680}\x{2000}-\x{200D}\x{2028}\x{2029}\x{202F}\x{205F}\x{2060}\x{3000}\x{FEFF}"

WHITE = r"\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"

# Name cells that only say that no name is known (letters and digits, upper case).
NAME_PLACEHOLDERS = (
    "UNKNOWN", "UNK", "UNKN", "NA", "NONE", "NULL", "NIL", "XXX", "XX", "X", "NMN", "NONAME", "NOTGIVEN", "NOTPROVIDED",
)

# Texts that mean missing in a cell.
NULL_WORDS = ("NAN", "NONE", "NULL")

MASKS = "*#?x"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeezed(c: Column | str) -> Column:
    """Runs of blanks (also unusual and invisible ones) made one space, outer ones removed; null becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(col(c), f"[{BLANKS}]+", " ")), F.lit(""))


def stripped(c: Column | str) -> Column:
    """The cell without outer white space (also unusual white space); null becomes ''."""
    return F.coalesce(F.regexp_replace(col(c), f"^[{WHITE}]+|[{WHITE}]+$", ""), F.lit(""))


def norm_text(c: Column | str) -> Column:
    """Upper case of the squeezed cell; 'nan', 'none' and 'null' are blank.

    Compatibility forms (NFKC) are not unified: Catalyst has no such function; :func:`nfkc` does it in Python.
    """
    text = F.upper(squeezed(c))
    return F.when(text.isin(*NULL_WORDS), F.lit("")).otherwise(text)


def name_core(c: Column | str) -> Column:
    return F.regexp_replace(norm_text(c), "[^A-Z0-9]", "")


def norm_name(c: Column | str) -> Column:
    """Normalized name, blank if it has no A-Z or 0-9 or is a placeholder."""
    core = name_core(c)
    return F.when((core == "") | core.isin(*NAME_PLACEHOLDERS), F.lit("")).otherwise(norm_text(c))


def with_names(df, **names: str):
    """``df`` with normalized names: with_names(df, first="first_name"); staged, so that each cell is cleaned once a row."""
    df = df.withColumns({f"_n_{k}": norm_text(v) for k, v in names.items()})
    df = df.withColumns({f"_c_{k}": F.regexp_replace(f"_n_{k}", "[^A-Z0-9]", "") for k in names})
    blank = {k: F.col(f"_c_{k}").isin("", *NAME_PLACEHOLDERS) for k in names}
    df = df.withColumns({k: F.when(blank[k], F.lit("")).otherwise(F.col(f"_n_{k}")) for k in names})
    return df.drop(*[f"_{x}_{k}" for k in names for x in "nc"])


def ssn_pattern(c: Column | str) -> Column:
    """Mask signs read as X, only digits and X kept."""
    return F.regexp_replace(F.translate(F.upper(F.coalesce(col(c), F.lit(""))), "*#?", "XXX"), "[^0-9X]", "")


def known_digits(pattern: Column) -> Column:
    return F.length(F.regexp_replace(pattern, "X", ""))


def norm_ssn(c: Column | str) -> Column:
    """Nine signs with at least four known digits, else ''."""
    k = ssn_pattern(c)
    return F.when((F.length(k) == 9) & (known_digits(k) >= 4), k).otherwise(F.lit(""))


def ssn_full(ssn: Column | str) -> Column:
    return col(ssn).rlike("^[0-9]{9}$")


def ssn_issue(c: Column | str) -> Column:
    """Message for a nine-sign masked value with fewer than four known digits, else ''."""
    k = ssn_pattern(c)
    bad = (F.length(k) == 9) & k.contains("X") & (known_digits(k) < 4)
    return F.when(bad, F.concat(F.lit("only "), known_digits(k).cast("string"), F.lit(" of 9 digits known"))).otherwise(F.lit(""))


def ssn_compare(a: Column | str, b: Column | str) -> Column:
    """'same', 'diff' or 'unknown' with X as wildcard; fewer than four digits known on both sides is 'unknown'."""
    a, b = col(a), col(b)
    at = lambda c, i: F.substring(c, i, 1)
    both = [(at(a, i) != "X") & (at(b, i) != "X") for i in range(1, 10)]
    overlap = sum((x.cast("int") for x in both), F.lit(0))
    differ = sum(((x & (at(a, i) != at(b, i))).cast("int") for i, x in enumerate(both, 1)), F.lit(0))
    return F.when((F.length(a) != 9) | (F.length(b) != 9), F.lit("unknown")).when(differ > 0, F.lit("diff")).when(overlap >= 4, F.lit("same")).otherwise(F.lit("unknown"))


def id_tokens(c: Column | str) -> Column:
    """Distinct normalized tokens of a cell whose parts are set off by ';'."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(col(c), F.lit("")), ";"), norm_text), lambda t: t != ""))


def whole_number_text(c: Column | str) -> Column:
    """'123.0' as '123': numeric cells of a spreadsheet read as text."""
    return F.regexp_replace(col(c), r"^(-?\d+)\.0$", "$1")


def blank_or_unknown(c: Column | str) -> Column:
    return F.lower(F.trim(F.coalesce(col(c), F.lit("")))).isin("", "[unknown]")


def compatible(a: Column, b: Column) -> Column:
    return (a == "") | (b == "") | (a == b)


def conflict(a: Column, b: Column) -> Column:
    return (a != "") & (b != "") & (a != b)


def prefix_compatible(a: Column, b: Column) -> Column:
    return (a == "") | (b == "") | a.startswith(b) | b.startswith(a)


def nfkc(c: Column | str) -> Column:
    """NFKC through Arrow batches; for cells outside ASCII, where compatibility forms may occur."""

    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKC")

    return fold(col(c))
