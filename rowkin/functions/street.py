"""Street and zip expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col, conflict, norm_text, stripped

# Postal abbreviations; each word and its short forms read as the first entry.
SHORT = {
    "N": ("NORTH",), "S": ("SOUTH",), "E": ("EAST",), "W": ("WEST",),
    "NE": ("NORTHEAST",), "NW": ("NORTHWEST",), "SE": ("SOUTHEAST",), "SW": ("SOUTHWEST",),
    "ST": ("STREET",), "AVE": ("AVENUE", "AV"), "BLVD": ("BOULEVARD",), "RD": ("ROAD",), "LN": ("LANE",), "DR": ("DRIVE",),
    "CT": ("COURT",), "CIR": ("CIRCLE",), "PL": ("PLACE",), "TER": ("TERRACE", "TERR"), "PKWY": ("PARKWAY",), "HWY": ("HIGHWAY",),
    "SQ": ("SQUARE",), "TRL": ("TRAIL",), "CV": ("COVE",), "PT": ("POINT",), "XING": ("CROSSING",), "PLZ": ("PLAZA",),
    "EXPY": ("EXPRESSWAY",), "FWY": ("FREEWAY",), "RTE": ("ROUTE",), "JCT": ("JUNCTION",), "MT": ("MOUNT",), "MTN": ("MOUNTAIN",),
    "APT": ("APARTMENT",), "STE": ("SUITE",), "BLDG": ("BUILDING",), "FL": ("FLOOR",),
}
DIRECTIONS = ("N", "S", "E", "W", "NE", "NW", "SE", "SW")
UNIT_WORDS = ("APT", "STE", "UNIT", "BLDG", "FL")


def _short(token: Column) -> Column:
    out = F
    for short, words in SHORT.items():
        out = out.when(token.isin(*words), F.lit(short))
    return out.otherwise(token)


def with_street(df: DataFrame, source: str, out: str, base: str | None = None, unit: str | None = None) -> DataFrame:
    """``df`` with the canonical street of cell ``source``, and its part before and after the unit word.

    '203A West Shore Rd' and '203 A West Shore Rd' both become '203 W SHORE RD UNIT A'.
    """
    df = df.withColumn("_w", F.split(norm_text(source), " "))
    first, second = F.get("_w", 0), F.get("_w", 1)
    glued = first.rlike("^[0-9]+[A-Z]$")
    loose = first.rlike("^[0-9]+$") & (F.length(second) == 1) & ~second.isin(*DIRECTIONS)
    df = df.withColumn("_l", F.when(glued, F.right(first, F.lit(1))).when(loose, second).otherwise(F.lit("")))
    rest = lambda n: F.slice("_w", n, F.greatest(F.size("_w") - n + 1, F.lit(0)))
    body = F.when(glued, F.concat(F.array(F.regexp_replace(first, "[A-Z]$", "")), rest(2))).when(loose, F.concat(F.array(first), rest(3))).otherwise(F.col("_w"))
    df = df.withColumn("_w", F.transform(F.transform(body, lambda t: F.regexp_replace(t, r"\.+$", "")), _short))
    own = (F.col("_l") != "") & ~F.exists("_w", lambda t: t.isin(*UNIT_WORDS))
    df = df.withColumn("_w", F.when(own, F.concat("_w", F.array(F.lit("UNIT"), "_l"))).otherwise(F.col("_w")))
    df = df.withColumn(out, F.array_join("_w", " "))
    if base or unit:
        at = F.array_position(F.transform("_w", lambda t: t.isin(*UNIT_WORDS) | t.startswith("#")), True)
        df = df.withColumn("_at", F.when(at == 0, F.size("_w") + 1).otherwise(at).cast("int"))
        df = df.withColumn(base or "_b", F.array_join(F.slice("_w", 1, F.col("_at") - 1), " "))
        df = df.withColumn(unit or "_u", F.array_join(F.slice("_w", F.col("_at"), F.greatest(F.size("_w") - F.col("_at") + 1, F.lit(0))), " "))
    return df.drop("_w", "_l", "_at", "_b", "_u")


def street_compatible(a_street: Column, a_base: Column, a_unit: Column, b_street: Column, b_base: Column, b_unit: Column) -> Column:
    """Equal, blank on one side, or one non-empty base whose units are not both given and different."""
    return (a_street == "") | (b_street == "") | (a_street == b_street) | ((a_base != "") & (a_base == b_base) & ~conflict(a_unit, b_unit))


def zip5(c: Column | str) -> Column:
    digits = F.regexp_replace(F.coalesce(col(c), F.lit("")), "[^0-9]", "")
    return F.when(F.length(digits) >= 5, F.substring(digits, 1, 5)).otherwise(F.lit(""))


def zip_key(c: Column | str) -> Column:
    return F.when(zip5(c) != "", zip5(c)).otherwise(norm_text(c))


def full_address(*cells: Column | str) -> Column:
    """Filled parts joined by ', '."""
    return F.array_join(F.filter(F.array(*[stripped(c) for c in cells]), lambda x: x != ""), ", ")
