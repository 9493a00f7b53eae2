"""Best representative of each duplicate group, field by field.

Every (group, field, record) that can supply a value becomes one candidate row with a score; a window ranks the
candidates of a (group, field) by score (completeness or trust), recency and record id and keeps the first.  The
``row_number() <= 1`` filter is pushed below the exchange as a partial group limit, so a map task sends at most one
row per group and field, and a group with a third of all rows is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import norm_text, squeezed

# Cells that only say that nothing is known (letters and digits, upper case).
NO_VALUE = (
    "UNKNOWN", "UNK", "UNKN", "NA", "NONE", "NULL", "NIL", "NAN", "NMN", "NONAME", "NOMIDDLENAME", "NOMIDDLE", "NOSUFFIX",
    "NOTGIVEN", "NONEGIVEN", "NOTPROVIDED", "NOTKNOWN", "NOTAVAILABLE", "NOTAPPLICABLE", "NOTSTATED", "MISSING", "BLANK",
    "REDACTED", "PENDING", "TBD", "XXX", "XX", "X",
)

# Spellings of one suffix (letters and digits, upper case).
SUFFIXES = {
    "JR": ("JUNIOR", "JNR", "JR"),
    "SR": ("SENIOR", "SNR", "SR"),
    "II": ("2ND", "SECOND", "THESECOND", "THE2ND", "II"),
    "III": ("3RD", "THIRD", "THETHIRD", "THE3RD", "III"),
    "IV": ("4TH", "FOURTH", "THEFOURTH", "THE4TH", "IV"),
    "V": ("5TH", "FIFTH", "THEFIFTH", "THE5TH", "V"),
}

# A unit of a building; what is left must hold a house number and a street word.
UNIT = r"(?:\b(?:APARTMENT|APT|UNIT|SUITE|STE|ROOM|RM|FLOOR|FL|LOT)\b\.?\s*#?\s*[A-Z0-9-]+|#\s*[A-Z0-9-]+)"
HOUSE = r"(?:^|[ ,])(?:[A-Z0-9]+-)?[0-9]+[A-Z]?(?:[ ,]|$)"
STREET = r"(?:^|[ ,])(?:[0-9]+(?:ST|ND|RD|TH)|[^ ,0-9]{3,})(?:[ ,.]|$)"


def core(c: Column | str) -> Column:
    return F.regexp_replace(norm_text(c), r"[^\p{L}\p{N}]", "")


def letters(c: Column | str) -> Column:
    return F.length(F.regexp_replace(norm_text(c), r"[^\p{L}]", ""))


def real(c: Column | str) -> Column:
    return ~core(c).isin("", *NO_VALUE)


def suffix_class(c: Column | str) -> Column:
    """One text for all spellings of a suffix; null if none is stated."""
    k = core(c)
    out = F.when(~real(c), F.lit(None).cast("string"))
    for name, forms in SUFFIXES.items():
        out = out.when(k.isin(*forms), F.lit(name))
    return out.otherwise(k)


def names_place(c: Column | str) -> Column:
    """Whether an address cell has at least a house number and a street."""
    rest = F.regexp_replace(norm_text(c), UNIT, " ")
    return rest.rlike(HOUSE) & F.regexp_replace(rest, HOUSE, " ").rlike(STREET)


def ranked_first(candidates: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group; ``order`` should end with a unique column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return candidates.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= 1).drop("_rank")


def members(groups: DataFrame, records: DataFrame, columns: list[str]) -> DataFrame:
    """Each membership once, with the record; members that were never delivered drop out, null ids match nothing."""
    own = groups.select("group_key", "rec_id").where(F.col("group_key").isNotNull()).distinct()
    return own.join(records.select("rec_id", *columns), "rec_id")


FIELDS = ["middle_name", "suffix", "residential_address"]


def candidates(rows: DataFrame) -> DataFrame:
    """(group_key, field_name, rec_id, received_at, score) of every cell that may survive.

    middle_name scores its letters, residential_address 0 if it names house number and street; suffix gives one row
    per class, the class's best record with the number of records that state the class.
    """
    cells = rows.select(
        "group_key", "rec_id", "received_at",
        F.explode(F.array(
            F.when(real("middle_name") & (letters("middle_name") > 0), F.struct(F.lit("middle_name").alias("field_name"), letters("middle_name").cast("long").alias("score"))),
            F.when(names_place("residential_address"), F.struct(F.lit("residential_address").alias("field_name"), F.lit(0).cast("long").alias("score"))),
        )).alias("c"),
    ).where(F.col("c").isNotNull()).select("group_key", "c.field_name", "rec_id", "received_at", "c.score")
    latest = F.max_by(F.struct("rec_id", "received_at"), F.struct(F.col("received_at").isNotNull(), "received_at", -F.col("rec_id")))
    suffixes = (
        rows.withColumn("_class", suffix_class("suffix"))
        .where(F.col("_class").isNotNull())
        .groupBy("group_key", "_class")
        .agg(F.count(F.lit(1)).alias("score"), latest.alias("best"))
        .select("group_key", F.lit("suffix").alias("field_name"), "best.rec_id", "best.received_at", "score")
    )
    return cells.unionByName(suffixes)


def field_survivors(groups: DataFrame, records: DataFrame) -> DataFrame:
    """(group_key, field_name, rec_id): the record whose value survives, for each field with some real value.

    Null or blank cells, placeholders and addresses without house number or street are no candidates; repeated
    memberships count once, repeated rows (other rec_id) count each; ties go to the latest received_at (null is
    oldest), then the smaller rec_id; empty tables give no row; other columns of either table are ignored.
    """
    rows = members(groups, records, [*FIELDS, "received_at"])
    order = [F.desc("score"), F.desc_nulls_last("received_at"), F.asc("rec_id")]
    return ranked_first(candidates(rows), ["group_key", "field_name"], order).select("group_key", "field_name", "rec_id")


def survivors(groups: DataFrame, records: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """One record per group: the most complete one, then the latest, then the smallest rec_id, with the surviving
    values of FIELDS in place of its own ('' where no member has one)."""
    fields = fields or [c for c, kind in records.dtypes if kind == "string"]
    filled = sum((F.when(squeezed(c) != "", 1).otherwise(0) for c in fields), F.lit(0))
    scored = records.select("rec_id", "received_at", filled.alias("n_filled"))
    base = ranked_first(
        groups.select("group_key", "rec_id").where(F.col("group_key").isNotNull()).distinct().join(scored, "rec_id"),
        ["group_key"],
        [F.desc("n_filled"), F.desc_nulls_last("received_at"), F.asc("rec_id")],
    ).select("group_key", "rec_id", "n_filled")
    value = F.get(F.array(*[F.col(c) for c in FIELDS]), F.array_position(F.array(*[F.lit(c) for c in FIELDS]), F.col("field_name")).cast("int") - 1)
    chosen = (
        field_survivors(groups, records)
        .join(records.select("rec_id", *FIELDS), "rec_id")
        .select("group_key", "field_name", squeezed(value).alias("value"))
        .groupBy("group_key")
        .agg(*[F.coalesce(F.max(F.when(F.col("field_name") == c, F.col("value"))), F.lit("")).alias(c) for c in FIELDS])
    )
    return base.join(chosen, "group_key", "left").select("group_key", "rec_id", F.col("n_filled").cast("long").alias("n_filled"), *[F.coalesce(c, F.lit("")).alias(c) for c in FIELDS])
