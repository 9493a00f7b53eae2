"""One row per group out of its raw rows; every rule is an aggregate with map-side combine and an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text


def merged_tokens(rows: DataFrame, group: str, order: Column, columns: list[str]) -> DataFrame:
    """Per group and column the distinct ';' tokens in first-seen order and casing, joined by '; '.

    Cells go to long form (blank ones drop out at once), the first of each normalized token is a grouped minimum, so a
    large group is combined before the shuffle.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns])
    long = rows.select(group, order.alias("_o"), F.explode(cells).alias("x")).where(F.trim(F.coalesce("x.v", F.lit(""))) != "")
    tokens = long.select(group, "_o", F.col("x.c").alias("c"), F.posexplode(F.split("x.v", ";")).alias("pos", "t"))
    tokens = tokens.select(group, "c", "_o", "pos", text.norm_text("t").alias("norm"), text.stripped("t").alias("raw")).where("norm <> ''")
    first = tokens.groupBy(group, "c", "norm").agg(F.min(F.struct("_o", "pos", "raw")).alias("f"))
    joined = first.groupBy(group, "c").agg(F.array_join(F.transform(F.array_sort(F.collect_list("f")), lambda x: x["raw"]), "; ").alias("v"))
    return joined.groupBy(group).agg(*[F.coalesce(F.max(F.when(F.col("c") == c, F.col("v"))), F.lit("")).alias(c) for c in columns])


def fullest(raw: str, norm: Column, order: Column) -> Column:
    """Longest trimmed cell with a normalized value; the first on a tie; '' if none."""
    value = text.stripped(raw)
    rank = F.struct(-F.length(value), order)
    return F.coalesce(F.min_by(F.when(norm != "", value), F.when(norm != "", rank)), F.lit(""))


def varies(c: str) -> Column:
    n = F.nullif(text.norm_text(c), F.lit(""))
    return F.coalesce(F.min(n) != F.max(n), F.lit(False))


def suffix_mode(rows: DataFrame, group: str, order: Column) -> DataFrame:
    """(group, suffix): the most frequent normalized suffix, shown in its longest form; longer, then earlier, on a tie."""
    value = text.stripped("suffix")
    tally = rows.where("suf <> ''").select(group, "suf", value.alias("v"), order.alias("_o"))
    tally = tally.groupBy(group, "suf").agg(F.count(F.lit(1)).alias("n"), F.min_by("v", F.struct(-F.length("v"), "_o")).alias("raw"), F.min("_o").alias("at"))
    return tally.groupBy(group).agg(F.min_by("raw", F.struct(-F.col("n"), -F.length("raw"), "at")).alias("suffix"))


def merged_dob(rows: DataFrame, group: str, order: Column) -> DataFrame:
    """(group, dob_shown): distinct dates of the group in first-seen order as MM/DD/YYYY, joined by '; '.

    A row's key counts where its cell gave one; else the parts of a cell with several dates are read one by one.
    """
    one = rows.select(group, order.alias("_o"), F.lit(0).alias("pos"), F.col("dob").alias("key"))
    parts = rows.where("dob = '' and dob_raw like '%;%'").select(group, order.alias("_o"), F.posexplode(F.split("dob_raw", ";")).alias("pos", "part"))
    parts = dates.with_dob(parts, "part", "key").drop("part")
    first = one.unionByName(parts).where("key <> ''").groupBy(group, "key").agg(F.min(F.struct("_o", "pos")).alias("f"))
    shown = F.transform(F.array_sort(F.collect_list(F.struct("f", "key"))), lambda x: dates.shown(x["key"]))
    return first.groupBy(group).agg(F.array_join(shown, "; ").alias("dob_shown"))


def evidence(flags: list[Column]) -> Column:
    """How many of the evidence fields are filled."""
    return sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0))


def chunks(c: str, most: int = 20_000, sep: str = "; ") -> Column:
    """Greedy pieces of at most ``most`` characters, broken only at separators; a longer token is a piece of its own."""
    start = F.array().cast("array<string>")

    def add(done: Column, t: Column) -> Column:
        last = F.element_at(done, -1)
        fits = (F.size(done) > 0) & (F.length(last) + len(sep) + F.length(t) <= most)
        head = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(fits, F.concat(head, F.array(F.concat(last, F.lit(sep), t)))).otherwise(F.concat(done, F.array(t)))

    return F.aggregate(F.split(F.coalesce(c, F.lit("")), sep), start, lambda d, t: F.when(F.size(d) == 0, F.array(t)).otherwise(add(d, t)))
