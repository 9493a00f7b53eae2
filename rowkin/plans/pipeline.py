"""Person resolution from raw rows to the output tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import address, consolidate, legacy, linkage, normalize, reports, survivorship
from ..schema import ADDRESS, CONTACT, MATCH_IDS, NAMES, OLD_COLUMNS, OTHER, VF3_COLUMNS, require
from ..workspace import spread, written
from .profiles import PROFILES

TOKENS = ("docids", *MATCH_IDS, *CONTACT, *OTHER)
NONPII = (*MATCH_IDS, *CONTACT, *OTHER)


@dataclass
class Resolved:
    merged: DataFrame
    unknown_entries: DataFrame
    junk_ssn: DataFrame
    junk_dob: DataFrame
    large_groups: DataFrame
    ambiguous: DataFrame


def required(profile: str) -> tuple[str, ...]:
    return VF3_COLUMNS if PROFILES[profile].dob_alt else tuple(c for c in VF3_COLUMNS if c != "dobs")


def resolve(df: DataFrame, profile: str = "vf3", idx: str = "rec_id") -> Resolved:
    """One row per person of ``df`` and the review tables.

    ``idx`` is a unique row number whose order is the row order.  Extra columns are ignored, missing ones raise.  No known
    row gives an empty table with all columns.
    """
    rules = PROFILES[profile]
    require(df.columns, required(profile))
    raw = df.select(idx, *[c for c in df.columns if c in VF3_COLUMNS])
    rows = written(normalize.with_address_key(normalize.normalized(spread(raw, idx), rules, idx)), "rows")
    known = normalize.known(rows)
    roots = written(linkage.clusters(known, rules), "roots")
    rooted = known.join(roots, "idx")

    places = normalize.with_address_key(address.addresses(rooted, "root"))
    own = rooted.groupBy("root", "first", "last").agg(
        F.count(F.lit(1)).alias("n"),
        survivorship.evidence([F.max(F.col("ssn") != ""), F.max((F.col("dob") != "") | F.col("dob_raw").contains(";")), *[F.max(F.size(text.id_tokens(c)) > 0) for c in rules.evidence]]).alias("evidence"),
        (survivorship.varies("first_name") | survivorship.varies("last_name")).alias("names_differ"),
    )
    per_root = written(own.join(places, "root"), "per-root")
    to, review = consolidate.decisions(per_root, rooted.select("root", *NONPII), list(NONPII), rules)
    to = written(to, "decisions")
    final = rooted.join(to, "root")
    order = F.struct(F.col("root") != F.col("final"), F.col("root"), F.col("idx"))

    base = final.groupBy("final").agg(
        survivorship.fullest("first_name", F.col("first"), order).alias("first_name"),
        survivorship.fullest("middle_name", F.col("mid"), order).alias("middle_name"),
        survivorship.fullest("last_name", F.col("last"), order).alias("last_name"),
        survivorship.fullest("suffix", F.col("suf"), order).alias("suffix_fullest"),
        survivorship.fullest("social_security_number", F.col("ssn"), order).alias("social_security_number"),
        F.min_by("unique_id", order).alias("unique_id"),
        F.count(F.lit(1)).alias("rows_merged"),
    )
    flags = per_root.join(to, "root").groupBy("final").agg(F.max("names_differ").alias("names_differ"), F.max("tie_break").alias("tie_break"))
    folded = consolidate.folded_addresses(per_root.join(to, "root").withColumn("_f", F.col("root") == F.col("final")), "final", "_f", rules.cluster_folds)
    merged = base.join(flags, "final").join(folded.select("final", *ADDRESS, "other_address"), "final")
    merged = merged.join(survivorship.merged_tokens(final, "final", order, list(TOKENS)), "final", "left")
    merged = merged.join(survivorship.merged_dob(final, "final", order), "final", "left")
    if rules.suffix_mode:
        merged = merged.join(survivorship.suffix_mode(final, "final", order), "final", "left")
    else:
        merged = merged.withColumn("suffix", F.col("suffix_fullest"))
    columns = [
        F.col("final").alias("root"), "first_name", "middle_name", "last_name", F.coalesce("suffix", F.lit("")).alias("suffix"),
        "social_security_number", F.coalesce("dob_shown", F.lit("")).alias("full_date_of_birth"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in MATCH_IDS], *ADDRESS, "other_address",
        *[F.coalesce(c, F.lit("")).alias(c) for c in (*CONTACT, "docids", *OTHER)],
        "unique_id", "rows_merged", "names_differ", "tie_break",
    ]
    merged = written(merged.select(*columns), "merged")
    said = F.format_string("no identifier of its own; %d rows of this name fit alike (%d identifiers, %d source rows each), so it was left alone", "n_candidates", "evidence", "rows_each")
    ambiguous = review.join(merged.withColumnRenamed("root", "final"), "final")
    ambiguous = ambiguous.select("first_name", "last_name", "suffix", "docids", said.alias("remarks"), "n_candidates", "evidence", "rows_each")
    merged = with_docid_columns(merged)
    return Resolved(
        merged, normalize.unknown(rows).select(*raw.columns, "unknown_field"), reports.junk_ssn(raw, idx),
        reports.junk_dob(raw, idx, ("full_date_of_birth", "dobs") if rules.dob_alt else ("full_date_of_birth",)), reports.large_groups(merged), ambiguous,
    )


OLD_TOKENS = tuple(c for c in OLD_COLUMNS if c not in (*NAMES, *ADDRESS, "full_date_of_birth", "social_security_number"))


def _old_rows(rooted: DataFrame, order: F.Column, places: DataFrame) -> DataFrame:
    base = rooted.groupBy("root").agg(
        *[survivorship.fullest(c, F.col(n), order).alias(c) for c, n in zip(NAMES, ("first", "last", "mid", "suf"))],
        survivorship.fullest("social_security_number", F.col("ssn"), order).alias("social_security_number"),
        F.count(F.lit(1)).alias("rows_merged"),
        (survivorship.varies("first_name") | survivorship.varies("last_name")).alias("names_differ"),
    )
    out = base.join(places, "root").join(survivorship.merged_tokens(rooted, "root", order, list(OLD_TOKENS)), "root", "left")
    out = out.join(survivorship.merged_dob(rooted, "root", order), "root", "left")
    shown = [F.coalesce("dob_shown", F.lit("")).alias("full_date_of_birth") if c == "full_date_of_birth" else F.coalesce(c, F.lit("")).alias(c) for c in OLD_COLUMNS]
    return out.select("root", *shown, "other_address", "rows_merged", "names_differ")


def resolve_old(df: DataFrame, bridged: bool = False, idx: str = "rec_id") -> tuple[DataFrame, DataFrame | None]:
    """One row per person under the older rules, in input column order, and with ``bridged`` the unnamed rows left for review.

    Unnamed rows stay in the pool; ``bridged`` then shows missing names as [UNKNOWN] and merges each fully unnamed row into
    the named row that it belongs to (``legacy.bridge``): texts, dates and addresses are joined flat, the named row's first.
    """
    require(df.columns, OLD_COLUMNS)
    rows = legacy.normalized(spread(df.select(idx, *OLD_COLUMNS), idx), idx).withColumn("dob_raw", F.col("full_date_of_birth"))
    rows = written(normalize.with_address_key(rows.drop("addr", "base", "unit")), "old-rows")
    roots = written(legacy.clusters(legacy.normalized(rows.drop("dob", "ssn"), "idx")), "old-roots")
    rooted = rows.join(roots, "idx")
    places = written(address.addresses(rooted, "root"), "old-places")
    merged = written(_old_rows(rooted, F.col("idx"), places), "old-merged")
    if not bridged:
        return merged, None
    told = legacy.bridge(legacy.normalized(merged, "root"))
    told = written(told, "bridge")
    to = told.where("target is not null").select(F.col("idx").alias("root"), "target")
    moved = rooted.join(to, "root", "left").withColumn("own", F.col("target").isNull()).withColumn("old", F.col("root")).withColumn("root", F.coalesce("target", "root"))
    order = F.struct(~F.col("own"), F.col("old"), F.col("idx"))
    per_root = places.join(to, "root", "left").withColumn("_f", F.col("target").isNull()).withColumn("final", F.coalesce("target", "root")).withColumn("n", F.lit(1).cast("long"))
    folded = consolidate.folded_addresses(normalize.with_address_key(per_root), "final", "_f", False).select(F.col("final").alias("root"), *ADDRESS, "other_address")
    out = legacy.backfilled(_old_rows(moved, order, folded))
    tie = told.where("decided = 'evidence'").select(F.col("target").alias("root")).distinct().withColumn("tie_break", F.lit(True))
    out = out.join(tie, "root", "left").withColumn("tie_break", F.coalesce("tie_break", F.lit(False)))
    by = F.when(F.col("tier") == 1, F.lit("its number")).otherwise(F.concat(F.col("n_shared"), F.lit(" of its identifiers")))
    said = F.concat(F.lit("no name; several named rows share "), by, F.lit(" and tell equally much, so it was left alone"))
    review = told.where("decided = 'review'").join(merged, F.col("idx") == F.col("root")).select(F.substring("docids", 1, 200).alias("docids"), said.alias("remarks"), "tier", "n_shared")
    return out, review


def with_docid_columns(merged: DataFrame, most: int = 20_000) -> DataFrame:
    """``merged`` with long docids cells spread over docids, docids_2, ... beside each other; one action finds how many are needed."""
    split = merged.withColumn("_c", F.when(F.length("docids") > most, survivorship.chunks("docids", most)).otherwise(F.array("docids")))
    width = split.agg(F.max(F.size("_c"))).first()[0] or 1
    cells = [F.coalesce(F.get("_c", k), F.lit("")).alias("docids" if k == 0 else f"docids_{k + 1}") for k in range(width)]
    return split.select(*[x for c in merged.columns for x in (cells if c == "docids" else [F.col(c)])])


def final_rows(merged: DataFrame) -> DataFrame:
    """Exact duplicates once (the first root's), most merged rows first."""
    same = [c for c in merged.columns if c != "root"]
    return merged.groupBy(*same).agg(F.min("root").alias("root")).select(*merged.columns).orderBy(F.desc("rows_merged"), "root")
