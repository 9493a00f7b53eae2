"""Which known rows are one person: levels 1 and 2 in closed form, higher levels by a guarded greedy union.

Every rule needs equal first and last name.  Level 1 links rows of one full social security number, level 2 rows of
one date of birth, both unless the other value contradicts; taken in row order this has a closed form: a row without a
date takes the first date of its number, a row without a number the first number of its date, and equal (number,
date) is one group.  It needs two grouped minima and joins, no pairs, so a value on many rows is no hot spot.

Levels 3 and up link rows that share an ID token.  Their result depends on the order of the pairs, which is part of
the semantics (ascending level, then row numbers; groups that were formed at earlier levels do not join each other), so
the names that share any token are worked on name by name; rows alike in number, date, tokens and group count once.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.profiles import PROFILES, Profile

NAME = ["first", "last"]


def level12(rows: DataFrame) -> DataFrame:
    """(idx, first, last, root, g_ssn, g_dob): groups of levels 1 and 2 of the known rows; root is the smallest idx."""
    rows = rows.select("idx", *NAME, "ssn", "ssn_full", "dob")
    d = rows.where(F.col("ssn_full") & (F.col("dob") != "")).groupBy(*NAME, "ssn").agg(F.min_by("dob", "idx").alias("d"))
    s = rows.where("ssn <> '' and dob <> ''").groupBy(*NAME, "dob").agg(F.min_by("ssn", "idx").alias("s"))
    keyed = rows.join(d, [*NAME, "ssn"], "left").join(s, [*NAME, "dob"], "left")
    keyed = keyed.select(
        "idx", *NAME,
        F.when((F.col("ssn") == "") & (F.col("dob") != ""), F.coalesce("s", F.lit(""))).otherwise(F.col("ssn")).alias("g_ssn"),
        F.when((F.col("dob") == "") & F.col("ssn_full"), F.coalesce("d", F.lit(""))).otherwise(F.col("dob")).alias("g_dob"),
    )
    alone = (F.col("g_dob") == "") & ~F.col("g_ssn").rlike("^[0-9]{9}$")
    keyed = keyed.withColumn("own", F.when(alone, F.col("idx")).otherwise(F.lit(-1)))
    keys = [*NAME, "g_ssn", "g_dob", "own"]
    roots = keyed.groupBy(*keys).agg(F.min("idx").alias("root"))
    return keyed.join(roots, keys).select("idx", *NAME, "root", "g_ssn", "g_dob")


def _prefix(a: str, b: str) -> bool:
    return not a or not b or a.startswith(b) or b.startswith(a)


def greedy(rows: list[dict], levels: list[int], profile: Profile, start: dict | None = None) -> tuple[dict[int, int], dict[str, int]]:
    """Final root of every row of one name, and how many unions each guard refused.

    ``rows``: idx, ssn, dob, mid and per level a list of keys.  ``start``: root -> (ssn, dob, locked) of groups formed
    before, with rows carrying ``root``.  Pairs of a level come in ascending order of their row numbers.
    """
    rows = sorted(rows, key=lambda r: r["idx"])
    parent = {r["idx"]: r["idx"] for r in rows}
    state = {r["idx"]: [r["ssn"], r["dob"], False, 1] for r in rows}
    if start:
        for r in rows:
            parent.setdefault(r["root"], r["root"])
            parent[r["idx"]] = r["root"]
        state |= {root: [s, d, locked, 2 if locked else 1] for root, (s, d, locked) in start.items()}
    refused = {"lock": 0, "ssn": 0, "dob": 0}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def fits(level: int, a: dict, b: dict) -> bool:
        if profile.middle_guard and not _prefix(a["mid"], b["mid"]):
            return False
        if level == 1:
            return not (a["dob"] and b["dob"] and a["dob"] != b["dob"])
        ssn_ok = not a["ssn"] or not b["ssn"] or a["ssn"] == b["ssn"]
        return ssn_ok and (level == 2 or not a["dob"] or not b["dob"] or a["dob"] == b["dob"])

    for level in levels:
        holders = defaultdict(list)
        for k, r in enumerate(rows):
            for key in r[f"k{level}"]:
                holders[key].append(k)
        touched = set()
        for k, a in enumerate(rows):
            later = sorted({j for key in a[f"k{level}"] for j in holders[key] if j > k})
            for j in later:
                b = rows[j]
                if not fits(level, a, b):
                    continue
                ra, rb = find(a["idx"]), find(b["idx"])
                if ra == rb:
                    continue
                x, y = state[ra], state[rb]
                if x[2] and y[2]:
                    refused["lock"] += 1
                elif x[0] and y[0] and x[0] != y[0]:
                    refused["ssn"] += 1
                elif x[1] and y[1] and x[1] != y[1]:
                    refused["dob"] += 1
                else:
                    lo, hi = min(ra, rb), max(ra, rb)
                    parent[hi] = lo
                    state[lo] = [x[0] or y[0], x[1] or y[1], x[2] or y[2], x[3] + y[3]]
                    touched.add(lo)
        for root in {find(x) for x in touched}:
            state[root][2] = True
    return {r["idx"]: find(r["idx"]) for r in rows}, refused


def level_keys(rows: DataFrame, profile: Profile) -> DataFrame:
    """``rows`` with one array of blocking keys per level, k1, k2, ..."""
    confirms = (F.col("ssn") != "") if profile.masked_ssn_confirms else F.col("ssn_full")
    one = lambda cond, c: F.when(cond, F.array(c)).otherwise(F.array().cast("array<string>"))
    keys = {"k1": one(confirms, "ssn"), "k2": one(F.col("dob") != "", "dob")}
    return rows.withColumns(keys | {f"k{n}": F.col(f"ids{n}") for n, _ in profile.id_levels})


def shared_keys(rows: DataFrame, levels: list[int]) -> DataFrame:
    """(level, first, last, key, n): blocking keys of a name that at least two rows hold."""
    each = F.array(*[F.struct(F.lit(n).alias("level"), F.col(f"k{n}").alias("keys")) for n in levels])
    flat = rows.select("idx", *NAME, F.explode(each).alias("l")).select("idx", *NAME, "l.level", F.explode("l.keys").alias("key"))
    return flat.groupBy("level", *NAME, "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _worked(rows: DataFrame, profile: Profile) -> tuple[DataFrame, DataFrame]:
    """(idx, root) before the levels that depend on order, and what these do: (root, top) of moved rows, or else the unions that
    each guard refused in one name."""
    rows = level_keys(rows, profile)
    ids = [n for n, _ in profile.id_levels]
    closed = not (profile.middle_guard or profile.masked_ssn_confirms)
    levels = ids if closed else [1, 2, *ids]
    base = level12(rows) if closed else rows.select("idx", *NAME, F.col("idx").alias("root"), F.col("ssn").alias("g_ssn"), F.col("dob").alias("g_dob"))
    names = shared_keys(rows, levels).select(*NAME).distinct()
    slim = rows.select("idx", "ssn", "dob", "mid", *[F.array_sort(f"k{n}").alias(f"k{n}") for n in levels]).join(base, "idx").join(names, NAME, "left_semi")
    # rows alike in all that the levels read do the same as their first one
    alike = [*NAME, "root", "g_ssn", "g_dob", "ssn", "dob", "mid", *[f"k{n}" for n in levels]]
    size = base.groupBy("root").agg((F.count(F.lit(1)) > 1).alias("locked"))
    if closed:
        slim = slim.groupBy(*alike).agg(F.min("idx").alias("idx")).join(size, "root")
    else:
        slim = slim.withColumn("locked", F.lit(False))
    fields = ["idx", "root", "g_ssn", "g_dob", "locked", "ssn", "dob", "mid", *[f"k{n}" for n in levels]]
    grouped = slim.groupBy(*NAME).agg(F.collect_list(F.struct(*fields)).alias("rows"))

    def run(batches):
        for pdf in batches:
            out = []
            for own in pdf["rows"]:
                own = [dict(r) for r in own]
                start = {r["root"]: (r["g_ssn"], r["g_dob"], r["locked"]) for r in own} if closed else None
                final, refused = greedy(own, levels, profile, start)
                out += [(root, top, None, None, None) for root, top in {(r["root"], final[r["idx"]]) for r in own if r["root"] != final[r["idx"]]}]
                if any(refused.values()):
                    out.append((None, None, refused["lock"], refused["ssn"], refused["dob"]))
            yield pd.DataFrame(out, columns=["root", "top", "by_lock", "by_ssn", "by_dob"], dtype="Int64")

    return base, grouped.select("rows").mapInPandas(run, "root long, top long, by_lock long, by_ssn long, by_dob long")


def clusters(rows: DataFrame, profile: Profile = PROFILES["vf3"]) -> DataFrame:
    """(idx, root) of every known row, under all levels of the profile."""
    base, worked = _worked(rows, profile)
    moved = worked.where("root is not null").select("root", "top")
    return base.join(moved, "root", "left").select("idx", F.coalesce("top", "root").alias("root"))


def refusals(rows: DataFrame, profile: Profile = PROFILES["vf3"]) -> DataFrame:
    """(guard, n): pairs of different kinds of rows that a level matches but a guard keeps apart: 'lock' both groups are of
    earlier levels, 'ssn' or 'dob' they have different ones.  The first guard that refuses counts."""
    each = F.array(*[F.struct(F.lit(g).alias("guard"), F.coalesce(F.sum(f"by_{g}"), F.lit(0)).alias("n")) for g in ("lock", "ssn", "dob")])
    return _worked(rows, profile)[1].agg(each.alias("g")).select(F.explode("g").alias("g")).select("g.guard", "g.n")


def hot_buckets(rows: DataFrame, profile: Profile = PROFILES["vf3"], k: int = 5) -> DataFrame:
    """(level, rank, n): sizes of the k largest blocking buckets of each level, without their values."""
    from pyspark.sql import Window

    levels = [1, 2, *[n for n, _ in profile.id_levels]]
    w = Window.partitionBy("level").orderBy(F.desc("n"), *NAME, "key")
    ranked = shared_keys(level_keys(rows, profile), levels).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("level", "rank", "n")


def link_counts(rows: DataFrame, level: int, profile: Profile = PROFILES["vf3"]) -> DataFrame:
    """(idx, n_links): for every row the number of rows that the level matches with it, if any.

    Rows alike in name, key, number and date are counted as a class, and classes are compared, never rows.
    """
    rows = level_keys(rows, profile).select("idx", *NAME, "ssn", "dob", F.col(f"k{level}").alias("keys")).where(F.size("keys") > 0)
    same = [*NAME, "ssn", "dob", "keys"]
    classes = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("c"))
    a = classes.select(*NAME, F.explode("keys").alias("key"), F.col("c").alias("ca"), F.col("ssn").alias("sa"), F.col("dob").alias("da"))
    b = classes.select(*NAME, F.explode("keys").alias("key"), F.col("c").alias("cb"), F.col("ssn").alias("sb"), F.col("dob").alias("db"), F.col("n").alias("nb"))
    differ = lambda x, y: (F.col(x) != "") & (F.col(y) != "") & (F.col(x) != F.col(y))
    ok = ~differ("da", "db") if level == 1 else ~differ("sa", "sb") & ~differ("da", "db")
    met = a.join(b, [*NAME, "key"]).where(ok).select("ca", "cb", "nb").distinct()
    links = met.groupBy(F.col("ca").alias("c")).agg(F.sum("nb").alias("links"))
    own = rows.join(classes, same).select("idx", "c")
    return own.join(links, "c").select("idx", (F.col("links") - 1).alias("n_links")).where("n_links > 0")
