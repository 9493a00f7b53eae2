"""The older rule set: eight levels with prefix-tolerant names, and the bridge from unnamed to named rows."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, street, text
from ..workspace import written
from .labels import linked_labels

IDS = {3: "employee_identification_number", 4: "drivers_license_number", 5: "passport_number", 6: "phone_number", 7: "email_address_personal"}
BRIDGE = (3, 4, 5, 7)
NAME = ["first", "last", "mid", "suf"]
PLACE = ["addr", "base", "unit", "city_n", "state_n", "zip_n", "zip5", "province_n"]


def normalized(df: DataFrame, idx: str = "rec_id") -> DataFrame:
    df = df.withColumn("idx", F.col(idx).cast("long"))
    df = text.with_names(df, first="first_name", last="last_name", mid="middle_name", suf="suffix")
    df = dates.with_dob(df, "full_date_of_birth", "dob", False).withColumn("ssn", text.norm_ssn("social_security_number"))
    # a merged row's cell may hold several dates
    each = F.transform(F.split(F.coalesce("full_date_of_birth", F.lit("")), ";"), lambda c: dates.dob_key(c, False))
    df = df.withColumn("dob_set", F.array_distinct(F.filter(each, lambda k: k != "")))
    df = df.withColumns({f"ids{n}": text.id_tokens(c) for n, c in IDS.items()})
    df = street.with_street(df, "residential_address", "addr", "base", "unit")
    cells = {"city_n": "city", "state_n": "state_of_residence", "zip_n": "zip_code", "province_n": "province_of_residence"}
    return df.withColumns({k: text.norm_text(c) for k, c in cells.items()} | {"zip5": street.zip5("zip_code")})


def name_conflict(a: str, b: str) -> Column:
    """First, middle or last names that are no prefix of each other, or different suffixes; '{n}_a' style column names."""
    bad = text.conflict(F.col(f"suf{a}"), F.col(f"suf{b}"))
    for n in ("first", "mid", "last"):
        bad = bad | ~text.prefix_compatible(F.col(n + a), F.col(n + b))
    return bad


def address_conflict(a: str, b: str) -> Column:
    at = lambda c, s: F.col(c + s)
    bad = ~street.street_compatible(at("addr", a), at("base", a), at("unit", a), at("addr", b), at("base", b), at("unit", b))
    for c in ("city_n", "state_n", "zip5", "province_n"):
        bad = bad | text.conflict(at(c, a), at(c, b))
    return bad


def keys(level: int) -> Column:
    """Blocking keys of a row, as an array."""
    named = (F.col("first") != "") & (F.col("last") != "")
    none = F.array().cast("array<string>")
    name = F.concat_ws("\u0001", "first", "last")
    if level == 1:
        return F.when(F.col("ssn") != "", F.array("ssn")).otherwise(none)
    if level == 2:
        return F.when(named & (F.col("dob") != ""), F.array(F.concat_ws("\u0001", name, "dob"))).otherwise(none)
    if level < 8:
        return F.when(named, F.transform(f"ids{level}", lambda t: F.concat_ws("\u0001", name, t))).otherwise(none)
    cells = [F.when(F.col(c) != "", F.concat_ws("\u0001", F.lit(c), c, F.substring("last", 1, 1))) for c in ("addr", "city_n", "zip_n")]
    return F.when(named, F.filter(F.array(*cells), lambda x: x.isNotNull())).otherwise(none)


def _matched(classes: DataFrame, used: list[str], level: int) -> DataFrame:
    """(c_a, c_b, n_a, n_b): classes that the level matches; at level 8 in one direction only, else in both."""
    side = lambda s: classes.select(F.explode("keys").alias("key"), F.col("c").alias(f"c{s}"), F.col("n").alias(f"n{s}"), *[F.col(x).alias(x + s) for x in used])
    a, b = side("_a"), side("_b")
    if level == 8:
        prefixes = F.transform(F.sequence(F.lit(1), F.length("first_a")), lambda n: F.substring(F.col("first_a"), F.lit(1), n))
        a, b = a.withColumn("p", F.explode(prefixes)), b.withColumn("p", F.col("first_b"))
        met = a.join(b, ["key", "p"])
    else:
        met = a.join(b, "key")
    bad = text.conflict(F.col("dob_a"), F.col("dob_b")) | name_conflict("_a", "_b")
    if level > 1:
        bad = bad | text.conflict(F.col("ssn_a"), F.col("ssn_b"))
    if level == 8:
        bad = bad | address_conflict("_a", "_b")
        both = lambda c: (F.col(f"{c}_a") != "") & (F.col(f"{c}_b") != "")
        real = both("addr")
        for c in ("city_n", "state_n", "zip5", "province_n"):
            real = real | (both(c) & (F.col(f"{c}_a") == F.col(f"{c}_b")))
        bad = bad | ~real
    return met.where(~bad).select("c_a", "c_b", "n_a", "n_b").distinct()


def links(rows: DataFrame, level: int) -> DataFrame:
    """(idx, n_links): for every row the number of rows that the level matches with it, if any.

    Rows alike in all that the level reads are one class; classes are compared, not rows.  At level 8, where a bucket may
    be a whole city, the first name is part of the join key too: one of two compatible names is a prefix of the other, so
    the longer name's prefixes meet the shorter name, and a frequent city makes no large bucket.
    """
    used = ["ssn", "dob", *NAME, *(PLACE if level == 8 else [])]
    rows = rows.select("idx", *used, keys(level).alias("keys")).where(F.size("keys") > 0)
    same = [*used, "keys"]
    classes = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("c"))
    found = _matched(classes, used, level)
    if level == 8:
        turned = found.select(F.col("c_b").alias("c_a"), F.col("c_a").alias("c_b"), F.col("n_b").alias("n_a"), F.col("n_a").alias("n_b"))
        found = found.union(turned).distinct()
    counted = found.groupBy(F.col("c_a").alias("c")).agg(F.sum("n_b").alias("links"))
    own = rows.join(classes.select(*same, "c"), same).select("idx", "c")
    return own.join(counted, "c").select("idx", (F.col("links") - 1).alias("n_links")).where("n_links > 0")


PLACE_SETS = ["base", "city_n", "state_n", "zip5", "province_n"]


def guarded(rows: list[tuple[int, int]], facts: dict[int, dict], near: dict[int, dict[int, set[int]]], many: dict[int, set[int]] | None = None) -> dict[int, int]:
    """Root of every row of one block of work.

    ``rows``: (idx, class), or the first row of each class alone, with ``many``: level -> classes of several rows that the level
    unites (rows of a class have the same partners, so they always end together).  ``facts``: class -> ssn, dob and place fields.  ``near``: level -> class -> classes that it
    matches.  Pairs come in ascending order within a level; two groups formed at earlier levels stay apart, as do groups of
    different numbers or dates, and at level 8 groups with nothing in common in a place field that both know.
    """
    parent = {i: i for i, _ in rows}
    own = {i: {k: {v} if v else set() for k, v in facts[c].items()} for i, c in rows}
    members, locked = defaultdict(list), set()
    for i, c in sorted(rows):
        members[c].append(i)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for level in sorted(near):
        touched = set()
        for i, c in sorted(rows):
            for j in sorted(j for other in near[level].get(c, ()) for j in members[other] if j > i):
                x, y = find(i), find(j)
                guards = ["ssn", "dob", *(PLACE_SETS if level == 8 else [])]
                if x == y or (x in locked and y in locked) or any(own[x][k] and own[y][k] and not own[x][k] & own[y][k] for k in guards):
                    continue
                lo, hi = min(x, y), max(x, y)
                parent[hi] = lo
                own[lo] = {k: own[lo][k] | own[hi][k] for k in own[lo]}
                if hi in locked:
                    locked.add(lo)
                touched.add(lo)
        locked |= {find(x) for x in (*touched, *(many or {}).get(level, ()))}
    return {i: find(i) for i, _ in rows}


def clusters(rows: DataFrame) -> DataFrame:
    """(idx, root) of every row under all eight levels.

    Matched classes of like rows are labelled by what they are linked with; nothing beyond a label can ever unite, so
    each label is one block of work, of classes, not of rows.
    """
    used = ["ssn", "dob", *NAME, *PLACE]
    ids = [f"ids{n}" for n in IDS]
    code = written(rows.select("idx", *used, *ids), "legacy-rows")
    classes = written(code.groupBy(*used, *ids).agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("c")), "legacy-classes")
    found = None
    for level in range(1, 9):
        keyed = classes.withColumn("keys", keys(level)).where(F.size("keys") > 0)
        pairs = _matched(keyed, used, level).where("c_a <> c_b or n_a > 1").select(F.lit(level).alias("level"), F.least("c_a", "c_b").alias("x"), F.greatest("c_a", "c_b").alias("y")).distinct()
        found = pairs if found is None else found.unionByName(pairs)
    found = written(found, "legacy-pairs")
    label = written(linked_labels(found, "x", "y"), "legacy-labels")
    alone = found.where("x = y").select(F.col("x").alias("node")).distinct().join(label.select("node"), "node", "left_anti").select("node", F.col("node").alias("label"))
    label = label.unionByName(alone)
    of_class = classes.join(label, F.col("c") == F.col("node"))
    facts = of_class.groupBy("label").agg(F.collect_list(F.struct("c", "ssn", "dob", *PLACE_SETS)).alias("facts"))
    edges = found.join(label, F.col("x") == F.col("node")).groupBy("label").agg(F.collect_list(F.struct("level", "x", "y")).alias("edges"))
    blocks = facts.join(edges, "label")

    def run(batches):
        for pdf in batches:
            out = []
            for known, pairs in zip(pdf["facts"], pdf["edges"]):
                near: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
                many = defaultdict(set)
                for e in pairs:
                    if e["x"] == e["y"]:
                        many[e["level"]].add(e["x"])
                        near[e["level"]]  # the level counts, whoever else it matches
                    else:
                        near[e["level"]][e["x"]].add(e["y"])
                        near[e["level"]][e["y"]].add(e["x"])
                known = {f["c"]: {k: f[k] for k in ("ssn", "dob", *PLACE_SETS)} for f in known}
                out += guarded([(c, c) for c in known], known, near, many).items()
            yield pd.DataFrame(out, columns=["c", "root"])

    done = blocks.select("facts", "edges").mapInPandas(run, "c long, root long")
    of_row = classes.join(done, "c").select(*used, *ids, "root")  # rows alike in all, but without any key, stay apart
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*used, *ids)]
    met = code.alias("l").join(of_row.alias("r"), reduce(lambda x, y: x & y, same), "left")
    return met.select("l.idx", F.coalesce("r.root", "l.idx").alias("root"))


def bridge(rows: DataFrame) -> DataFrame:
    """(idx, target, tier, n_shared, decided): the named row that each fully unnamed row belongs to.

    Tier 1 are named rows of the same number, tier 2 (only without any of tier 1) those that share an employee, license,
    passport or e-mail token; unequal numbers, or dates of which none is the same, exclude.  Most shared ID columns win, then most filled
    evidence fields (``decided`` = 'evidence'); a row still tied has target null and decided 'review'.
    """
    ids = [f"ids{n}" for n in BRIDGE]
    filled = (F.col("ssn") != "").cast("int") + (F.size("dob_set") > 0).cast("int") + sum((F.size(c) > 0).cast("int") for c in ids)
    slim = rows.select("idx", "first", "last", "ssn", "dob_set", *ids, filled.alias("evidence"))
    slim = written(slim, "bridge-rows")
    lost = slim.where("first = '' and last = ''").select(*[F.col(c).alias(f"u_{c}") for c in ("idx", "ssn", "dob_set", *ids)])
    named = slim.where("first <> '' or last <> ''").drop("first", "last")
    tokens = F.array(*[F.struct(F.lit(n).alias("k"), F.col(c).alias("t")) for n, c in zip(BRIDGE, ids)])
    flat = lambda df, idx, t: df.select(idx, F.explode(t).alias("x")).select(idx, "x.k", F.explode("x.t").alias("t"))
    lost_tokens = F.array(*[F.struct(F.lit(n).alias("k"), F.col(f"u_{c}").alias("t")) for n, c in zip(BRIDGE, ids)])
    by_ssn = lost.where("u_ssn <> ''").select("u_idx", F.col("u_ssn").alias("ssn")).join(named.where("ssn <> ''").select("ssn", "idx"), "ssn").select("u_idx", "idx", F.lit(1).alias("tier"))
    by_id = flat(lost, "u_idx", lost_tokens).join(flat(named, "idx", tokens), ["k", "t"]).select("u_idx", "idx", F.lit(2).alias("tier"))
    pool = by_ssn.unionByName(by_id.distinct()).join(lost, "u_idx").join(named, "idx")
    apart = (F.size("u_dob_set") > 0) & (F.size("dob_set") > 0) & ~F.arrays_overlap("u_dob_set", "dob_set")
    pool = pool.where(~apart & ~text.conflict(F.col("u_ssn"), F.col("ssn")))
    pool = pool.withColumn("n_shared", sum((F.arrays_overlap(c, f"u_{c}")).cast("int") for c in ids))
    best = pool.groupBy("u_idx").agg(F.min("tier").alias("tier"))
    pool = pool.join(best, ["u_idx", "tier"])
    top = pool.groupBy("u_idx").agg(F.max("n_shared").alias("n_shared"))
    pool = pool.join(top, ["u_idx", "n_shared"])
    out = pool.groupBy("u_idx", "tier", "n_shared").agg(F.count(F.lit(1)).alias("m"), F.max("evidence").alias("e"), F.min("idx").alias("only"))
    rich = pool.join(out.select("u_idx", "e"), "u_idx").where("evidence = e").groupBy("u_idx").agg(F.count(F.lit(1)).alias("me"), F.min("idx").alias("richest"))
    out = out.join(rich, "u_idx")
    return out.select(
        F.col("u_idx").alias("idx"),
        F.when(F.col("m") == 1, F.col("only")).when(F.col("me") == 1, F.col("richest")).alias("target"),
        "tier", F.col("n_shared").cast("long").alias("n_shared"),
        F.when(F.col("m") == 1, F.lit("shared")).when(F.col("me") == 1, F.lit("evidence")).otherwise(F.lit("review")).alias("decided"),
    )


def backfilled(rows: DataFrame) -> DataFrame:
    """Blank first or last names shown as [UNKNOWN]."""
    return rows.withColumns({c: F.when(F.trim(F.coalesce(c, F.lit(""))) == "", F.lit("[UNKNOWN]")).otherwise(F.col(c)) for c in ("first_name", "last_name")})
