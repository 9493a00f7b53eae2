"""Rows without any identifier folded into the rows of the same name that have some."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..plans.profiles import Profile
from ..schema import ADDRESS
from .address import address_text, keys_conflict

PARTS = ["a0", "a_base", "a_unit", "a1", "a2", "a3", "a4", "a5"]
FIELDS = [(0, 1, 2), (3,), (4,), (5,), (6,), (7,)]  # key parts of each address cell


def fold(base: dict, extra: dict) -> None:
    """Fold ``extra`` (cells, key, other, n) into ``base``: gaps are filled if nothing conflicts, else the address with
    more rows stays (the base's on a tie) and the other one is kept as text."""
    other = list(base["other"])
    if not any(base["key"]):
        cells, key = extra["cells"], extra["key"]
    elif not any(extra["key"]):
        cells, key = base["cells"], base["key"]
    elif not keys_conflict(tuple(base["key"]), tuple(extra["key"])):
        cells, key = list(base["cells"]), list(base["key"])
        for f, parts in enumerate(FIELDS):
            if extra["key"][parts[0]] and (not key[parts[0]] or len(extra["cells"][f].strip()) > len(cells[f].strip())):
                cells[f] = extra["cells"][f].strip()
                for p in parts:
                    key[p] = extra["key"][p]
    else:
        keep, lose = (extra, base) if extra["n"] > base["n"] else (base, extra)
        cells, key = keep["cells"], keep["key"]
        other.append(address_text(lose["cells"]))
    seen, out = set(), []
    for s in other + list(extra["other"]):
        k = " ".join(s.upper().split())
        if k and k not in seen:
            seen.add(k)
            out.append(s)
    base |= {"cells": list(cells), "key": list(key), "other": out, "n": base["n"] + extra["n"]}


def flat(base: dict, extra: dict) -> None:
    """Every address cell as the distinct values of both, joined by '; '."""
    cells = []
    for a, b in zip(base["cells"], extra["cells"]):
        parts, seen = [], set()
        for v in (x.strip() for c in (a, b) for x in (c or "").split(";")):
            k = " ".join(v.upper().split())
            if k and k not in seen:
                seen.add(k)
                parts.append(v)
        cells.append("; ".join(parts))
    base |= {"cells": cells, "n": base["n"] + extra["n"], "other": list(dict.fromkeys([*base["other"], *extra["other"]]))}


def folded_addresses(roots: DataFrame, group: str, first: str, cluster: bool) -> DataFrame:
    """(group, address cells, other_address, key parts) of groups of roots, folded in the order (``first`` desc, root).

    Roots without rows to outweigh others repeat the same addresses; only the first of each is folded, the rest would change nothing.
    """
    cells = F.array(*[F.coalesce(c, F.lit("")) for c in ADDRESS])
    other = F.filter(F.split(F.coalesce("other_address", F.lit("")), "; "), lambda x: x != "")
    one = roots.groupBy(group, F.col(first).alias("_first"), cells.alias("cells"), F.array(*PARTS).alias("key"), other.alias("other")).agg(F.min("root").alias("root"), F.sum("n").alias("n"))
    own = one.groupBy(group).agg(F.array_sort(F.collect_list(F.struct((~F.col("_first")).alias("later"), "root", "cells", "key", "other", "n"))).alias("own"))
    names = [*ADDRESS, "other_address", *PARTS]

    def run(batches):
        for pdf in batches:
            out = []
            for g, rows in zip(pdf[group], pdf["own"]):
                base, *rest = [{k: list(v) if k in ("cells", "key", "other") else v for k, v in dict(r).items()} for r in rows]
                if base["later"]:
                    base["n"] = 1
                for r in rest:
                    (fold if cluster else flat)(base, r | {"n": 1})
                out.append((g, *base["cells"], "; ".join(base["other"]), *base["key"]))
            yield pd.DataFrame(out, columns=[group, *names])

    return own.mapInPandas(run, f"{group} long, " + ", ".join(f"{c} string" for c in names))


def decisions(roots: DataFrame, rows: DataFrame, nonpii: list[str], profile: Profile) -> tuple[DataFrame, DataFrame]:
    """(root, final, tie_break) for every root, and the names left undecided.

    ``roots``: root, first, last, n, evidence, address cells and key parts.  ``rows``: root and raw cells of the known rows.
    All roots of a name without any evidence are one; they go to the only root with evidence, else to the only one that
    shares a non-identifying value with them, else to the one with most evidence, then most rows (``tie_break``);
    if that is tied too they stay, and are reported.
    """
    name = ["first", "last"]
    per = roots.groupBy(*name).agg(
        F.count(F.lit(1)).alias("k"),
        F.sum((F.col("evidence") > 0).cast("int")).alias("n_filled"),
        F.min(F.when(F.col("evidence") == 0, F.col("root"))).alias("blank"),
    ).where("blank is not null and k > 1")
    some = roots.join(per, name)
    blanks = some.where("evidence = 0")
    filled = some.where("evidence > 0")
    only = filled.where("n_filled = 1").select("blank", F.col("root").alias("target"), F.lit(False).alias("flag"))
    many = filled.where("n_filled > 1")
    shared = None
    if profile.nonpii:
        cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in nonpii])
        tokens = rows.select("root", F.explode(cells).alias("x")).where(F.trim(F.coalesce("x.v", F.lit(""))) != "")
        tokens = tokens.select("root", F.col("x.c").alias("c"), F.explode(text.id_tokens("x.v")).alias("token"))
        mine = tokens.join(blanks.where("n_filled > 1").select("root", "blank", *name), "root").select(*name, "blank", "c", "token").distinct()
        theirs = tokens.join(many.select("root", *name), "root").select(*name, "c", "token", "root").distinct()
        by_token = mine.join(theirs, [*name, "c", "token"]).select("blank", F.col("root").alias("target"))
        at = F.array(*[c for c in PARTS if c not in ("a_base", "a_unit")])
        full = F.exists(at, lambda x: x != "")
        combined = folded_addresses(blanks.where("n_filled > 1").withColumn("_f", F.lit(False)), "blank", "_f", profile.cluster_folds)
        by_place = combined.where(full).select("blank", at.alias("at")).join(many.where(full).select("blank", at.alias("at"), F.col("root").alias("target")), ["blank", "at"]).select("blank", "target")
        shared = by_token.unionByName(by_place).distinct().groupBy("blank").agg(F.count(F.lit(1)).alias("m"), F.min("target").alias("target")).where("m = 1").select("blank", "target", F.lit(False).alias("flag"))
    best = many.groupBy("blank").agg(F.max(F.struct("evidence", "n")).alias("top"))
    tied = many.join(best, "blank").where((F.col("evidence") == F.col("top.evidence")) & (F.col("n") == F.col("top.n")))
    ranked = tied.groupBy("blank").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("target"), F.first("top").alias("top"))
    if shared is not None:
        ranked = ranked.join(shared.select("blank"), "blank", "left_anti")
    winner = ranked.where("m = 1").select("blank", "target", F.lit(True).alias("flag"))
    to = only.unionByName(winner)
    to = to.unionByName(shared) if shared is not None else to
    moved = blanks.select("root", "blank").join(to, "blank", "left").select("root", F.coalesce("target", "blank").alias("final"))
    flags = to.where("flag").select(F.col("target").alias("final")).distinct().withColumn("tie_break", F.lit(True))
    out = roots.select("root").join(moved, "root", "left").select("root", F.coalesce("final", "root").alias("final"))
    out = out.join(flags, "final", "left").select("root", "final", F.coalesce("tie_break", F.lit(False)).alias("tie_break"))
    review = ranked.where("m > 1").select(F.col("blank").alias("final"), F.col("m").alias("n_candidates"), F.col("top.evidence").alias("evidence"), F.col("top.n").alias("rows_each"))
    return out, review
