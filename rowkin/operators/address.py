"""Several addresses of one person: the majority address, and the others as text."""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import street, text
from ..schema import ADDRESS

KEY = ["a0", "a1", "a2", "a3", "a4", "a5"]


def keys_conflict(a: tuple, b: tuple) -> bool:
    """Whether two address keys (street, base, unit, city, state, province, zip, country) contradict each other."""
    if a[0] and b[0] and a[0] != b[0] and not (a[1] and a[1] == b[1] and not (a[2] and b[2] and a[2] != b[2])):
        return True
    return any(x and y and x != y for x, y in zip(a[3:], b[3:]))


def fullest(raws: list, norms: list) -> str:
    best = ""
    for raw, norm in zip(raws, norms):
        raw = (raw or "").strip()
        if norm and len(raw) > len(best):
            best = raw
    return best


def address_text(values: list[str]) -> str:
    return ", ".join(v.strip() for v in values if v and v.strip())


def majority(keys: list[dict]) -> tuple[list[str], list[str]]:
    """The six cells of the majority address and the texts of the others.

    ``keys``: distinct keys of a person in order of first row, each with ``key`` (eight parts), ``raw`` (six cells of its
    first row) and ``n``.  Keys that do not conflict are one cluster, also through others; the heaviest cluster wins,
    the earliest on a tie, a blank one only alone.
    """
    n = len(keys)
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    bases = defaultdict(list)  # streets of different bases always conflict; a blank street fits any
    filled = [i for i in range(n) if any(keys[i]["key"])]
    for i in filled:
        bases[keys[i]["key"][1] if keys[i]["key"][0] else None].append(i)
    for base, own in bases.items():
        near = own if base is None else own + bases.get(None, [])
        for i in own:
            for j in near:
                if i != j and find(i) != find(j) and not keys_conflict(keys[i]["key"], keys[j]["key"]):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    clusters = defaultdict(list)
    for i in range(n):
        clusters[find(i)].append(i)
    real = [c for c in clusters.values() if any(any(keys[i]["key"]) for i in c)]
    top = max(real or clusters.values(), key=lambda c: (sum(keys[i]["n"] for i in c), -min(c)))

    def cells(c: list[int]) -> list[str]:
        part = [0, 3, 4, 5, 6, 7]
        return [fullest([keys[i]["raw"][f] for i in c], [keys[i]["key"][part[f]] for i in c]) for f in range(6)]

    return cells(top), [address_text(cells(c)) for c in clusters.values() if c is not top and c in real]


def addresses(rows: DataFrame, group: str) -> DataFrame:
    """(group, six address cells, other_address): rows carry the address key, ``group`` and idx.

    A person's rows collapse into distinct keys first, so what a task holds is the number of spellings, not of rows.
    """
    key = F.array("a0", "a_base", "a_unit", "a1", "a2", "a3", "a4", "a5")
    raw = F.array(*[text.stripped(c) for c in ADDRESS])
    distinct = rows.groupBy(group, key.alias("key")).agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("at"), F.min_by(raw, "idx").alias("raw"))
    own = distinct.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("at", "key", "raw", "n"))).alias("keys"))
    names = [*ADDRESS, "other_address"]

    def run(batches):
        for pdf in batches:
            out = []
            for g, keys in zip(pdf[group], pdf["keys"]):
                best, others = majority([dict(k) for k in keys])
                out.append((g, *best, "; ".join(others)))
            yield pd.DataFrame(out, columns=[group, *names])

    several = own.where(F.size("keys") > 1).mapInPandas(run, f"{group} long, " + ", ".join(f"{c} string" for c in names))
    one = own.where(F.size("keys") == 1).select(group, F.get("keys", 0).alias("k"))
    part = [0, 3, 4, 5, 6, 7]
    one = one.select(
        group, *[F.when(F.get("k.key", part[i]) != "", F.get("k.raw", i)).otherwise(F.lit("")).alias(c) for i, c in enumerate(ADDRESS)], F.lit("").alias("other_address")
    )
    return one.unionByName(several)


def conflict(a: dict, b: dict):
    """Expression for two sets of columns a0..a5, a_base, a_unit given as dicts of columns."""
    bad = ~street.street_compatible(a["a0"], a["a_base"], a["a_unit"], b["a0"], b["a_base"], b["a_unit"])
    for k in KEY[1:]:
        bad = bad | text.conflict(a[k], b[k])
    return bad
