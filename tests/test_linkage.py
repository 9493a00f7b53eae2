"""Closed form and grouped greedy union against a plain simulation of the rules."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from rowkin.operators import linkage
from rowkin.plans.profiles import PROFILES


def simulate(rows, profile):
    """All levels over all pairs in ascending order, as the rules say."""
    root = {r["idx"]: r["idx"] for r in rows}
    ssn, dob, locked = {r["idx"]: r["ssn"] for r in rows}, {r["idx"]: r["dob"] for r in rows}, set()
    rows = sorted(rows, key=lambda r: r["idx"])
    full = lambda s: len(s) == 9 and s.isdigit()
    clash = lambda x, y: bool(x and y and x != y)
    for level in [1, 2, *[n for n, _ in profile.id_levels]]:
        touched = set()
        for a, b in combinations(rows, 2):
            if (a["first"], a["last"]) != (b["first"], b["last"]):
                continue
            if level == 1:
                ok = a["ssn"] == b["ssn"] and (full(a["ssn"]) or (profile.masked_ssn_confirms and a["ssn"])) and not clash(a["dob"], b["dob"])
            elif level == 2:
                ok = a["dob"] and a["dob"] == b["dob"] and not clash(a["ssn"], b["ssn"])
            else:
                ok = set(a[f"ids{level}"]) & set(b[f"ids{level}"]) and not clash(a["ssn"], b["ssn"]) and not clash(a["dob"], b["dob"])
            if profile.middle_guard and not (a["mid"].startswith(b["mid"]) or b["mid"].startswith(a["mid"])):
                ok = False
            x, y = root[a["idx"]], root[b["idx"]]
            if not ok or x == y or (x in locked and y in locked) or clash(ssn[x], ssn[y]) or clash(dob[x], dob[y]):
                continue
            lo, hi = min(x, y), max(x, y)
            root = {k: lo if v == hi else v for k, v in root.items()}
            ssn[lo], dob[lo] = ssn[lo] or ssn[hi], dob[lo] or dob[hi]
            if hi in locked:
                locked.add(lo)
            touched.add(lo)
        locked |= {root[t] for t in touched}
    return root


def made(rng, n):
    out = []
    for i in rng.sample(range(1, 10 * n), n):
        out.append({
            "idx": i, "first": rng.choice("AB"), "last": "L", "mid": rng.choice(["", "J", "JO", "K"]),
            "ssn": rng.choice(["", "", "111111111", "222222222", "11111XXXX"]), "dob": rng.choice(["", "", "19800101", "19900101"]),
            **{f"ids{k}": rng.choice([[], [], ["X"], ["Y"], ["X", "Y"]]) for k in (3, 4, 5, 6)},
        })
    return out


@pytest.mark.parametrize("name", ["vf3", "new"])
def test_clusters_equal_simulation(spark, name):
    profile, rng = PROFILES[name], random.Random(5)
    rows, want = [], {}
    for block in range(40):
        own = made(rng, 12)
        for r in own:
            r["idx"] += block * 1000
            r["last"] = f"L{block}"
        rows += own
        want |= simulate(own, profile)
    schema = "idx long, first string, last string, mid string, ssn string, dob string, " + ", ".join(f"ids{k} array<string>" for k in (3, 4, 5, 6))
    df = spark.createDataFrame(rows, schema).withColumn("ssn_full", F.col("ssn").rlike("^[0-9]{9}$"))
    got = {r["idx"]: r["root"] for r in linkage.clusters(df, profile).collect()}
    assert got == want


def test_no_rows(spark):
    schema = "idx long, first string, last string, mid string, ssn string, dob string, ssn_full boolean, " + ", ".join(f"ids{k} array<string>" for k in (3, 4, 5, 6))
    empty = spark.createDataFrame([], schema)
    assert linkage.clusters(empty).count() == 0 and linkage.link_counts(empty, 1).count() == 0 and linkage.hot_buckets(empty).count() == 0


def test_group_guards_refuse():
    profile = PROFILES["vf3"]
    row = lambda i, ssn, dob, ids: {"idx": i, "root": i, "ssn": ssn, "dob": dob, "mid": "", "k3": ids}
    rows = [row(1, "111111111", "", ["L"]), row(2, "", "", ["L"]), row(3, "222222222", "", ["L"])]
    root, refused = linkage.greedy(rows, [3], profile)
    assert root == {1: 1, 2: 1, 3: 3} and refused["ssn"] == 1
    start = {1: ("111111111", "", True), 3: ("", "19800101", True)}
    root, refused = linkage.greedy([row(1, "111111111", "", ["L"]), row(3, "", "19800101", ["L"])], [3], profile, start)
    assert root == {1: 1, 3: 3} and refused["lock"] == 1
    assert Counter(root.values())[1] == 1
