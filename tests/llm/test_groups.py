"""Survivors, components and packing."""

import random
from collections import defaultdict
from datetime import datetime

import pytest

from rowkin.llm import components, packing, survivors
from rowkin.llm import queries as llm_queries

RECORD = "rec_id long, middle_name string, suffix string, residential_address string, received_at timestamp, group_key string"


@pytest.mark.parametrize("name", sorted(llm_queries.SQL))
def test_same_rows_as_sql(name, same_as_sql):
    same_as_sql(llm_queries.QUERIES[name], llm_queries.SQL[name])


def found(spark, records, groups):
    r = spark.createDataFrame(records, RECORD)
    g = spark.createDataFrame(groups, "group_key long, rec_id long, suffix string")
    return {(x["group_key"], x["field_name"]): x["rec_id"] for x in survivors.field_survivors(g, r).collect()}, r, g


def test_survivors(spark):
    t = lambda d: datetime(2024, 1, d)
    records = [
        (1, "Jo", "Jr", "1 Oak St", t(1), "x"), (2, "Joan", "JUNIOR", "Oak St", t(2), "x"), (3, "unk", "iii", "12", t(3), None), (4, "JOAN​​", None, "2 Elm Rd", None, "x"),
        (5, None, "none", None, None, None), (6, "N/A", "-", "Apt 3", t(1), ""),
        (7, None, "2nd", "9th Avenue", t(1), ""), (8, "", "III", "7C-81 Raven Ln", t(1), ""), (9, None, "x" * 50_000, "7" * 50_000, t(1), ""),
    ]
    groups = [(1, 1, ""), (1, 2, ""), (1, 2, ""), (1, 3, None), (1, 4, ""), (1, 99, ""), (2, 5, ""), (2, 6, ""), (3, 7, ""), (3, 8, ""), (None, 1, ""), (4, None, "")]
    got, r, g = found(spark, records, groups)
    assert got == {(1, "middle_name"): 2, (1, "suffix"): 2, (1, "residential_address"): 1, (3, "suffix"): 7, (3, "residential_address"): 8}
    whole = {x["group_key"]: x for x in survivors.survivors(g, r).collect()}
    assert set(whole) == {1, 2, 3} and whole[1]["middle_name"] == "Joan" and whole[2]["suffix"] == ""


def test_survivors_of_nothing(spark):
    assert found(spark, [], [])[0] == {} and found(spark, [], [(1, 1, "")])[0] == {}


def union_find(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(100_000), 400)
    pairs = [(rng.choice(ids), rng.choice(ids)) for _ in range(260)]
    pairs += list(zip(ids[:60], ids[1:61]))  # a chain in random order of ids
    pairs += [(ids[70], x) for x in ids[71:120]]  # a star
    pairs += pairs[:30] + [(b, a) for a, b in pairs[:30]] + [(5, 5), (None, 7), (7, None)]
    df = spark.createDataFrame([(a, b, "v") for a, b in pairs], "rec_a long, rec_b long, v string")
    assert {r[0]: r[1] for r in components.components(df).collect()} == union_find(pairs)


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "rec_a long, rec_b long")).collect() == []


def test_verdicts(spark):
    said = ["match", " MATCH ", "Matched", "no match", "not matched", None, "undecided", "match"]
    pairs = spark.createDataFrame([(1, 2 + i, v, "z") for i, v in enumerate(said)], "rec_a long, rec_b long, verdict string, rec_id string")
    records = spark.createDataFrame([(i,) for i in range(1, 9)], "rec_id long")
    assert sorted(r["rec_b"] for r in components.matching(pairs, records).collect()) == [2, 3, 4]


def test_sweep_keeps_the_capacity():
    rng = random.Random(1)
    for capacity in (10, 64, 2048):
        sizes = defaultdict(int)
        for _ in range(3000):
            sizes[min(capacity, int(rng.expovariate(8 / capacity)) + 1)] += 1
        moves, n = packing.sweep(dict(sizes), capacity)
        used, ranks = defaultdict(int), defaultdict(list)
        for size, first, count, box in moves.tolist():
            ranks[size] += range(first, first + count)
            for i in range(count):
                used[box + i] += size
        assert {s: sorted(r) for s, r in ranks.items()} == {s: list(range(c)) for s, c in sizes.items()}
        assert max(used.values()) <= capacity and set(used) <= set(range(n))
        assert n <= 1.02 * sum(s * c for s, c in sizes.items()) / capacity + 1


def test_packed(spark):
    texts = [None, "", "one two three", "word " * 500, "a", "a", "b c"]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)] + [(None, "x", 1, 2)], "doc_id long, text string, file int, before int")
    out = packing.packed(docs, capacity=64).collect()
    tokens = {r["doc_id"]: r["n_tokens"] for r in packing.token_counts(docs.where("doc_id is not null")).collect()}
    pieces = defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append((r["first_token"], r["n_tokens"]))
    assert set(pieces) == set(range(len(texts)))
    for i, own in pieces.items():
        own.sort()
        assert [a for a, _ in own] == [64 * k for k in range(len(own))] and sum(n for _, n in own) == tokens[i]
        assert len(own) == max(1, -(-tokens[i] // 64))
    boxes = defaultdict(int)
    for r in out:
        boxes[r["container_id"]] += r["n_tokens"]
    assert max(boxes.values()) <= 64
    assert packing.packed(docs.limit(0)).count() == 0
    assert {r["container_id"] for r in packing.packed(docs.where("text = ''")).collect()} == {0}


def test_packed_fill(spark, sf):
    out = llm_queries.p6_packed(spark, sf).groupBy("container_id").sum("n_tokens").collect()
    used = [r[1] for r in out]
    assert max(used) <= packing.CAPACITY and sum(used) / len(used) > 0.9 * packing.CAPACITY
