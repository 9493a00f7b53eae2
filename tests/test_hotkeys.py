from collections import defaultdict
from datetime import datetime
import random

import pytest
from pyspark.sql import functions as F

from rowkin.operators.hotkeys import key_rollup
from rowkin.workspace import heavy_keys, lookup


@pytest.mark.parametrize("chunks", [1, 3, 50, 4096])
def test_rollup_equals_plain_groups(spark, chunks):
    rng, rows = random.Random(3), []
    for i in range(900):
        k = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", "", None])
        p = "one" if rng.random() < 0.3 else rng.choice(["p", "q", "r", "", None])
        t = None if rng.random() < 0.1 else datetime(2024, 1, 1 + rng.randrange(28))
        rows.append((k, p, t, i, 7))
    df = spark.createDataFrame(rows, "k string, p string, t timestamp, i long, file long").withColumn("key_value", F.lit("clash"))
    got = {r[0]: tuple(r)[1:] for r in key_rollup(df, F.col("k"), F.col("p"), F.col("t"), F.col("i"), chunks).collect()}
    want = defaultdict(list)
    for k, p, t, *_ in rows:
        if k:
            want[k].append((p, t))
    assert set(got) == set(want)
    for k, own in want.items():
        times = [t for _, t in own if t]
        assert got[k] == (len(own), len({p for p, _ in own if p}), min(times), max(times))


def test_empty(spark):
    df = spark.createDataFrame([], "k string, p string, t timestamp, i long")
    assert key_rollup(df, F.col("k"), F.col("p"), F.col("t"), F.col("i")).count() == 0


def test_lookup_with_heavy_keys(spark, monkeypatch):
    monkeypatch.setattr("rowkin.workspace.LIGHT", 5)
    rows = spark.createDataFrame([(1 if i < 60 else i, i) for i in range(100)] + [(None, -1)], "k long, v long")
    heavy = heavy_keys(rows, "k", 100)
    assert heavy == [1]
    side = spark.createDataFrame([(i, i * 2) for i in range(80)], "s long, w long")
    for how in ("left", "inner", "left_semi"):
        plain = sorted(map(str, rows.join(side, F.col("k") == F.col("s"), how).collect()))
        assert sorted(map(str, lookup(rows, "k", side, "s", how, heavy).collect())) == plain
