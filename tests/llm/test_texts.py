"""Leaks and languages."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest

from rowkin.llm import language, leaks
from rowkin.llm import queries as llm_queries


def text(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_winnowing_finds_every_long_shared_span():
    rng = random.Random(1)
    for _ in range(200):
        shared = text(rng, leaks.K + leaks.W - 1)
        each = [[*text(rng, rng.randrange(30)), *shared, *text(rng, rng.randrange(30))] for _ in range(2)]
        marks, of = leaks.winnowed(leaks.hashes(each[0] + each[1]), np.repeat([0, 1], [len(x) for x in each]))
        assert np.intersect1d(marks[of == 0], marks[of == 1]).size
        assert set(marks[of == 1]) == set(leaks.winnowed(leaks.hashes(each[1]), np.zeros(len(each[1]), int))[0])  # texts do not touch
    for n in range(9):
        assert (leaks.winnowed(leaks.hashes(["a"] * n), np.zeros(n, int))[0].size > 0) == (n >= leaks.K)


def test_chain_is_near_the_matched_words():
    rng = random.Random(2)
    item = text(rng, 80)
    doc = text(rng, 50) + item[10:40] + text(rng, 5) + item[45:70] + text(rng, 50)
    runs = lambda ws: leaks._grams(leaks.hashes(ws), leaks.RUN)
    n, a, b = leaks.chained(runs(item), runs(doc))
    blocks = SequenceMatcher(None, item, doc, autojunk=False).get_matching_blocks()
    assert n == sum(x.size for x in blocks if x.size >= leaks.RUN) == 55 and (a, b) == (50, 110)
    assert leaks.chained(runs(item), runs(text(rng, 100)))[0] == 0 and leaks.chained(runs([]), runs(doc)) == (0, 0, 0)


def test_leaks(spark):
    rng = random.Random(3)
    items = [" ".join(text(rng, 60)) for _ in range(3)]
    own = items[0].split()
    quoted = "\n".join("> " + " ".join(own[i : i + 7]).upper() for i in range(0, 42, 7))
    changed = " ".join("zzz" if i % 11 == 5 else w for i, w in enumerate(own))
    docs = [quoted, f"<b>{changed}</b>", " ".join(own[:15]), " ".join(items[1].split()[::-1]), None, "", "hi", items[1] + " " + items[2], " ".join(text(rng, 30_000)) + " " + items[2], quoted]
    d = spark.createDataFrame([(i, t, "m") for i, t in enumerate(docs)] + [(None, items[0], "m")], "doc_id long, text string, mark string")
    e = spark.createDataFrame([(10 + i, t, "x") for i, t in enumerate(items)] + [(20, None, "x"), (21, "too short", "x")], "item_id long, item_text string, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in leaks.leaks(d, e).collect())
    assert got == [(0, 10), (1, 10), (7, 11), (7, 12), (8, 12), (9, 10)]
    assert leaks.leaks(d.limit(0), e).count() == 0 and leaks.leaks(d, e.limit(0)).count() == 0
    assert sorted((r["doc_id"], r["item_id"]) for r in leaks.leaks(d, e.union(e), held=10).collect()) == got  # every item a block of its own


@pytest.mark.parametrize("many", [21, 200, 2000])
def test_passage_of_many_items(spark, many):
    rng = random.Random(4)
    passage, stock = text(rng, 60), text(rng, 12)
    items = [(i, " ".join(passage + text(rng, 10))) for i in range(many)] + [(10_000 + i, " ".join(stock + text(rng, 60))) for i in range(30)]
    docs = [(1, " ".join(text(rng, 40) + passage)), (2, " ".join(stock + text(rng, 80))), (3, " ".join(text(rng, 80)))]
    d, e = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, item_text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in leaks.leaks(d, e).collect()) == [(1, i) for i in range(many)]


def test_reach_bounds_the_chain():
    rng = random.Random(5)
    for _ in range(300):
        item, doc = ([f"w{rng.randrange(6)}" for _ in range(rng.randrange(25))] for _ in range(2))
        item, doc = (leaks._grams(leaks.hashes(x), leaks.RUN) for x in (item, doc))
        assert leaks.within_reach(item, doc) >= leaks.chained(item, doc)[0]


@pytest.fixture(scope="module")
def samples(sf):
    import pandas as pd

    return pd.read_parquet(f"{sf}/lang_samples.parquet")


def test_held_out_accuracy(samples):
    test = samples.sample_id % 5 == 0
    model = language.train(list(samples.sample_text[~test]), list(samples.lang[~test]))
    right = total = 0
    for t, y in zip(samples.sample_text[test], samples.lang[test]):
        words = language.words_of(language.clean(t))[0]
        if len(words) >= 5:
            top = max(model.passages(words), key=lambda p: p[1] - p[0])
            right, total = right + (top[2] == y), total + 1
    assert right / total > 0.95


def test_paths_against_a_plain_search():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 12, 60)
    e = rng.normal(0, 2, (size.sum(), 3))
    begin = np.cumsum(size) - size
    got = language.best_paths(e, begin, size, 1.5)
    for a, n in zip(begin, size):
        best = [(e[a, k], (k,)) for k in range(3)]
        for t in range(1, n):
            best = [max((v - 1.5 * (p[-1] != k) + e[a + t, k], (*p, k)) for v, p in best) for k in range(3)]
        path = got[a : a + n]
        value = e[np.arange(a, a + n), path].sum() - 1.5 * (path[1:] != path[:-1]).sum()
        assert value == pytest.approx(max(best)[0])


def test_words_of_many_texts():
    texts = ["It's a Fimdane 300, not ABC 1!", "", "d’accord — ¿qué? x1y", "Да 12", "👍 𝒳yz"]
    words, of, a, b = language.cut(texts)
    assert list(zip(of.tolist(), words)) == [(0, "It's"), (0, "a"), (0, "not"), (2, "d’accord"), (2, "qué"), (2, "x"), (2, "y"), (4, "𝒳yz")]
    assert all(texts[i][x:y] == w for i, x, y, w in zip(of, a, b, words))
    assert language.clean("<a title='" + "x" * 900 + "'>hi</a> 3 < 5 > 4 [url=" + "y" * 500 + "]z[/url] u@v.w &amp;lt;b&amp;gt;k").split() == ["hi", "3", "<", "5", ">", "4", "z", "0", "k"]
    assert language.clean("a" * 200_000 + " b")[-1] == "b"  # no quadratic search


def test_unknown_languages_are_rejected(samples):
    """Six languages left out of the samples in turn.  Not among them: Spanish, Portuguese and French, whose rates are below 0.9 (README), and Polish."""
    total = rejected = 0
    for out in ("de", "en", "it", "nl", "ru", "sv"):
        left = samples.lang != out
        model = language.train(list(samples.sample_text[left]), list(samples.lang[left]), epochs=8)
        for t in samples.sample_text[~left]:
            for a, b, _, p in model.passages(language.words_of(language.clean(t))[0]):
                if b - a >= language.MIN_WORDS:
                    total, rejected = total + 1, rejected + (p < language.REJECT)
    assert rejected / total >= 0.9
    model = language.train(list(samples.sample_text), list(samples.lang))
    finnish = "Eilen illalla satoi niin paljon että joki nousi yli äyräiden ja koko kylä joutui lähtemään kodeistaan ennen aamua"
    letters = "xqzv wkjp bvtr zzkq pltx vrrw qmnb xxpt jkwz hgfd qwrt plkm"
    for text in (finnish, letters):
        assert all(p < language.REJECT for a, b, _, p in model.passages(language.words_of(text)[0]) if b - a >= language.MIN_WORDS)


def test_passages_and_labels(spark, samples):
    by = {x: " ".join(samples.sample_text[samples.lang == x][:4]) for x in ("en", "de", "fr")}
    model = language.train(list(samples.sample_text), list(samples.lang))
    given = [
        (1, by["en"], "en"), (2, by["en"], "English"), (3, by["de"], None), (4, by["fr"], "de"), (5, by["en"] + "\n\n> " + by["de"], "en-US"),
        (6, by["en"] + " Bei mir auch.", "en"), (7, None, "en"), (8, "", None), (9, "+1", None), (10, "123 http://a.b", "xx"), (11, by["de"] * 300, "ger"), (3, by["de"], None), (None, by["de"], "en"),
    ]
    docs = spark.createDataFrame([(*g, "p") for g in given], "doc_id long, text string, lang string, passage string")
    got = {tuple(r) for r in language.mislabelled(docs, model).collect()}
    assert got == {(3, "de"), (4, "fr"), (5, "en"), (5, "de")}
    rows = [r for r in language.passages(docs, model).collect() if r["doc_id"] == 5]
    assert [r["lang"] for r in sorted(rows, key=lambda r: r["passage"])] == ["en", "de"] and all(0 <= r["confidence"] <= 1 for r in rows)
    assert language.mislabelled(docs.limit(0), model).count() == 0
    alone = language.train(["one two three four"] * 2, ["xx"] * 2)  # a language of no fixed list is known by its own code
    assert language.mislabelled(spark.createDataFrame([(1, "one two three four " * 4, "XX"), (2, "one two three four " * 4, "en")], "doc_id long, text string, lang string"), alone).collect() == [(2, "xx")]


def test_labels(spark):
    said = ["en", "EN", "en_GB", "eng", "English", "de-AT", "Deutsch", "español", "русский", "und", "??", "unknown", "", None, "-"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "i int, c string")
    from pyspark.sql import functions as F

    got = [r[0] for r in df.orderBy("i").select(language.label_of(F.col("c"))).collect()]
    assert got == ["en"] * 5 + ["de"] * 2 + ["es", "ru"] + [None] * 6


def test_fitted_on_the_table(spark, sf):
    model = language.fitted(spark.read.parquet(f"{sf}/lang_samples.parquet"))
    assert len(model.langs) == 10
    assert llm_queries.p8_passages(spark, sf).where("lang is not null").count() > 50
