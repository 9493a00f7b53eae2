"""Evaluation texts leaking into training text: winnowing, then extension of the hits.

Texts become words (lower case; markup, punctuation, line breaks and quote signs gone).  Every run of K words is
hashed, and of every W successive hashes the smallest is kept: two texts that share W + K - 1 words in a row share a
fingerprint.  Fingerprints of corpus and test items are joined, and for the pairs that meet the common runs of at
least RUN words are chained in order; a pair is a leak if the chain holds SHARE of the item's words.  Fingerprints of
stock sentences count like any other: their pairs fall at a bound on the chain that costs little.

The test items are the small side: blocks of at most HELD bytes of their text are sent to every task, as sorted
fingerprints and hashed words, and each block meets the whole corpus in one pass that reads, cuts, joins and extends.  The
corpus is never shuffled; more or longer items mean more blocks, not another way of working.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import spread
from .words import DIGIT, LETTER, Numbers, codes, joined, kinds, portions, runs, unmarked

K = 4
W = 4
RUN = 3
SHARE = 0.4
HELD = 32_000_000  # bytes of item text held by a task at a time
KEPT = 500_000  # words whose hashes a task remembers


def words(text: str | None) -> list[str]:
    if not isinstance(text, str) or not text:
        return []
    return [w.lower() for w in _cut([unmarked(text)])[0]]


def _cut(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Words of texts without markup, and the text of each; letters and digits in a row are one word."""
    text, begins = joined(texts)
    a, b = runs(((kinds(codes(text)) & (LETTER | DIGIT)) > 0).astype(np.uint8))
    return [text[x:y] for x, y in zip(a.tolist(), b.tolist())], np.searchsorted(begins, a, side="right") - 1


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, given the words' hashes."""
    if len(h) < k:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for i in range(k):
        out = (out ^ h[i : len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.lower())


def hashes(ws: list[str]) -> np.ndarray:
    return np.fromiter(map(_hash, ws), dtype=np.uint64, count=len(ws))


def winnowed(h: np.ndarray, of: np.ndarray, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and the text of each, for texts whose words' hashes follow each other; ``of``: the text of each word.

    A text of at least k words has at least one.
    """
    g = _grams(h, k)
    if not len(g):
        return g, np.empty(0, dtype=np.int64)
    own = of[: len(g)]
    whole = own == of[k - 1 :]  # runs within one text
    g, own = g[whole], own[whole]
    if not len(g):
        return g, own
    begin = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    size = np.diff(np.r_[begin, len(own)])
    marks, texts = [], []
    if len(g) >= w:
        least = np.lib.stride_tricks.sliding_window_view(g, w).min(1)
        inside = own[: len(least)] == own[w - 1 :]
        marks, texts = [least[inside]], [own[: len(least)][inside]]
    short = size < w
    marks.append(np.minimum.reduceat(g, begin)[short])
    texts.append(own[begin][short])
    return np.concatenate(marks), np.concatenate(texts)


def chained(item: np.ndarray, doc: np.ndarray, run: int = RUN) -> tuple[int, int, int]:
    """Words of ``item`` found in ``doc`` in the same order, and the first and last word + 1 of that chain in ``doc``, both
    given as the hashes of their runs of ``run`` words.

    Only words in common runs count: the longest chain of such word pairs that rises in both texts, in O(pairs x log item).
    """
    at: dict[int, list[int]] = {}
    for p, g in enumerate(item.tolist()):
        at.setdefault(g, []).append(p)
    pairs: dict[int, set[int]] = {}
    for q in np.flatnonzero(np.isin(doc, item)).tolist():
        for p in at[int(doc[q])]:
            for i in range(run):
                pairs.setdefault(q + i, set()).add(p + i)
    ends: list[int] = []  # item word at the end of the best chain of each length
    begin: list[int] = []  # where that chain begins in doc
    last = 0
    for q in sorted(pairs):
        for p in sorted(pairs[q], reverse=True):
            k = bisect.bisect_left(ends, p)
            start = begin[k - 1] if k else q
            if k == len(ends):
                ends.append(p)
                begin.append(start)
                last = q + 1
            elif p < ends[k]:
                ends[k], begin[k] = p, start
    return len(ends), begin[-1] if begin else 0, last


def within_reach(item: np.ndarray, doc: np.ndarray, run: int = RUN) -> int:
    """Words of an item in common runs of at least ``run`` words, in any order, from the runs of both: ``chained`` gives no more."""
    hit = np.isin(item, doc)
    return int(np.convolve(hit, np.ones(run, dtype=int)).astype(bool).sum()) if len(hit) else 0


class Index:
    """A block of items: sorted fingerprints with the items that hold each, and every item's hashed runs."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = np.array(ids, dtype=np.int64)
        own = [hashes(words(t)) for t in texts]
        self.sizes = np.array([len(h) for h in own])
        self.runs = [_grams(h, RUN) for h in own]
        h, of = np.concatenate([*own, np.empty(0, np.uint64)]), np.repeat(np.arange(len(own)), self.sizes)
        mark, item = winnowed(h, of)
        pairs = np.unique(np.stack([mark, item.astype(np.uint64)], axis=1), axis=0) if len(mark) else np.empty((0, 2), np.uint64)
        self.marks, start = np.unique(pairs[:, 0], return_index=True)
        self.items, self.start = pairs[:, 1].astype(np.int64), np.r_[start, len(pairs)]

    def candidates(self, marks: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Distinct (text, item) that share a fingerprint, in order of the texts."""
        if not len(self.marks):
            return np.empty((0, 2), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.marks, marks), len(self.marks) - 1)
        hit = self.marks[at] == marks
        met = np.unique(np.stack([of[hit], at[hit]], axis=1), axis=0)
        n = self.start[met[:, 1] + 1] - self.start[met[:, 1]]
        item = self.items[np.repeat(self.start[met[:, 1]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        return np.unique(np.stack([np.repeat(met[:, 0], n), item], axis=1), axis=0)


def blocks(items: DataFrame, held: int = HELD) -> Iterator[Index]:
    """The items in blocks of at most ``held`` bytes of text, or one longer item alone; the driver holds one at a time."""
    ids, texts, size = [], [], 0
    for r in items.where("item_id is not null and item_text <> ''").select("item_id", "item_text").distinct().orderBy("item_id", "item_text").toLocalIterator():
        n = len(r[1].encode("utf-8", "surrogatepass"))
        if ids and size + n > held:
            yield Index(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(r[0])
        texts.append(r[1])
        size += n
    if ids:
        yield Index(ids, texts)


def leaks(docs: DataFrame, items: DataFrame, share: float = SHARE, held: int = HELD) -> DataFrame:
    """(doc_id, item_id, n_matched, n_item_words, first_word, last_word) of every post that contains ``share`` of an item.

    Null, empty or short texts (under K words) and null ids match nothing; a repeated post is a case of its own, of an item_id
    with several texts the best matched one counts; very long texts are read whole; extra columns are ignored; empty tables
    give no row.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, n_matched int, n_item_words int, first_word int, last_word int"
    texts = spread(docs.where("doc_id is not null and text <> ''").select("doc_id", "text"), "doc_id")

    def found(index) -> DataFrame:
        def run(batches):
            own: Index = index.value
            known: list[int] = []
            numbers = Numbers(lambda w: known.append(_hash(w)))
            for pdf in batches:
                ids, cells = pdf["doc_id"].to_numpy(), [unmarked(t) for t in pdf["text"]]
                for x, y in portions(cells):
                    ws, of = _cut(cells[x:y])
                    at = numbers.of(ws)
                    h = np.array(known, dtype=np.uint64)[at] if len(at) else np.empty(0, dtype=np.uint64)
                    yield pd.DataFrame(_extended(own, h, of, ids[x:y], share), columns=["doc_id", "item_id", "n_matched", "n_item_words", "first_word", "last_word"])
                    if len(known) > KEPT:
                        numbers.clear()
                        known.clear()

        return texts.mapInPandas(run, schema)

    out = None
    for block in blocks(items, held):
        part = found(spark.sparkContext.broadcast(block))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], schema)
    return out


def _extended(own: Index, h: np.ndarray, of: np.ndarray, ids: np.ndarray, share: float) -> list[tuple]:
    """Rows of the posts of a portion whose candidates stand the test."""
    rows: dict[tuple, tuple] = {}
    last, doc = -1, None
    for d, j in own.candidates(*winnowed(h, of)).tolist():
        if d != last:
            last, doc = d, _grams(h[np.searchsorted(of, d) : np.searchsorted(of, d, side="right")], RUN)
        size = int(own.sizes[j])
        if within_reach(own.runs[j], doc) < share * size:
            continue
        n, a, b = chained(own.runs[j], doc)
        key = d, int(own.ids[j])
        if n >= share * size and n > rows.get(key, (0,) * 6)[2]:
            rows[key] = (ids[d], own.ids[j], n, size, a, b)
    return list(rows.values())
