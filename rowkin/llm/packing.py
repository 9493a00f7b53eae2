"""Fixed-capacity containers filled by bulk-synchronous best fit.

Documents are measured in tokens of a public tokenizer; one that alone exceeds the capacity is cut at multiples of it.
The pieces are range-sorted by size and written once, so that file offsets and parquet's row index give every piece
its exact rank among those of its size.

Rounds: the remaining documents, largest first, are swept along the sorted gaps; each finds its successor (the
smallest gap that is large enough), documents of one size that want the same gaps are resolved by rank, every gap
takes one document a round, then gaps are updated.  When no gap fits what is left, as many containers open as the rest
must have.  A sweep meets equal sizes and equal gaps as runs, and there are at most ``capacity`` different ones, so
the state of the sweep is bounded by the capacity, not by the corpus: runs of (size, ranks) are matched with runs of
(gap, container numbers).  Which documents they are is decided where the documents are: each looks up its (size,
rank) in the runs, without another shuffle.
"""

from __future__ import annotations

import bisect
import importlib.util
import os
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import dropped, spread, written

CAPACITY = 2048
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def encoder(folder: str = TOKENIZERS, name: str = VOCABULARY):
    """The public tokenizer of a vocabulary file; its split pattern comes from the folder's own module."""
    import base64

    import tiktoken

    spec = importlib.util.spec_from_file_location("_public_tokenizers", os.path.join(folder, "__init__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    with open(os.path.join(folder, name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=module.PATTERN, mergeable_ranks=ranks, special_tokens={})


_encoder: dict[tuple[str, str], object] = {}


def token_counts(docs: DataFrame, folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens); null and empty texts have 0."""

    def run(batches):
        if (folder, name) not in _encoder:
            _encoder[folder, name] = encoder(folder, name)
        encode = _encoder[folder, name].encode_ordinary
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": [len(encode(t)) if isinstance(t, str) and t else 0 for t in pdf["text"]]})

    return spread(docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text"), "doc_id").mapInPandas(run, "doc_id long, n_tokens long")


def sweep(sizes: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Rows (size, first rank, count, first container) of the best-fit rounds, and the number of containers.

    Ranks first .. first + count - 1 of a size go to containers first container, + 1, ...
    """
    left = {s: n for s, n in sizes.items() if s > 0 and n > 0}
    rank = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs of containers (first, count)
    moves, containers = [], 0
    while left:
        if not gaps or max(gaps) < min(left):
            n = -(-sum(s * n for s, n in left.items()) // capacity)
            gaps[capacity].append((containers, n))
            containers += n
        free, after = sorted(gaps), defaultdict(list)
        for s in sorted(left, reverse=True):
            while left[s]:
                k = bisect.bisect_left(free, s)
                if k == len(free):
                    break
                g = free[k]
                while gaps[g] and left[s]:
                    first, n = gaps[g].pop()
                    m = min(n, left[s])
                    moves.append((s, rank[s], m, first))
                    if m < n:
                        gaps[g].append((first + m, n - m))
                    if g > s:
                        after[g - s].append((first, m))
                    rank[s] += m
                    left[s] -= m
                if not gaps[g]:
                    del gaps[g], free[k]
            if not left[s]:
                del left[s]
        for g, runs in after.items():
            gaps[g] += runs
    return np.array(moves, dtype=np.int64).reshape(-1, 4), containers


def packed(docs: DataFrame, capacity: int = CAPACITY, folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, first_token, n_tokens, container_id): where each post, or piece of one longer than ``capacity``, goes.

    Null and empty texts have no tokens: they take no space and are spread over the containers by rank.  Repeated rows
    are packed each; ties of size go by doc_id; a null doc_id or an empty table gives no row; other columns are ignored.
    """
    spark = docs.sparkSession
    counts = written(token_counts(docs, folder, name), "tokens")  # else the sample for the ranges counts a second time
    pieces = counts.select(
        "doc_id",
        F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / capacity) - 1).cast("int"))).alias("piece"),
        "n_tokens",
    )
    pieces = pieces.select(
        "doc_id", "piece", (F.col("piece").cast("long") * capacity).alias("first_token"),
        F.least(F.lit(capacity), F.col("n_tokens") - F.col("piece").cast("long") * capacity).alias("n_tokens"),
    )
    order = [F.desc("n_tokens"), "doc_id", "piece"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = written(pieces.repartitionByRange(parts, *order).sortWithinPartitions(*order), "pieces")
    dropped(counts)
    sizes = {r[0]: r[1] for r in kept.groupBy("n_tokens").count().collect()}  # at most capacity + 1 rows
    moves, containers = sweep(sizes, capacity)
    containers = max(containers, 1)
    start, seen = {}, 0
    for s in sorted(sizes, reverse=True):
        start[s], seen = seen, seen + sizes[s]
    first = np.zeros(capacity + 1, dtype=np.int64)
    first[list(start)] = list(start.values())
    moves = moves[np.lexsort((moves[:, 1], moves[:, 0]))]
    step = max(sizes.values(), default=0) + 1
    keys = moves[:, 0] * step + moves[:, 1]

    placed = kept.select("*", F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int").alias("file"), F.col("_metadata.row_index").alias("at"))
    files = placed.groupBy("file").agg(F.count(F.lit(1)).alias("n"))  # one row per file
    before = files.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))

    def run(batches):
        for pdf in batches:
            size = pdf["n_tokens"].to_numpy()
            rank = pdf["before"].to_numpy() + pdf["at"].to_numpy() - first[size]
            box = rank % containers
            if len(keys):
                k = np.maximum(np.searchsorted(keys, size * step + rank, side="right") - 1, 0)
                box = np.where(size > 0, moves[k, 3] + rank - moves[k, 1], box)
            yield pdf[["doc_id", "piece", "first_token", "n_tokens"]].assign(container_id=box)

    schema = "doc_id long, piece int, first_token long, n_tokens long, container_id long"
    return placed.join(F.broadcast(before), "file").drop("file").mapInPandas(run, schema)
