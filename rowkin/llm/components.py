"""Pairwise links consolidated into groups: deterministic Borůvka hooking.

Each round every component selects its smallest outgoing edge, the resulting trees are collapsed by pointer
doubling, and the edges are relabelled and deduplicated, until no edge is left.  Components at least halve per
round.  Edges are ordered by (smaller label, larger label); a component's smallest edge therefore leads to its
smallest neighbour, two components that select each other form the only cycles, and the smaller becomes the root.  The
smallest id of a whole group is selected back by its own choice in every round, so it always stays a root: the final
label is the group's smallest id.

Every round's tables are written to the shared folder, so lineage stays short and a lost executor costs one round
at most.  Labels that many rows point to are found before each join and meet their rows in a broadcast join (fewer than 1,000
labels, a proven bound).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import dropped, heavy_keys, lookup, written


def _edges(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct()


def _side(parents: DataFrame) -> DataFrame:
    return parents.select(F.col("v").alias("v2"), F.col("p").alias("p2"))


def _roots(edges: DataFrame) -> DataFrame:
    """(v, p): each component with the root of its tree."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("lo").alias("v"), F.col("hi").alias("n")), F.struct(F.col("hi").alias("v"), F.col("lo").alias("n")))).alias("e"))
    parent = written(ends.select("e.v", "e.n").groupBy("v").agg(F.min("n").alias("p")), "pick")
    total = parent.count()
    moved, first = True, True
    while moved:
        far = lookup(parent, "p", _side(parent), "v2", heavy=heavy_keys(parent, "p", total))
        if first:  # of two that select each other the smaller becomes the root
            to = F.when((F.col("p2") == F.col("v")) & (F.col("v") < F.col("p")), F.col("v")).otherwise(F.col("p"))
        else:
            to = F.col("p2")
        new = written(far.select("v", to.alias("p"), (to != F.col("p")).alias("moved")), "parent")
        moved = first or not new.where("moved").isEmpty()
        dropped(parent)
        parent, first = new, False
    return parent.select("v", "p")


def components(pairs: DataFrame, a: str = "rec_a", b: str = "rec_b") -> DataFrame:
    """(rec_id, group_id): every id linked with at least one other, and the smallest id of all it is linked with.

    Null ids, repeated and turned pairs and pairs of an id with itself add nothing; no pairs, no rows.
    """
    edges = written(_edges(pairs, a, b), "edges")
    maps: list[DataFrame] = []
    while total := edges.count():
        roots = _roots(edges)
        maps.append(roots)
        half = lookup(edges, "lo", _side(roots), "v2", "inner", heavy_keys(edges, "lo", total)).select(F.col("p2").alias("p1"), "hi")
        full = lookup(half, "hi", _side(roots), "v2", "inner", heavy_keys(edges, "hi", total))
        new = written(_edges(full, "p1", "p2"), "edges")
        dropped(edges)
        edges = new
    if not maps:
        return edges.select(F.col("lo").alias("rec_id"), F.col("hi").alias("group_id"))
    # later rounds know only roots of earlier ones: compose from the last, smallest map back to the first
    out = maps[-1]
    for earlier in reversed(maps[:-1]):
        heavy = heavy_keys(earlier, "p", earlier.count())
        out = lookup(earlier, "p", _side(out), "v2", heavy=heavy).select("v", F.coalesce("p2", "p").alias("p"))
    return out.select(F.col("v").alias("rec_id"), F.col("p").alias("group_id"))


# What a verdict of a match reads as, letters only and lower case.
MATCHES = ("match", "matched", "matches", "ismatch", "samematch", "matching")


def matching(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs whose verdict says match in any notation and both of whose records exist."""
    said = F.regexp_replace(F.lower(F.col("verdict")), r"[^\p{L}]", "")
    out = pairs.where(said.isin(*MATCHES) & (F.col("rec_a") != F.col("rec_b"))).select("rec_a", "rec_b")
    known = records.select(F.col("rec_id").alias("_known"))
    total = out.count()
    for side in ("rec_a", "rec_b"):
        out = lookup(out, side, known, "_known", "left_semi", heavy_keys(out, side, total))
    return out
