"""One postal address written differently: MinHash banding, then affine-gap alignment of the words.

1. Cells are taken apart into house number, unit, street words, direction, type, city and zip (``address_parts``); rows
   with equal parts collapse into one record, and records with equal number and street words into one street spelling.
2. Street spellings are shingled into words and q-grams; MinHash signatures are cut into bands, and spellings of one
   house number that share a band, or a key of a short name (``short_keys``), are candidates.  Since a candidate is a pair of spellings, not of rows, many
   residents, units or repeated rows of one building make no pairs here.
3. Candidates are verified by affine-gap alignment of their words, where a substitution costs little between an
   abbreviation or a typo and its word, and a gap costs little once it is open.
4. Linked spellings are consolidated (``components``) into houses.  Within each, towns that are fully stated are linked by
   equality joins on keys (one zip and like cities, one city and zips one edit apart) and consolidated; a town that lacks city or zip is
   the only one that it fits, or stays apart.
5. Within a house of one town a missing direction, type or unit is the only one that is known there; where there are
   several, the record is in doubt and unites with nobody but those that say the same.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import shuffled, small, spread, written
from .address_parts import ORDINALS, STREET_WORDS, TYPES, parsed
from .components import components
from .name_parts import edits
from .names import same_group_pairs
from .words import Numbers

BANDS = 32
CITY_BANDS = 12
ROWS = 2
Q = 3
SHORT = 8  # words up to this length also meet by one edit
ZIPS = 200_000  # zips up to this number are broadcast
CITY_KEYS = 200_000  # keys of cities up to this number are broadcast
MOST_COST = 0.3  # cost per word up to which two spellings are one street
CELLS = ["residential_address", "city", "zip_code"]

_rng = np.random.default_rng(11)
_MUL = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_SHORT = {short: name for table in (TYPES, STREET_WORDS) for name, forms in table.items() for short in forms}


def shingles(street: str) -> set[str]:
    """The words of a street name, and the q-grams of its letters run together."""
    words = street.split()
    run = f"^{''.join(words)}$"
    return {f"w{w}" for w in words} | {run[i : i + Q] for i in range(max(1, len(run) - Q + 1))}


@lru_cache(100_000)
def _word_keys(w: str) -> frozenset:
    """Of one word: itself in full, its first letters, and, if short, itself with one letter left out."""
    keys = {f"s{_SHORT.get(w, w)}"} | ({f"p{w[:3]}"} if len(w) >= 3 else set())
    return frozenset(_hash(k) for k in keys | (_without_one(w) if len(w) <= SHORT else set()))


def _run_keys(run: str) -> set[int]:
    return {_hash(k) for k in {f"s{_SHORT.get(run, run)}"} | (_without_one(run) if len(run) <= SHORT + 4 else set())}


def _without_one(w: str) -> set[str]:
    return {f"d{w}"} | {f"d{w[:i]}{w[i + 1 :]}" for i in range(len(w))}


def _hash(key: str) -> int:
    return xxhash.xxh64_intdigest(key, seed=BANDS)


def short_keys(street: str) -> set[int]:
    """What spellings of one street share where 3-grams tell little: a word, or all words run together, is known by its full
    form, a word by its first letters, and both, if short, by themselves with one letter left out (one edit or swap apart share one of these)."""
    words = street.split()
    return _run_keys("".join(words)).union(*map(_word_keys, words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Banding:
    """Keys of which two candidates of one group share one: MinHash bands of many spellings at once, and short keys."""

    def __init__(self):
        self.known: list[int] = []
        self.numbers = Numbers(lambda s: self.known.append(xxhash.xxh64_intdigest(s)))

    def bands(self, spellings: list[str]) -> np.ndarray:
        """One hash per spelling and band of its MinHash signature."""
        if len(self.known) > 200_000:
            self.known.clear()
            self.numbers.clear()
        each = [shingles(x) for x in spellings]
        at = self.numbers.of(list(chain.from_iterable(each)))
        h = np.array(self.known, dtype=np.uint64)[at]
        n = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
        x = h[:, None] * _MUL + _ADD
        sig = np.minimum.reduceat(x ^ (x >> np.uint64(31)), np.cumsum(n) - n).reshape(len(each), BANDS, ROWS)
        out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(each), BANDS))
        for r in range(ROWS):
            out = _mixed(out ^ sig[:, :, r])
        return out

    def keys(self, groups: list[str], spellings: list[str], most: int = 1000) -> tuple[np.ndarray, np.ndarray]:
        """The place of a spelling in the list and one of its keys within its group, for all its keys."""
        places, keys = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.uint64)]
        for a in range(0, len(spellings), most):
            own = spellings[a : a + most]
            group = np.array([xxhash.xxh64_intdigest(g, seed=1) for g in groups[a : a + most]], dtype=np.uint64)
            short = [short_keys(x) for x in own]
            n = np.fromiter(map(len, short), dtype=np.int64, count=len(short))
            at = np.repeat(np.arange(len(own)), n)
            flat = np.fromiter(chain.from_iterable(short), dtype=np.uint64, count=n.sum())
            places += [np.repeat(np.arange(a, a + len(own)), BANDS), a + at]
            keys += [_mixed(self.bands(own) ^ group[:, None]).ravel(), _mixed(flat ^ group[at])]
        return np.concatenate(places), np.concatenate(keys).view(np.int64)


@lru_cache(200_000)
def word_cost(a: str, b: str) -> float:
    """0 for equal words, little for an abbreviation or a typo, 1 for different ones."""
    if a == b:
        return 0.0
    if _SHORT.get(a, a) == _SHORT.get(b, b):
        return 0.05
    if a in ORDINALS and b in ORDINALS or a.isdigit() or b.isdigit():
        return 1.0
    n = min(len(a), len(b))
    if n >= 3 and (a.startswith(b) or b.startswith(a)):
        return 0.25
    k = 1 if n < 8 else 2 if n < 12 else 3
    d = edits(a, b, k) if max(len(a), len(b)) >= 4 and n >= 3 else k + 1
    return 0.3 * d / k if d <= k else 1.0


def alignment(a: tuple[str, ...], b: tuple[str, ...], start: float = 0.5, more: float = 0.25) -> float:
    """Least cost of aligning two word sequences with affine gaps (Gotoh's three tables)."""
    inf = float("inf")
    n, m = len(a), len(b)
    best = [[inf] * (m + 1) for _ in range(n + 1)]
    up = [[inf] * (m + 1) for _ in range(n + 1)]
    left = [[inf] * (m + 1) for _ in range(n + 1)]
    best[0][0] = 0.0
    for i in range(n + 1):
        for j in range(m + 1):
            if i:
                up[i][j] = min(best[i - 1][j] + start, up[i - 1][j] + more)
            if j:
                left[i][j] = min(best[i][j - 1] + start, left[i][j - 1] + more)
            if i or j:
                step = best[i - 1][j - 1] + word_cost(a[i - 1], b[j - 1]) if i and j else inf
                best[i][j] = min(step, up[i][j], left[i][j])
    return best[n][m]


def same_street(a: str, b: str) -> bool:
    """Whether two spellings name one street: aligned as they stand, or with the words run together."""
    x, y = tuple(a.split()), tuple(b.split())
    if alignment(x, y) <= MOST_COST * min(max(len(x), len(y)), 2):
        return True
    return len(x) + len(y) > 2 and word_cost("".join(x), "".join(y)) <= MOST_COST / 2


@lru_cache(200_000)
def same_city(a: str, b: str) -> bool:
    x, y = a.split(), b.split()
    if sorted(x) == sorted(y) or word_cost("".join(x), "".join(y)) <= MOST_COST:
        return True
    return len(x) == len(y) and alignment(tuple(x), tuple(y)) <= MOST_COST * len(x) / 2


@lru_cache(200_000)
def like_city(a: str, b: str) -> bool:
    """A weaker test for cities of one zip: some longer word in common, typos aside."""
    return same_city(a, b) or any(word_cost(x, y) <= MOST_COST for x in a.split() for y in b.split() if min(len(x), len(y)) > 3)


@lru_cache(200_000)
def same_zip(a: str, b: str) -> bool:
    return a == b or edits(a, b, 1) <= 1


PARTS = ("city", "zip", "direction", "type", "unit")


def _met(spelled: DataFrame, group: str, text: str, own: str) -> DataFrame:
    """(a, b), a < b: ids ``own`` of spellings that share a key within their ``group``."""

    def run(batches):
        banding = Banding()
        for pdf in batches:
            at, key = banding.keys(list(pdf[group]), list(pdf[text]))
            yield pd.DataFrame({"id": pdf[own].to_numpy()[at], "key": key})

    keyed = spread(spelled.select(own, group, text), own).mapInPandas(run, "id long, key long")
    return keyed.select("key", F.col("id").alias("a")).join(shuffled(keyed.select("key", F.col("id").alias("b"))), "key").where("a < b").select("a", "b").distinct()


def _verified(met: DataFrame, spelled: DataFrame, text: str, own: str, test) -> DataFrame:
    """The pairs of :func:`_met` whose texts stand the ``test``."""

    def run(batches):
        for pdf in batches:
            keep = [test(x, y) for x, y in zip(pdf["x"], pdf["y"])]
            yield pdf[["a", "b"]][pd.Series(keep, index=pdf.index, dtype=bool)]

    side = lambda x, t: shuffled(spelled.select(F.col(own).alias(x), F.col(text).alias(t)))
    both = met.join(side("a", "x"), "a").join(side("b", "y"), "b")
    return both.mapInPandas(run, "a long, b long")


def _city_keys(towns: DataFrame) -> DataFrame:
    """(city, key): keys of which cities that are alike share one, each distinct city's once."""

    def run(batches):
        banding = Banding()
        for pdf in batches:
            cities = list(pdf["city"])
            some = banding.bands(cities)[:, :CITY_BANDS].astype(np.uint64).view(np.int64).tolist() if cities else []
            got = [{*b, *(k - (1 << 63) for k in short_keys(c) | _run_keys("".join(sorted(c.split()))))} for b, c in zip(some, cities)]
            yield pd.DataFrame({"city": pdf["city"].repeat([len(g) for g in got]).to_numpy(), "key": np.array([k for g in got for k in g], dtype=np.int64)})

    return towns.where("city <> ''").select("city").distinct().mapInPandas(run, "city string, key long")


def _tested(met: DataFrame, test) -> DataFrame:
    """(a, b) of the pairs (a, b, ca, za, cb, zb) whose towns stand the ``test``."""

    def run(batches):
        for pdf in batches:
            keep = [test(*row) for row in zip(pdf["ca"], pdf["za"], pdf["cb"], pdf["zb"])]
            yield pdf[["a", "b"]][pd.Series(keep, index=pdf.index, dtype=bool)]

    return met.mapInPandas(run, "a long, b long")


def _several(towns: DataFrame, *keys: str) -> DataFrame:
    return towns.join(shuffled(towns.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")), list(keys), "left_semi")


def town_classes(towns: DataFrame) -> DataFrame:
    """(house, city, zip, town) for distinct (house, city, zip) with an id t: the same ``town`` for what is one town of a house.

    Fully stated towns are one if they have one zip and like cities, or the same city, typos aside, and zips one edit apart, also
    through others.  One without zip is the only one whose city it has, typos and abbreviations aside; one without city the
    only one of its zip.  With several to choose from it stays apart; without any it meets only others without zip.
    Only towns of one house that share a key meet (of the city, or the zip less one sign), so a house in many towns makes few pairs.
    """
    keys = small(written(_city_keys(towns), "city-keys"), CITY_KEYS)
    full, bare, coded = towns.where("city <> '' and zip <> ''"), towns.where("city <> '' and zip = ''"), towns.where("city = '' and zip <> ''")
    side = lambda df, x, *on: df.select(*on, F.col("t").alias(x), F.col("city").alias("c" + x), F.col("zip").alias("z" + x))
    pairs = lambda df, *on: side(df, "a", *on).join(shuffled(side(df, "b", *on)), list(on)).where("a < b").select("a", "b", "ca", "za", "cb", "zb").distinct()
    in_zip = pairs(_several(full, "house", "zip").join(keys, "city"), "house", "zip", "key")
    less = F.transform(F.sequence(F.lit(1), F.length("zip")), lambda i: F.concat(F.expr("zip").substr(F.lit(1), i - 1), F.expr("zip").substr(i + 1, F.lit(99))))
    near_zip = pairs(_several(full, "house").withColumn("k", F.explode(F.array_union(F.array("zip"), less))), "house", "k").where("za <> zb")
    of_bare = bare.select("house").distinct()
    asked = side(bare.join(keys, "city"), "a", "house", "key")
    held = side(towns.where("city <> ''").join(shuffled(of_bare), "house", "left_semi").join(keys, "city"), "b", "house", "key")
    named = asked.join(shuffled(held), ["house", "key"]).where("a <> b").select("a", "b", "ca", "za", "cb", "zb").distinct()
    has_zip = shuffled(towns.select(F.col("t").alias("b"), (F.col("zip") != "").alias("full")))
    named = written(_tested(named, lambda ca, za, cb, zb: same_city(ca, cb)).join(has_zip, "b"), "named-towns")
    known = named.where("full").select(F.col("a").alias("p"), F.col("b").alias("t"))
    tied = known.select(F.col("p").alias("t")).distinct()
    apart = named.where("not full and a < b").select("a", "b")
    for x in ("a", "b"):
        apart = apart.join(shuffled(tied.withColumnRenamed("t", x)), x, "left_anti")
    one = _tested(in_zip, lambda ca, za, cb, zb: like_city(ca, cb)).unionByName(_tested(near_zip, lambda ca, za, cb, zb: same_zip(za, zb) and same_city(ca, cb)))
    classes = components(one.unionByName(apart.select("a", "b")), "a", "b").select(F.col("rec_id").alias("t"), "group_id")
    own = written(towns.join(shuffled(classes), "t", "left").select("house", "city", "zip", "t", F.coalesce("group_id", "t").alias("town")), "town-classes")
    zoned = coded.select("house", "zip", F.col("t").alias("p")).join(shuffled(own.where("city <> '' and zip <> ''").select("house", "zip", "t")), ["house", "zip"]).select("p", "t")
    only = known.unionByName(zoned).join(shuffled(own.select("t", "town")), "t").groupBy("p").agg(F.min("town").alias("lo"), F.max("town").alias("hi")).where("lo = hi")
    return own.join(shuffled(only.select(F.col("p").alias("t"), "lo")), "t", "left").select("house", "city", "zip", F.coalesce("lo", "town").alias("town"))


def _filled(kinds: DataFrame, part: str, beside: str) -> DataFrame:
    """``kinds`` with a blank ``part`` made the only value that is known in the town for records whose ``beside`` is the same
    or blank on one side."""
    said, town, like = F.nullif(F.col(part), F.lit("")), Window.partitionBy("town"), Window.partitionBy("town", beside)
    free = F.when(F.col(beside) == "", said)
    out = kinds.withColumns({"_al": F.min(said).over(town), "_ah": F.max(said).over(town), "_fl": F.min(free).over(town), "_fh": F.max(free).over(town)})
    out = out.withColumns({"_ll": F.min(said).over(like), "_lh": F.max(said).over(like)})
    lo = F.when(F.col(beside) == "", F.col("_al")).otherwise(F.least("_ll", "_fl"))
    hi = F.when(F.col(beside) == "", F.col("_ah")).otherwise(F.greatest("_lh", "_fh"))
    return out.withColumn(part, F.when((F.col(part) == "") & (lo == hi), lo).otherwise(F.col(part))).drop("_al", "_ah", "_fl", "_fh", "_ll", "_lh")


def same_places(rows: DataFrame) -> DataFrame:
    """(rec_id, place_id) of every row that names a place; place_id is the smallest rec_id of the location's records."""

    def read(batches):
        for pdf in batches:
            out = []
            for i, *cells in zip(pdf["rec_id"], *(pdf[c] for c in CELLS)):
                p = parsed(*cells)
                if p:
                    out.append((i, p.number, " ".join(p.street), " ".join(p.city), p.zip, p.direction, p.type, p.unit))
            yield pd.DataFrame(out, columns=["rec_id", "number", "street", *PARTS])

    schema = "rec_id long, number string, street string, " + ", ".join(f"{c} string" for c in PARTS)
    cells = written(spread(rows.where(F.col("rec_id").isNotNull()).select("rec_id", *CELLS), "rec_id").mapInPandas(read, schema), "cells")
    told = cells.where("city <> '' and zip <> ''").groupBy("zip", "city").agg(F.count(F.lit(1)).alias("n"))
    of_zip = told.groupBy("zip").agg(F.max_by("city", F.struct("n", "city")).alias("town"), (F.max("n") * 2 > F.sum("n")).alias("most"))
    majority = small(of_zip.where("most").select(F.col("zip").alias("z"), F.col("town").alias("usual")), ZIPS)
    # a missing city is the one that most rows of the zip state
    cells = cells.join(majority, F.col("zip") == F.col("z"), "left").withColumn("city", F.when(F.col("city") == "", F.coalesce("usual", F.lit(""))).otherwise(F.col("city"))).drop("z", "usual")
    spelled = written(cells.groupBy("number", "street").agg(F.min("rec_id").alias("s")), "spellings")
    links = written(_verified(_met(spelled, "number", "street", "s"), spelled, "street", "s", same_street), "streets")
    street = components(links, "a", "b").select(F.col("rec_id").alias("s"), "group_id")
    houses = spelled.join(shuffled(street), "s", "left").select("number", "street", F.coalesce("group_id", "s").alias("house"))
    housed = written(cells.join(shuffled(houses), ["number", "street"]).select("rec_id", "house", *PARTS), "housed")
    # from here on distinct kinds of records only, so a house with many rows is not a large group
    kinds = written(housed.groupBy("house", *PARTS).agg(F.min("rec_id").alias("rec")), "kinds")
    towns = town_classes(written(kinds.groupBy("house", "city", "zip").agg(F.min("rec").alias("t")), "towns"))
    told = kinds.join(shuffled(towns), ["house", "city", "zip"]).select("rec", "town", "direction", "type", "unit")
    told = _filled(_filled(told, "direction", "type"), "type", "direction")
    building, unit = Window.partitionBy("town", "direction", "type"), F.nullif(F.col("unit"), F.lit(""))
    told = told.withColumns({"_lo": F.min(unit).over(building), "_hi": F.max(unit).over(building)})
    told = told.withColumn("unit", F.when((F.col("unit") == "") & (F.col("_lo") == F.col("_hi")), F.col("_lo")).otherwise(F.col("unit")))
    told = told.select("rec", F.min("rec").over(Window.partitionBy("town", "direction", "type", "unit")).alias("place_id"))
    placed = written(kinds.join(shuffled(told), "rec").drop("rec"), "placed")
    return housed.join(shuffled(placed), ["house", *PARTS]).select("rec_id", "place_id")


def variant_addresses(rows: DataFrame) -> DataFrame:
    """(rec_a, rec_b), rec_a < rec_b: rows of one location whose address, city and zip are not all written alike.

    Null is ''; cells that name no house number and street, and null ids, are no case; repeated rows pair with every other spelling; very
    long cells are read whole; empty tables give no row; other columns are ignored.
    """
    named = same_places(rows).join(shuffled(rows.select("rec_id", *CELLS)), "rec_id")
    return same_group_pairs(named, "place_id", CELLS)
