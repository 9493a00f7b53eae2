"""Trie join, name variants and addresses."""

import random

import numpy as np
import pytest

from rowkin.llm import address_parts, name_parts, names, places
from rowkin.llm.trie_join import Trie, asked_in, held_in


def words(seed, n):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 10))) for _ in range(n)})


def brute(ws):
    k = name_parts.reach
    return {(a, b) for a in ws for b in ws if name_parts.edits(a, b, k(min(len(a), len(b)))) <= k(min(len(a), len(b)))}


def test_forest_equals_brute_force():
    ws, k = words(1, 300), name_parts.reach
    lens = np.array([len(w) for w in ws])
    shard = np.sort(lens) - 1
    held = sorted(ws, key=lambda w: (len(w), w))
    trie, got = Trie(held, shard), set()
    for m in range(1, 11):  # every word asks the tree of every length
        for q, w, d in trie.near(ws, np.full(len(ws), m - 1), k, batch=64):
            got |= {(ws[a], held[b]) for a, b in zip(q, w)}
    assert got == {(a, b) for a in ws for b in ws if name_parts.edits(a, b, k(len(a))) <= k(len(a))}
    none = np.empty(0, dtype=np.int64)
    assert not list(Trie(["abc"], np.array([0])).near([], none, k))


def edited(rng, w):
    i, kind = rng.randrange(len(w)), rng.randrange(4)
    if kind == 3:
        return w[:i] + w[i + 1 : i + 2] + w[i : i + 1] + w[i + 2 :]
    return w[:i] + ("" if kind == 0 else rng.choice("abcdefgh")) + w[i + (kind < 2) :]


def test_neighbours_share_a_shard():
    rng = random.Random(3)
    for _ in range(20_000):
        a = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 13)))
        b = edited(rng, a)
        b = edited(rng, b) if len(b) > 8 and len(a) > 7 else b
        a, b = sorted((a, b), key=len)
        k = name_parts.reach(len(a))
        if k and name_parts.edits(a, b, k) <= k:
            assert asked_in(a, name_parts.reach) & held_in(b, name_parts.reach), (a, b)


def test_sharded_join_equals_brute_force(spark):
    ws = words(2, 250)
    got = names.neighbours(spark.createDataFrame([(w,) for w in ws], "word string"), most=30)
    assert {(r[0], r[1]) for r in got.collect()} == brute(ws)
    assert names.neighbours(spark.createDataFrame([], "word string")).count() == 0


@pytest.mark.parametrize(
    "cells,want",
    [
        (("Noor", "J.", "Ruskström", ""), (("noor",), ("j",), ("ruskstrom",), "")),
        (("Jornins, Jürgen M.", None, None, None), (("jurgen",), ("m",), ("jornins",), "")),
        (("Dr. Ann", "N/A", "PE11SKY, PhD", "snr."), (("ann",), (), ("pellsky",), "sr")),
        (("[Unknown]", "-", "X", ""), ((), (), (), "")),
        ((None, None, None, None), ((), (), (), "")),
    ],
)
def test_names_apart(cells, want):
    assert tuple(name_parts.parsed(*cells)) == want


SCHEMA = "rec_id long, " + ", ".join(f"{c} string" for c in ("full_date_of_birth", *names.CELLS)) + ", rec string, value string"


def rows(spark, *given):
    out = [{c: None for c in ("full_date_of_birth", *names.CELLS, "rec", "value")} | {"rec_id": i} | g for i, g in enumerate(given, 1)]
    return spark.createDataFrame(out, SCHEMA)


def test_names_in_any_order():
    m = name_parts.Matcher([])
    name = lambda *parts: name_parts.Name(*[tuple(x.split()) for x in parts], "")
    assert m.names(name("anna", "maria", "lopez"), name("lopez", "anna", "maria")) == (3, 3)
    assert m.names(name("anna", "maria", "lopez"), name("maria", "lopes", "anna")) == (2, 2)
    assert min(m.names(name("anna", "maria", "lopez"), name("lopez", "clara", "maria"))) < 2
    assert min(m.names(name("anna", "", "lopez"), name("clara", "", "lopez"))) < 2


def test_variants(spark):
    forms = spark.createDataFrame([("William", "Bill"), ("William", "Will"), (None, "x")], "given_name string, short_form string")
    dob, mail = {"full_date_of_birth": "01/02/1980"}, {"email_address_personal": "a@b.c"}
    got = names.variant_pairs(
        rows(
            spark,
            {"first_name": "William", "last_name": "Osterley"} | dob,  # 1
            {"first_name": "Bill", "last_name": "OSTERLYE"} | dob | mail,  # 2: short form and typo
            {"first_name": "Osterley, W.", "email_address_personal": "A@B.C"},  # 3: turned round, initial
            {"first_name": "William", "last_name": "Osterley", "full_date_of_birth": "03/04/1990"},  # 4: namesake
            {"first_name": "Wilma", "last_name": "Osterley"} | dob | {"social_security_number": "111-11-1112"},  # 5: twin
            {"first_name": "N/A", "last_name": ""} | mail,  # 6: no name
            {"first_name": "Bill", "last_name": "OSTERLYE"} | dob | mail,  # 7: repeated row
            {"first_name": "x" * 30_000, "last_name": "y" * 30_000} | dob,  # 8
        ),
        forms,
    )
    assert sorted(map(tuple, got.collect())) == [(1, 2), (1, 3), (1, 7), (2, 3), (3, 7)]
    assert names.variant_pairs(rows(spark).limit(0), forms.limit(0)).count() == 0


@pytest.mark.parametrize(
    "cells,want",
    [
        (("12643B  YARROWMERE AVENUE", "Mount Wyndle", "35364-1"), ("12643", "B", ("YARROWMERE",), "", "AVENUE", ("MOUNT", "WYNDLE"))),
        (("16-8303 Granaryfield Str", "", ""), ("8303", "16", ("GRANARYFIELD",), "", "STREET", ())),
        (("Unit 9, 9305 Birchen Pasture Blvd, Corvale, GA 64218", "", ""), ("9305", "9", ("BIRCHEN", "PASTURE"), "", "BOULEVARD", ("CORVALE",))),
        (("Jasmine Haven Ln N 1077 #4", "St. Ives", None), ("1077", "4", ("JASMINE", "HAVEN"), "NORTH", "LANE", ("SAINT", "IVES"))),
        (("4948 e. 11th rd.", None, None), ("4948", "", ("ELEVENTH",), "EAST", "ROAD", ())),
    ],
)
def test_addresses_apart(cells, want):
    assert tuple(address_parts.parsed(*cells))[:6] == want


@pytest.mark.parametrize("cell", [None, "", "N/A", "same as above", "Apt 3", "Ravenwood Lane", "8423", "[redacted]"])
def test_no_place(cell):
    assert address_parts.parsed(cell, "Corvale", "64218") is None


def test_alignment():
    assert places.alignment(("OAK", "HILL"), ("OAK", "HILL")) == 0
    assert places.alignment(("OAK",), ("OAK", "HILL", "VIEW")) == 0.75  # one gap of two words
    assert places.same_street("RAVENBROOK", "RAVEEN BROOK") and places.same_street("JUNCITON VIEW", "JUNCTION VIEW")
    assert not places.same_street("NINTH", "TENTH") and not places.same_street("RAVENGATE", "HERONGATE")


def test_same_places(spark):
    given = [
        ("4059 North Copperwood Lane", "Zennock Junction", "34344"), ("4059 n copperwod ln.", "zennock jct", ""), ("4059 COPPERWOOD LANE", "", "34344"),  # 1-3
        ("1010 E Lantern Springs Drv, Apt 25", "Corvale", "64218"), ("1010 E. LANTERN SPRINGS DRV", "", "64218"),  # 4, 5
        ("3727 N Dapple Ln", "Fulbrough", "81708"), ("3727 S Dapple Ln", "Fulbrough", "81708"),  # 6, 7
        ("5 Oak St Apt 1", "Corvale", "64218"), ("5 Oak St Apt 2", "Corvale", "64218"), ("5 Oak Street", "Corvale", "64218"),  # 8-10: two units known
        ("same as above", "Corvale", "64218"), (None, None, None), ("4059 Copperwood Lane", "Harkness", "99999"), ("9" * 20_000 + " Oak St", "x" * 20_000, ""),
    ]
    df = spark.createDataFrame([(i, *g, "n") for i, g in enumerate(given, 1)] + [(None, "1 Oak St", "", "", "n")], "rec_id long, residential_address string, city string, zip_code string, number string")
    got = sorted(map(tuple, places.variant_addresses(df).collect()))
    assert got == [(1, 2), (1, 3), (2, 3), (4, 5)]
    assert places.variant_addresses(df.limit(0)).count() == 0


def located(spark, *cells):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cells, 1)], "rec_id long, residential_address string, city string, zip_code string")
    return [r[1] for r in sorted(map(tuple, places.same_places(df).collect()))]


def test_a_part_in_doubt_unites_nobody(spark):
    assert located(spark, ("9 Oak St", "Corvale", "64218"), ("9 Oak St", "Harkness", "64218"), ("9 Oak St", "", "64218")) == [1, 2, 3]
    assert located(spark, ("9 Oak St", "Corvale", "64218"), ("9 Oak St", "Corvale", "70000"), ("9 Oak St", "Corvale", "")) == [1, 2, 3]
    assert located(spark, ("9 Oak St", "Corvale", "64218"), ("9 Oak St", "CORVALLE", "64281"), ("9 Oak St", "Corvale", "")) == [1, 1, 1]
    assert located(spark, ("9 N Oak St", "Corvale", "64218"), ("9 S Oak St", "Corvale", "64218"), ("9 Oak", "Corvale", "64218"), ("9 Oak St", "Corvale", "64218")) == [1, 2, 3, 3]
    assert located(spark, ("9 N Oak St", "Corvale", "64218"), ("9 Oak", "Corvale", "64218"), ("9 Oak Rd", "Corvale", "64218")) == [1, 2, 3]
    assert located(spark, ("9 Oak St", "Corvale", ""), ("9 Oak St", "corvale", ""), ("9 Oak St", "", ""), ("9 Oak St Apt 7", "Corvale", "")) == [1, 1, 3, 1]


def test_many_kinds_of_one_house(spark):
    from pyspark.sql import functions as F

    kind = F.col("id") % 3
    df = spark.range(60_000).select(
        F.col("id").alias("rec_id"), F.when(kind == 0, F.concat(F.lit("9 Oak St Apt "), "id")).otherwise(F.lit("9 Oak St")).alias("residential_address"),
        F.lit("Corvale").alias("city"), F.when(kind == 1, F.lpad(F.col("id").cast("string"), 5, "9")).otherwise(F.lit("64218")).alias("zip_code"),
    )
    assert places.same_places(df).count() == 60_000


def test_no_join_is_broadcast_by_an_estimate(spark, monkeypatch):
    """Of the 51 keys a spelling, Spark expects less than the spellings' own bytes: broadcast, they filled the driver."""
    plans, kept = {}, places.written
    planned = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    monkeypatch.setattr(places, "written", lambda df, label: (plans.update({label: planned(df)}), kept(df, label))[1])
    for most in ("ZIPS", "CITY_KEYS"):  # what is counted first may be broadcast; here nothing is few enough
        monkeypatch.setattr(places, most, 0, raising=False)
    given = [("4 Oak St", "Corvale", "64218"), ("4 Oak Street", "corvale", "64218"), ("9 Elm St", "Corvale", ""), ("9 Elm St", "CORVALE", "64218"), ("9 Elm", "", "64218")]
    df = spark.createDataFrame([(i, *g) for i, g in enumerate(given, 1)], "rec_id long, residential_address string, city string, zip_code string")
    out = places.variant_addresses(df)
    plans["out"] = planned(out)
    assert {"streets", "named-towns", "town-classes", "placed", "out"} <= set(plans)
    assert not [label for label, plan in plans.items() if "Broadcast" in plan]
    assert sorted(map(tuple, out.collect())) == [(1, 2), (3, 4), (3, 5), (4, 5)]


def meets(street):
    return {int(x) for x in places.Banding().bands([street])[0]} | places.short_keys(street)


def test_short_street_names_meet():
    for a, b in (("MAIN", "MIAN"), ("PARK", "PRAK"), ("MAPLE", "MALPE"), ("OAK HILL", "ELM HILL"), ("MAIN", "MAN"), ("ELM", "ELMWOOD")):
        assert meets(a) & meets(b), (a, b)
    rng = random.Random(6)
    for _ in range(300):
        a = [rng.choice("ABCDE") for _ in range(rng.randrange(4, 8))]
        b, i = list(a), rng.randrange(len(a) - 1)
        b[i], b[i + 1] = b[i + 1], b[i]
        assert meets("".join(a)) & meets("".join(b))


def test_form_links_of_many_rows():
    short = [("Robert", "Bob"), ("Robert", "Rob"), *[(f"Given{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}", f"Short{i}") for i in range(2500)]]
    got = set(names.form_links(names.Matcher(short)))
    assert {("robert", "bob"), ("bob", "robert"), ("bob", "rob"), ("rob", "bob")} <= got
