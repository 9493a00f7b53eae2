import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from rowkin.operators import legacy
from rowkin.plans import legacy_queries

COLUMNS = [
    "first_name", "last_name", "middle_name", "suffix", "full_date_of_birth", "social_security_number", *legacy.IDS.values(), "residential_address", "city", "state_of_residence", "zip_code", "province_of_residence",
]


def rows(spark, *given):
    out = [{c: None for c in COLUMNS} | {"rec_id": i} | g for i, g in enumerate(given, 1)]
    return legacy.normalized(spark.createDataFrame(out, "rec_id long, " + ", ".join(f"{c} string" for c in COLUMNS)))


@pytest.mark.parametrize("name", sorted(legacy_queries.SQL))
def test_same_rows_as_sql(name, same_as_sql):
    same_as_sql(legacy_queries.QUERIES[name], legacy_queries.SQL[name])


def links(df, level):
    return {r["idx"]: r["n_links"] for r in legacy.links(df, level).collect()}


def test_prefix_names_meet_by_number_and_place(spark):
    df = rows(
        spark,
        {"first_name": "J", "last_name": "Lee", "social_security_number": "111111112", "city": "X"},
        {"first_name": "Jeffrey", "last_name": "Lee", "social_security_number": "111111112", "city": "X"},
        {"first_name": "Jeffrey", "last_name": "Lee", "suffix": "Jr", "social_security_number": "111111112"},
        {"first_name": "Jeffrey", "last_name": "Lee", "suffix": "Sr", "social_security_number": "111111112"},
        {"first_name": "Jon", "last_name": "Lee", "city": "X", "zip_code": "1"},
    )
    assert links(df, 1) == {1: 3, 2: 3, 3: 2, 4: 2}
    assert links(df, 8) == {1: 2, 2: 1, 5: 1}
    assert links(df, 2) == {} and links(df.limit(0), 8) == {}


def test_bridge(spark):
    named = {"first_name": "Ann", "last_name": "Lee"}
    df = rows(
        spark,
        named | {"social_security_number": "111111112"},  # 1
        named | {"email_address_personal": "a@b", "full_date_of_birth": "1/1/1980"},  # 2
        named | {"email_address_personal": "a@b", "passport_number": "P1", "full_date_of_birth": "1/1/1980"},  # 3
        {"first_name": "N/A", "social_security_number": "111-11-1112", "email_address_personal": "a@b"},  # 4 -> 1
        {"email_address_personal": "A@B"},  # 5 -> 3, more evidence
        {"email_address_personal": "a@b", "full_date_of_birth": "2/2/1990"},  # 6: dates exclude
        named | {"phone_number": "5", "employee_identification_number": "E9"}, named | {"employee_identification_number": "e9", "phone_number": "6"},  # 7, 8
        {"employee_identification_number": "E9"},  # 9: tied
    )
    got = {r["idx"]: (r["target"], r["tier"], r["decided"]) for r in legacy.bridge(df).collect()}
    assert got == {4: (1, 1, "shared"), 5: (3, 2, "evidence"), 9: (None, 2, "review")}
    assert legacy.bridge(df.where(F.lit(False))).count() == 0


def simulate(given):
    """The eight levels over all pairs of rows in ascending order."""
    clash = lambda x, y: bool(x and y and x != y)
    apart = lambda x, y: bool(x and y and not x.startswith(y) and not y.startswith(x))
    root = {r["idx"]: r["idx"] for r in given}
    fields = ["ssn", "dob", *legacy.PLACE_SETS]
    own = {r["idx"]: {k: {r[k]} if r[k] else set() for k in fields} for r in given}
    locked = set()
    for level in range(1, 9):
        touched = set()
        for a, b in combinations(sorted(given, key=lambda r: r["idx"]), 2):
            named = all(r["first"] and r["last"] for r in (a, b))
            same = named and (a["first"], a["last"]) == (b["first"], b["last"])
            if level == 1:
                key = a["ssn"] and a["ssn"] == b["ssn"]
            elif level == 2:
                key = same and a["dob"] and a["dob"] == b["dob"]
            elif level < 8:
                key = same and set(a[f"ids{level}"]) & set(b[f"ids{level}"])
            else:
                key = named and a["last"][0] == b["last"][0] and any(a[k] and a[k] == b[k] for k in ("addr", "city_n", "zip_n"))
                street = clash(a["addr"], b["addr"]) and not (a["base"] and a["base"] == b["base"] and not clash(a["unit"], b["unit"]))
                key = key and not street and not any(clash(a[k], b[k]) for k in ("city_n", "state_n", "zip5", "province_n"))
                key = key and ((a["addr"] and b["addr"]) or any(a[k] and a[k] == b[k] for k in ("city_n", "state_n", "zip5", "province_n")))
            if not key or clash(a["dob"], b["dob"]) or clash(a["suf"], b["suf"]) or any(apart(a[k], b[k]) for k in ("first", "mid", "last")):
                continue
            if level > 1 and clash(a["ssn"], b["ssn"]):
                continue
            x, y = root[a["idx"]], root[b["idx"]]
            guards = fields if level == 8 else fields[:2]
            if x == y or (x in locked and y in locked) or any(own[x][k] and own[y][k] and not own[x][k] & own[y][k] for k in guards):
                continue
            lo, hi = min(x, y), max(x, y)
            root = {k: lo if v == hi else v for k, v in root.items()}
            own[lo] = {k: own[lo][k] | own[hi][k] for k in fields}
            locked |= {lo} if hi in locked else set()
            touched.add(lo)
        locked |= {root[t] for t in touched}
    return root


def test_clusters_equal_simulation(spark):
    rng, given = random.Random(4), []
    for i in rng.sample(range(1, 2000), 120):
        block = rng.randrange(8)
        street = rng.choice(["", f"{block} OAK ST", f"{block} OAK ST APT 1", f"{block} OAK ST APT 2"])
        given.append({
            "idx": i, "first": rng.choice(["", "J", "JEFF", "JEFFREY"]), "last": f"L{block}", "mid": rng.choice(["", "A"]), "suf": rng.choice(["", "", "JR", "SR"]),
            "ssn": rng.choice(["", f"11111111{block}", f"22222222{block}"]), "dob": rng.choice(["", "", "19800101", "19900101"]),
            **{f"ids{n}": rng.choice([[], [], ["P"], ["P", "Q"]]) for n in legacy.IDS}, "addr": street, "base": street.split(" APT")[0], "unit": street[len(street.split(" APT")[0]) + 1:],
            "city_n": rng.choice(["", "X", "Y"]), "state_n": "", "zip_n": rng.choice(["", "12345"]), "zip5": "", "province_n": "",
        })
        given[-1]["zip5"] = given[-1]["zip_n"]
    given += [g | {"idx": g["idx"] + 5000} for g in given[:20]]
    schema = "idx long, " + ", ".join(f"{c} string" for c in [*legacy.NAME, "ssn", "dob", *legacy.PLACE]) + ", " + ", ".join(f"ids{n} array<string>" for n in legacy.IDS)
    df = spark.createDataFrame([{k: g[k] for k in g} for g in given], schema)
    assert {r["idx"]: r["root"] for r in legacy.clusters(df).collect()} == simulate(given)


def test_old_pipeline(spark):
    from rowkin.plans import pipeline
    from rowkin.schema import OLD_COLUMNS

    given = [
        {"first_name": "Jeffrey", "last_name": "Lee", "social_security_number": "111-11-1112", "residential_address": "1 Oak St", "suffix": "Jr"},
        {"first_name": "J", "last_name": "Lee", "social_security_number": "111111112", "docids": "D2"},
        {"social_security_number": "111111112", "first_name": "N/A", "docids": "D3", "full_date_of_birth": "1/1/1980"},
        {"first_name": "Ann", "last_name": None},
    ]
    out = [{c: "" for c in OLD_COLUMNS} | {"rec_id": i, "extra": 1} | g for i, g in enumerate(given)]
    df = spark.createDataFrame(out, "rec_id long, extra int, " + ", ".join(f"{c} string" for c in OLD_COLUMNS))
    got = {r["root"]: r for r in pipeline.resolve_old(df)[0].collect()}
    assert {k: r["rows_merged"] for k, r in got.items()} == {0: 3, 3: 1} and got[0]["first_name"] == "Jeffrey" and got[0]["docids"] == "D2; D3"
    rows, review = pipeline.resolve_old(df.where("rec_id in (0, 3)"), bridged=True)
    assert {r["last_name"] for r in rows.collect()} == {"Lee", "[UNKNOWN]"} and review.count() == 0
    with pytest.raises(ValueError, match="docids"):
        pipeline.resolve_old(df.drop("docids"))
