"""Survivorship, addresses, consolidation and the whole pipeline on small tables."""

import pytest
from pyspark.sql import functions as F

from rowkin.operators import address, reports, survivorship
from rowkin.plans import pipeline, record_queries
from rowkin.schema import VF3_COLUMNS


def people(spark, rows):
    full = [{c: "" for c in VF3_COLUMNS} | {"rec_id": i, "docids": f"D{i}"} | r for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "rec_id long, " + ", ".join(f"{c} string" for c in VF3_COLUMNS))


def ann(last, **cells):
    return {"first_name": "Ann", "last_name": last} | cells


FILLED = [{"social_security_number": "111111111", "phone_number_personal": "5"}, {"social_security_number": "222222222", "full_date_of_birth": "1/1/1980"}]
ROWS = [
    *[ann("DATES", social_security_number="111-11-1111", full_date_of_birth=d) for d in ("01/01/1980", "1/1/1980", "02/02/1990")],  # 0-2
    *[ann("MASKED", social_security_number="123-45-XXXX")] * 2,  # 3, 4
    ann("ONE", **FILLED[0]), ann("ONE"),  # 5, 6
    ann("SHARES", **FILLED[0]), ann("SHARES", **FILLED[1]), ann("SHARES", phone_number_personal="5"),  # 7-9
    ann("RICHER", **FILLED[0]), ann("RICHER", **FILLED[1]), ann("RICHER"),  # 10-12
    ann("TIED", **FILLED[0]), ann("TIED", social_security_number="222222222"), ann("TIED"), ann("TIED"),  # 13-16
    *[ann("STREETS", social_security_number="111111111", residential_address=x, city="X" if x else None) for x in ("1 Oak St", "9 Elm Rd", "1 Oak Street", None)],  # 17-20
    ann("FOLD", social_security_number="111111111", residential_address="1 Oak St"), ann("FOLD", residential_address="9 Elm Rd"),  # 21, 22
    {c: None for c in VF3_COLUMNS}, ann("N/A"), ann("NULLS", suffix=None, docids=None),  # 23-25
    *[ann("MIDDLE", social_security_number="111111111", middle_name=m) for m in ("J", "K")],  # 26, 27
]


@pytest.fixture(scope="module")
def vf3(spark):
    out = pipeline.resolve(people(spark, ROWS))
    return {r["root"]: r for r in out.merged.collect()}, out


def test_numbers_and_dates(vf3):
    got = {k: r["rows_merged"] for k, r in vf3[0].items()}
    assert got[0] == 2 and got[2] == 1 and vf3[0][0]["full_date_of_birth"] == "01/01/1980" and vf3[0][0]["docids"] == "D0; D1"
    assert got[26] == 2


def test_blank_rows_fold(vf3):
    got, out = vf3
    assert got[3]["rows_merged"] == 1 and got[4]["rows_merged"] == 1  # a masked number is evidence but confirms nothing
    assert {k: (got[k]["rows_merged"], got[k]["tie_break"]) for k in (5, 7, 11, 15)} == {5: (2, False), 7: (2, False), 11: (2, True), 15: (2, False)}
    assert [r["last_name"] for r in out.ambiguous.collect()] == ["TIED"]


def test_conflicting_addresses(vf3):
    got, _ = vf3
    assert got[17]["residential_address"] == "1 Oak St" and got[17]["other_address"] == "9 Elm Rd, X"
    assert got[21]["residential_address"] == "1 Oak St" and got[21]["other_address"] == "9 Elm Rd"


def test_unknown_and_nulls(vf3):
    got, out = vf3
    assert {r["rec_id"]: r["unknown_field"] for r in out.unknown_entries.collect()} == {23: "First Name & Last Name", 24: "Last Name"}
    assert got[25]["docids"] == ""


def test_other_profiles(spark):
    new = {r["root"]: r for r in pipeline.resolve(people(spark, ROWS), "new").merged.collect()}
    assert new[3]["rows_merged"] == 2 and 26 in new and 27 in new and new[21]["residential_address"] == "1 Oak St; 9 Elm Rd"


def test_no_known_row(spark):
    out = pipeline.resolve(people(spark, [ann("N/A")]))
    assert out.merged.count() == 0 and "docids" in out.merged.columns
    with pytest.raises(ValueError, match="dobs"):
        pipeline.resolve(people(spark, []).drop("dobs"))


def test_large_groups_boundary(spark):
    df = spark.createDataFrame([(1, 51), (2, 50)], "root long, rows_merged long")
    assert [r["root"] for r in reports.large_groups(df).collect()] == [1]


def test_suffix_counts(spark):
    df = spark.createDataFrame([(1, 1, "JR", "Jr"), (1, 2, "SR", "Sr"), (1, 3, "JR", "Jr "), (2, 4, "", None)], "g long, idx long, suf string, suffix string")
    assert [tuple(r) for r in survivorship.suffix_mode(df, "g", F.col("idx")).collect()] == [(1, "Jr")]


def test_chunks(spark):
    df = spark.createDataFrame([("aa; bb; cc; dddddddd",), ("",), (None,)], "d string")
    assert [r[0] for r in df.select(survivorship.chunks("d", 6)).collect()] == [["aa; bb", "cc", "dddddddd"], [""], [""]]
    wide = pipeline.with_docid_columns(df.withColumnRenamed("d", "docids"), 6).collect()
    assert tuple(wide[0]) == ("aa; bb", "cc", "dddddddd") and tuple(wide[2]) == ("", "", "")


def test_blank_street_chains_addresses():
    key = lambda street, city: (street, street, "", city, "", "", "", "")
    keys = [{"key": key(s, c), "raw": [s, c, "", "", "", ""], "n": 1} for s, c in (("1 A ST", "X"), ("", "X"), ("2 B ST", "X"))]
    best, others = address.majority(keys)
    assert best[1] == "X" and others == []


def test_rows_add_up(spark, sf):
    df = spark.read.parquet(f"{sf}/vf3_records.parquet")
    out = pipeline.resolve(df)
    known = df.count() - out.unknown_entries.count()
    assert out.merged.agg(F.sum("rows_merged")).first()[0] == known
    assert out.merged.where(F.col("full_date_of_birth").contains(";") & (F.col("rows_merged") > 1)).count() == 0


def test_merged_new_reads_new_records(spark, tmp_path):
    people(spark, [ann("OTHER")]).write.parquet(f"{tmp_path}/vf3_records.parquet")
    people(spark, ROWS).write.parquet(f"{tmp_path}/new_records.parquet")
    got = {r["root"]: r["rows_merged"] for r in record_queries.QUERIES["merged_new"](spark, str(tmp_path)).collect()}
    assert got[3] == 2 and got[26] == 1 and got[27] == 1  # equal masked numbers join, other middle names do not
    assert [r["last_name"] for r in record_queries.QUERIES["merged_vf3"](spark, str(tmp_path)).collect()] == ["OTHER"]


def test_reports_of_all_levels(spark, tmp_path):
    street = lambda i: "9 Elm Rd" if i == 59 else "1 Oak St"
    rows = [ann("LICENSE", drivers_license_number="L1234567", residential_address=street(i)) for i in range(60)]
    people(spark, rows).write.parquet(f"{tmp_path}/vf3_records.parquet")
    got = lambda name: [tuple(r) for r in record_queries.QUERIES[name](spark, str(tmp_path)).collect()]
    assert got("large_groups_resolved") == [(0, 60)] and got("run_summary_resolved") == [(1, 1, 60, 60)]
    pieces = sorted(got("docid_chunks"))
    assert {r[0] for r in pieces} == {0} and "; ".join(r[2] for r in pieces) == "; ".join(f"D{i}" for i in range(60))
    (one,) = record_queries.QUERIES["address_split"](spark, str(tmp_path)).collect()
    assert one["root"] == 0 and one["residential_address"] == "1 Oak St" and one["other_address"] == "9 Elm Rd"
