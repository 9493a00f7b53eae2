"""Small made-up persons, each a rule of person resolution, through the whole pipeline, and the rows that must come out.

The tables are not read: what is expected is stated row by row, apart from any code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import OLD_COLUMNS, VF3_COLUMNS
from . import pipeline


def _people(spark: SparkSession, columns: tuple[str, ...], rows: list[dict]) -> DataFrame:
    full = [{c: "" for c in columns} | {"rec_id": i, "docids": f"D{i}"} | r for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "rec_id long, " + ", ".join(f"{c} string" for c in columns))


def _ann(last: str, first: str = "Ann", **cells: str) -> dict:
    return {"first_name": first, "last_name": last} | cells


SSN, DL, DOB = "social_security_number", "drivers_license_number", "full_date_of_birth"
_ONE = {SSN: "111111111", "phone_number_personal": "5"}
_TWO = {SSN: "222222222", DOB: "1/1/1980"}
VF3 = [
    *[_ann("DATES", **{SSN: "111-11-1111", DOB: d}) for d in ("01/01/1980", "January 1, 1980", "02/02/1990")],  # 0-2: one number, two dates
    *[_ann("MASKED", **{SSN: "123-45-XXXX"})] * 2,  # 3, 4: a masked number alone ties nothing
    _ann("ONE", **_ONE), _ann("ONE"),  # 5, 6: no identifier, one row to go to
    _ann("SHARES", **_ONE), _ann("SHARES", **_TWO), _ann("SHARES", phone_number_personal="5"),  # 7-9: the phone decides
    _ann("RICHER", **_ONE), _ann("RICHER", **_TWO), _ann("RICHER"),  # 10-12: more identifiers decide
    _ann("TIED", **_ONE), _ann("TIED", **{SSN: "222222222"}), _ann("TIED"), _ann("TIED"),  # 13-16: left for review
    *[_ann("STREETS", **{SSN: "111111111", "residential_address": x, "city": "X" if x else ""}) for x in ("1 Oak St", "9 Elm Rd", "1 Oak Street", "")],  # 17-20
    _ann("FOLD", **{SSN: "111111111", "residential_address": "1 Oak St"}), _ann("FOLD", residential_address="9 Elm Rd"),  # 21, 22: addresses in conflict
    *[_ann("LOCK", **{SSN: "333-33-3333", DL: "L9"})] * 2, *[_ann("LOCK", **{DOB: "03/03/1970", DL: "L9"})] * 2,  # 23-26: two groups stay apart
    _ann("INITIAL", "J", **{SSN: "111111111"}), _ann("INITIAL", "Jeffrey", **{SSN: "111111111"}),  # 27, 28
    _ann("SUFFIX", suffix="Jr.", **{SSN: "111111111"}), _ann("SUFFIX", suffix="Sr", **{SSN: "111111111"}),  # 29, 30
    {SSN: "111111111"},  # 31: no name
    _ann("COUNTED", suffix="Jr", **{SSN: "111111111"}), _ann("COUNTED", suffix="Sr"), _ann("COUNTED", suffix="SR"),  # 32-34: counted again when rows fold
    *[_ann("LICENSE", **{DL: "A1; B2"}), _ann("LICENSE", **{DL: "b2;C3"}), _ann("LICENSE", **{DL: "C3"})],  # 35-37: through others
    *[_ann("FIFTYONE", **{SSN: "444444444"})] * 51, *[_ann("FIFTY", **{SSN: "444444444"})] * 50,  # 38-88, 89-138
]
_D = "01/01/1980"
PERSONS = [  # root, rows_merged, full_date_of_birth, suffix, residential_address, other_address, tie_break
    (0, 2, _D, "", "", "", False), (2, 1, "02/02/1990", "", "", "", False), (3, 1, "", "", "", "", False), (4, 1, "", "", "", "", False),
    (5, 2, "", "", "", "", False), (7, 2, "", "", "", "", False), (8, 1, _D, "", "", "", False), (10, 1, "", "", "", "", False), (11, 2, _D, "", "", "", True),
    (13, 1, "", "", "", "", False), (14, 1, "", "", "", "", False), (15, 2, "", "", "", "", False), (17, 4, "", "", "1 Oak St", "9 Elm Rd, X", False),
    (21, 2, "", "", "1 Oak St", "9 Elm Rd", False), (23, 2, "", "", "", "", False), (25, 2, "03/03/1970", "", "", "", False), (27, 1, "", "", "", "", False),
    (28, 1, "", "", "", "", False), (29, 2, "", "Jr.", "", "", False), (32, 3, "", "Sr", "", "", False), (35, 3, "", "", "", "", False),
    (38, 51, "", "", "", "", False), (89, 50, "", "", "", "", False),
]
OLD = [
    *[_ann("STONE", **{SSN: "111-11-1111", DL: "D1"})] * 5, *[_ann("STONE", **{SSN: "999-99-9999", DL: "D2"})] * 3, _ann("STONE", **{DL: "D1;D2"}),  # 0-8: the bridge joins one
    *[_ann("MASKED", **{SSN: "123-45-XXXX"})] * 2,  # 9, 10
    _ann("INITIAL", "J", **{SSN: "222222222"}), _ann("INITIAL", "Jeffrey", **{SSN: "222222222"}),  # 11, 12
    _ann("SUFFIX", suffix="Jr", **{SSN: "333333333"}), _ann("SUFFIX", suffix="Sr", **{SSN: "333333333"}),  # 13, 14
    _ann("NUMBER", **{SSN: "444444444"}), {SSN: "444444444"},  # 15, 16: one number, at the first level
    _ann("LICENSE", **{DL: "D7"}), {DL: "d7"},  # 17, 18: bridged
    _ann("TIED", "Bea", employee_identification_number="E1"), _ann("TYED", "Cy", employee_identification_number="E1"), {"employee_identification_number": "E1"},  # 19-21: review
    _ann("POOR", "Bea", **{DL: "D8"}), _ann("RICH", "Cy", **{DL: "D8", SSN: "555555555"}), {DL: "D8"},  # 22-24: evidence decides
    _ann("APART", **{DL: "D9", DOB: "01/05/1985; 02/05/1985"}), {DL: "D9", DOB: "03/03/1990"},  # 25, 26: other dates
    _ann("DATED", **{DL: "D10", DOB: "01/05/1985; 02/05/1985"}), {DL: "D10", DOB: "2/5/1985"},  # 27, 28: one of the dates
]
OLD_PERSONS = [
    (0, "Ann", "STONE", 6), (5, "Ann", "STONE", 3), (9, "Ann", "MASKED", 2), (11, "Jeffrey", "INITIAL", 2), (13, "Ann", "SUFFIX", 1), (14, "Ann", "SUFFIX", 1), (15, "Ann", "NUMBER", 2),
    (17, "Ann", "LICENSE", 1), (18, "", "", 1), (19, "Bea", "TIED", 1), (20, "Cy", "TYED", 1), (21, "", "", 1), (22, "Bea", "POOR", 1), (23, "Cy", "RICH", 1), (24, "", "", 1),
    (25, "Ann", "APART", 1), (26, "", "", 1), (27, "Ann", "DATED", 1), (28, "", "", 1),
]
_U = "[UNKNOWN]"
BRIDGED = [
    (0, "Ann", "STONE", 6, False), (5, "Ann", "STONE", 3, False), (9, "Ann", "MASKED", 2, False), (11, "Jeffrey", "INITIAL", 2, False), (13, "Ann", "SUFFIX", 1, False), (14, "Ann", "SUFFIX", 1, False),
    (15, "Ann", "NUMBER", 2, False), (17, "Ann", "LICENSE", 2, False), (19, "Bea", "TIED", 1, False), (20, "Cy", "TYED", 1, False), (21, _U, _U, 1, False), (22, "Bea", "POOR", 1, False), (23, "Cy", "RICH", 2, True),
    (25, "Ann", "APART", 1, False), (26, _U, _U, 1, False), (27, "Ann", "DATED", 2, False),
]
NEW = [
    *[_ann("MASKED", **{SSN: "123-45-XXXX"})] * 2,  # 0, 1: masked numbers confirm here
    *[_ann("MIDDLE", middle_name=m, **{SSN: "111111111"}) for m in ("J", "K", "John")],  # 2-4: middle names guard
    _ann("SUFFIX", suffix="Jr", **{SSN: "111111111"}), _ann("SUFFIX", suffix="Sr.", **{SSN: "111111111"}),  # 5, 6: the longest suffix
]
NEW_PERSONS = [(0, 2, ""), (2, 2, ""), (3, 1, ""), (5, 2, "Sr.")]

_kept: dict[tuple[str, str], pipeline.Resolved] = {}


def _resolved(spark: SparkSession, profile: str, rows: list[dict], name: str) -> pipeline.Resolved:
    key = spark.sparkContext.applicationId, name
    if key not in _kept:
        _kept[key] = pipeline.resolve(_people(spark, VF3_COLUMNS, rows), profile)
    return _kept[key]


def scenario_persons(spark, d):
    merged = pipeline.final_rows(_resolved(spark, "vf3", VF3, "vf3").merged)
    return merged.select("root", "rows_merged", DOB, "suffix", "residential_address", "other_address", "tie_break")


def scenario_ambiguous(spark, d):
    return _resolved(spark, "vf3", VF3, "vf3").ambiguous.select("first_name", "last_name", "docids", "n_candidates", "evidence", "rows_each")


def scenario_large_groups(spark, d):
    return _resolved(spark, "vf3", VF3, "vf3").large_groups.select("root", "rows_merged")


def scenario_unknown_entries(spark, d):
    return _resolved(spark, "vf3", VF3, "vf3").unknown_entries.select("rec_id", "first_name", "last_name", "unknown_field")


def scenario_no_known_name(spark, d):
    """Columns in order and number of rows if no row has a name."""
    merged = _resolved(spark, "vf3", [{SSN: "111111111"}, _ann("N/A")], "nobody").merged
    shown = F.array(*[F.struct(F.lit(i).cast("long").alias("position"), F.lit(c).alias("column_name")) for i, c in enumerate(merged.columns)])
    return merged.agg(F.count(F.lit(1)).alias("n_rows")).select(F.explode(shown).alias("x"), "n_rows").select("x.position", "x.column_name", "n_rows")


def scenario_persons_new(spark, d):
    return pipeline.final_rows(_resolved(spark, "new", NEW, "new").merged).select("root", "rows_merged", "suffix")


def scenario_persons_old(spark, d):
    return pipeline.final_rows(pipeline.resolve_old(_people(spark, OLD_COLUMNS, OLD))[0]).select("root", "first_name", "last_name", "rows_merged")


_bridge: dict[str, tuple] = {}


def _bridged(spark: SparkSession) -> tuple:
    key = spark.sparkContext.applicationId
    if key not in _bridge:
        _bridge[key] = pipeline.resolve_old(_people(spark, OLD_COLUMNS, OLD), bridged=True)
    return _bridge[key]


def scenario_persons_bridged(spark, d):
    return pipeline.final_rows(_bridged(spark)[0]).select("root", "first_name", "last_name", "rows_merged", "tie_break")


def scenario_bridge_review(spark, d):
    return _bridged(spark)[1].select("docids", "tier", "n_shared")


# Stated apart from the pipeline: the columns of a merged row, in order.
_COLUMNS = """root first_name middle_name last_name suffix social_security_number full_date_of_birth drivers_license_number passport_number tax_identification_number
government_issued_id_number residential_address city state_of_residence province_of_residence zip_code country_of_residence other_address employee_identification_number
phone_number_personal email_address_personal work_related_information docids data_subject_type birth_information address_comments contact_information dl_issuing_country
dl_issuing_province dl_issuing_state passport_country government_id_issuing_country government_issued_identification health_related_information family_information
financial_account_information demographic_information biometric_data pi_notes access_credentials_non_financial unique_id rows_merged names_differ tie_break""".split()


def _values(columns: str, rows: list[tuple], types: str) -> str:
    cell = lambda v: str(v).lower() if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else str(v)
    names, kinds = columns.split(), types.split()
    cast = ", ".join(f"CAST({c} AS {k}) AS {c}" for c, k in zip(names, kinds))
    return f"SELECT {cast} FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) v({', '.join(names)})"


QUERIES = {
    f.__name__: f
    for f in (scenario_persons, scenario_ambiguous, scenario_large_groups, scenario_unknown_entries, scenario_no_known_name, scenario_persons_new, scenario_persons_old, scenario_persons_bridged, scenario_bridge_review)
}
SQL = {
    "scenario_persons": _values(f"root rows_merged {DOB} suffix residential_address other_address tie_break", PERSONS, "BIGINT BIGINT VARCHAR VARCHAR VARCHAR VARCHAR BOOLEAN"),
    "scenario_ambiguous": _values("first_name last_name docids n_candidates evidence rows_each", [("Ann", "TIED", "D15; D16", 2, 1, 1)], "VARCHAR VARCHAR VARCHAR BIGINT INTEGER BIGINT"),
    "scenario_large_groups": _values("root rows_merged", [(38, 51)], "BIGINT BIGINT"),
    "scenario_unknown_entries": _values("rec_id first_name last_name unknown_field", [(31, "[Unknown]", "[Unknown]", "First Name & Last Name")], "BIGINT VARCHAR VARCHAR VARCHAR"),
    "scenario_no_known_name": _values("position column_name n_rows", [(i, c, 0) for i, c in enumerate(_COLUMNS)], "BIGINT VARCHAR BIGINT"),
    "scenario_persons_new": _values("root rows_merged suffix", NEW_PERSONS, "BIGINT BIGINT VARCHAR"),
    "scenario_persons_old": _values("root first_name last_name rows_merged", OLD_PERSONS, "BIGINT VARCHAR VARCHAR BIGINT"),
    "scenario_persons_bridged": _values("root first_name last_name rows_merged tie_break", BRIDGED, "BIGINT VARCHAR VARCHAR BIGINT BOOLEAN"),
    "scenario_bridge_review": _values("docids tier n_shared", [("D21", 2, 1)], "VARCHAR INTEGER BIGINT"),
}
