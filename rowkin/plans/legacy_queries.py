"""Queries of the older rule set over old_records, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import legacy
from ..workspace import spread, table
from . import pipeline
from .hot_queries import sql_date, sql_name, sql_text
from .record_queries import SSN, STREETS, sql_tokens

_IDS = ", ".join(f"{sql_tokens(c)} AS ids{n}" for n, c in legacy.IDS.items())
_DIGITS = "regexp_replace(coalesce(zip_code, ''), '[^0-9]', '', 'g')"
_SET = f"list_distinct(list_filter(list_transform(string_split(coalesce(full_date_of_birth, ''), ';'), lambda x: coalesce(strftime({sql_date('x')}, '%Y%m%d'), '')), lambda x: x <> ''))"
_ROWS = f"""WITH n AS (SELECT * FROM old_records),
{STREETS}, r AS (SELECT rec_id AS idx, {sql_name('first_name')} AS first, {sql_name('last_name')} AS last, {sql_name('middle_name')} AS mid, {sql_name('suffix')} AS suf, {SSN} AS ssn,
 coalesce(strftime({sql_date('full_date_of_birth')}, '%Y%m%d'), '') AS dob, {_SET} AS dob_set, {_IDS}, street AS addr, base, unit, {sql_text('city')} AS city_n, {sql_text('state_of_residence')} AS state_n,
 {sql_text('zip_code')} AS zip_n, CASE WHEN length({_DIGITS}) >= 5 THEN substr({_DIGITS}, 1, 5) ELSE '' END AS zip5, {sql_text('province_of_residence')} AS province_n FROM s)"""


def _keys(level: int) -> str:
    named = "first <> '' AND last <> ''"
    if level == 1:
        return "SELECT *, ssn AS key FROM r WHERE ssn <> ''"
    if level == 2:
        return f"SELECT *, concat(first, '|', last, '|', dob) AS key FROM r WHERE {named} AND dob <> ''"
    if level < 8:
        return f"SELECT *, concat(first, '|', last, '|', t) AS key FROM (SELECT *, unnest(ids{level}) AS t FROM r WHERE {named}) x"
    return "\nUNION ALL ".join(f"SELECT *, concat('{c}|', {c}, '|', substr(last, 1, 1)) AS key FROM r WHERE {named} AND {c} <> ''" for c in ("addr", "city_n", "zip_n"))


def _fits(level: int) -> str:
    differ = lambda c: f"NOT (a.{c} <> '' AND b.{c} <> '' AND a.{c} <> b.{c})"
    prefix = lambda c: f"(a.{c} = '' OR b.{c} = '' OR starts_with(a.{c}, b.{c}) OR starts_with(b.{c}, a.{c}))"
    ok = [differ("dob"), differ("suf"), *(prefix(c) for c in ("first", "mid", "last"))]
    if level > 1:
        ok.append(differ("ssn"))
    if level == 8:
        ok += [differ(c) for c in ("city_n", "state_n", "zip5", "province_n")]
        ok.append("(a.addr = '' OR b.addr = '' OR a.addr = b.addr OR (a.base <> '' AND a.base = b.base AND NOT (a.unit <> '' AND b.unit <> '' AND a.unit <> b.unit)))")
        same = " OR ".join(f"(a.{c} <> '' AND a.{c} = b.{c})" for c in ("city_n", "state_n", "zip5", "province_n"))
        ok.append(f"((a.addr <> '' AND b.addr <> '') OR {same})")
    return " AND ".join(ok)


def rows_of(spark, d):
    return legacy.normalized(spread(table(spark, d, "old_records"), "rec_id"))


QUERIES, SQL = {}, {}


def _add(level: int) -> None:
    name = f"legacy_links_l{level}"
    QUERIES[name] = lambda spark, d: legacy.links(rows_of(spark, d), level)
    SQL[name] = f"{_ROWS}, e AS ({_keys(level)}) SELECT a.idx, count(DISTINCT b.idx) AS n_links FROM e a JOIN e b ON a.key = b.key AND a.idx <> b.idx AND {_fits(level)} GROUP BY a.idx"


for _n in range(1, 9):
    _add(_n)


def bridge_decision(spark, d):
    return legacy.bridge(rows_of(spark, d))


_LOST = ("first_name", "last_name", "middle_name")


def bridge_of_lost_names(spark, d):
    """The bridge if every row without a phone number had lost its names: many unnamed rows with something to go by."""
    rows = table(spark, d, "old_records")
    lost = F.trim(F.coalesce("phone_number", F.lit(""))) == ""
    return legacy.bridge(legacy.normalized(spread(rows.withColumns({c: F.when(~lost, F.col(c)) for c in _LOST}), "rec_id"))).withColumn("target", F.coalesce("target", F.lit(0)))


def backfilled_names(spark, d):
    return legacy.backfilled(table(spark, d, "old_records")).select("rec_id", "first_name", "last_name")


def merged_old(spark, d):
    return pipeline.final_rows(pipeline.resolve_old(table(spark, d, "old_records"))[0])


def merged_unknowns(spark, d):
    return pipeline.final_rows(pipeline.resolve_old(table(spark, d, "old_records"), bridged=True)[0])


def legacy_clusters(spark, d):
    return legacy.clusters(rows_of(spark, d))


QUERIES |= {"legacy_clusters": legacy_clusters, "merged_old": merged_old, "merged_unknowns": merged_unknowns}
QUERIES |= {"bridge_decision": bridge_decision, "bridge_of_lost_names": bridge_of_lost_names, "backfilled_names": backfilled_names}
_OVER = " + ".join(f"CAST(list_has_any(u.ids{n}, v.ids{n}) AS INT)" for n in legacy.BRIDGE)
_EV = "CAST(v.ssn <> '' AS INT) + CAST(len(v.dob_set) > 0 AS INT) + " + " + ".join(f"CAST(len(v.ids{n}) > 0 AS INT)" for n in legacy.BRIDGE)
SQL["bridge_decision"] = f"""{_ROWS}, p AS (SELECT u.idx, v.idx AS target, CASE WHEN u.ssn <> '' AND u.ssn = v.ssn THEN 1 ELSE 2 END AS tier, {_OVER} AS n_shared, {_EV} AS evidence FROM r u JOIN r v
 ON u.first = '' AND u.last = '' AND (v.first <> '' OR v.last <> '') AND ((u.ssn <> '' AND u.ssn = v.ssn) OR {_OVER} > 0)
 AND NOT (u.ssn <> '' AND v.ssn <> '' AND u.ssn <> v.ssn) AND NOT (len(u.dob_set) > 0 AND len(v.dob_set) > 0 AND NOT list_has_any(u.dob_set, v.dob_set))),
q AS (SELECT * FROM p QUALIFY tier = min(tier) OVER (PARTITION BY idx)),
s2x AS (SELECT * FROM q QUALIFY n_shared = max(n_shared) OVER (PARTITION BY idx)),
t AS (SELECT *, count(*) OVER (PARTITION BY idx) AS m, max(evidence) OVER (PARTITION BY idx) AS e FROM s2x),
f AS (SELECT idx, tier, n_shared, m, min(target) AS first_one, count(*) FILTER (evidence = e) AS me, min(target) FILTER (evidence = e) AS richest FROM t GROUP BY idx, tier, n_shared, m)
SELECT idx, CASE WHEN m = 1 THEN first_one WHEN me = 1 THEN richest END AS target, tier, CAST(n_shared AS BIGINT) AS n_shared, CASE WHEN m = 1 THEN 'shared' WHEN me = 1 THEN 'evidence' ELSE 'review' END AS decided FROM f"""
SQL["backfilled_names"] = "SELECT rec_id, " + ", ".join(f"CASE WHEN trim(coalesce({c}, ''), ' ') = '' THEN '[UNKNOWN]' ELSE {c} END AS {c}" for c in ("first_name", "last_name")) + " FROM old_records"
_KEPT = ", ".join(f"CASE WHEN trim(coalesce(phone_number, ''), ' ') <> '' THEN {c} END AS {c}" for c in _LOST)
SQL["bridge_of_lost_names"] = SQL["bridge_decision"].replace("SELECT * FROM old_records", f"SELECT * REPLACE ({_KEPT}) FROM old_records", 1).replace("WHEN me = 1 THEN richest END AS target", "WHEN me = 1 THEN richest ELSE 0 END AS target")
