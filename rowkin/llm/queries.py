"""The subpackage's queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.hot_queries import sql_squeezed
from ..workspace import table
from . import components as _components
from . import language as _language
from . import leaks as _leaks
from . import names as _names
from . import packing as _packing
from . import places as _places
from . import survivors as _survivors


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _survivors.field_survivors(table(spark, d, "merge_groups"), table(spark, d, "vf3_records"))


def p1_survivors(spark: SparkSession, d: str) -> DataFrame:
    return _survivors.survivors(table(spark, d, "merge_groups"), table(spark, d, "vf3_records"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _components.components(_components.matching(table(spark, d, "match_pairs"), table(spark, d, "vf3_records")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _names.variant_pairs(table(spark, d, "old_records"), table(spark, d, "name_forms"))


def p3_persons(spark: SparkSession, d: str) -> DataFrame:
    return _names.persons(table(spark, d, "old_records"), table(spark, d, "name_forms"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _places.variant_addresses(table(spark, d, "old_records"))


def p4_places(spark: SparkSession, d: str) -> DataFrame:
    return _places.same_places(table(spark, d, "old_records"))


def p6_packed(spark: SparkSession, d: str) -> DataFrame:
    return _packing.packed(table(spark, d, "documents"))


def p7_spans(spark: SparkSession, d: str) -> DataFrame:
    return _leaks.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_spans(spark, d).select("doc_id", "item_id").distinct()


def p8_passages(spark: SparkSession, d: str) -> DataFrame:
    return _language.passages(table(spark, d, "documents"), _language.fitted(table(spark, d, "lang_samples")))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _language.mislabelled(table(spark, d, "documents"), _language.fitted(table(spark, d, "lang_samples")))


QUERIES = {f.__name__: f for f in (p1_found, p1_survivors, p2_found, p3_found, p3_persons, p4_found, p4_places, p6_packed, p7_found, p7_spans, p8_found, p8_passages)}

def _in(values) -> str:
    return "(" + ", ".join(f"'{x}'" for x in values) + ")"


def _core(c: str) -> str:
    return f"regexp_replace(upper({sql_squeezed(c)}), '[^\\p{{L}}\\p{{N}}]', '', 'g')"


_SUFFIX = "CASE " + " ".join(f"WHEN {{0}} IN {_in(forms)} THEN '{name}'" for name, forms in _survivors.SUFFIXES.items()) + " ELSE {0} END"
_REST = f"regexp_replace(upper({sql_squeezed('residential_address')}), '{_survivors.UNIT}', ' ', 'g')"
_MEMBERS = "SELECT DISTINCT group_key, rec_id FROM merge_groups WHERE group_key IS NOT NULL"
_P1 = f"""WITH m AS (SELECT g.group_key, v.* FROM ({_MEMBERS}) g JOIN vf3_records v ON v.rec_id = g.rec_id),
mid AS (SELECT group_key, 'middle_name' AS field_name, rec_id, received_at, length(regexp_replace(upper({sql_squeezed('middle_name')}), '[^\\p{{L}}]', '', 'g')) AS score, middle_name AS value
        FROM m WHERE {_core('middle_name')} NOT IN {_in(('', *_survivors.NO_VALUE))}),
adr AS (SELECT group_key, 'residential_address' AS field_name, rec_id, received_at, 0 AS score, residential_address AS value FROM m
        WHERE regexp_matches({_REST}, '{_survivors.HOUSE}') AND regexp_matches(regexp_replace({_REST}, '{_survivors.HOUSE}', ' ', 'g'), '{_survivors.STREET}')),
suf AS (SELECT group_key, 'suffix' AS field_name, rec_id, received_at, count(*) OVER (PARTITION BY group_key, {_SUFFIX.format(_core('suffix'))}) AS score, suffix AS value
        FROM m WHERE {_core('suffix')} NOT IN {_in(('', *_survivors.NO_VALUE))}),
c AS (SELECT * FROM mid WHERE score > 0 UNION ALL SELECT * FROM adr UNION ALL SELECT * FROM suf),
best AS (SELECT group_key, field_name, rec_id, value FROM
         (SELECT *, row_number() OVER (PARTITION BY group_key, field_name ORDER BY score DESC, received_at DESC NULLS LAST, rec_id) AS r FROM c) x WHERE r = 1)
"""


def _survivor_sql() -> str:
    from ..schema import VF3_TABLE

    fields = [c for c in VF3_TABLE if c not in ("rec_id", "received_at")]
    filled = " + ".join(f"CASE WHEN {sql_squeezed('m.' + c)} <> '' THEN 1 ELSE 0 END" for c in fields)
    shown = ", ".join(
        f"coalesce((SELECT {sql_squeezed('b.value')} FROM best b WHERE b.group_key = s.group_key AND b.field_name = '{c}'), '') AS {c}" for c in _survivors.FIELDS
    )
    return _P1 + f"""SELECT s.group_key, s.rec_id, s.n_filled, {shown} FROM
(SELECT group_key, rec_id, n_filled, row_number() OVER (PARTITION BY group_key ORDER BY n_filled DESC, received_at DESC NULLS LAST, rec_id) AS r
 FROM (SELECT group_key, rec_id, received_at, CAST({filled} AS BIGINT) AS n_filled FROM m) f) s WHERE r = 1"""


SQL = {
    "p1_found": _P1 + "SELECT group_key, field_name, rec_id FROM best",
    "p1_survivors": _survivor_sql(),
    "p2_found": f"""WITH RECURSIVE e AS (
 SELECT rec_a AS a, rec_b AS b FROM match_pairs WHERE rec_a <> rec_b AND regexp_replace(lower(verdict), '[^\\p{{L}}]', '', 'g') IN {_in(_components.MATCHES)}
   AND rec_a IN (SELECT rec_id FROM vf3_records) AND rec_b IN (SELECT rec_id FROM vf3_records)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS rec_id, a AS g FROM u UNION SELECT u.b, r.g FROM r JOIN u ON u.a = r.rec_id)
SELECT rec_id, min(g) AS group_id FROM r GROUP BY rec_id""",
}
