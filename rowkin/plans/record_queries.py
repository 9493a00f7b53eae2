"""Queries of the person operators over the whole person tables, and SQL that gives the same rows.

The SQL is built from the same small pieces for every query: normalized cells as one common table, then the operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import street, text
from ..operators import address, linkage, normalize, reports, survivorship
from ..schema import ADDRESS
from ..workspace import spread, table, written
from . import pipeline
from .hot_queries import sql_date, sql_name, sql_squeezed, sql_text
from .profiles import PROFILES

VF3 = PROFILES["vf3"]


def vf3(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "vf3_records")


def rows_of(spark: SparkSession, d: str) -> DataFrame:
    return normalize.normalized(spread(vf3(spark, d), "rec_id"))


def rooted(spark: SparkSession, d: str) -> DataFrame:
    """Known rows with the root of levels 1 and 2."""
    known = written(normalize.known(rows_of(spark, d)), "known")
    return known.join(linkage.level12(known).select("idx", "root"), "idx")


def persons(spark: SparkSession, d: str) -> DataFrame:
    """Known rows with the root of all levels."""
    known = written(normalize.known(rows_of(spark, d)), "known")
    return known.join(written(linkage.clusters(known), "roots"), "idx")


def final(spark: SparkSession, d: str) -> DataFrame:
    """The final row of every person: all levels, blank rows folded, exact duplicates once."""
    return pipeline.final_rows(pipeline.resolve(vf3(spark, d)).merged)


# -- the SQL's common pieces ------------------------------------------------------------------------------------------

SSN_PATTERN = "regexp_replace(translate(upper(coalesce(social_security_number, '')), '*#?', 'XXX'), '[^0-9X]', '', 'g')"
KNOWN_DIGITS = f"length(replace({SSN_PATTERN}, 'X', ''))"
SSN = f"CASE WHEN length({SSN_PATTERN}) = 9 AND {KNOWN_DIGITS} >= 4 THEN {SSN_PATTERN} ELSE '' END"


def sql_stripped(c: str) -> str:
    white = r"[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
    return f"regexp_replace(coalesce({c}, ''), '^{white}|{white}$', '', 'g')"


def sql_key(c: str) -> str:
    return f"coalesce(CASE WHEN year({sql_date(c)}) > 1900 THEN strftime({sql_date(c)}, '%Y%m%d') END, '')"


def sql_tokens(c: str) -> str:
    """Distinct normalized tokens of a cell, in no order."""
    norm = "CASE WHEN upper({0}) IN ('NAN','NONE','NULL') THEN '' ELSE upper({0}) END".format(sql_squeezed("t"))
    return f"list_distinct(list_filter(list_transform(string_split(coalesce({c}, ''), ';'), lambda t: {norm}), lambda t: t <> ''))"


def sql_rows(columns: str = "") -> str:
    """CTE n: the normalized rows; k: the known ones; g: their levels 1 and 2."""
    ids = ", ".join(f"{sql_tokens(c)} AS ids{n}" for n, c in VF3.id_levels)
    return f"""WITH z AS (SELECT *, rec_id AS idx, {sql_name('first_name')} AS first, {sql_name('last_name')} AS last, {sql_name('middle_name')} AS mid,
  {sql_name('suffix')} AS suf, {SSN} AS ssn, {sql_key('full_date_of_birth')} AS dob_primary, {sql_key('dobs')} AS dob_alt, {ids} FROM vf3_records),
n AS (SELECT *, CASE WHEN dob_primary <> '' THEN dob_primary ELSE dob_alt END AS dob,
  CASE WHEN dob_primary <> '' THEN full_date_of_birth ELSE dobs END AS dob_raw, regexp_full_match(ssn, '[0-9]{{9}}') AS ssn_full FROM z),
k AS (SELECT * FROM n WHERE first <> '' AND last <> ''){columns}"""


L12 = """,
w AS (SELECT k.*, CASE WHEN ssn = '' AND dob <> '' THEN coalesce(first_value(nullif(ssn, '') IGNORE NULLS) OVER (PARTITION BY first, last, dob ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), '') ELSE ssn END AS gs,
  CASE WHEN dob = '' AND ssn_full THEN coalesce(first_value(nullif(dob, '') IGNORE NULLS) OVER (PARTITION BY first, last, ssn ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), '') ELSE dob END AS gd FROM k),
g AS (SELECT *, min(idx) OVER (PARTITION BY first, last, gs, gd, CASE WHEN gd = '' AND NOT regexp_full_match(gs, '[0-9]{9}') THEN idx ELSE -1 END) AS root FROM w)
"""


def sql_street(c: str) -> str:
    """Subquery text for lateral use: the canonical tokens of a street as a list."""
    case = " ".join(f"WHEN t IN ({', '.join(repr(w) for w in words)}) THEN '{short}'" for short, words in street.SHORT.items())
    return f"list_transform(list_transform({c}, lambda t: regexp_replace(t, '\\.+$', '')), lambda t: CASE {case} ELSE t END)"


STREETS = f"""s0 AS (SELECT *, string_split({sql_text('residential_address')}, ' ') AS w FROM n),
s1 AS (SELECT *, CASE WHEN regexp_full_match(w[1], '[0-9]+[A-Z]') THEN 1 WHEN regexp_full_match(w[1], '[0-9]+') AND length(w[2]) = 1 AND w[2] NOT IN ('N','S','E','W') THEN 2 ELSE 0 END AS kind FROM s0),
s2 AS (SELECT *, CASE kind WHEN 1 THEN right(w[1], 1) WHEN 2 THEN w[2] ELSE '' END AS letter,
  {sql_street("CASE kind WHEN 1 THEN list_concat([regexp_replace(w[1], '[A-Z]$', '')], w[2:]) WHEN 2 THEN list_concat([w[1]], w[3:]) ELSE w END")} AS o FROM s1),
s3 AS (SELECT *, CASE WHEN letter <> '' AND NOT list_has_any(o, ['APT','STE','UNIT','BLDG','FL']) THEN list_concat(o, ['UNIT', letter]) ELSE o END AS o2 FROM s2),
s4 AS (SELECT *, coalesce(list_position(list_transform(o2, lambda t: t IN ('APT','STE','UNIT','BLDG','FL') OR starts_with(t, '#')), true), 0) AS cut FROM s3),
s AS (SELECT *, array_to_string(o2, ' ') AS street, array_to_string(CASE WHEN cut = 0 THEN o2 ELSE o2[1:cut - 1] END, ' ') AS base, CASE WHEN cut = 0 THEN '' ELSE array_to_string(o2[cut:], ' ') END AS unit FROM s4)
"""
_PLAIN = "WITH n AS (SELECT * FROM vf3_records),\n"

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


# -- cells ------------------------------------------------------------------------------------------------------------


@query(sql_rows() + " SELECT rec_id, first, last, mid, suf FROM n")
def norm_names(spark, d):
    return rows_of(spark, d).select("rec_id", "first", "last", "mid", "suf")


@query(sql_rows() + " SELECT rec_id, ssn, ssn_full FROM n")
def norm_ssn(spark, d):
    return rows_of(spark, d).select("rec_id", "ssn", "ssn_full")


@query(sql_rows() + " SELECT rec_id, dob_primary, dob, dob_raw FROM n")
def norm_dob(spark, d):
    return rows_of(spark, d).select("rec_id", "dob_primary", "dob", "dob_raw")


@query(
    f"SELECT rec_id, docids AS docid, first_name, last_name, social_security_number AS original_ssn, 'only ' || {KNOWN_DIGITS} || ' of 9 digits known' AS remarks "
    f"FROM vf3_records WHERE length({SSN_PATTERN}) = 9 AND contains({SSN_PATTERN}, 'X') AND {KNOWN_DIGITS} < 4"
)
def junk_ssn(spark, d):
    return reports.junk_ssn(vf3(spark, d))


_DATE = sql_date("v")
_CELL = sql_squeezed("v")


@query(
    f"""SELECT rec_id, docid, first_name, last_name, v AS original_dob, mark || why AS remarks FROM (
SELECT *, CASE WHEN lower({_CELL}) IN ('', 'nan', 'none', 'null') THEN '' WHEN year({_DATE}) <= 1900 AND regexp_full_match({_CELL}, '\\d{{1,6}}(\\.\\d+)?') THEN 'serial number of a day up to 1900'
  WHEN year({_DATE}) <= 1900 THEN 'year up to 1900' WHEN {_DATE} IS NULL THEN 'not a date' ELSE '' END AS why
FROM (SELECT rec_id, docids AS docid, first_name, last_name, '' AS mark, full_date_of_birth AS v FROM vf3_records
 UNION ALL SELECT rec_id, docids, first_name, last_name, '[DOBs] ', dobs FROM vf3_records) c) w WHERE why <> ''"""
)
def junk_dob(spark, d):
    return reports.junk_dob(vf3(spark, d))


@query(sql_rows() + "\nUNION ALL\n".join(f" SELECT rec_id, {n} AS level, unnest(ids{n}) AS token FROM n" for n, _ in VF3.id_levels))
def id_tokens(spark, d):
    each = F.array(*[F.struct(F.lit(n).alias("level"), F.col(f"ids{n}").alias("t")) for n, _ in VF3.id_levels])
    return rows_of(spark, d).select("rec_id", F.explode(each).alias("x")).select("rec_id", "x.level", F.explode("x.t").alias("token"))


@query(_PLAIN + STREETS + "SELECT rec_id, street, base, unit FROM s")
def norm_street(spark, d):
    return street.with_street(vf3(spark, d), "residential_address", "street", "base", "unit").select("rec_id", "street", "base", "unit")


@query(
    _PLAIN + STREETS + f""", q AS (SELECT rec_id, street, base, unit, lag(rec_id) OVER b AS before, lag(street) OVER b AS street_b, lag(unit) OVER b AS unit_b FROM s WHERE base <> '' WINDOW b AS (PARTITION BY base ORDER BY rec_id))
SELECT rec_id, before, (street = street_b OR NOT (unit <> '' AND unit_b <> '' AND unit <> unit_b)) AS compatible FROM q WHERE before IS NOT NULL"""
)
def street_compat(spark, d):
    """Each row against the one before it with the same base street."""
    s = street.with_street(vf3(spark, d), "residential_address", "street", "base", "unit").where("base <> ''")
    w = Window.partitionBy("base").orderBy("rec_id")
    s = s.select("rec_id", "street", "base", "unit", F.lag("rec_id").over(w).alias("before"), F.lag("street").over(w).alias("street_b"), F.lag("unit").over(w).alias("unit_b")).where("before is not null")
    ok = street.street_compatible(F.col("street"), F.col("base"), F.col("unit"), F.col("street_b"), F.col("base"), F.col("unit_b"))
    return s.select("rec_id", "before", ok.alias("compatible"))


_DIGITS = "regexp_replace(coalesce(zip_code, ''), '[^0-9]', '', 'g')"
_ZIP = f"CASE WHEN length({_DIGITS}) >= 5 THEN substr({_DIGITS}, 1, 5) ELSE {sql_text('zip_code')} END"


@query(f"SELECT rec_id, CASE WHEN length({_DIGITS}) >= 5 THEN substr({_DIGITS}, 1, 5) ELSE '' END AS zip5, {_ZIP} AS zip_key FROM vf3_records")
def zip_key(spark, d):
    return vf3(spark, d).select("rec_id", street.zip5("zip_code").alias("zip5"), street.zip_key("zip_code").alias("zip_key"))


@query("SELECT rec_id, array_to_string(list_filter([" + ", ".join(sql_stripped(c) for c in ADDRESS) + "], lambda x: x <> ''), ', ') AS full_address FROM vf3_records")
def full_address(spark, d):
    return vf3(spark, d).select("rec_id", street.full_address(*ADDRESS).alias("full_address"))


def _compare_sql() -> str:
    at = lambda c, i: f"substr({c}, {i}, 1)"
    both = [f"({at('ssn', i)} <> 'X' AND {at('b', i)} <> 'X')" for i in range(1, 10)]
    overlap = " + ".join(f"CAST({x} AS INT)" for x in both)
    differ = " OR ".join(f"({x} AND {at('ssn', i)} <> {at('b', i)})" for i, x in enumerate(both, 1))
    return sql_rows() + f""", q AS (SELECT rec_id, ssn, lag(ssn) OVER (PARTITION BY last ORDER BY rec_id) AS b FROM k)
SELECT rec_id, CASE WHEN length(ssn) <> 9 OR length(b) <> 9 THEN 'unknown' WHEN {differ} THEN 'diff' WHEN {overlap} >= 4 THEN 'same' ELSE 'unknown' END AS verdict FROM q WHERE b IS NOT NULL"""


@query(_compare_sql())
def ssn_compare(spark, d):
    """Masked comparison of each row with the one before it of the same last name."""
    w = Window.partitionBy("last").orderBy("rec_id")
    k = normalize.known(rows_of(spark, d)).select("rec_id", "ssn", F.lag("ssn").over(w).alias("b")).where("b is not null")
    return k.select("rec_id", text.ssn_compare("ssn", "b").alias("verdict"))


# -- phase tables -----------------------------------------------------------------------------------------------------


@query(
    sql_rows() + """ SELECT rec_id, docids, CASE WHEN first = '' THEN '[Unknown]' ELSE first_name END AS first_name, CASE WHEN last = '' THEN '[Unknown]' ELSE last_name END AS last_name,
 array_to_string(list_filter([CASE WHEN first = '' THEN 'First Name' END, CASE WHEN last = '' THEN 'Last Name' END], lambda x: x IS NOT NULL), ' & ') AS unknown_field FROM n WHERE first = '' OR last = ''"""
)
def unknown_entries(spark, d):
    return normalize.unknown(rows_of(spark, d)).select("rec_id", "docids", "first_name", "last_name", "unknown_field")


_KNOWN = " AND ".join(f"lower(trim(coalesce({c}, ''))) NOT IN ('', '[unknown]')" for c in ("first_name", "last_name"))


@query(f"SELECT rec_id, first_name, last_name, social_security_number FROM vf3_records WHERE {_KNOWN} ORDER BY coalesce(first_name, ''), coalesce(last_name, ''), coalesce(social_security_number, ''), rec_id LIMIT 10000")
def sampler_topk(spark, d):
    return reports.sampler(vf3(spark, d)).select("rec_id", "first_name", "last_name", "social_security_number")


_KEYS = "\nUNION ALL ".join(
    [" SELECT idx, first, last, ssn, dob, 1 AS level, ssn AS key FROM k WHERE ssn_full", "SELECT idx, first, last, ssn, dob, 2, dob FROM k WHERE dob <> ''"]
    + [f"SELECT idx, first, last, ssn, dob, {n}, unnest(ids{n}) FROM k" for n, _ in VF3.id_levels]
)


@query(
    sql_rows() + f""", e AS ({_KEYS}), b AS (SELECT level, first, last, key, count(*) AS n FROM e GROUP BY ALL HAVING count(*) > 1),
r AS (SELECT level, n, row_number() OVER (PARTITION BY level ORDER BY n DESC, first, last, key) AS rank FROM b) SELECT level, rank, n FROM r WHERE rank <= 5"""
)
def hot_buckets(spark, d):
    return linkage.hot_buckets(normalize.known(rows_of(spark, d)))


@query(sql_rows(L12) + "SELECT root, count(*) AS n_rows, max(gs) AS g_ssn, max(gd) AS g_dob FROM g GROUP BY root")
def l12_clusters(spark, d):
    known = written(normalize.known(rows_of(spark, d)), "known")
    return linkage.level12(known).groupBy("root").agg(F.count(F.lit(1)).alias("n_rows"), F.max("g_ssn").alias("g_ssn"), F.max("g_dob").alias("g_dob"))


def _links(level: int):
    ok = "NOT (a.dob <> '' AND b.dob <> '' AND a.dob <> b.dob)"
    ok += " AND NOT (a.ssn <> '' AND b.ssn <> '' AND a.ssn <> b.ssn)" if level > 1 else ""
    sql = sql_rows() + f""", e AS (SELECT * FROM ({_KEYS}) x WHERE level = {level})
SELECT a.idx, count(DISTINCT b.idx) AS n_links FROM e a JOIN e b ON a.first = b.first AND a.last = b.last AND a.key = b.key AND a.idx <> b.idx AND {ok} GROUP BY a.idx"""

    def links(spark, d):
        return linkage.link_counts(normalize.known(rows_of(spark, d)), level)

    links.__name__ = f"links_l{level}"
    return query(sql)(links)


for _n in range(1, 7):
    _links(_n)


def _each(expr) -> str:
    return "\nUNION ALL ".join(expr(n) for n, _ in VF3.id_levels)


def _differ(a: str, b: str) -> str:
    return f"({a} <> '' AND {b} <> '' AND {a} <> {b})"


def _put(c: str, at: str, value: str) -> str:
    return f"CASE WHEN ok THEN list_concat({c}[1:{at} - 1], [{value}], {c}[{at} + 1:]) ELSE {c} END AS {c}"


# p: the known rows with ``top``, the root of all levels.  For every name that shares a token, rt lists its roots and what is known
# of each; the pairs of rows come in the order of level and row numbers, and st takes one pair of every name a step.
# ``since`` is the level at which a root was last enlarged first (0: at levels 1 and 2, 100: never): it is locked at later levels.
ALL_LEVELS = sql_rows(L12).replace("WITH z", "WITH RECURSIVE z", 1) + f""",
gk AS (SELECT min(idx) AS idx, first, last, root, ssn, dob, {', '.join(f'i{n} AS ids{n}' for n, _ in VF3.id_levels)}
  FROM (SELECT *, {', '.join(f'list_sort(ids{n}) AS i{n}' for n, _ in VF3.id_levels)} FROM g) x GROUP BY first, last, root, ssn, dob, mid, {', '.join(f'i{n}' for n, _ in VF3.id_levels)}),
e AS ({_each(lambda n: f"SELECT idx, first, last, root, ssn, dob, {n} AS level, unnest(ids{n}) AS key FROM gk")}),
pr AS (SELECT DISTINCT a.first, a.last, a.level, a.idx AS ia, b.idx AS ib, a.root AS xa, b.root AS xb FROM e a JOIN e b ON a.first = b.first AND a.last = b.last AND a.level = b.level
  AND a.key = b.key AND a.idx < b.idx AND a.root <> b.root AND NOT {_differ('a.ssn', 'b.ssn')} AND NOT {_differ('a.dob', 'b.dob')}),
rt AS (SELECT first, last, list(root ORDER BY root) AS roots, list(gs ORDER BY root) AS ssns, list(gd ORDER BY root) AS dobs, list(since ORDER BY root) AS since
  FROM (SELECT first, last, root, max(gs) AS gs, max(gd) AS gd, CASE WHEN count(*) > 1 THEN 0 ELSE 100 END AS since FROM g GROUP BY first, last, root) x
  WHERE (first, last) IN (SELECT (first, last) FROM pr) GROUP BY first, last),
sq AS (SELECT first, last, level, list_position(roots, xa) AS pa, list_position(roots, xb) AS pb, row_number() OVER (PARTITION BY first, last ORDER BY level, ia, ib) AS k FROM pr JOIN rt USING (first, last)),
st AS (SELECT first, last, CAST(0 AS BIGINT) AS k, CAST(range(1, len(roots) + 1) AS BIGINT[]) AS own, ssns, dobs, since, '' AS refused FROM rt
 UNION ALL SELECT first, last, k2, CASE WHEN ok THEN list_transform(own, lambda r: CASE WHEN r = hi THEN lo ELSE r END) ELSE own END,
  {_put('ssns', 'lo', "coalesce(nullif(ssns[lo], ''), ssns[hi])")}, {_put('dobs', 'lo', "coalesce(nullif(dobs[lo], ''), dobs[hi])")}, {_put('since', 'lo', 'least(since[lo], since[hi], level)')},
  CASE WHEN ra = rb OR ok THEN '' WHEN since[ra] < level AND since[rb] < level THEN 'lock' WHEN {_differ('ssns[ra]', 'ssns[rb]')} THEN 'ssn' ELSE 'dob' END
  FROM (SELECT *, least(ra, rb) AS lo, greatest(ra, rb) AS hi,
          ra <> rb AND NOT (since[ra] < level AND since[rb] < level) AND NOT {_differ('ssns[ra]', 'ssns[rb]')} AND NOT {_differ('dobs[ra]', 'dobs[rb]')} AS ok
        FROM (SELECT st.*, sq.k AS k2, sq.level, st.own[sq.pa] AS ra, st.own[sq.pb] AS rb FROM st JOIN sq ON st.first = sq.first AND st.last = sq.last AND sq.k = st.k + 1) y) w),
tops AS (SELECT unnest(roots) AS root, unnest(list_transform(own, lambda r: roots[r])) AS top FROM (SELECT * FROM st QUALIFY k = max(k) OVER (PARTITION BY first, last)) f JOIN rt USING (first, last)),
p AS (SELECT g.*, coalesce(tops.top, g.root) AS top FROM g LEFT JOIN tops ON g.root = tops.root)
"""


@query(ALL_LEVELS + "SELECT top AS root, count(*) AS n_rows FROM p GROUP BY top")
def greedy_clusters(spark, d):
    known = written(normalize.known(rows_of(spark, d)), "known")
    return linkage.clusters(known).groupBy("root").agg(F.count(F.lit(1)).alias("n_rows"))


# -- survivorship over the groups of levels 1 and 2 -------------------------------------------------------------------


_MERGED = ("docids", "email_address_personal", "work_related_information")


def _merged_sql() -> str:
    long = "\nUNION ALL ".join(f"SELECT root, idx, '{c}' AS c, {c} AS v FROM g" for c in _MERGED)
    norm = sql_text("t")
    pick = ", ".join(f"coalesce(max(CASE WHEN c = '{c}' THEN v END), '') AS {c}" for c in _MERGED)
    return sql_rows(L12) + f""", l AS ({long}), t AS (SELECT root, c, idx, unnest(string_split(v, ';')) AS t, unnest(range(len(string_split(v, ';')))) AS pos FROM l WHERE trim(coalesce(v, '')) <> ''),
m AS (SELECT *, {norm} AS norm, row_number() OVER (PARTITION BY root, c, {norm} ORDER BY idx, pos) AS r FROM t),
j AS (SELECT root, c, string_agg({sql_stripped('t')}, '; ' ORDER BY idx, pos) AS v FROM m WHERE r = 1 AND norm <> '' GROUP BY root, c)
SELECT root, {pick} FROM j GROUP BY root"""


@query(_merged_sql())
def merge_tokens(spark, d):
    return survivorship.merged_tokens(rooted(spark, d), "root", F.col("idx"), list(_MERGED))


def _full_sql(raw: str, norm: str) -> str:
    v = sql_stripped(raw)
    return f"coalesce(arg_min(CASE WHEN {norm} <> '' THEN {v} END, CASE WHEN {norm} <> '' THEN {{'a': -length({v}), 'b': idx}} END), '') AS {raw}"


def _vary(c: str) -> str:
    return f"coalesce(min(nullif({sql_text(c)}, '')) <> max(nullif({sql_text(c)}, '')), false)"


@query(
    sql_rows(L12) + f"""SELECT root, {_full_sql('first_name', 'first')}, {_full_sql('last_name', 'last')}, {_full_sql('middle_name', 'mid')}, {_full_sql('social_security_number', 'ssn')},
 {_vary('first_name')} OR {_vary('last_name')} AS names_differ, count(*) AS rows_merged, arg_min(unique_id, idx) AS unique_id FROM g GROUP BY root"""
)
def fullest(spark, d):
    """Fullest names and number, name variation, size and first source key of each group."""
    o = F.col("idx")
    return rooted(spark, d).groupBy("root").agg(
        *[survivorship.fullest(c, F.col(n), o).alias(c) for c, n in (("first_name", "first"), ("last_name", "last"), ("middle_name", "mid"), ("social_security_number", "ssn"))],
        (survivorship.varies("first_name") | survivorship.varies("last_name")).alias("names_differ"), F.count(F.lit(1)).alias("rows_merged"), F.min_by("unique_id", o).alias("unique_id"),
    )


@query(
    sql_rows(L12) + """, t AS (SELECT root, suf, count(*) AS n, arg_min(SUFFIX, {'a': -length(SUFFIX), 'b': idx}) AS raw, min(idx) AS first_idx FROM g WHERE suf <> '' GROUP BY root, suf),
r AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY n DESC, length(raw) DESC, first_idx) AS r FROM t) SELECT root, raw AS suffix FROM r WHERE r = 1""".replace('SUFFIX', sql_stripped('suffix'))
)
def suffix_mode(spark, d):
    return survivorship.suffix_mode(rooted(spark, d), "root", F.col("idx"))


_PART = sql_key("part")


@query(
    sql_rows(L12) + f""", o AS (SELECT root, idx, 0 AS pos, dob AS key FROM g UNION ALL SELECT root, idx, pos, {_PART} FROM (SELECT root, idx, unnest(range(len(string_split(dob_raw, ';')))) AS pos, unnest(string_split(dob_raw, ';')) AS part
  FROM g WHERE dob = '' AND dob_raw LIKE '%;%') p), f AS (SELECT *, row_number() OVER (PARTITION BY root, key ORDER BY idx, pos) AS r FROM o WHERE key <> '')
SELECT root, string_agg(substr(key, 5, 2) || '/' || substr(key, 7, 2) || '/' || substr(key, 1, 4), '; ' ORDER BY idx, pos) AS dob_shown FROM f WHERE r = 1 GROUP BY root"""
)
def dob_merge(spark, d):
    return survivorship.merged_dob(rooted(spark, d), "root", F.col("idx"))


_FILLED = " + ".join([*(f"CAST(max({c}) <> '' AS INT)" for c in ("ssn", "dob")), *(f"CAST(max(len(ids{n})) > 0 AS INT)" for n, _ in VF3.id_levels)])


@query(sql_rows(L12) + f"SELECT root, {_FILLED} AS evidence FROM g GROUP BY root")
def evidence_score(spark, d):
    flags = [F.max("ssn") != "", F.max("dob") != "", *[F.max(F.size(f"ids{n}")) > 0 for n, _ in VF3.id_levels]]
    return rooted(spark, d).groupBy("root").agg(survivorship.evidence(flags).alias("evidence"))


@query(sql_rows(L12) + "SELECT root, count(*) AS rows_merged FROM g GROUP BY root HAVING count(*) > 50 ORDER BY 2 DESC, 1")
def large_groups(spark, d):
    """Of the groups of levels 1 and 2, which SQL can say; ``large_groups_resolved`` has the persons of all levels."""
    return reports.large_groups(rooted(spark, d).groupBy("root").agg(F.count(F.lit(1)).alias("rows_merged")))


@query(sql_rows(L12) + "SELECT count(*) AS n_persons, CAST(sum(CASE WHEN rows_merged > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_merged, max(rows_merged) AS largest, CAST(sum(rows_merged) AS BIGINT) AS n_rows FROM (SELECT root, count(*) AS rows_merged FROM g GROUP BY root) m")
def run_summary(spark, d):
    """Of the groups of levels 1 and 2, which SQL can say; ``run_summary_resolved`` has the persons of all levels."""
    return reports.summary(rooted(spark, d).groupBy("root").agg(F.count(F.lit(1)).alias("rows_merged")))


# -- the persons of all levels ----------------------------------------------------------------------------------------


@query()
def large_groups_resolved(spark, d):
    return reports.large_groups(final(spark, d)).select("root", "rows_merged")


@query()
def run_summary_resolved(spark, d):
    return reports.summary(final(spark, d))


@query()
def docid_chunks(spark, d):
    """Merged docids of each person in pieces of at most 200 characters."""
    return final(spark, d).select("root", F.posexplode(survivorship.chunks("docids", 200)).alias("piece", "docids"))


_NEW = PROFILES["new"]
_NEW_KEYS = "\nUNION ALL ".join(
    ["SELECT *, 1 AS level, ssn AS key FROM k WHERE ssn <> ''", "SELECT *, 2, dob FROM k WHERE dob <> ''", *(f"SELECT *, {n}, unnest(ids{n}) FROM k" for n, _ in _NEW.id_levels)]
)
_FREE_KEY = lambda c: f"coalesce(strftime({sql_date(c)}, '%Y%m%d'), '')"
_MIDDLE = "(a.mid = '' OR b.mid = '' OR starts_with(a.mid, b.mid) OR starts_with(b.mid, a.mid))"
# The same walk as in ALL_LEVELS from single rows on, through all levels, with masked numbers and the guard on middle names.
_NEW_SQL = f"""WITH RECURSIVE z AS (SELECT rec_id AS idx, {sql_name('first_name')} AS first, {sql_name('last_name')} AS last, {sql_name('middle_name')} AS mid, {SSN} AS ssn,
  {_FREE_KEY('full_date_of_birth')} AS d1, {_FREE_KEY('dobs')} AS d2, {', '.join(f'{sql_tokens(c)} AS ids{n}' for n, c in _NEW.id_levels)} FROM new_records),
k AS (SELECT *, CASE WHEN d1 <> '' THEN d1 ELSE d2 END AS dob FROM z WHERE first <> '' AND last <> ''),
e AS ({_NEW_KEYS}),
pr AS (SELECT DISTINCT a.first, a.last, a.level, a.idx AS xa, b.idx AS xb FROM e a JOIN e b ON a.first = b.first AND a.last = b.last AND a.level = b.level AND a.key = b.key AND a.idx < b.idx
  AND {_MIDDLE} AND NOT {_differ('a.dob', 'b.dob')} AND (a.level = 1 OR NOT {_differ('a.ssn', 'b.ssn')})),
rt AS (SELECT first, last, list(idx ORDER BY idx) AS roots, list(ssn ORDER BY idx) AS ssns, list(dob ORDER BY idx) AS dobs FROM k
  WHERE (first, last) IN (SELECT (first, last) FROM pr) GROUP BY first, last),
sq AS (SELECT first, last, level, list_position(roots, xa) AS pa, list_position(roots, xb) AS pb, row_number() OVER (PARTITION BY first, last ORDER BY level, xa, xb) AS n FROM pr JOIN rt USING (first, last)),
st AS (SELECT first, last, CAST(0 AS BIGINT) AS n, CAST(range(1, len(roots) + 1) AS BIGINT[]) AS own, ssns, dobs, list_transform(roots, lambda r: 100) AS since FROM rt
 UNION ALL SELECT first, last, n2, CASE WHEN ok THEN list_transform(own, lambda r: CASE WHEN r = hi THEN lo ELSE r END) ELSE own END,
  {_put('ssns', 'lo', "coalesce(nullif(ssns[lo], ''), ssns[hi])")}, {_put('dobs', 'lo', "coalesce(nullif(dobs[lo], ''), dobs[hi])")}, {_put('since', 'lo', 'least(since[lo], since[hi], level)')}
  FROM (SELECT *, least(ra, rb) AS lo, greatest(ra, rb) AS hi,
          ra <> rb AND NOT (since[ra] < level AND since[rb] < level) AND NOT {_differ('ssns[ra]', 'ssns[rb]')} AND NOT {_differ('dobs[ra]', 'dobs[rb]')} AS ok
        FROM (SELECT st.*, sq.n AS n2, sq.level, st.own[sq.pa] AS ra, st.own[sq.pb] AS rb FROM st JOIN sq ON st.first = sq.first AND st.last = sq.last AND sq.n = st.n + 1) y) w),
tops AS (SELECT unnest(roots) AS idx, unnest(list_transform(own, lambda r: roots[r])) AS top FROM (SELECT * FROM st QUALIFY n = max(n) OVER (PARTITION BY first, last)) f JOIN rt USING (first, last))
SELECT coalesce(top, k.idx) AS root, count(*) AS n_rows FROM k LEFT JOIN tops ON k.idx = tops.idx GROUP BY 1"""


@query(_NEW_SQL)
def greedy_clusters_new(spark, d):
    """The persons of profile new: no closed form, masked numbers confirm, middle names guard."""
    rows = normalize.normalized(spread(table(spark, d, "new_records"), "rec_id"), _NEW)
    return linkage.clusters(written(normalize.known(rows), "known"), _NEW).groupBy("root").agg(F.count(F.lit(1)).alias("n_rows"))


@query(ALL_LEVELS + "SELECT guard, CAST(count(refused) AS BIGINT) AS n FROM (VALUES ('lock'), ('ssn'), ('dob')) v(guard) LEFT JOIN st ON refused = guard GROUP BY guard")
def union_refusals(spark, d):
    """Pairs that a level matches and a guard keeps apart, by guard."""
    return linkage.refusals(written(normalize.known(rows_of(spark, d)), "known"))


_KEY_SQL = f"""SELECT rec_id, street AS a0, base AS a_base, unit AS a_unit, {sql_text('city')} AS a1, {sql_text('state_of_residence')} AS a2, {sql_text('province_of_residence')} AS a3,
 {_ZIP} AS a4, {sql_text('country_of_residence')} AS a5"""


@query(_PLAIN + STREETS + _KEY_SQL + " FROM s")
def address_keys(spark, d):
    return normalize.with_address_key(vf3(spark, d)).select("rec_id", "a0", "a_base", "a_unit", "a1", "a2", "a3", "a4", "a5")


@query(
    _PLAIN + STREETS + f""", t AS ({_KEY_SQL}, {sql_name('last_name')} AS last FROM s),
q AS (SELECT *, {', '.join(f'lag({c}) OVER b AS {c}_b' for c in ('rec_id', 'a0', 'a_base', 'a_unit', 'a1', 'a2', 'a3', 'a4', 'a5'))} FROM t WHERE last <> '' WINDOW b AS (PARTITION BY last ORDER BY rec_id))
SELECT rec_id, rec_id_b AS before, ({' OR '.join(_differ(f'a{i}', f'a{i}_b') for i in range(1, 6))} OR ({_differ('a0', 'a0_b')} AND NOT (a_base <> '' AND a_base = a_base_b AND NOT {_differ('a_unit', 'a_unit_b')}))) AS apart FROM q WHERE rec_id_b IS NOT NULL"""
)
def address_conflicts(spark, d):
    """Each row's address against the one before it of the same last name."""
    rows = normalize.with_address_key(text.with_names(vf3(spark, d), last="last_name")).where("last <> ''")
    w, parts = Window.partitionBy("last").orderBy("rec_id"), ("a0", "a_base", "a_unit", "a1", "a2", "a3", "a4", "a5")
    rows = rows.select("rec_id", *parts, F.lag("rec_id").over(w).alias("before"), *[F.lag(c).over(w).alias(f"{c}_b") for c in parts]).where("before is not null")
    return rows.select("rec_id", "before", address.conflict({c: F.col(c) for c in parts}, {c: F.col(f"{c}_b") for c in parts}).alias("apart"))


_AT = lambda side: [f"{side}.k[{i}]" for i in range(1, 9)]
_APART = " OR ".join(
    ["({0} <> '' AND {3} <> '' AND {0} <> {3} AND NOT ({1} <> '' AND {1} = {4} AND NOT {u}))".format(*_AT("a")[:3], *_AT("b")[:3], u=_differ(_AT("a")[2], _AT("b")[2]))]
    + [_differ(x, y) for x, y in zip(_AT("a")[3:], _AT("b")[3:])]
)
# y: distinct address keys of a person in order of the first row; cl: the cluster of each; fc: the fullest cells of each cluster
_SPLIT = ALL_LEVELS + f""", {STREETS}, q AS (SELECT p.top, s.idx, [s.street, s.base, s.unit, {sql_text('s.city')}, {sql_text('s.state_of_residence')}, {sql_text('s.province_of_residence')},
   {_ZIP.replace('zip_code', 's.zip_code')}, {sql_text('s.country_of_residence')}] AS k, [{", ".join(sql_stripped('s.' + c) for c in ADDRESS)}] AS raw FROM s JOIN p ON s.idx = p.idx),
y AS (SELECT top, k, count(*) AS n, min(idx) AS pos, arg_min(raw, idx) AS raw, array_to_string(k, '') <> '' AS filled FROM q GROUP BY top, k),
lk AS (SELECT a.top, a.pos AS i, b.pos AS j FROM y a JOIN y b ON a.top = b.top AND a.filled AND b.filled AND NOT ({_APART})),
cc AS (SELECT top, pos AS i, pos AS c FROM y UNION SELECT cc.top, lk.j, cc.c FROM cc JOIN lk ON cc.top = lk.top AND cc.i = lk.i),
cl AS (SELECT y.*, m.c FROM y JOIN (SELECT top, i, min(c) AS c FROM cc GROUP BY top, i) m ON y.top = m.top AND y.pos = m.i),
fc AS (SELECT top, c, sum(n) AS n, bool_or(filled) AS filled, {", ".join(f"coalesce(arg_min(raw[{i}], {{'a': -length(raw[{i}]), 'b': pos}}) FILTER (k[{j}] <> ''), '') AS {c}" for i, j, c in zip(range(1, 7), (1, 4, 5, 6, 7, 8), ADDRESS))} FROM cl GROUP BY top, c),
o AS (SELECT *, row_number() OVER (PARTITION BY top ORDER BY filled DESC, n DESC, c) AS r, array_to_string(list_filter([{", ".join(ADDRESS)}], lambda x: x <> ''), ', ') AS told FROM fc)
SELECT top AS root, {", ".join(f"max(CASE WHEN r = 1 THEN {c} END) AS {c}" for c in ADDRESS)}, coalesce(string_agg(told, '; ' ORDER BY c) FILTER (r > 1 AND filled), '') AS other_address FROM o GROUP BY top"""


@query(_SPLIT)
def address_split(spark, d):
    return address.addresses(normalize.with_address_key(persons(spark, d)), "root")


SOURCES = {"new": "new_records"}  # the table of a profile, if not vf3_records


def _resolved(profile: str):
    def merged(spark, d):
        return pipeline.final_rows(pipeline.resolve(table(spark, d, SOURCES.get(profile, "vf3_records")), profile).merged)

    merged.__name__ = f"merged_{profile}"
    return query()(merged)


for _p in PROFILES:
    _resolved(_p)


@query()
def ambiguous_names(spark, d):
    return pipeline.resolve(vf3(spark, d)).ambiguous
