"""Variant spellings of one person's name: trie join, then a check of the candidates.

1. Cells become name words by role (``name_parts``); rows alike in all that counts collapse into one record.
2. The distinct words are sharded into tries by their pieces and joined with themselves within a bounded edit distance
   (``trie_join``); known short forms add their links.
3. Two records are candidates if a word of one is a neighbour of a word of the other and they share a cell value that
   tells persons apart (number, date of birth, address ...).  The join key holds both, word and value, so neither a
   frequent name nor a frequent value makes a large group.
4. Candidates are checked: names are compared by role and in either order, other cells support or exclude the pair.
5. Linked records are consolidated (``components``), and rows of one person whose name cells are not written exactly
   alike come out as pairs.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import with_dob
from ..workspace import small, spread, written
from . import address_parts
from .components import components
from .name_parts import Matcher, Name, parsed, reach, tokens
from .trie_join import Trie, asked_in, held_in

ASKED = 100_000  # questions to tries that a task answers, or nearly so
FEW = 100_000  # split shards up to this number are broadcast
FORMS = 100_000  # most rows of short forms that are used as a whole

IDS = ("drivers_license_number", "passport_number", "government_issued_id_number", "employee_identification_number")
CELLS = ("first_name", "middle_name", "last_name", "suffix", "social_security_number", "residential_address", "city", "zip_code", "phone_number", "email_address_personal", *IDS)


class Person(NamedTuple):
    name: Name
    dob: str
    ssn: str
    email: str
    phone: frozenset
    ids: frozenset
    place: str
    town: str


def _ssn(cell) -> str:
    k = re.sub(r"[^0-9X]", "", re.sub(r"[*#?]", "X", cell.upper())) if isinstance(cell, str) else ""
    return k if len(k) == 9 and len(k.replace("X", "")) >= 4 and len(set(k)) > 1 else ""


def _parts(cell) -> list[str]:
    return [x for x in (re.sub(r"[^0-9A-Z@._+-]", "", p.upper()) for p in cell.split(";")) if x] if isinstance(cell, str) else []


def person(row: dict) -> Person:
    """What a row tells; placeholders and cells in no known notation tell nothing."""
    mail = [p for p in _parts(row["email_address_personal"]) if "@" in p]
    phones = {d[-10:] for d in (re.sub(r"\D", "", p) for p in _parts(row["phone_number"])) if len(d) >= 10 and len(set(d[-10:])) > 1}
    ids = {f"{k}{p}" for k, c in enumerate(IDS) for p in _parts(row[c]) if sum(x.isdigit() for x in p) >= 4 and len(set(p)) > 2}
    place = address_parts.parsed(row["residential_address"], row["city"], row["zip_code"])
    at = f"{place.number} {''.join(place.street)}" if place else ""
    town = f"{' '.join(place.city)}|{place.zip}" if place else ""
    name = parsed(row["first_name"], row["middle_name"], row["last_name"], row["suffix"])
    return Person(name, row["dob"] or "", _ssn(row["social_security_number"]), mail[0] if mail else "", frozenset(phones), frozenset(ids), at, town)


def evidence(p: Person) -> list[str]:
    """Values that two rows of a person may share; the first letter tells the kind."""
    out = [f"i{x}" for x in p.ids] + [f"p{x}" for x in p.phone]
    if p.ssn:
        out += [f"s{p.ssn}"] if "X" not in p.ssn else []
        out += [f"l{p.ssn[-4:]}"] if "X" not in p.ssn[-4:] else []
    out += [f"e{p.email}"] if p.email else []
    out += [f"d{p.dob}"] if p.dob else []
    out += [f"a{p.place}"] if p.place else []
    return sorted(out)


def coded(p: Person) -> str:
    """A record as one text, alike for records alike in all that counts."""
    n = p.name
    parts = [" ".join(n.first), " ".join(n.middle), " ".join(n.last), n.suffix, p.dob, p.ssn, p.email, ";".join(sorted(p.phone)), ";".join(sorted(p.ids)), p.place, p.town]
    return "\x1f".join(parts)


def decoded(code: str) -> Person:
    f, m, l, suffix, dob, ssn, email, phone, ids, place, town = code.split("\x1f")  # noqa: E741
    name = Name(tuple(f.split()), tuple(m.split()), tuple(l.split()), suffix)
    return Person(name, dob, ssn, email, frozenset(phone.split(";")) - {""}, frozenset(ids.split(";")) - {""}, place, town)


def same_person(a: Person, b: Person, m: Matcher) -> bool:
    """Whether other cells support that two records with neighbouring names are one person."""
    full = a.ssn and b.ssn and "X" not in a.ssn + b.ssn
    if full and a.ssn != b.ssn:
        return False
    if (full and a.ssn == b.ssn) or (a.email and a.email == b.email) or a.ids & b.ids:
        return True
    if a.email and b.email:
        return False
    for k in "0123":
        x, y = {i for i in a.ids if i[0] == k}, {i for i in b.ids if i[0] == k}
        if x and y:
            return False
    if a.ssn and b.ssn and any(x != y and "X" not in (x, y) for x, y in zip(a.ssn, b.ssn)):
        return False
    if a.dob and b.dob and a.dob != b.dob:
        return False
    if a.name.suffix and b.name.suffix and a.name.suffix != b.name.suffix:
        return False
    given, family = m.names(a.name, b.name)
    middle = m.part(a.name.middle, b.name.middle)
    phone, place = bool(a.phone & b.phone), bool(a.place) and a.place == b.place
    last4 = a.ssn and b.ssn and a.ssn[-4:] == b.ssn[-4:]
    if a.dob and a.dob == b.dob:
        if family >= 2:
            return given >= 1 or ((phone or place or last4) and (given == -1 or middle >= 2))
        if family == -1:
            return given >= 2 and (phone or place or bool(last4) or middle >= 2)
        return given >= 2 and (middle >= 2 or phone or place or bool(last4))
    if last4:
        return given >= 1 and family >= 2
    if middle == 0 or bool(a.name.suffix) != bool(b.name.suffix):  # father and son share all but this
        return False
    if given >= 2 and family >= 2:
        return phone or place
    return (given >= 1 and family >= 2 or given >= 2 and family >= 1) and phone and (place or middle >= 2)


def neighbours(words: DataFrame, most: int = ASKED) -> DataFrame:
    """(word, near): all ordered pairs of distinct ``words`` within the edit distance that ``reach`` allows, each word
    with itself included.

    Words are held in shards and ask shards (``trie_join``), a few of each per word.  A shard that more than ``most`` words ask is
    split: its questions are salted and its words copied to each salt.  Shards share tasks by hash.
    """

    def keyed(keys):
        def run(batches):
            for pdf in batches:
                got = [list(keys(w, reach)) for w in pdf["word"]]
                yield pd.DataFrame({"word": pdf["word"].repeat([len(g) for g in got]).to_numpy(), "key": np.array([k for g in got for k in g], dtype=np.int64)})

        return spread(words, "word").mapInPandas(run, "word string, key long")

    held, asked = keyed(held_in), written(keyed(asked_in), "asked")
    often = asked.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("key", F.ceil(F.col("n") / most).cast("int").alias("salts"))
    often = small(written(often, "often"), FEW)
    tasks = F.lit(max(1, -(-asked.count() // most)))
    asked = asked.join(often, "key", "left").withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("word"), F.col("salts"))))
    held = held.join(often, "key", "left").withColumn("salt", F.explode(F.when(F.col("salts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("salts") - 1))))
    task = F.pmod(F.xxhash64("key", F.col("salt").cast("int")), tasks).alias("task")
    asked, held = asked.select("word", "key", task), held.select("word", "key", task)

    def run(own: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        queries = queries[queries["key"].isin(own["key"])]
        if not len(queries):
            return pd.DataFrame({"word": [], "near": []}, dtype=str)
        own = own[own["key"].isin(queries["key"])]
        turned = lambda df: [w[::-1] if k & 1 else w for w, k in zip(df["word"], df["key"])]
        keys = np.sort(own["key"].unique())
        rows = sorted(set(zip(np.searchsorted(keys, own["key"].to_numpy()).tolist(), turned(own))))
        shard, texts = np.array([s for s, _ in rows]), [w for _, w in rows]
        of, asks = np.searchsorted(keys, queries["key"].to_numpy()), turned(queries)
        backwards = keys & 1
        out = set()
        for q, w, _ in Trie(texts, shard).near(asks, of, reach):
            turn = backwards[of[q]].tolist()
            out.update((asks[i][::-1], texts[j][::-1]) if t else (asks[i], texts[j]) for i, j, t in zip(q.tolist(), w.tolist(), turn))
        return pd.DataFrame(list(out), columns=["word", "near"])

    found = held.groupBy("task").cogroup(asked.groupBy("task")).applyInPandas(run, "word string, near string").where(F.col("word") != F.col("near"))
    turned = found.select(F.col("near").alias("word"), F.col("word").alias("near"))
    return found.unionByName(turned).unionByName(words.select("word", F.col("word").alias("near"))).distinct()


def form_links(matcher: Matcher) -> list[tuple[str, str]]:
    """Both directions of every two words that are forms of one given name, grouped by that name."""
    by_name: dict[str, set[str]] = {}
    for word, names in matcher.forms.items():
        for name in names:
            by_name.setdefault(name, set()).add(word)
    return sorted({(a, b) for own in by_name.values() for a in own for b in own if a != b})


def linked_records(rows: DataFrame, forms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rec_id, code) of the rows with a name, and (rec_a, rec_b) of records, one per code, found to be one person."""
    spark = rows.sparkSession
    short = [(r[0], r[1]) for r in forms.select("given_name", "short_form").where("given_name is not null and short_form is not null").distinct().limit(FORMS + 1).collect()]
    if len(short) > FORMS:
        raise ValueError(f"more than {FORMS} short forms")
    matcher = Matcher(short)

    def read(batches):
        for pdf in batches:
            got = [(r["rec_id"], coded(p)) for r in pdf.to_dict("records") if any((p := person(r)).name[:3])]
            yield pd.DataFrame(got, columns=["rec_id", "code"])

    slim = with_dob(rows.where(F.col("rec_id").isNotNull()).select("rec_id", "full_date_of_birth", *CELLS), "full_date_of_birth", "dob").drop("full_date_of_birth")
    people = written(spread(slim, "rec_id").mapInPandas(read, "rec_id long, code string"), "people")
    records = written(people.groupBy("code").agg(F.min("rec_id").alias("rec")), "records")

    def take(batches):
        for pdf in batches:
            ps = [decoded(c) for c in pdf["code"]]
            yield pd.DataFrame({"rec": pdf["rec"], "words": [tokens(p.name) for p in ps], "values": [evidence(p) for p in ps]})

    told = written(spread(records, "rec").mapInPandas(take, "rec long, words array<string>, values array<string>").where((F.size("words") > 0) & (F.size("values") > 0)), "told")
    near = neighbours(told.select(F.explode("words").alias("word")).distinct())
    alike = form_links(matcher)
    if alike:
        near = near.unionByName(spark.createDataFrame(alike, "word string, near string"))
    near = written(near, "near")
    shared = told.select(F.explode("values").alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("value")
    per_value = told.select("rec", "words", F.explode("values").alias("value")).join(shared, "value", "left_semi")
    each = written(per_value.select("rec", F.explode("words").alias("word"), "value"), "each")
    # a pair of words is followed from the rarer one only: a frequent name has hundreds of misspellings, each on few rows
    often = each.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    near = near.join(often, "word").join(often.select(F.col("word").alias("near"), F.col("n").alias("m")), "near")
    near = near.where((F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("word") <= F.col("near")))).select("word", "near")
    left = each.join(near, "word").select(F.col("rec").alias("a"), F.xxhash64("near", "value").alias("k"))
    right = each.select(F.col("rec").alias("b"), F.xxhash64("word", "value").alias("k"))
    met = left.join(right, "k").where(F.col("a") != F.col("b"))
    pairs = met.select(F.least("a", "b").alias("rec_a"), F.greatest("a", "b").alias("rec_b")).distinct()

    def check(batches):
        seen: dict[str, Person] = {}
        for pdf in batches:
            if len(seen) > 50_000:
                seen.clear()
            keep = []
            for a, b in zip(pdf["code_a"], pdf["code_b"]):
                pa, pb = (seen.get(c) or seen.setdefault(c, decoded(c)) for c in (a, b))
                keep.append(bool(same_person(pa, pb, matcher)))
            yield pdf[["rec_a", "rec_b"]][pd.Series(keep, index=pdf.index, dtype=bool)]

    both = pairs.join(records.select(F.col("rec").alias("rec_a"), F.col("code").alias("code_a")), "rec_a")
    both = both.join(records.select(F.col("rec").alias("rec_b"), F.col("code").alias("code_b")), "rec_b")
    return people, written(both.mapInPandas(check, "rec_a long, rec_b long"), "links")


def persons(rows: DataFrame, forms: DataFrame) -> DataFrame:
    """(rec_id, person_id) of every row with a name; person_id is the smallest rec_id of the person's records."""
    people, links = linked_records(rows, forms)
    records = people.groupBy("code").agg(F.min("rec_id").alias("rec"))
    groups = components(links).select(F.col("rec_id").alias("rec"), "group_id")
    of_code = records.join(groups, "rec", "left").select("code", F.coalesce("group_id", "rec").alias("person_id"))
    return people.join(of_code, "code").select("rec_id", "person_id")


def same_group_pairs(rows: DataFrame, group: str, cells: list[str]) -> DataFrame:
    """(rec_a, rec_b), rec_a < rec_b: rows of one group whose ``cells`` are not all written alike (null = '')."""
    side = rows.select("rec_id", group, F.to_json(F.array(*[F.coalesce(c, F.lit("")) for c in cells])).alias("_w"))
    a = side.select(group, F.col("rec_id").alias("rec_a"), F.col("_w").alias("_wa"))
    b = side.select(group, F.col("rec_id").alias("rec_b"), F.col("_w").alias("_wb"))
    return a.join(b, group).where((F.col("rec_a") < F.col("rec_b")) & (F.col("_wa") != F.col("_wb"))).select("rec_a", "rec_b")


NAME_CELLS = ["first_name", "middle_name", "last_name"]


def variant_pairs(rows: DataFrame, forms: DataFrame) -> DataFrame:
    """(rec_a, rec_b), rec_a < rec_b: rows of one person whose name cells are not all written exactly alike.

    Null is ''; rows without a real name or rec_id are no case; repeated rows (alike but for rec_id) pair with every other spelling;
    very long cells are read whole; empty tables give no row; other columns are ignored.
    """
    named = persons(rows, forms).join(rows.select("rec_id", *NAME_CELLS), "rec_id")
    return same_group_pairs(named, "person_id", NAME_CELLS)
