import pytest
from pyspark.sql import functions as F

from rowkin.functions import dates, street, text


def values(spark, cells, make):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    return [r[1] for r in make(df).orderBy("i").select("i", "o").collect()]


def column(f):
    return lambda df: df.withColumn("o", f("c"))


def test_norm_name(spark):
    cells = [" ann ", "ANN", "[Unknown]", "(unknown)", "N/A", "NMN", "X", None, "", "nan", "a  b", "J​​", "-"]
    assert values(spark, cells, column(text.norm_name)) == ["ANN", "ANN", "", "", "", "", "", "", "", "", "A B", "J", ""]
    staged = lambda df: text.with_names(df, o="c")
    assert values(spark, cells, staged) == values(spark, cells, column(text.norm_name))


def test_ssn(spark):
    cells = ["123-45-6789", "123-45-XXXX", "123-45-6xxx", "123-4*-####", "123-45-678", None, "unknown"]
    assert values(spark, cells, column(text.norm_ssn)) == ["123456789", "12345XXXX", "123456XXX", "1234XXXXX", "", "", ""]
    issues = values(spark, ["12X-XX-XXXX", "123-45-6789", "1234-XX", None], column(text.ssn_issue))
    assert issues == ["only 2 of 9 digits known", "", "", ""]


def test_ssn_compare(spark):
    df = spark.createDataFrame([("12345XXXX", "123456789"), ("12345XXXX", "123956789"), ("XXXXX6789", "12345XXXX"), ("", "123456789")], "a string, b string")
    assert [r[0] for r in df.select(text.ssn_compare("a", "b")).collect()] == ["same", "diff", "unknown", "unknown"]


def test_tokens(spark):
    assert values(spark, ["12345; 12346", "12345;12346", "a;A; ;b", None, ""], column(text.id_tokens)) == [["12345", "12346"], ["12345", "12346"], ["A", "B"], [], []]


@pytest.mark.parametrize(
    "cell,key",
    [
        ("1990-01-01", "19900101"), ("Jan 5, 1985", "19850105"), ("1985-1-5", "19850105"), ("01-05-1985", "19850105"), ("5-Jan-1985", "19850105"),
        ("1985-01-05 00:00:00", "19850105"), ("1985-01-05T00:00:00", "19850105"), ("1985-01-05T23:59:59.123Z", "19850105"), ("1/5/1985 12:00 AM", "19850105"), ("January 5 1985", "19850105"),
        ("5 January 1985", "19850105"), ("Jan. 5, 1985", "19850105"), ("01.05.1985", "19850105"), ("25.12.1985", "19851225"), ("25-12-1985", "19851225"), ("1/5/85", "19850105"), ("5-Jan-85", "19850105"),
        ("1/5/30", "20300105"), ("Sept 5th, 1985", "19850905"), ("Sat, Jan 5 1985", "19850105"), ("1985 jan 5", "19850105"), ("Jan 5", ""), ("Janet 5 1985", ""), ("13/13/1985", ""), ("99.99.1985", ""),
        ("1/5/1985", "19850105"), ("25/12/1985", "19851225"), ("20037", "19541109"), ("20037.5", "19541109"), ("1985", "19050607"), ("366", ""), ("367", "19010101"),
        ("XX/XX/1980", ""), ("00/00/0000", ""), ("", ""), (None, ""), ("1900-01-01", ""), ("02/30/1990", ""), ("10:30", ""), ("today", ""), ("999999", ""),
    ],
)
def test_dob(spark, cell, key):
    assert values(spark, [cell], column(dates.dob_key)) == [key]


def test_dob_issue(spark):
    got = values(spark, ["XX/XX/1980", "366", "1/1/1850", "", None, "1/1/1980", "nan"], column(dates.dob_issue))
    assert got == ["not a date", "serial number of a day up to 1900", "year up to 1900", "", "", "", ""]


def test_street(spark):
    cells = ["123 West Lane", "123 W Ln", "123 W Ln.", "203A West Shore Rd", "203 A West Shore Rd", "203 E West Shore", None, "", "5 Oak Street Apartment 3"]
    got = values(spark, cells, lambda df: street.with_street(df, "c", "o"))
    assert got == ["123 W LN"] * 3 + ["203 W SHORE RD UNIT A"] * 2 + ["203 E W SHORE", "", "", "5 OAK ST APT 3"]


def test_street_parts(spark):
    df = spark.createDataFrame([("123 ABC LN",), ("123 ABC LN APT 1",), ("9 Elm St #4",)], "c string")
    got = street.with_street(df, "c", "o", "base", "unit").select("base", "unit").collect()
    assert [tuple(r) for r in got] == [("123 ABC LN", ""), ("123 ABC LN", "APT 1"), ("9 ELM ST", "#4")]


def test_zip_and_address(spark):
    assert values(spark, ["62701-1234", "62701", "K1A 0B1", None, "123"], column(street.zip_key)) == ["62701", "62701", "K1A 0B1", "", "123"]
    df = spark.createDataFrame([("123 ABC Ln", "Springfield", "IL", "", "62701", "USA")], "a string, b string, c string, d string, e string, f string")
    assert df.select(street.full_address(*df.columns)).first()[0] == "123 ABC Ln, Springfield, IL, 62701, USA"


def test_whole_numbers(spark):
    assert values(spark, ["123.0", "123.5", "abc", None], column(text.whole_number_text)) == ["123", "123.5", "abc", None]


def test_nfkc(spark):
    assert values(spark, ["Ａｎｎ", None], column(lambda c: F.upper(text.nfkc(c)))) == ["ANN", None]
