import pytest

from rowkin.plans.profiles import PROFILES
from rowkin.sources import readers, writers
from rowkin.streaming import reviews


def test_csv(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('First Name , Last Name,Social Security Number\nAnn,NA,"1\n2"\nnull,Lee,\n')
    df = readers.read_csv(spark, str(path), ("first_name", "last_name"), number="row")
    assert [tuple(r) for r in df.orderBy("row").collect()] == [(0, "Ann", "", "1\n2"), (1, "", "Lee", "")]
    kept = readers.read_csv(spark, str(path), keep_literals=True).collect()
    assert kept[0]["last_name"] == "NA" and kept[1]["first_name"] == "null"
    with pytest.raises(ValueError, match="middle_name"):
        readers.read_csv(spark, str(path), ("middle_name",))


def test_headers():
    names = {
        "Full Date of Birth (MM/DD/YYYY)": "full_date_of_birth", "DOBs": "dobs", "State of Residence (if US)": "state_of_residence", "Driver's License Number": "drivers_license_number",
        "Government- Issued Identification": "government_issued_identification", "Government-Issued ID Number": "government_issued_id_number", "Phone Number - Personal": "phone_number_personal",
        "Access Credentials (Non-Financial Account)": "access_credentials_non_financial", "DL Issuing Province (if Canada)": "dl_issuing_province", "Unique_ID": "unique_id",
    }
    assert {h: readers.column_name(h) for h in names} == names
    assert readers.excel_engine("a.xlsb") in ("calamine", "pyxlsb") and set(PROFILES) == {"vf3", "alt_dob", "vf2", "vf", "new"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"')], "i long, s string")
    writers.write_tables({"t": df}, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p/t")).count() == 1
    writers.write_tables({"t": df}, str(tmp_path / "c"), "csv")
    assert readers.read_csv(spark, str(tmp_path / "c/t")).first()["s"] == 'a "b"'
    writers.write_csv(spark.createDataFrame([(" a ", "")], "first_name string, last_name string"), str(tmp_path / "b"), bom=True)
    assert next((tmp_path / "b").glob("part-*.csv")).read_bytes().startswith(b"\xef\xbb\xbf")
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "b"), ("first_name",)).collect()] == [(" a ", "")]
    assert writers.convert_to_xlsb("a", "b") is False


def test_shared_folder_is_demanded_off_one_machine(spark, monkeypatch):
    from rowkin import workspace

    assert workspace.shared_dir(spark)

    class Elsewhere:
        master, applicationId = "spark://host:7077", "x"
        getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda *a: None)}))

    session = type("S", (), {"sparkContext": Elsewhere, "conf": type("C", (), {"get": staticmethod(lambda *a: None)})})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_dir(session)
    big = spark.createDataFrame([("x" * 1000,)] * 5, "s string")
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(workspace.small(big, 5)) and "broadcast" not in plan(workspace.small(big, 4)) and "broadcast" not in plan(workspace.small(big, 5, 4000))


def test_streams_give_the_batch_rows(spark, sf, tmp_path):
    source = spark.read.parquet(f"{sf}/vf3_records.parquet")
    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "vf3_records.parquet").parquet(sf)
    for name, make in (("junk", reviews.junk_ssn_stream), ("lost", reviews.unknown_stream)):
        q = make(stream).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert spark.table(name).count() == make(source).count()
    q = reviews.arrivals(stream).writeStream.format("memory").queryName("arrived").outputMode("complete").option("checkpointLocation", str(tmp_path / "a")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("arrived").groupBy().sum("n_rows").first()[0] == source.where("received_at is not null").count()
