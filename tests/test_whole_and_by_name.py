"""Results without cuts, files matched by name, scans that read what they need."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnlake.__main__ import main
from tarnlake.operators import enrich, enrich_sql, latest_per_key, row_number_desc
from tarnlake.plans import build_report
from tarnlake.schemas import METHOD_COLUMNS, SAMPLE_COLUMNS, SAMPLES, SITE_COLUMNS
from tarnlake.session import work_folder
from tarnlake.sources import delimited_stream, read_delimited, redelimit
from tarnlake.streaming import BatchStore, drain, store_batch

KEPT = StructType().add("id", "integer").add("name", "string").add("day", "date")


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("more;DAY;name;ID\nx;2020-01-02; a ;1\ny;bad;b;z\n")
    df = read_delimited(spark, str(tmp_path), KEPT)
    assert df.columns == ["id", "name", "day"]
    assert sorted(map(tuple, df.collect()), key=str) == [(1, " a ", datetime.date(2020, 1, 2)), (None, "b", None)]
    with pytest.raises(ValueError, match="missing"):
        read_delimited(spark, str(tmp_path), StructType().add("other", "integer"))


def test_stream_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("PROGRAM_ID,SITE_ID\nP,S\n")
    schema = StructType().add("SITE_ID", "string").add("PROGRAM_ID", "string")
    target = work_folder(spark, "out")
    rows = delimited_stream(spark, str(tmp_path), schema)
    writer = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", work_folder(spark, "p"))
    drain(writer.trigger(availableNow=True).start(), 60)
    assert [r.asDict() for r in spark.read.parquet(target).collect()] == [{"SITE_ID": "S", "PROGRAM_ID": "P"}]


def test_values_pass_through_another_delimiter(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a;b\n"say ""hi"", now";" x "\n"two\nlines";y\n')
    target = work_folder(spark, "csv")
    redelimit(spark, str(tmp_path / "a.csv"), target, multi_line=True)
    rows = read_delimited(spark, target, sep=",", multi_line=True).collect()
    assert sorted(map(tuple, rows)) == [('say "hi", now', " x "), ("two\nlines", "y")]


def test_metrics_read_few_columns(spark):
    folder = work_folder(spark, "wide")
    spark.createDataFrame([], SAMPLES).write.mode("overwrite").parquet(folder)
    samples = spark.read.parquet(folder)
    sites = spark.createDataFrame([], "SITE_ID string, PROGRAM_ID string, UPDATE_DATE string")
    methods = spark.createDataFrame([], "PROGRAM_ID string, END_YEAR string")
    report = build_report(samples, sites, methods, sample_tie_break=("TIME_SMP",), ties_are_unique=True)
    plan = report.metrics._jdf.queryExecution().optimizedPlan().toString()
    read = plan[plan.rindex("Relation") :]
    scan = report.metrics._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1].split("\n")[0]
    assert read and scan.count(":") <= 7


def test_both_forms_of_the_newest_row_agree(spark):
    rows = [("a", "2020-01-01", 1, {"x": 1}), ("a", "2020-01-01", 2, {"y": 2, "b": 3}), ("b", None, 3, None)]
    df = spark.createDataFrame(rows, "k string, d string, tie int, m map<string,int>")
    got = [sorted(map(str, latest_per_key(df, ["k"], "d", ["tie"], unique).collect())) for unique in (False, True)]
    assert got[0] == got[1] and latest_per_key(df, ["k"], "d", []).count() == 2
    assert row_number_desc(df, ["K"], "D", ["tie"]).dtypes[-1] == row_number_desc(df, ["k"], "d", ["tie"], rows_per_task=1).dtypes[-1]


@pytest.mark.parametrize("form", [enrich, enrich_sql])
def test_tables_may_share_column_names(spark, form):
    samples = spark.createDataFrame([("s", "p", "here")], "SITE_ID string, PROGRAM_ID string, STATE string")
    sites = spark.createDataFrame([("s", "p", "there", 1)], "SITE_ID string, PROGRAM_ID string, state string, METHOD int")
    methods = spark.createDataFrame([("p", "m")], "PROGRAM_ID string, METHOD string")
    joined = form(samples, sites, methods)
    assert joined.first().asDict() == {
        "SITE_ID_LTM": "s", "PROGRAM_ID_LTM": "p", "STATE": "here", "PROGRAM_ID_METHODE": "p", "METHOD": "m",
        "SITE_ID_SITE": "s", "PROGRAM_ID_SITE": "p", "state_SITE": "there", "METHOD_SITE": 1,
    }
    joined.write.mode("overwrite").parquet(work_folder(spark, "joined"))


def test_ledger_bounds_in_an_hour_that_a_zone_skips(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        batch = spark.sql("SELECT 's' AS SITE_ID, t FROM VALUES (timestamp_ntz'2024-03-31 02:30:00'), (timestamp_ntz'2024-03-31 02:45:00') AS v(t)")
        store = BatchStore(work_folder(spark, "store"))
        store_batch(batch, 0, store, "t")
        row = store.ledger(spark, batch.schema["t"].dataType).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row.min_datestamp, row.max_datestamp) == (datetime.datetime(2024, 3, 31, 2, 30), datetime.datetime(2024, 3, 31, 2, 45))


def test_report_stores_the_whole_reconciliation_and_the_log(spark, tmp_path, capsys):
    def lines(columns, *rows):
        return "\n".join([";".join(columns), *(";".join(r.get(c, "") for c in columns) for r in rows)]) + "\n"

    sample = {"SITE_ID": "A", "PROGRAM_ID": "P", "DATE_SMP": "2020-01-01 00:00:00", "PH_LAB": "5,5"}
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text(lines(SAMPLE_COLUMNS, sample))
    (tmp_path / "sites.csv").write_text(lines(SITE_COLUMNS, *({"SITE_ID": f"B{i}", "PROGRAM_ID": "P"} for i in range(50))))
    (tmp_path / "methods.csv").write_text(lines(METHOD_COLUMNS, {"PROGRAM_ID": "P", "END_YEAR": "2008"}))
    at = {n: work_folder(spark, n) for n in "messages store sites methods joined metrics progress p1 p2".split()}

    def run(*argv):
        main([str(a) for a in argv], spark)

    run("replay", "--source", tmp_path / "raw", "--sep", ";", "--target", at["messages"], "--checkpoint", at["p1"], "--timeout", 120)
    run("ingest", "--source", at["messages"], "--store", at["store"], "--checkpoint", at["p2"], "--timeout", 120, "--progress", at["progress"])
    assert spark.read.parquet(at["progress"]).select(F.sum("row_count")).first()[0] == 1
    run("load-dimensions", "--methods-file", tmp_path / "methods.csv", "--sites-file", tmp_path / "sites.csv",
        "--methods", at["methods"], "--sites", at["sites"])
    run("report", *(a for n in ("store", "sites", "methods", "joined", "metrics") for a in (f"--{n}", at[n])))
    missing = spark.read.parquet(f"{at['joined']}-reconciliation")
    assert missing.count() == 51 and missing.where("missing_in = 'samples'").count() == 50
