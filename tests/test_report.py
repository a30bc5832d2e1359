"""From JSON messages and dimension files to the metrics table, on the water-chemistry schema."""

import json

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import assert_not_empty, check_not_empty
from tarnlake.plans import build_report, clean_file, load_dimension, save_report
from tarnlake.schemas import METHOD_COLUMNS, METHODS, SAMPLE_COLUMNS, SAMPLES, SITE_COLUMNS, SITES
from tarnlake.session import work_folder
from tarnlake.sources import message_stream
from tarnlake.streaming import BatchStore, drain, ingest

BATCHES = [
    [("A", "P1", "2019-05-01", "7,5", "10", "1"), ("B", "P1", "2019-06-01", "6,5", "20", "2")],
    [
        ("A", "P1", "2020-05-01", "6,0", "49,77", "13.73"),
        ("A", "P1", "2020-07-01", "6,2", "50", "x"),
        ("C", "P2", "2020-06-01", "", "NaN", "<1"),
        ("D", "P3", "2020-06-15", "5,04", "46,67", "22,49"),
    ],
]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("in")
    for i, batch in enumerate(BATCHES):
        names = ("SITE_ID", "PROGRAM_ID", "DATE_SMP", "PH_LAB", "SO4_UEQ_L", "NO3_UEQ_L")
        lines = [json.dumps(dict(zip(names, (*r[:2], r[2] + " 12:00:00", *r[3:])))) for r in batch]
        folder = root / "messages"
        folder.mkdir(exist_ok=True)
        (folder / f"{i}.txt").write_text("\n".join(lines))
        import os

        os.utime(folder / f"{i}.txt", (1_700_000_000 + i, 1_700_000_000 + i))
    site = {"SITE_ID": "A", "PROGRAM_ID": "P1", "SITE_NAME": "old", "UPDATE_DATE": "2010-01-01"}
    sites = [site, {**site, "SITE_NAME": "new", "UPDATE_DATE": "2015-01-01"}, {**site, "SITE_ID": "C", "PROGRAM_ID": "P2"}, {**site, "SITE_ID": "Z"}]
    (root / "sites.csv").write_text(
        "\n".join([";".join(SITE_COLUMNS), *(";".join(s.get(c, "") for c in SITE_COLUMNS) for s in sites)])
    )
    (root / "methods.csv").write_text(
        "\n".join(
            [
                ";".join(METHOD_COLUMNS),
                "P1;PH;1990;2008;first;x",
                "P1;PH;2009;2015-12-31;second;x",
                "P1;SO4;1990;present;undated;x",
                "P3;PH;1990;2020;other;x",
            ]
        )
    )
    store = BatchStore(work_folder(spark, "store"))
    stream = message_stream(spark, str(root / "messages"), files_per_batch=1)
    drain(ingest(stream, SAMPLES, store, work_folder(spark, "progress")), 120)
    return {
        "samples": store.table(spark, SAMPLES).drop("batch_id"),
        "ledger": store.ledger(spark),
        "sites": load_dimension(spark, str(root / "sites.csv"), SITES, work_folder(spark, "sites")),
        "methods": load_dimension(
            spark, str(root / "methods.csv"), METHODS, work_folder(spark, "methods"), end_year_column="END_YEAR"
        ),
    }


def report_of(stored, **options):
    return build_report(
        stored["samples"], stored["sites"], stored["methods"].select(*METHOD_COLUMNS), stored["ledger"], **options
    )


def metrics(df):
    return {(r.SITE_ID, r.PROGRAM_ID, r.YEAR): (r.AVG_PH, r.AVG_SO4, r.AVG_NO3, r.TOTAL_SAMPLES) for r in df.collect()}


def test_dimension_has_the_end_year(stored):
    assert {r.end_date for r in stored["methods"].collect()} == {"2008", "2015", "pres", "2020"}


def test_joined_table(stored):
    joined = report_of(stored).joined
    expected = [c + "_LTM" if c in ("SITE_ID", "PROGRAM_ID") else c for c in SAMPLE_COLUMNS]
    expected += ["PROGRAM_ID_METHODE", *METHOD_COLUMNS[1:]]
    expected += [c + "_SITE" if c in ("SITE_ID", "PROGRAM_ID") else c for c in SITE_COLUMNS]
    assert joined.columns == expected and len(expected) == 67
    got = {r.SITE_ID_LTM: (r.SITE_NAME, r.METHOD) for r in joined.collect()}
    assert got == {"A": ("new", "second"), "C": ("old", None), "D": (None, None)}


def test_metrics_of_the_last_batch(stored):
    assert metrics(report_of(stored).metrics) == {
        ("A", "P1", 2020): (6.2, 50.0, None, 1),
        ("C", "P2", 2020): (None, None, None, 1),
        ("D", "P3", 2020): (5.04, 46.67, 22.49, 1),
    }


def test_yearly_means_over_all_samples(stored):
    got = metrics(report_of(stored, collapse_samples=False).metrics)
    assert got["A", "P1", 2020] == (pytest.approx(6.1), pytest.approx(49.885), 13.73, 2)


def test_reconciliation(stored):
    got = {tuple(r) for r in report_of(stored).reconciliation.collect()}
    assert got == {("sites", "D"), ("samples", "Z")}


def test_saving_again_replaces(spark, stored):
    report = report_of(stored)
    joined, target = work_folder(spark, "joined"), work_folder(spark, "metrics")
    for version in ("batch_0", "batch_1", "batch_1"):
        saved = save_report(report, joined, target, version)
    assert metrics(saved) == metrics(report.metrics)
    assert spark.read.parquet(joined).groupBy("version_id").count().agg(F.min("count"), F.max("count")).first() == (3, 3)


def test_checks(stored):
    result = report_of(stored).metrics
    assert_not_empty(result, "metrics")
    assert tuple(check_not_empty(result, "metrics").first()) == ("metrics is not empty", True, 3)
    none = result.filter("YEAR < 0")
    assert tuple(check_not_empty(none, "metrics").first()) == ("metrics is not empty", False, 0)
    looks = [check_not_empty(df, "metrics", counted=False) for df in (result, none)]
    assert [tuple(df.first()) for df in looks] == [("metrics is not empty", True), ("metrics is not empty", False)]
    assert "Limit 1" in looks[0]._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(AssertionError):
        assert_not_empty(none, "metrics")


def test_metrics_read_no_dimension(stored):
    plan = report_of(stored).metrics._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan


def test_clean_file(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("a;b;c\n1;x;2,5\n;NA;3\n")
    target = str(tmp_path / "clean")
    got = [tuple(r) for r in clean_file(spark, str(tmp_path / "raw.csv"), target).collect()]
    assert got == [(0, "a", "int", 1), (1, "b", "string", 1), (2, "c", "string", 0)]
    (tmp_path / "kinds.csv").write_text("i;l;d;day;t;b;none;mixed\n1;5000000000;2.5;2020-01-02;2020-01-02 03:04:05;true;;1\n-2;3;1e3;2021-01-02;2020-01-02T03:04:05;FALSE;NA;true\n")
    kinds = clean_file(spark, str(tmp_path / "kinds.csv"), f"{target}-kinds").select("data_type", "null_count").collect()
    assert [k[0] for k in kinds] == ["int", "bigint", "double", "date", "timestamp", "boolean", "string", "string"]
    assert [k[1] for k in kinds] == [0, 0, 0, 0, 0, 0, 2, 0]
    (tmp_path / "empty.csv").write_text("a;b\n")
    assert [tuple(r)[1:] for r in clean_file(spark, str(tmp_path / "empty.csv"), f"{target}-empty").collect()] == [("a", "string", 0), ("b", "string", 0)]
    assert sorted(map(tuple, spark.read.csv(target, header=True).collect()), key=str) == [("1", "x", "2,5"), (None, None, "3")]


def test_saving_with_reconciliation_reads_every_table_once(spark, stored, tmp_path):
    """What both results need is stored once: behind it, no plan reads a sample or site again."""
    report = report_of(stored)
    copies = [f"file:{tmp_path}/{n}" for n in ("samples", "sites")]
    for df, folder in zip(report.inputs, copies):
        df.write.parquet(folder)
    again = report.over(*[spark.read.parquet(c) for c in copies], report.inputs[2])
    for name in ("joined", "reconciliation", "metrics"):
        want, got = getattr(report, name), getattr(again, name)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.dtypes == want.dtypes
    assert {f.rpartition("/")[0].rpartition("/")[2] for f in again.reconciliation.inputFiles()} == {"samples", "sites"}
    joined, metrics, missing = (work_folder(spark, n) for n in ("joined", "metrics", "missing"))
    save_report(report, joined, metrics, "batch_1", missing)
    kept = spark.read.parquet(missing).drop("version_id")
    assert sorted(map(str, kept.collect())) == sorted(map(str, report.reconciliation.collect()))
