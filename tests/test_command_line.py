"""All jobs one after the other, as an operator would run them."""

import pytest

from tarnlake.__main__ import main
from tarnlake.schemas import METHOD_COLUMNS, SAMPLE_COLUMNS, SITE_COLUMNS
from tarnlake.session import work_folder


def lines(columns, *rows):
    return "\n".join([";".join(columns), *(";".join(r.get(c, "") for c in columns) for r in rows)]) + "\n"


@pytest.mark.parametrize("all_samples, expected", [(False, (6.5, 1)), (True, (6.0, 2))])
def test_from_file_to_metrics(spark, tmp_path, capsys, all_samples, expected):
    sample = {"SITE_ID": "A", "PROGRAM_ID": "P", "DATE_SMP": "2020-01-01 00:00:00", "PH_LAB": "5,5", "SO4_UEQ_L": "NA"}
    later = {**sample, "DATE_SMP": "2020-02-01 00:00:00", "PH_LAB": "6,5"}
    (tmp_path / "raw.csv").write_text(lines(SAMPLE_COLUMNS, sample, later))
    (tmp_path / "sites.csv").write_text(lines(SITE_COLUMNS, {"SITE_ID": "B", "PROGRAM_ID": "P"}))
    (tmp_path / "methods.csv").write_text(lines(METHOD_COLUMNS, {"PROGRAM_ID": "P", "END_YEAR": "2008"}))
    at = {n: work_folder(spark, n) for n in "clean messages store sites methods joined metrics progress p1 p2".split()}

    def run(*argv):
        main([str(a) for a in argv], spark)

    run("clean", "--source", tmp_path / "raw.csv", "--target", at["clean"])
    run("replay", "--source", at["clean"], "--target", at["messages"], "--checkpoint", at["p1"], "--timeout", 120)
    run("ingest", "--source", at["messages"], "--store", at["store"], "--checkpoint", at["p2"], "--timeout", 120)
    run("load-dimensions", "--methods-file", tmp_path / "methods.csv", "--sites-file", tmp_path / "sites.csv",
        "--methods", at["methods"], "--sites", at["sites"])
    run("report", *(a for n in ("store", "sites", "methods", "joined", "metrics") for a in (f"--{n}", at[n])),
        *(["--all-samples"] if all_samples else []))

    row = spark.read.parquet(at["metrics"]).first()
    assert (row.SITE_ID, row.YEAR, row.AVG_PH, row.AVG_SO4, row.TOTAL_SAMPLES) == ("A", 2020, expected[0], None, expected[1])
    shown = capsys.readouterr().out
    assert "SITE_ID" in shown and "missing_in" in shown


def test_create_tables_twice(spark):
    folder = work_folder(spark, "schema")
    for _ in range(2):
        main(["create-tables", "--schema", "tarn_cli", "--location", folder], spark)
    assert spark.table("tarn_cli.samples").dtypes[2] == ("DATE_SMP", "timestamp")
    assert spark.table("tarn_cli.ledger").count() == 0
    spark.sql("DROP SCHEMA tarn_cli CASCADE")
