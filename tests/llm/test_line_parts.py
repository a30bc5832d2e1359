"""Line dedup: parts hold a bounded number of line hashes, and rows hold their own lost keys only."""

from pyspark.sql import functions as F

from tarnlake.llm import lines
from tarnlake.llm.common import prepare


def table(spark, rows):
    return prepare(spark).createDataFrame(rows, "doc_id long, text string")


def test_unique_lines_are_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(lines, "PROBES_PER_TASK", 100)
    # One shared key; one id and one null id have many different or equal texts.
    rows = [(i, f"a line that all share\nonly row {i} has this line") for i in range(600)]
    rows += [(None, f"no row but {i} has this one") for i in range(600)] + [(None, "an equal text many times")] * 600
    rows += [(700, f"one id and text number {i}") for i in range(600)]
    df = table(spark, rows)
    texts = df.select(F.coalesce("doc_id", F.lit(lines.NULL_ID)).alias("doc"), F.xxhash64("text").alias("text_hash"), "text")
    hashes = lines.stored(lines.line_hashes(texts), "line-hashes")
    index, shards = lines.build_index(hashes)
    probes, copies = lines.dealt_probes(hashes, index, shards)
    sizes = [r["count"] for r in probes.groupBy("shard", "part").count().collect()]
    assert shards == 1 and sum(sizes) == 3000 and len(sizes) == copies.count() == 30 and max(sizes) <= 200
    kept = {(r["doc_id"], r["text"]): r["kept_text"] for r in lines.line_dedup(df).collect()}
    assert kept == {(i, t): t if i is None or i in (0, 700) else t.split("\n")[1] for i, t in rows}


def test_rows_without_an_id_hold_their_own_lost_keys_only(spark):
    rows = [(i, f"the shared line number {i}") for i in range(300)]
    rows += [(None, f"the shared line number {i}\nkept {i}") for i in range(300)] + [(None, "the shared line number 7\nkept 7")] * 40
    rows += [(400, f"the shared line number {i}") for i in range(300)]
    df = table(spark, rows)
    texts = df.select(F.coalesce("doc_id", F.lit(lines.NULL_ID)).alias("doc"), F.xxhash64("text").alias("text_hash"), "text")
    assert [r["n"] for r in lines.lost_lines(texts).groupBy(F.size("lost").alias("n")).count().collect()] == [1]
    found = lines.line_dedup(df).collect()
    assert len(found) == len(rows)
    for r in found:
        want = r["text"] if (r["doc_id"] or 400) < 400 or r["doc_id"] == 0 else "".join(r["text"].split("\n")[1:])
        assert r["kept_text"] == want
