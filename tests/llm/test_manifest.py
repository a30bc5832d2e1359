"""The Merkle manifest against a plain tree."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tarnlake.llm import manifest
from tarnlake.llm.common import prepare

ROWS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, grp string, rank int, `a.b` int"


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row):
    fields = [row[0], row[3], row[2], row[4], row[1]]
    return digest(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def climb(nodes, arity):
    """The root and each leaf's (left, right) steps."""
    steps, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(places):
            first = p - p % arity
            steps[i].append(("".join(nodes[first:p]), "".join(nodes[p + 1 : first + arity])))
        nodes = [digest(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
        places = [p // arity for p in places]
    return nodes[0], steps


def plain(rows, arity):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], arity) for g in order}
    root, above = climb([trees[g][0] for g in order], arity) if order else (None, [])
    out = []
    for g, top in zip(order, above):
        for x, steps in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            out.append((x[3], x[2], trees[g][0], root, tuple(steps + top)))
    return sorted(out, key=str)


def made(df):
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple(tuple(s) for s in r["proof"])) for r in df.collect()), key=str)


def table(spark, rows):
    return prepare(spark).createDataFrame([(*r, "x", "y", 1, 2) for r in rows], ROWS)


def odd_rows():
    rows = [(i, f"text {i}", "en", "s", i) for i in range(37)]
    rows += [(None, f"no id {i}", "en", None, None) for i in range(9)] + [(None, "same", "en", None, 1)] * 5
    rows += [(5, "text 5", "en", "s", 5)] * 3 + [(5, "other", "en", "s", 5), (5, None, "en", "s", 5), (5, "", "en", "s", 5), (5, "-", "en", "s", 5)]
    rows += [(1, "é" * 50_000, None, "s", 1), (2, "z", None, "s", 1), (8, "lone", "zz", "s", 1), (9, "lone", "é", "s", 1), (-3, "w", "", "", -1)]
    random.Random(2).shuffle(rows)
    return rows


@pytest.mark.parametrize(("arity", "digits"), [(2, 10), (2, 2), (3, 2), (2, 1)])
def test_odd_rows_in_blocks_of_all_sizes(spark, arity, digits):
    rows = odd_rows()
    got = manifest.merkle_manifest(table(spark, rows), arity=arity, digits=digits)
    assert made(got) == plain(rows, arity)
    folded = got.select((manifest.fold(F.col("leaf"), "proof") == F.col("root")).alias("ok"))
    assert {r["ok"] for r in folded.collect()} == {True}


def test_small_slices_rank_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(manifest, "ROWS_PER_SLICE", 7)
    rows = odd_rows()
    assert made(manifest.merkle_manifest(table(spark, rows), digits=3)) == plain(rows, 2)


def test_empty_one_row_and_carried_columns(spark):
    assert manifest.merkle_manifest(table(spark, [])).count() == 0
    one = [(7, "t", "en", "s", 1)]
    got = manifest.merkle_manifest(table(spark, one), carry={"grp": F.lower("text"), "proof 2": F.lit(1)}).collect()
    assert [(r["leaf"], r["subroot"], r["root"], r["proof"], r["grp"], r["proof 2"]) for r in got] == [(leaf(one[0]),) * 3 + ([], "t", 1)]


def test_a_changed_leaf_is_found(spark):
    rows = [(i, f"text {i}", "en" if i % 3 else "de", "s", i) for i in range(50)]
    got = manifest.merkle_manifest(table(spark, rows), carry={"wrong": F.sha2("text", 256)})
    verdicts = got.select((manifest.fold(F.col("wrong"), "proof") == F.col("root")).alias("ok"))
    assert {r["ok"] for r in verdicts.collect()} == {False}


def test_no_join_hands_out_the_proofs(spark):
    above = spark.createDataFrame([], "grp string, block long, proof array<struct<left:string,right:string>>, top struct<subroot:string,root:string>")
    nodes = spark.createDataFrame([], "grp string, n long, rank long, hash string, item struct<key:long>")
    blocks = manifest._rolled(nodes, 2, 3)
    plan = manifest._unrolled(blocks, above, 2, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
