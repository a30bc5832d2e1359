"""Unequal odds inside a source, and columns named like the operator's own."""

import random

import pytest

from tarnlake.llm import mixing
from tarnlake.llm.common import prepare


def docs(spark, seed=1):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.randrange(20, 60), f"s{i % 3}", float(rng.choice([1, 1, 2, 8]))) for i in range(3000)]
    return rows, prepare(spark).createDataFrame(rows, "doc_id long, text string, source string, quality double")


def test_important_documents_are_taken_more_often(spark):
    rows, df = docs(spark)
    found = mixing.mix(df, importance="quality").collect()
    by_source = {}
    for r in found:
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        by_source.setdefault(r["source"], []).append(r)
    for own in by_source.values():
        target, sizes = own[0]["target"], sum(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - target) <= 60
        # The rate at which expected copies, held at three, make up the target.
        low, high = 0.0, 1000.0
        for _ in range(100):
            rate = (low + high) / 2
            low, high = (rate, high) if sum(r["size"] * min(3, rate * r["quality"]) for r in own) < target else (low, rate)
        if target < 3 * sizes - 1:
            for q in (1.0, 2.0, 8.0):
                some = [r for r in own if r["quality"] == q]
                mean = sum(r["copies"] for r in some) / len(some)
                assert mean == pytest.approx(min(3, rate * q), abs=0.12)
    again = mixing.mix(df.repartition(7), importance="quality").collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_odd_importance(spark):
    rows = [(i, "a b c", "s", q) for i, q in enumerate([None, -1.0, 0.0, 1.0, 1.0, 5.0])] + [(9, "", "t", 1.0), (10, "x", "t", None)]
    df = prepare(spark).createDataFrame(rows, "doc_id long, text string, source string, quality double")
    found = {r["doc_id"]: r["copies"] for r in mixing.mix(df, importance="quality").collect()}
    assert len(found) == len(rows) and found[0] == found[1] == found[2] == 0


def test_own_columns_pass_through(spark):
    names = ["__source", "__random", "__weight", "row", "rank", "weight", "random", "s", "rate", "cut", "k", "m", "a.b"]
    columns = ", ".join(f"`{n}` string" for n in names)
    rows = [(i, "a b " * (i % 5), f"s{i % 2}", *[f"{n}{i}" for n in names]) for i in range(40)]
    df = prepare(spark).createDataFrame(rows, f"doc_id long, text string, source string, {columns}")
    found = mixing.mix(df)
    assert found.columns[: 3 + len(names)] == df.columns
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in found.collect()} == {r[0]: r[3:] for r in rows}
