"""A row repeated with a third of a source is taken in part, and one row closes."""

import random

import pytest

from tarnlake.llm import mixing
from tarnlake.llm.common import prepare

DOCS = "doc_id long, text string, source string, lang string"


@pytest.mark.parametrize("hot_id", [1000, 1003, None])
@pytest.mark.parametrize("unlike", [False, True])
def test_repeated_rows_come_near_the_target(spark, monkeypatch, hot_id, unlike):
    monkeypatch.setattr(mixing, "COPIES_PER_BUNDLE", 7)
    rng = random.Random(4)
    rows = []
    for number, source in enumerate(("a", "b", None)):
        own = [(1_000_000 * number + i, "w " * rng.randrange(5, 40), source, "en") for i in range(200)]
        rows += own + [(hot_id, "w " * 30, source, f"l{i % 20}" if unlike else None) for i in range(100)]
    df = prepare(spark).createDataFrame(rows, DOCS)
    found = mixing.mix(df).collect()
    assert sorted((r["doc_id"], r["text"], r["source"], r["lang"]) for r in found if r["doc_id"] is not None and r["lang"] and r["source"]) == sorted(
        r for r in rows if r[0] is not None and r[3] and r[2]
    ) and len(found) == len(rows)
    for source in ("a", "b", None):
        own = [r for r in found if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 15
        assert all(r["taken"] == r["copies"] * r["size"] for r in own)
    key = lambda r: str(tuple(r))
    assert sorted(map(key, mixing.mix(df.repartition(5)).collect())) == sorted(map(key, found))
