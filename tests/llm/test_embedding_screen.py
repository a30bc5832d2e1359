"""The screen lets go of no class with a link, and of nearly all without; what goes on is compared exactly."""

import math

import numpy as np
import pyarrow as pa
import pytest

from tarnlake.llm import embeddings
from tarnlake.llm.common import prepare


def unit(x):
    return x / np.linalg.norm(x, axis=1)[:, None]


def cell(blobs, asking, asked):
    """Packed rows as a task gets them, of which the last one asks where chunks differ."""
    tables = [pa.Table.from_batches([b]).append_column("member", pa.array([k == 0])) for k, b in enumerate(blobs)]
    table = pa.concat_tables(tables)
    return table.append_column("asking", pa.array([asking] * len(table))).append_column("asked", pa.array([asked] * len(table)))


@pytest.mark.parametrize(("region", "visits", "dense"), [(10**9, 1 << 22, False), (16, 1 << 22, False), (16, 100, False), (16, 1 << 22, True)])
def test_codes_that_come_near_as_all_pairs(monkeypatch, region, visits, dense):
    monkeypatch.setattr(embeddings, "REGION", region)
    monkeypatch.setattr(embeddings, "REGION_VISITS", visits)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 24)) * 30
    x = np.concatenate([x, x[:200] + rng.normal(size=(200, 24)) * rng.choice([3, 8, 12], 200)[:, None]])
    if dense:
        x = x[0] + rng.integers(-1, 2, size=x.shape)
    codes = np.rint(np.clip(x, -127, 127)).astype(np.int8)
    n, reach, here = len(codes), 50.3, 3
    homes = np.where(rng.random(n) < 0.4, here, rng.integers(4, 9, n))
    away = ((codes[:, None].astype(float) - codes[None].astype(float)) ** 2).sum(axis=2)
    near = (away <= reach * reach) & ~np.eye(n, dtype=bool) & ((homes == here)[:, None] | (homes == here)[None, :])

    def packed(rows):
        return embeddings._packed(1, 24, np.ones(9, np.int64), [(np.full(len(rows), here), rows, homes[rows], codes[rows])])

    def found(blobs, asking=0, asked=0):
        return set(embeddings._near(cell(blobs, asking, asked), {(1, 24): reach}).column("class").to_pylist())

    want = set(np.flatnonzero(near.any(axis=1)).tolist())
    assert len(want) > 150 and found([packed(np.arange(n))]) == want
    chunks = [packed(rows) for rows in np.split(rng.permutation(n), [n // 3])]
    by_chunks = [found([chunks[j]] if i == j else [chunks[j], chunks[i]], i, j) for i in (0, 1) for j in (0, 1)]
    assert set().union(*by_chunks) == want


@pytest.mark.parametrize("width", [3, 40])
def test_codes_of_links_are_within_reach(width):
    rng = np.random.default_rng(width)
    sample = unit(rng.normal(size=(300, width)) * np.linspace(3, 0.1, width))
    directions = embeddings._directions(sample, rng)
    assert np.allclose(directions.T @ directions, np.eye(directions.shape[1]))
    layout = embeddings.Layout(sample[:2], np.ones(2, np.int64), directions, float(np.abs(sample @ directions).max()) / 200)
    x = unit(rng.normal(size=(2000, width)))
    y = unit(x + rng.normal(size=x.shape) * 0.2 / math.sqrt(width))
    linked = (x * y).sum(axis=1) >= 0.98
    apart = np.linalg.norm(layout.codes(x).astype(float) - layout.codes(y).astype(float), axis=1)
    assert linked.sum() > 500 and (apart[linked] <= layout.reach(math.sqrt(0.04))).all()


def test_only_classes_near_another_go_to_shards_with_their_vectors(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SHARD_SIZE", 400)
    rows = {}

    def counted(df, label, store=embeddings.stored):
        out = store(df, label)
        rows[label] = rows.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(embeddings, "stored", counted)
    rng = np.random.default_rng(21)
    base = unit(rng.normal(size=(3000, 48)))
    x = np.concatenate([base, unit(base[:50] + rng.normal(size=(50, 48)) * 0.01), unit(base[60] + rng.normal(size=(30, 48)) * 0.02)]).astype(np.float32)
    df = prepare(spark).createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    found = {r["vec_id"]: r["n_links"] for r in embeddings.embedding_dedup(df).collect()}
    y = unit(x.astype(np.float64))
    links = ((y @ y.T >= 0.98) & ~np.eye(len(x), dtype=bool)).sum(axis=1)
    assert [found[i] for i in range(len(x))] == links.tolist() and (links > 0).sum() > 100
    # Every class went to several shards before, with its vector and a graph's work in each.
    assert rows["vector-classes"] == len(x) and (links > 0).sum() <= rows["vector-shards"] < len(x) / 3


def test_links_at_the_threshold_over_shards_and_chunks_are_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SHARD_SIZE", 250)
    monkeypatch.setattr(embeddings, "CELL_SIZE", 60)
    monkeypatch.setattr(embeddings, "CODES_PER_CELL", 300)
    monkeypatch.setattr(embeddings, "REGION", 16)
    rng = np.random.default_rng(5)
    base = unit(rng.normal(size=(900, 32)))
    # Cosines on either side of the threshold.
    turned = [np.cos(a) * base[:200] + np.sin(a) * unit(base[200:400] - base[:200] * (base[:200] * base[200:400]).sum(axis=1)[:, None]) for a in (0.18, 0.2, 0.2005, 0.21)]
    x = np.concatenate([base, *turned, unit(base[0] + rng.normal(size=(150, 32)) * 0.02), np.repeat(base[5:9], 5, axis=0)]).astype(np.float32)
    df = prepare(spark).createDataFrame([(i, v.tolist(), 7) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    rows = {r["vec_id"]: r for r in embeddings.embedding_dedup(df).collect()}
    y = unit(x.astype(np.float64))
    near = (y @ y.T >= 0.98) & ~np.eye(len(x), dtype=bool)
    root = np.arange(len(x))
    while True:
        lower = np.minimum(root, np.where(near, root[None, :], len(x)).min(axis=1))
        if (lower == root).all():
            break
        root = lower
    assert [rows[i]["n_links"] for i in range(len(x))] == near.sum(axis=1).tolist()
    assert [rows[i]["component_id"] for i in range(len(x))] == root.tolist()
