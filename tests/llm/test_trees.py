"""Vantage-point trees: which shards a fingerprint is placed in."""

import numpy as np
import pytest

from tarnlake.llm import simhash


@pytest.mark.parametrize("radius", [0, 1, 2])
@pytest.mark.parametrize("leaves", [1, 30, 400])
def test_near_points_meet_where_one_is_at_home(radius, leaves):
    rng = np.random.default_rng(leaves + radius)
    mask = simhash.masks(3)[1]
    base = rng.integers(0, 2**63, 300, dtype=np.uint64) << np.uint64(1)
    near = [base ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) for _ in range(4)]
    points = np.unique(np.concatenate([base, *near, near[0] ^ near[1] ^ near[2]]))
    tree = simhash.Tree(points[rng.random(len(points)) < 0.7], mask, radius, leaves, rng)
    row, leaf, home = tree.place(points)
    assert sorted(row[home]) == list(range(len(points))) and len(set(zip(row.tolist(), leaf.tolist()))) == len(row)
    own = dict(zip(row[home].tolist(), leaf[home].tolist()))
    at = {}
    for r, place in zip(row.tolist(), leaf.tolist()):
        at.setdefault(r, set()).add(place)
    masked = points & np.uint64(mask)
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(masked ^ masked[i]) <= radius).tolist():
            assert own[i] in at[j] or own[j] in at[i]
    if radius <= 1:
        assert max(map(len, at.values())) <= 1 + radius * mask.bit_count()


def test_a_visit_leads_to_a_shard_of_a_point_one_bit_away():
    rng = np.random.default_rng(6)
    mask = simhash.masks(3)[0]
    points = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    tree = simhash.Tree(points, mask, 1, 500, rng)
    shard_of = lambda p: (lambda r, leaf, home: leaf[home][np.argsort(r[home])])(*tree.place(p))
    flips = [np.uint64(1 << b) for b in range(64) if mask >> b & 1]
    reached = np.stack([shard_of(points), *(shard_of(points ^ f) for f in flips)], axis=1)
    row, leaf, _ = tree.place(points)
    assert (reached[row] == leaf[:, None]).any(axis=1).all()


def test_batches_are_gathered(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(simhash, "PLACED_AT_ONCE", 5)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64())], ["fp"]) for n in (3, 0, 4, 1, 0)]
    assert [p.tolist() for p in simhash.gathered(iter(batches))] == [[0, 1, 2, 0, 1, 2, 3], [0]]
    assert list(simhash.gathered(iter([]))) == []
