"""Planted links over several shards: every direct link and every component, against all pairs."""

import math

import numpy as np
import pytest

from tarnlake.llm import embeddings
from tarnlake.llm.common import prepare


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def planted(seed, n=2400, width=24):
    """Unlinked vectors, noisy copies of some, chains, a dense group, exact copies; two labels and none."""
    rng = np.random.default_rng(seed)
    base = unit(rng.normal(size=(n, width)))
    out = [base]
    few = base[:250]
    for copies in (1, 1, 2):
        out += [unit(few[rng.permutation(len(few))[:120]] + rng.normal(size=(120, width)) * 0.025) for _ in range(copies)]
    for start in range(300, 306):
        a, b = base[start], base[start + 1]
        b = unit(b - a * (a @ b))
        steps = np.arange(40) * math.acos(0.985)
        out.append(np.cos(steps)[:, None] * a + np.sin(steps)[:, None] * b)
    out.append(unit(base[400] + rng.normal(size=(200, width)) * 0.012))
    out.append(base[500:540])
    x = np.concatenate(out).astype(np.float32)
    labels = np.where(rng.random(len(x)) < 0.15, 2, 1).astype(object)
    labels[rng.random(len(x)) < 0.03] = None
    order = rng.permutation(len(x))
    return x[order], labels[order]


def all_pairs(x, labels, threshold):
    y = x.astype(np.float64)
    norms = np.linalg.norm(y, axis=1)
    near = (y @ y.T) / np.outer(norms, norms) >= threshold
    known = np.array([label is not None for label in labels])
    near &= (labels[:, None] == labels[None, :]) & known[:, None] & known[None, :]
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    while True:
        least = np.array([min(root[i], root[near[i]].min(initial=len(x))) for i in range(len(x))])
        if (least == root).all():
            return near.sum(axis=1), root
        root = least[least]


@pytest.mark.parametrize("seed", [0, 1])
def test_links_and_components_as_all_pairs(spark, monkeypatch, seed, caplog):
    monkeypatch.setattr(embeddings, "SHARD_SIZE", 300)
    monkeypatch.setattr(embeddings, "CELL_SIZE", 700)
    x, labels = planted(seed)
    rows = [(i, v.tolist(), labels[i]) for i, v in enumerate(x)]
    df = prepare(spark).createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    with caplog.at_level("INFO", logger="tarnlake.llm.embeddings"):
        found = {r["vec_id"]: r for r in embeddings.embedding_dedup(df).collect()}
    links, roots = all_pairs(x, labels, embeddings.THRESHOLD)
    assert (links > 0).sum() > 700 and len(found) == len(x)
    got = np.array([found[i]["n_links"] for i in range(len(x))])
    recall = np.minimum(got, links)[links > 0] / links[links > 0]
    assert (got <= links).all() and recall.mean() >= 0.995, recall.mean()
    missed = np.flatnonzero(np.array([found[i]["component_id"] for i in range(len(x))]) != roots)
    assert len(missed) <= 0.005 * (links > 0).sum(), len(missed)
    assert "recall" in caplog.text and "linked classes" in caplog.text
    print("mean recall", recall.mean(), "components off", len(missed))


def test_the_audit_counts_by_class(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "AUDIT_FIRST", 64)
    x, labels = planted(2, n=800)
    df = prepare(spark).createDataFrame([(i, i, 1 if labels[i] else 0, v.tolist(), 1) for i, v in enumerate(x)], "class long, key long, label int, vector array<float>, n long")
    links, _ = all_pairs(x, np.array([1 if label else 0 for label in labels], dtype=object), 0.98)
    whole = spark.createDataFrame([(i, int(n), i) for i, n in enumerate(links) if n], "class long, links long, with long")
    audit = embeddings.audit_recall(df, whole, 0.98)
    assert audit.recall == 1.0 and audit.linked >= embeddings.AUDIT_LINKED and audit.sample > 64
    # A dense group found whole does not hide that others are missed.
    dense = spark.createDataFrame([(i, int(n), i) for i, n in enumerate(links) if n > 100], "class long, links long, with long")
    assert embeddings.audit_recall(df, dense, 0.98).recall < 0.6
    assert embeddings.audit_recall(df.limit(0), whole, 0.98) == embeddings.Audit(1.0, 0, 0)
