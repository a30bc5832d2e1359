"""What a task holds is bounded in bytes, whatever the length of the vectors."""

import numpy as np

from tarnlake.llm import embeddings


def test_long_vectors_make_smaller_chunks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL_SIZE", 40)
    monkeypatch.setattr(embeddings, "CELL_BYTES", 12 * 64 * 10)
    placed = spark.range(100).selectExpr("id AS class", "1 AS label", "IF(id < 50, 4, 64) AS length", "0 AS shard")
    chunks = {r["length"]: r["chunks"] for r in embeddings._chunked(placed).select("length", "chunks").distinct().collect()}
    assert chunks == {4: 2, 64: 5}


def test_a_vector_longer_than_the_bound_is_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL_BYTES", 12)
    placed = spark.range(3).selectExpr("id AS class", "1 AS label", "8 AS length", "0 AS shard")
    assert {r["chunks"] for r in embeddings._chunked(placed).collect()} == {3}


def test_links_do_not_depend_on_what_is_held_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SHARD_SIZE", 50)
    rng = np.random.default_rng(12)
    base = rng.normal(size=(150, 24))
    x = np.concatenate([base, base[:60] + rng.normal(size=(60, 24)) * 0.1, base[:20] + rng.normal(size=(20, 24)) * 0.1]).astype(np.float32)
    df = spark.createDataFrame([(i, r.tolist(), i % 2) for i, r in enumerate(np.repeat(x, 2, axis=0))], "vec_id long, embedding array<float>, label int")
    whole = sorted(map(tuple, embeddings.embedding_dedup(df).collect()))
    monkeypatch.setattr(embeddings, "DISTANCES_AT_ONCE", 7)
    monkeypatch.setattr(embeddings, "CELL_BYTES", 12 * 24 * 30)
    assert sorted(map(tuple, embeddings.embedding_dedup(df).collect())) == whole
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    links = ((unit @ unit.T >= 0.98) & ~np.eye(len(x), dtype=bool)).sum(axis=1)
    assert links.sum() > 0 and {r[0]: r[1] for r in whole} == {i: links[i // 2] for i in range(2 * len(x))}
