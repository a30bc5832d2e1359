"""The ring with bounded loads against a plain one that walks row by row."""

from collections import Counter

import pytest
import xxhash

from tarnlake.llm import sharding

SF_DIR = "/root/testdata/sf0.01"
BITS, NODES = 14, 64


def chained(*values):
    """XXH64 over values in turn, each seeded by the one before."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else v.to_bytes(4, "little"), seed)
    return seed >> (64 - BITS)


def plain_ring(ids, shards):
    """How many rows of each slot of the ring each shard takes, one row and one step at a time."""
    places = {}
    for shard in reversed(range(shards)):
        for node in range(NODES):
            places[chained("node", shard, node)] = shard

    def clockwise(slot):
        for step in range(1 << BITS):
            at = (slot + step) % (1 << BITS)
            if at in places:
                yield places[at]

    capacity = [len(ids) // shards + (s < len(ids) % shards) for s in range(shards)]
    load, taken, waiting = Counter(), Counter(), []
    for slot in sorted(chained(str(i)) for i in ids):
        own = next(clockwise(slot))
        if load[own] < capacity[own]:
            load[own] += 1
            taken[slot, own] += 1
        else:
            waiting.append(slot)
    for slot in waiting:
        shard = next(s for s in clockwise(slot) if load[s] < capacity[s])
        load[shard] += 1
        taken[slot, shard] += 1
    return taken


def placed(df, shards):
    return {r["doc_id"]: r["shard"] for r in sharding.shard_rows(df, "doc_id", "text", shards=shards).collect()}


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_each_shard_takes_the_rows_the_walk_gives_it(spark, shards):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    found = placed(df, shards)
    assert Counter((chained(str(i)), s) for i, s in found.items()) == plain_ring(list(found), shards)


def test_a_further_shard_takes_rows_and_moves_few_others(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "'t' AS text")
    old, new = placed(df, 16), placed(df, 17)
    moved = sum(old[i] != new[i] for i in old)
    assert 20_000 // 17 <= moved < 0.15 * 20_000
