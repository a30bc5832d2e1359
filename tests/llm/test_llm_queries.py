"""Queries against their SQL, or against plain versions where SQL cannot express them."""

import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarnlake.llm import urls
from tarnlake.llm.queries import ORACLES, QUERIES, TOKENIZER
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.01"


def rows_of(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet").collect()


def result(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", ORACLES)
def test_query_agrees_with_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


def roots(links, n):
    at = list(range(n))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for i, j in links:
        at[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(n)]


def test_simhash_as_plain_python(spark):
    docs = sorted(rows_of(spark, "documents"), key=lambda r: r["doc_id"])
    prints = []
    for r in docs:
        words = r["text"].encode().lower().split()
        shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    u = np.array(prints, dtype=np.uint64)
    links = [(i, j) for i in range(len(u)) for j in (np.flatnonzero(np.bitwise_count(u[i + 1 :] ^ u[i]) <= 4) + i + 1).tolist()]
    want = {r["doc_id"]: (f"{p:016x}", docs[root]["doc_id"]) for r, p, root in zip(docs, prints, roots(links, len(docs)))}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in result(spark, "op1_simhash_dedup")} == want


def test_packing_round_trip(spark):
    pieces, docs = result(spark, "op7_packing"), rows_of(spark, "documents")
    tokenizer = Tokenizer.from_file(TOKENIZER)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for r in docs:
        ids = np.array([*tokenizer.encode(r["text"], add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for p in sorted(by_doc[r["doc_id"]], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            at += p["length"]
            assert zlib.crc32(ids[p["start"] : at].tobytes()) == p["ids_crc32"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == 4096 or (at < 4096 and at & (at - 1) == 0)


def test_shards_hold_all_rows_in_equal_numbers(spark):
    rows, docs = result(spark, "op8_sharding"), {r["doc_id"]: r["text"].encode() for r in rows_of(spark, "documents")}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {i: (len(t) + 1, zlib.crc32(t)) for i, t in docs.items()}
    shards = {}
    for r in rows:
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(shards) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in shards.values())
    sizes = [len(s) for s in shards.values()]
    assert max(sizes) - min(sizes) <= 1


def test_quality_counts_and_verdicts(spark):
    rows = {r["doc_id"]: r for r in result(spark, "op9_quality_rules")}
    docs, labels = rows_of(spark, "documents"), {r["doc_id"]: r["quality"] for r in rows_of(spark, "labels")}
    assert len(rows) == len(docs)
    for d in docs:
        words = d["text"].encode().split()
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = {w for w in windows if windows.count(w) > 1} if len(windows) < 400 else None
        r = rows[d["doc_id"]]
        lines = [x for x in d["text"].split("\n") if x.encode().split()]
        assert (r["n_words"], r["n_dup_lines"]) == (len(words), len(lines) - len(set(lines)))
        assert r["word_chars"] == sum(len(w.decode()) for w in words) and r["n_symbols"] == sum(d["text"].count(c) for c in "#*$%&|<>")
        if often is not None:
            assert r["n_repeat_words"] == len({i + k for i, w in enumerate(windows) if w in often for k in range(3)})
        assert r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    judged = [(labels[i], r["kept"]) for i, r in rows.items() if i in labels and not r["base_failed"]]
    good = [kept for label, kept in judged if label == 1]
    bad = [kept for label, kept in judged if label == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) < 0.7 * len(bad)


def test_embedding_links_as_brute_force(spark):
    rows = {r["vec_id"]: r for r in result(spark, "op3_embedding_dedup")}
    data = rows_of(spark, "embeddings")
    x = np.array([r["embedding"] for r in data], dtype=np.float64)
    cosine = (x @ x.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1))
    labels = np.array([r["label"] for r in data])
    near = (cosine >= 0.98) & (labels[:, None] == labels) & ~np.eye(len(x), dtype=bool)
    assert {r["vec_id"]: int(n) for r, n in zip(data, near.sum(axis=1))} == {i: r["n_links"] for i, r in rows.items()}


def test_url_parts_and_rules_as_plain_python(spark):
    rows = {r["page_id"]: r for r in result(spark, "op4_url_filter")}
    for page in rows_of(spark, "pages"):
        rest = page["url"].partition("://")[2]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(r), r, a) for a, r in urls.RULES if ("." + host).endswith("." + r.split("/")[0]) and path.startswith(r[r.index("/") :])]
        own, best = rows[page["page_id"]], max(fits, default=(0, None, None))
        assert (own["host"], own["path"], own["rule"]) == (host, path, best[1])
        assert own["verdict"] in ("allow", "block") and best[2] in (None, own["verdict"])


def test_license_lines_are_found(spark):
    found = {(r["doc_id"], r["license"]) for r in result(spark, "op5_license_scan")}
    notices = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0."}
    docs = rows_of(spark, "documents")
    for name, text in notices.items():
        assert {(d["doc_id"], name) for d in docs if text in d["text"]} == {f for f in found if f[1] == name}


def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    (_, quality), (_, lines), (_, simhash), (_, mixing), (_, packing) = p.STAGES
    kept = {r["doc_id"] for r in QUERIES["op9_quality_rules"](spark, SF_DIR).where("kept").collect()}
    first = quality(spark, docs, SF_DIR).persist()
    assert {r["doc_id"] for r in first.collect()} == kept and first.columns == docs.columns
    second = lines(spark, first, SF_DIR).persist()
    assert second.dtypes == docs.dtypes and second.count() == len(kept)
    key = lambda line: line.strip(" \t\n\x0b\f\r").encode().lower()
    seen = {}
    for r in sorted(first.collect(), key=lambda r: r["doc_id"]):
        for line in r["text"].split("\n"):
            seen.setdefault(key(line), r["doc_id"])
    want = {
        r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if len(key(x).decode()) < 10 or seen[key(x)] == r["doc_id"])
        for r in first.collect()
    }
    assert {r["doc_id"]: r["text"] for r in second.collect()} == want
    third = simhash(spark, second, SF_DIR).persist()
    ids = [r["doc_id"] for r in third.collect()]
    assert len(ids) == len(set(ids)) and set(ids) <= kept
    fourth = mixing(spark, third, SF_DIR).persist()
    assert fourth.columns == docs.columns and fourth.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    assert packing(spark, fourth, SF_DIR).where("start = 0").count() == fourth.count()


