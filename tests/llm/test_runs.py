"""Periodic runs against all periods of all stretches."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tarnlake.llm import runs
from tarnlake.llm.common import prepare
from tarnlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def brute(s, least):
    """Maximal stretches by period, the smallest period of equal ones."""
    found = {}
    for q in range(1, len(s) // 2 + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted([(a, n, q) for (a, n), q in found.items() if n >= max(least, 2 * q)], key=lambda r: (r[0], r[2]))


def collapsed(tokens, found):
    dropped = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(t for i, t in enumerate(tokens) if i not in dropped)


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(seed):
    rng = random.Random(seed)
    for _ in range(100):
        texts = []
        for _ in range(rng.randint(1, 8)):
            n, kinds = rng.choice([0, 1, 5, 12, 13, 30, 60, 120]), rng.choice([1, 2, 2, 3, 4, 30])
            t = [rng.randrange(kinds) for _ in range(n)]
            if rng.random() < 0.4 and n:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 10)
                t = [t[i] if i < a else t[a + (i - a) % p] for i in range(n)]
            texts.append(np.array(t, dtype=np.int64))
        least = rng.choice([1, 2, 3, 5, 12, 13])
        assert runs.runs_of(texts, least) == [brute(t.tolist(), least) for t in texts]


def test_words_rich_in_runs(monkeypatch):
    monkeypatch.setattr(runs, "LOOKS", 50)
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    thue = [bin(i).count("1") % 2 for i in range(300)]
    texts = [b, thue, [1] * 200, ([0] * 5 + [1]) * 40, ([0, 1] * 8 + [2]) * 9 + [0, 1] * 8]
    arrays = [np.array(t, dtype=np.int64) for t in texts]
    for least in (1, 12):
        assert runs.runs_of(arrays, least) == [brute(t, least) for t in texts]


def test_odd_texts(spark):
    long = "x y z " * 60_000
    texts = [None, "", " \n", "a b " * 6, " a\tB a B " * 3, long, "one two three", "a b " * 6, "q " * 11, "q " * 12 + "w"]
    schema = "doc_id long, text string, n_words int, runs string, `a.b` int"
    docs = prepare(spark).createDataFrame([(i if i != 4 else None, t, 1, "r", i) for i, t in enumerate(texts)], schema)
    got = {r["a.b"]: r for r in runs.word_runs(docs).collect()}
    assert runs.word_runs(docs).columns == ["doc_id", "a.b", "n_words", "runs", "longest", "collapsed"]
    for i, text in enumerate(texts):
        tokens = (text or "").split()
        want = [(0, len(tokens), 3)] if text == long else brute(tokens, 12)
        assert [tuple(r) for r in got[i]["runs"]] == want and got[i]["n_words"] == len(tokens)
        assert got[i]["collapsed"] == collapsed(tokens, want)
        assert (got[i]["longest"] and tuple(got[i]["longest"])) == max(want, key=lambda r: r[1], default=None)
    assert got[4]["doc_id"] is None and runs.word_runs(docs.limit(0)).count() == 0


def test_query_as_plain_python(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op12_word_runs"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(rows) == len(docs)
    with_runs = 0
    for d in docs:
        tokens, h = d["text"].encode().split(), zlib.crc32(str(d["doc_id"]).encode())
        n, g = len(tokens), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            tokens = [tokens[i] if i < a else tokens[a + (i - a) % p] for i in range(n)]
        if n > 1500:
            continue
        found = brute(tokens, 12)
        with_runs += bool(found)
        r = rows[d["doc_id"]]
        best = max(found, key=lambda f: f[1], default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        text = "".join(f"{a},{m},{q}\n" for a, m, q in found)
        assert r["runs_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed([t.decode() for t in tokens], found).encode()).hexdigest()
    assert with_runs > 50
