"""Nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import numpy as np
import pytest

from tarnlake.llm import chat, components, embeddings, licenses, lines, mixing, packing, quality, sharding, simhash, urls
from tarnlake.llm.common import prepare
from tarnlake.llm.queries import TOKENIZER

DOCS = "doc_id long, text string, source string, shard int, size long, n_lines long, row string, kept string"
LONG = "a long tale of many words that goes on " * 20_000
ODD = [
    (1, "one shared line here\nmine alone in here", "a", 9, 9, 9, "r", "k"),
    (2, "  ONE shared line HERE \t\nother", "a", 9, 9, 9, "r", "k"),
    (2, "  ONE shared line HERE \t\nother", "a", 9, 9, 9, "r", "k"),
    (3, "", None, None, None, None, None, None),
    (4, None, "b", None, None, None, None, None),
    (None, "one shared line here\nno id", None, 1, 1, 1, "x", "y"),
    (5, LONG, "c", 1, 1, 1, "x", "y"),
    (6, "plain <|endoftext|> text\x1cwith   odd   spaces, İstanbul ΣΑΣ é", "c", 1, 1, 1, "x", "y"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return prepare(spark).createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return prepare(spark).createDataFrame([], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_simhash(docs, none):
    rows = simhash.simhash_dedup(docs).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ODD) and by_id[3]["fingerprint"] == by_id[4]["fingerprint"] == "0" * 16
    assert by_id[4]["component_id"] == 3 and by_id[2]["component_id"] == 2
    assert simhash.simhash_dedup(none).count() == 0


def test_hot_shards_are_cut_without_losing_links(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    prints = np.unique(np.concatenate([base, *[base[:4] ^ (np.uint64(1) << np.uint64(b)) for b in range(60)]]))
    df = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    links = simhash.fingerprint_links(df, 4, leaf_size=20, cell_size=16)
    found = {r["node"]: r["root"] for r in components.components(links).collect()}
    at = list(range(len(prints)))
    find = lambda i: i if at[i] == i else find(at[i])
    for i in range(len(prints)):
        for j in (np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 4) + i + 1).tolist():
            at[find(j)] = find(i)
    groups = {}
    for i, p in enumerate(prints.view(np.int64).tolist()):
        groups.setdefault(find(i), set()).add(found.get(p, p))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(2, 60)]
    df = spark.createDataFrame([*chain, *star, (7, 7), (None, 3)], "a long, b long")
    found = {r["node"]: r["root"] for r in components.components(df).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 60)}}
    assert components.components(df.limit(0)).count() == 0


def test_lines(docs, none):
    kept = lines.line_dedup(docs)
    assert kept.columns == ["doc_id", "text", "source", "shard", "size", "row", "kept", "n_lines", "n_dropped", "kept_text"]
    rows = kept.collect()
    texts = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in rows}
    assert len(rows) == len(ODD) and texts[2] == (2, 1, "other") and texts[None] == (2, 1, "no id")
    assert texts[1] == (2, 0, ODD[0][1]) and texts[3] == texts[4] == (1, 0, "") and texts[5][2] == LONG
    assert lines.line_dedup(none).count() == 0


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    high, low = rng.integers(0, 2**63, (2, 5000), dtype=np.uint64)
    high[1], low[2] = high[0], low[0]
    table = lines.PerfectHash.unpack(lines.PerfectHash(high, low).pack())
    assert sorted(table.index(high, low).tolist()) == list(range(5000))


def test_embeddings(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, 1), (3, [1.0, 2.0, 3.1], 1), (4, v, 2), (5, v, None), (6, None, 1), (7, [0.0, 0.0, 0.0], 1),
        (8, [1.0, None, 3.0], 1), (9, [float("nan"), 1.0, 1.0], 1), (10, [1.0, 2.0], 1), (None, v, 1), (11, [-3.0, 2.0, 0.5], 1),
        (12, [float("inf"), 1.0, 1.0], 1), (13, [], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.embedding_dedup(df).collect()}
    assert found[1] == (3, 1, True) and found[2] == found[3] == found[None] == (3, 1, False)
    assert all(found[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13))
    assert embeddings.embedding_dedup(df.limit(0)).count() == 0


def test_embedding_shards_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SHARD_SIZE", 60)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 16))
    x = np.concatenate([base, *(base[:40] + rng.normal(size=(40, 16)) * 0.12 for _ in range(6))])
    x = x.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, r.tolist(), 1) for i, r in enumerate(x)], "vec_id long, embedding array<float>, label int")
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    want = ((unit @ unit.T >= 0.98) & ~np.eye(len(x), dtype=bool)).sum(axis=1)
    found = {r["vec_id"]: r["n_links"] for r in embeddings.embedding_dedup(df).collect()}
    assert sum(found.values()) >= 0.99 * want.sum() and all(found[i] <= want[i] for i in range(len(x)))


def test_crowded_embedding_shards_are_cut_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SHARD_SIZE", 100)
    monkeypatch.setattr(embeddings, "CELL_SIZE", 40)
    rng = np.random.default_rng(8)
    spots = rng.normal(size=(6, 12))
    x = np.concatenate([rng.normal(size=(80, 12)), *(spot + rng.normal(size=(n, 12)) * 0.1 for spot, n in zip(spots, (150, 40, 20, 5, 3, 2)))])
    x = x.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, r.tolist(), 1) for i, r in enumerate(x)], "vec_id long, embedding array<float>, label int")
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = (unit @ unit.T >= 0.98) & ~np.eye(len(x), dtype=bool)
    root = np.arange(len(x))
    while True:
        lower = np.minimum(root, np.where(near, root[None, :], len(x)).min(axis=1))
        if (lower == root).all():
            break
        root = lower
    rows = {r["vec_id"]: r for r in embeddings.embedding_dedup(df).collect()}
    assert [rows[i]["n_links"] for i in range(len(x))] == near.sum(axis=1).tolist()
    assert [rows[i]["component_id"] for i in range(len(x))] == root.tolist()


def test_urls(spark):
    pages = [
        (1, "http://A.Example.NET/en/x?q#f", "h"), (2, "http://x.net", "h"), (3, "x.net/en/", "h"), (4, None, None), (5, "", "h"),
        (6, "https://example.com/de/1", "h"), (7, "https://b.org/fr/2", "h"), (8, "ftp://u/://v?w", "h"), (8, "ftp://u/://v?w", "h"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, host string")
    rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.url_filter(df).collect()}
    assert rows[1] == ("a.example.net", "/en/x", "example.net/en/", "allow") and rows[6][2:] == ("example.com/de/", "block")
    assert rows[2][:3] == ("x.net", "", None) and rows[3][:3] == rows[4][:3] == rows[5][:3] == ("", "", None)
    assert rows[7][2:] == ("org/fr/", "allow") and rows[8][:2] == ("u", "/://v")
    assert urls.url_filter(df).count() == len(pages) and urls.url_filter(df.limit(0)).count() == 0


def test_url_models_tell_classes_apart():
    good, bad = [f"news.site/story/{i}" for i in range(200)], [f"casino-win.biz/spin/{i}" for i in range(200)]

    def counts(texts):
        return urls._counts(urls.ORDER, *np.unique(urls.gram_keys(texts)[0], return_counts=True))

    models = counts(good[:100]), counts(bad[:100])
    assert (urls.scores(good[100:], *models) > 0).all() and (urls.scores(bad[100:], *models) < 0).all()


def test_licenses(spark, none):
    apache = licenses.TEMPLATES["Apache-2.0"][0]
    texts = [(1, f"x {apache.upper()} y"), (2, None), (3, ""), (4, "MIT"), (5, LONG + apache + " " + LONG), (None, apache), (5, apache)]
    rows = licenses.license_scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["license"], r["end_word"] - r["first_word"]) for r in rows) == [(0, "Apache-2.0", 7), (1, "Apache-2.0", 7), (5, "Apache-2.0", 7), (5, "Apache-2.0", 7)]
    assert licenses.license_scan(none).count() == 0
    grant = licenses.TEMPLATES["MIT-grant"][0].split()
    known = licenses.Templates(licenses.TEMPLATES)
    edited = " ".join(["so"] * 30 + grant[1:] + ["so"] * 30)
    assert [p[0] for p in licenses.passages([edited, " ".join(grant[::-1])], known)[0]] == ["MIT-grant"]
    assert licenses.passages([" ".join(grant[::-1])], known) == [[]]


def test_mix(spark, docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ODD) and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert {r["source"]: r["source_size"] for r in rows} == {"a": 18, "b": 0, "c": 180_010, None: 6}
    sizes = spark.createDataFrame([("a", 10), ("b", 10), ("c", 100), (None, 0)], "source string, source_size long")
    targets = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    # By weight 20, 40, 60 and 0: b stops at 30, and a and c share the other 90 as 1 to 3.
    assert targets == {"a": 22.5, "b": 30.0, "c": 67.5, None: 0.0}
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, rows)) and mixing.mix(none).count() == 0


def test_mix_comes_near_its_targets(spark):
    texts = [(i, "w " * (1 + i * 37 % 90), f"s{min(i % 9, 3)}") for i in range(3000)]
    rows = mixing.mix(spark.createDataFrame(texts, "doc_id long, text string, source string")).collect()
    taken, target = {}, {}
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 2 for s, t in target.items())


def test_packing(docs, none):
    pieces = packing.pack(docs, TOKENIZER).collect()
    assert sum(p["doc_tokens"] == 1 for p in pieces) == 2
    assert packing.pack(none, TOKENIZER).count() == 0
    encoder = packing.Encoder(TOKENIZER)
    for row in ODD:
        text = row[1] or ""
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want


def test_packer_wastes_nothing():
    rng = np.random.default_rng(2)
    packer = packing.Packer(0, capacity=64, max_open=8)
    sizes = rng.integers(1, 200, 500).tolist()
    rows = [r for i, n in enumerate(sizes) for r in packer.add(i, np.full(n, i, "<u4").tobytes())] + packer.finish()
    lengths = {r[4]: r[6] for r in rows}
    assert sum(r[2] for r in rows) == sum(sizes) == sum(lengths.values())
    assert all(n == 64 or n & (n - 1) == 0 for n in lengths.values()) and sum(n < 64 for n in lengths.values()) <= 6
    counts = np.zeros(65, np.int64)
    counts[10], counts[20] = 3, 1
    packer.counts = counts
    cost = {h: sum(c * c for c in moved(counts, h, 30)) for h in (0, 10, 20)}
    assert packer.level(30) == min(cost, key=lambda h: (cost[h], -h))


def moved(counts, level, size):
    after = counts.copy()
    after[level] -= level > 0
    after[level + size] += level + size < 64
    return after.tolist()


def test_sharding(docs, none):
    rows = sharding.shard_rows(docs, "doc_id", "text", shards=3).collect()
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 0), (2, 1)]
    assert sharding.shard_rows(none, "doc_id", "text").count() == 0


def test_a_hot_key_and_a_hot_row_are_numbered_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_TASK", 30)
    monkeypatch.setattr(sharding, "COPIES_PER_BUNDLE", 7)
    rows = [(i, f"t{i}") for i in range(200)] + [(1000, "copy")] * 250 + [(2000, f"v{i}") for i in range(151)] + [(None, None)] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.shard_rows(df, "doc_id", "text", shards=4).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in found) == sorted((str(i), str(t)) for i, t in rows)
    slots = [sorted(r["slot"] for r in found if r["shard"] == s) for s in range(4)]
    assert all(s == list(range(len(s))) for s in slots) and {len(s) for s in slots} == {160, 161}
    assert sorted(map(str, sharding.shard_rows(df.repartition(5), "doc_id", "text", shards=4).collect())) == sorted(map(str, found))


def test_more_shards_move_few_rows(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "'t' AS text")
    place = lambda n: {r["doc_id"]: r["shard"] for r in sharding.shard_rows(df, "doc_id", "text", shards=n).collect()}
    old, new = place(16), place(17)
    assert sum(old[i] != new[i] for i in old) < 0.4 * len(old)


def test_quality(spark, docs, none):
    rows = quality.quality_rules(docs, labels(spark)).collect()
    assert len(rows) == len(ODD) and all(r["kept"] == (not r["base_failed"]) for r in rows)
    counts = {r["doc_id"]: (r["n_words"], r["base_failed"]) for r in rows}
    assert counts[3] == counts[4] == (0, True) and counts[5] == (180_000, True)
    assert quality.quality_rules(none, labels(spark, [(1, 1, 0), (2, 0, None), (None, 1, 0)])).count() == 0
    assert quality.repeat_words(b"a b c x a b c a b c".split()) == 9


def test_chat(spark):
    turns = "pair long, turn long, role string, text string"
    chosen = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", None), (2, 0, "user", "x"), (None, 0, None, "q")]
    rejected = [(1, 0, "user", "hi"), (1, 1, "assistant", "no"), (2, 0, "user", "x"), (3, 0, "assistant", "alone"), (None, 0, None, "q")]
    found = chat.preference_pairs(*(spark.createDataFrame(t, turns) for t in (chosen, rejected)), "pair").collect()
    rows = {r["pair"]: r for r in found}
    assert rows[1]["n_common"] == 1 and rows[1]["prompt"] == "<|im_start|>user\nhi<|im_end|>\n"
    assert [(s["text"], s["trained"]) for s in rows[1]["chosen"]] == [
        ("<|im_start|>assistant\n", False), ("yes<|im_end|>\n", True), ("<|im_start|>user\n", False), ("<|im_end|>\n", False)
    ]
    assert rows[2]["chosen"] == rows[2]["rejected"] == [] and rows[3]["n_turns"] == 0
    # Turns without a pair are gathered with nothing.
    lone = sorted((r["n_turns"], r["n_common"], r["prompt"], len(r["chosen"]), len(r["rejected"])) for r in found if r["pair"] is None)
    assert lone == [(0, 0, "", 0, 2), (1, 0, "", 2, 0)]
    assert chat.preference_pairs(*(spark.createDataFrame([], turns) for _ in "ab"), "pair").count() == 0
