"""The whole pipeline on empty and odd tables: nulls, repeats, copies, long texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tarnlake.llm.queries import TOKENIZER

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
rng = np.random.default_rng(4)
WORDS = [f"{a}{b}" for a in ("sea", "corn", "lamp", "north", "tide", "glass", "hill") for b in ("ward", "light", "stone", "mill", "fold")]


def text_of(words):
    """Lines of ten words, unlike any other text's."""
    picked = [f"{w}{n}" for w, n in zip(rng.choice(WORDS, words), rng.integers(0, 10_000, words))]
    return "\n".join(" ".join(picked[i : i + 10]) for i in range(0, words, 10))


PLAIN = {i: text_of(80) for i in range(40)}
LONG, COPY = text_of(30_000), text_of(90)
SHARED = "this one line is in many of the texts, word for word"
ODD = [
    *[(i, f"{t}\n{SHARED}", "en", f"s{i % 3}", 1) for i, t in PLAIN.items()],
    *[(None, text_of(70), None, None, None) for _ in range(30)],
    *[(100, text_of(60), "en", "s0", 1) for _ in range(3)],
    *[(200 + i, COPY, "en", "s1", 1) for i in range(25)],
    (300, LONG, "de", "s2", 1),
    (301, None, "en", "s2", None),
    (302, "", "en", "s2", 0),
    (None, None, None, None, None),
]


def written(spark, tmp_path, rows):
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage hands on, and ``run``'s rows."""
    sf_dir = written(spark, tmp_path_factory.mktemp("odd"), ODD)
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).persist()
        out.append(docs.collect())
    return out, corpus_pipeline.run(spark, sf_dir).collect()


def test_run_is_the_stages_in_turn(stages):
    out, run = stages
    # Where a document is cut depends on the files; what is packed does not.
    packed = lambda rows: sorted((str(r["doc_id"]), r["doc_tokens"]) for r in rows if r["start"] == 0)
    assert packed(run) == packed(out[-1])


def test_only_texts_under_the_base_rules_go(stages):
    (quality, *_), _ = stages
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(key((r["doc_id"], r["text"])) for r in quality) == sorted(key(r) for r in ODD if r[1])


def test_one_row_of_the_copies_stays_and_unlike_texts_stay(stages):
    (quality, lines, near, *_), _ = stages
    assert len(lines) == len(quality)
    # All lines of the later copies are gone: they are empty texts and one component.
    assert sum(not r["text"] for r in lines) == 24 and sum(not r["text"] for r in near) == 1
    assert sorted(r["text"] for r in near if r["text"]) == sorted(r["text"] for r in lines if r["text"])
    assert sum(SHARED in r["text"] for r in near) == 1


def test_the_mix_takes_texts_up_to_three_times(stages):
    (_, _, near, mixed, _), _ = stages
    source = {r["text"]: r["source"] for r in near}
    taken = {}
    for r in mixed:
        taken[r["text"]] = taken.get(r["text"], 0) + 1
    assert max(taken.values()) <= 3 and set(taken) <= set(source)
    assert {source[t] for t in taken} == set(source.values())


def test_sequences_hold_the_mixed_texts(stages):
    (*_, mixed, _), run = stages
    encode = Tokenizer.from_file(TOKENIZER).encode
    want = sum(len(encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in mixed)
    assert sum(r["length"] for r in run) == want
    ends = {}
    for r in run:
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["offset"] + r["length"]))
    for spans in map(sorted, ends.values()):
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= 4096


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 4])
def test_run_on_nothing(spark, tmp_path, rows):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, rows)).agg(F.count("*")).first()[0] == 0
