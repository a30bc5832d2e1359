"""The pipeline's near-copy stage decides by row: null ids and ids repeated with other texts."""

import hashlib
import random

from corpus_pipeline import drop_near_copies
from tarnlake.llm import simhash
from tarnlake.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def tale(seed):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10_000)}" for _ in range(80))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def kept(spark, rows, parts=3):
    df = prepare(spark).createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], DOCS)
    found = drop_near_copies(spark, df.repartition(parts), "")
    assert found.columns == df.columns
    return sorted(((r["doc_id"], r["text"], r["lang"]) for r in found.collect()), key=str)


def test_unlike_texts_without_an_id_all_stay(spark):
    unlike = [(None, tale(i), "en") for i in range(20)]
    assert kept(spark, [*unlike, *unlike[:5], (None, tale(3).upper(), "en")]) == sorted(
        [*[u for i, u in enumerate(unlike) if i != 3], min([unlike[3], (None, tale(3).upper(), "en")], key=lambda r: digest(r[1]))], key=str
    )


def test_an_id_repeated_with_unlike_texts_stays_once_per_group(spark):
    rows = [(1, tale(1), "en"), (7, tale(1), "en"), (7, tale(2), "en"), (7, tale(2), "de"), (7, tale(2), "de"), (7, tale(3), None), (None, tale(3), "a")]
    want = sorted([(1, tale(1), "en"), (7, tale(2), "de"), (7, tale(3), None)], key=str)
    assert all(kept(spark, rows[::way], parts) == want for way in (1, -1) for parts in (1, 4))


def test_a_row_goes_only_with_a_link_to_the_one_that_stays(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([tale(i), tale(i).title()]), rng.choice(["en", None])) for i in rng.choices(range(12), k=60)]
    left = kept(spark, rows)
    # Here a group is a tale, whatever the case of its letters.
    assert sorted(t.lower() for _, t, _ in left) == sorted({t.lower() for _, t, _ in rows})
    for i, t, lang in left:
        assert (i, digest(t)) == min(((j, digest(u)) for j, u, _ in rows if u.lower() == t.lower()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert kept(spark, []) == [] and len({simhash.fingerprint(t) for _, t, _ in left}) == len(left)
