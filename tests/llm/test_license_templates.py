"""All templates against containment by brute force, in edited, cut and moved passages."""

import random

import numpy as np
import pytest

from tarnlake.llm import licenses

KNOWN = licenses.Templates(licenses.TEMPLATES)
TEXTS = [(name, t) for name, own in licenses.TEMPLATES.items() for t in ((own,) if isinstance(own, str) else own)]
FILL = [f"filler{i}" for i in range(400)]


def containment(words, template):
    """The greatest share of the template's shingles in a stretch of words of one and a half times its length."""
    own, found = set(licenses.shingle_hashes(licenses.license_words(template)).tolist()), licenses.shingle_hashes(words).tolist()
    width, best = len(own) + -(-len(own) // 2), 0.0
    for start in range(max(1, len(found) - width + 1)):
        best = max(best, len(own.intersection(found[start : start + width])) / len(own))
    return best


def edited(rng, words, kind):
    words = list(words)
    if kind == "words":
        for i in rng.sample(range(len(words)), min(len(words), rng.choice([0, 1, 1, 2, len(words) // 20]))):
            words[i] = rng.choice(FILL)
    elif kind == "cut":
        n = int(len(words) * rng.choice([0.0, 0.05, 0.1, 0.15, 0.3, 0.5]))
        words = words[n:] if rng.random() < 0.5 else words[: len(words) - n]
    elif kind == "moved":
        at = rng.randrange(len(words))
        words = words[at:] + words[:at]
    elif kind == "added":
        words.insert(rng.randrange(len(words)), rng.choice(FILL))
    elif kind == "shuffled":
        rng.shuffle(words)
    return words


@pytest.mark.parametrize("kind", ["whole", "words", "cut", "moved", "added", "shuffled"])
def test_passages_of_all_templates(kind):
    rng = random.Random(kind)
    for _ in range(4):
        docs = []
        for name, t in TEXTS:
            words = edited(rng, licenses.license_words(t), kind)
            docs.append([rng.choice(FILL) for _ in range(rng.randrange(0, 300))] + words + [rng.choice(FILL) for _ in range(rng.randrange(0, 300))])
        found = licenses.passages([" ".join(d) for d in docs], KNOWN)
        for (name, t), words, own in zip(TEXTS, docs, found):
            best = {}
            for other, text in TEXTS:
                best[other] = max(best.get(other, 0.0), containment(words, text))
            got = {p[0]: p[3] for p in own}
            for other, share in best.items():
                assert (other in got) == (share >= licenses.CONTAINMENT), (kind, name, other, share, got)
                if other in got:
                    assert got[other] == pytest.approx(share, abs=0.02)


@pytest.mark.parametrize(
    ("name", "text"),
    [
        ("MIT", "This code is released under the terms of the MIT License."),
        ("Apache-2.0", "Published under the Apache Software License, Version 2.0, see below"),
        ("Apache-2.0", "licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License."),
        ("GPL-3.0", "This program is free software: you can redistribute it and/or modify\n it under the terms of the GNU General Public License as published by\n the Free Software Foundation, either version 3 of the License, or\n (at your option) any later version.\n\n This program is distributed in the hope that it will be useful,\n but WITHOUT ANY WARRANTY; without even the implied warranty of\n MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the\n GNU General Public License for more details."),
        ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\n License, v. 2.0. If a copy of the MPL was not distributed with this\n file, You can obtain one at http://mozilla.org/MPL/2.0/."),
        ("ISC", licenses.TEMPLATES["ISC"].lower()),
        ("LGPL-2.1", licenses.TEMPLATES["LGPL-2.1"].replace("library", "library").upper()),
    ],
)
def test_usual_notices(name, text):
    assert name in {p[0] for p in licenses.passages([text], KNOWN)[0]}


def test_spans_hold_the_passage():
    grant = licenses.license_words(licenses.TEMPLATES["MPL-2.0"])
    doc = ["x"] * 50 + grant + ["y"] * 50
    (span,) = licenses.passages([" ".join(doc)], KNOWN)[0]
    assert span == ("MPL-2.0", 50, 50 + len(grant), 1.0)
    twice = licenses.passages([" ".join(doc * 2), None, "", "mit"], KNOWN)
    assert [len(p) for p in twice] == [2, 0, 0, 0]


def test_stretches_lose_no_window():
    rng = np.random.default_rng(0)
    line = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    for at in (0, 17, 2500, 2600, 4990):
        line[at] = KNOWN.all_shingles[at % len(KNOWN.all_shingles)]
    starts = np.zeros(len(line), bool)
    for first, end in KNOWN.stretches(line):
        starts[first:end] = True
    for at in (0, 17, 2500, 2600, 4990):
        assert starts[max(0, at - KNOWN.largest + 1) : at + 1].all()
