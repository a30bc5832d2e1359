"""Periodic runs of words in texts, by an enhanced suffix array.

A run is a maximal stretch of words with a smallest period. Its last square (two periods) starts
at two suffixes that agree in exactly one period: the period is the depth of the LCP interval
that parts them. So every interval is looked at where two of its children meet: the suffixes of
the smaller child look, by the inverse suffix array, whether the suffix ``depth`` before or after
them is in the other one. Squares found so are turned to the left as far as the words allow, which
gives the run; squares of a multiple of a run's period that end with it are the same run. Array
positions stand for tree nodes throughout.

Texts are worked off together, many at a time. A run of ``min_length`` words repeats at least half
as many; a text in which no such stretch of words comes twice has no run and no suffix array.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnlake.llm.common import mixed, prepare, text_pieces, words

MIN_LENGTH = 12
#: Looks at suffixes of smaller children at a time.
LOOKS = 1 << 20

_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
_RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, longest struct<start:long,length:long,period:long>, collapsed string"
_MADE = ("n_words", "runs", "longest", "collapsed")


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words one after the other, and for each its text's number, first place and end."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    return np.concatenate(texts).astype(np.int64), *(np.repeat(v, sizes) for v in (np.arange(len(texts)), ends - sizes, ends))


def repeating(texts: list[np.ndarray], width: int) -> np.ndarray:
    """The texts in which ``width`` words come twice (a hash may say so of others, of none too few)."""
    s, text, _, end = _joined(texts)
    code = mixed(text.astype(np.uint64), 1)
    for j in range(width):
        code = mixed(code + np.roll(s, -j).astype(np.uint64), 2)
    code, text = (v[np.arange(len(s)) + width <= end] for v in (code, text))
    order = np.argsort(code, kind="stable")
    again = code[order[1:]] == code[order[:-1]]
    return np.unique(text[order[1:]][again])


def suffix_order(s: np.ndarray, text: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, text by text, and the ranks of all suffixes by their first 1, 2, 4 ... words.

    Equal ranks mean that so many words agree, within their texts. The last ranks are the inverse
    suffix array. Each round sorts those suffixes only that still share their rank.
    """
    n = len(s)
    key = text * (int(s.max(initial=0)) + 1) + s
    sa = np.argsort(key, kind="stable")
    ranks, slots, sorted_key = [np.empty(n, np.int64)], np.arange(n), key[sa]
    width = 1
    while True:
        new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(slots)))
        ranks[-1][sa[slots]] = np.repeat(slots[starts], sizes)
        slots = slots[np.repeat(sizes > 1, sizes)]
        if not len(slots):
            return sa, ranks
        own, rank = sa[slots], ranks[-1]
        after = np.where(own + width < end[own], rank[np.minimum(own + width, n - 1)] + 1, 0)
        key = rank[own] * (n + 1) + after
        order = np.argsort(key, kind="stable")
        sa[slots], sorted_key = own[order], key[order]
        ranks.append(rank.copy())
        width *= 2


def common_prefixes(sa: np.ndarray, ranks: list[np.ndarray], end: np.ndarray) -> np.ndarray:
    """Words that each suffix has in common with the one before it in the suffix array."""
    a, b = np.roll(sa, 1), sa.copy()
    lcp = np.zeros(len(sa), dtype=np.int64)
    a_end, b_end, last = end[a], end[b], len(sa) - 1
    for level in reversed(range(len(ranks) - 1)):
        rank = ranks[level]
        same = (rank[np.minimum(a, last)] == rank[np.minimum(b, last)]) & (a < a_end) & (b < b_end)
        step = same * (1 << level)
        lcp, a, b = lcp + step, a + step, b + step
    lcp[0] = 0
    return lcp


def _sides(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest one before with no longer prefix, and the nearest after with a shorter one."""
    depths = lcp.tolist()
    left, right, open_ = [0] * len(depths), [len(depths)] * len(depths), [0]
    for k in range(1, len(depths)):
        depth = depths[k]
        while depth < depths[open_[-1]]:
            right[open_.pop()] = k
        left[k] = open_[-1]
        open_.append(k)
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def branching_squares(s, text, first, end) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all squares whose two halves are followed by different words."""
    sa, ranks = suffix_order(s, text, end)
    isa, lcp = ranks[-1], common_prefixes(sa, ranks, end)
    left, right = _sides(lcp)
    k = np.flatnonzero(lcp > 0)
    left_smaller = k - left[k] <= right[k] - k
    low, high = np.where(left_smaller, left[k], k), np.where(left_smaller, k, right[k])
    other_low, other_high = np.where(left_smaller, k, left[k]), np.where(left_smaller, right[k], k)
    sizes = high - low
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(LOOKS, sizes.sum() + LOOKS, LOOKS)) + 1 if len(k) else []
    found, begin = [], 0
    for cut in cuts:
        part = slice(begin, cut)
        begin = cut
        n = sizes[part]
        slot = np.repeat(low[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at, depth = sa[slot], np.repeat(lcp[k[part]], n)
        other = np.repeat(other_low[part], n), np.repeat(other_high[part], n)
        for shift, square in ((depth, 0), (-depth, -depth)):
            to = at + shift
            inside = (to >= first[at]) & (to < end[at])
            rank = isa[np.where(inside, to, 0)]
            hit = inside & (rank >= other[0]) & (rank < other[1])
            found.append(((at + square)[hit], depth[hit]))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))


def _turns(s: np.ndarray, first: int, start: int, period: int) -> int:
    """How often a square can be turned to the left."""
    moved, width = 0, 16
    while start - moved > first:
        high = start - moved
        low = max(first, high - width)
        differ = np.flatnonzero(s[low:high] != s[low + period : high + period])
        if len(differ):
            return moved + high - low - 1 - int(differ[-1])
        moved, width = moved + high - low, 2 * width
    return moved


def runs_of(texts: list[np.ndarray], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, a text being an array of word numbers."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    long_enough = [i for i, t in enumerate(texts) if len(t) >= min_length]
    if not long_enough:
        return out
    chosen = repeating([texts[i] for i in long_enough], -(-min_length // 2))
    if not len(chosen):
        return out
    numbers = [long_enough[i] for i in chosen.tolist()]
    s, text, first, end = _joined([texts[i] for i in numbers])
    start, period = branching_squares(s, text, first, end)
    # Short squares that cannot be turned often enough make no run of the length asked for.
    missing = min_length - 2 * period
    for turn in range(1, int(missing.max(initial=0)) + 1):
        place = start - turn
        held = (turn > missing) | ((place >= first[start]) & (s[place] == s[place + period]))
        start, period, missing = start[held], period[held], missing[held]
    stop = start + 2 * period
    order = np.lexsort((period, stop))
    last, ending = -1, []
    for square_start, q, e in zip(start[order].tolist(), period[order].tolist(), stop[order].tolist()):
        if e != last:
            last, ending = e, []
        if any(q % p == 0 and begin <= square_start for begin, p in ending):
            continue
        own_first = int(first[square_start])
        begin = square_start - _turns(s, own_first, square_start, q)
        ending.append((begin, q))
        if e - begin >= min_length:
            out[numbers[text[square_start]]].append((begin - own_first, e - begin, q))
    return [sorted(r, key=lambda run: (run[0], run[2])) for r in out]


def _number(tokens: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(t, len(known)) for t in tokens), np.int64, len(tokens))


def _collapsed(tokens: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats after its first period."""
    if runs:
        edges = np.zeros(len(tokens) + 1, dtype=np.int64)
        start, length, period = np.array(runs).T
        np.add.at(edges, start + period, 1)
        np.add.at(edges, start + length, -1)
        tokens = [tokens[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
    return b" ".join(tokens)


def word_runs(docs: DataFrame, text_column: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` without the text, with ``n_words``, ``runs``, ``longest`` and ``collapsed``.

    ``runs`` holds (``start``, ``length``, ``period``) of every run of a text's words
    ``[^\\x20\\x09-\\x0D]+``, by start, then period: a stretch of at least ``min_length`` words
    and two periods, which no word on either side prolongs; ``period`` is its smallest, words
    are numbered from 0. ``longest`` is the run of greatest length, the first of equals by start
    and period, null where there is none. ``collapsed`` joins by one space the words that remain
    when each run keeps its first period only.

    Whole texts count. A null or empty text has no words, no runs and an empty collapsed text.
    Repeated rows are looked at each. Other columns pass through, one named like a result is
    replaced. An empty table gives an empty result. Nothing is shuffled; a task holds one text, or
    some MB of short ones, with about 200 bytes a word of those that repeat.
    """
    prepare(docs.sparkSession)
    own = [c for c in docs.columns if c not in _MADE and c != text_column]
    rows = docs.select(F.col(f"`{text_column}`").alias("text"), F.struct(F.lit(0).alias(" "), *[F.col(f"`{c}`") for c in own]).alias("row"))
    schema = rows.select("row").schema
    for made in StructType.fromDDL(_RESULT):
        schema = schema.add(made)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_pieces(batches, "text"):
            tokens = [words(t) for t in texts]
            found = runs_of([_number(t) for t in tokens], min_length)
            named = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
            longest = [max(runs, key=lambda r: r["length"], default=None) for runs in named]
            arrays = [pa.array([len(t) for t in tokens], pa.int64()), pa.array(named, pa.list_(_RUN)), pa.array(longest, _RUN)]
            arrays.append(pa.array([_collapsed(t, r) for t, r in zip(tokens, found)], pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), *arrays], ["row", *_MADE])

    return rows.mapInArrow(find, schema).select(*[F.col(f"row.`{c}`") for c in own], *_MADE)
