"""Embedding near-dedup by exact comparison within cluster shards.

Equal vectors of a label form a class; only classes are compared. Classes of a large label are
dealt to cluster shards. A class is at home in the shard of its nearest centroid and visits
each shard whose border lies within half the link radius of it: two linked vectors on either
side of a border are together no farther from it than the radius, so one of them visits the
other's home, and no link is lost by sharding.

Most classes of a large label are near no other. A screen proves that: a class visits as a short
code, its part along the sample's principal directions in whole steps. Neither cutting off the
other directions nor the box that the codes end at moves two vectors apart, and rounding does so by
a known length; what is farther apart by the codes than radius and rounding has no link. In each
shard the codes of the classes at home meet all codes, and only those classes that come near
another one there go on, with their vectors, to that shard.

There each class at home is compared with all members, in single precision first; what is too
close to the threshold to tell is decided in double precision. A bounded sample of classes,
compared with all others in double precision, audits the recall.

A shard may be crowded, as no border parts a dense group of vectors. It is then cut into chunks,
and the classes of every chunk meet every chunk, each two in a task of their own: the same links,
and no task holds more than two chunks. A chunk is bounded in rows and in bytes.
"""

import logging
import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm.common import prepare, stored
from tarnlake.llm.components import components

_log = logging.getLogger(__name__)

THRESHOLD = 0.98
#: Classes of a shard, about, before visitors; centroids are fitted on a sample of so many classes.
#: Larger shards mean more pairs to compare, smaller ones more border to visit.
SHARD_SIZE = 8000
CENTROID_SAMPLE = 50_000
MAX_SHARDS = 4096
#: Classes of a shard, visitors included, above which it is cut into chunks of that size.
CELL_SIZE = 4 * SHARD_SIZE
#: What the vectors of a chunk may take, in double and single precision: long vectors make smaller chunks.
CELL_BYTES = 128 << 20
#: Distances between classes and centroids that a task holds at a time.
DISTANCES_AT_ONCE = 1 << 22
#: Directions of a code, and the steps on either side of zero: squared distances of codes stay below 2^24,
#: where whole numbers are exact in single precision.
DIRECTIONS, STEPS = 24, 127
#: Codes of a shard, and pairs of them, that meet in a task, about; visits that a task gathers before it hands on their codes.
CODES_PER_CELL, PAIRS_PER_CELL = 3 << 17, 1 << 33
VISITS_AT_ONCE = 1 << 18
#: Classes at home of a region of a shard, about, the most regions, and the most visits to them: beyond, all codes meet.
REGION, MOST_REGIONS, REGION_VISITS = 128, 512, 1 << 22
#: Rows and columns of a block of pairs, and the bytes of vectors of pairs that are decided in double precision at a time.
ROWS, COLUMNS = 256, 4096
PAIR_BYTES = 16 << 20
#: The audit's sample of classes doubles from the first number until so many of them have links, to
#: the last at most; and the recall to be reached, as a mean over classes with links.
AUDIT_FIRST, AUDIT_LINKED, AUDIT_MOST = 512, 200, 16384
MIN_RECALL = 0.95


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


def _matrix(column) -> np.ndarray:
    """A list column of equal lengths as (rows, length) doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def classes_of(vectors: DataFrame) -> DataFrame:
    """Stored classes: (``class``, ``key``, ``label``, ``vector``, ``first_id``, ``n``) of equal vectors of a label.

    The key is two 64-bit hashes of label and vector. Copies are counted before the shuffle.
    """
    usable = (
        F.col("label").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall("vector", lambda v: F.abs(v) < float("inf"))  # nor is it true of null and NaN, which sorts last
        & F.exists("vector", lambda v: v != 0)
    )
    grouped = (
        vectors.where(usable)
        .groupBy("key")
        .agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    )
    return stored(grouped.withColumn("class", F.monotonically_increasing_id()), "vector-classes")


@dataclass(frozen=True)
class Layout:
    """Shards of a large label: their centroids, chunks of codes each, and the directions and the step of its codes."""

    centers: np.ndarray
    chunks: np.ndarray
    directions: np.ndarray
    step: float

    def codes(self, x: np.ndarray) -> np.ndarray:
        return np.rint(np.clip(x @ self.directions / self.step, -STEPS, STEPS)).astype(np.int8)

    def reach(self, radius: float) -> float:
        """How far apart, in steps, the codes of vectors within the radius may be: rounding moves each by half a step in every direction."""
        return (radius + 1e-6) / self.step + math.sqrt(self.directions.shape[1])


def _layouts(classes: DataFrame, radius: float) -> dict[tuple[int, int], Layout]:
    """Layouts of the labels that need more than one shard, by (label, length), from a sample."""
    sizes = classes.groupBy("label", F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    sizes = stored(sizes.where(F.col("n") > SHARD_SIZE), "large-labels")
    scale = max(1, math.ceil((sizes.agg(F.sum("n")).first()[0] or 0) / SHARD_SIZE / MAX_SHARDS))
    # Of these there are MAX_SHARDS at most.
    cut = sizes.where(F.col("n") > SHARD_SIZE * scale)
    large = {(r["label"], r["length"]): r["n"] for r in cut.collect()}
    if not large:
        return {}
    share = min(1.0, CENTROID_SAMPLE / sum(large.values()))
    drawn = classes.where(F.pmod(F.xxhash64(F.lit("centroids"), "key"), F.lit(1 << 30)) < int(share * (1 << 30)))
    drawn = drawn.withColumn("length", F.size("vector")).join(cut, ["label", "length"], "left_semi")
    rows = drawn.orderBy("key").limit(2 * CENTROID_SAMPLE).select("label", "vector").toArrow()
    labels = rows.column("label").to_numpy()
    lengths = _lengths(rows.column("vector").combine_chunks())
    out = {}
    for (label, length), n in sorted(large.items()):
        own = rows.filter(pa.array((labels == label) & (lengths == length)))
        count = math.ceil(n / SHARD_SIZE / scale)
        if len(own) < count or count < 2:
            continue
        x = _unit(_matrix(own.column("vector")))
        rng = np.random.default_rng(label & 0x7FFFFFFF)
        centers = x[rng.choice(len(x), count, replace=False)]
        for _ in range(8):
            nearest = (x @ centers.T).argmax(axis=1)
            for c in np.unique(nearest):
                mean = x[nearest == c].mean(axis=0)
                centers[c] = mean / (np.linalg.norm(mean) or 1.0)
        centers = np.unique(centers, axis=0)
        _, shards, homes = _places(x, centers, radius)
        visits, at_home = (np.bincount(found, minlength=len(centers)) * (n / len(x)) for found in (shards, homes))
        chunks = np.ceil(np.maximum(visits / CODES_PER_CELL, np.sqrt(visits * at_home / PAIRS_PER_CELL))).astype(np.int64)
        directions = _directions(x, rng)
        step = float(np.abs(x @ directions).max()) / STEPS
        out[label, length] = Layout(centers, np.maximum(1, chunks), directions, step or 1.0)
    return out


def _directions(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Orthonormal columns, about the sample's principal directions."""
    spread = x - x.mean(axis=0)
    guess = rng.normal(size=(x.shape[1], min(DIRECTIONS, x.shape[1])))
    for _ in range(3):
        guess = np.linalg.qr(spread.T @ (spread @ guess) + 1e-9 * guess)[0]
    return guess


def _lengths(vectors: pa.Array) -> np.ndarray:
    return vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _places(x: np.ndarray, centers: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and shard of every visit, that of the home included, and each row's home."""
    apart = 2 * np.sqrt(np.maximum(2 - 2 * (centers @ centers.T), 1e-30))
    step = max(1, DISTANCES_AT_ONCE // len(centers))
    rows, shards, homes = [], [], []
    for at in range(0, len(x), step):
        away = 2 - 2 * (x[at : at + step] @ centers.T)
        every = np.arange(len(away))
        home = away.argmin(axis=1)
        visits = (away - away[every, home][:, None]) / apart[home] <= radius / 2 + 1e-9
        visits[every, home] = True
        row, shard = np.nonzero(visits)
        rows.append(row + at)
        shards.append(shard)
        homes.append(home)
    return np.concatenate(rows), np.concatenate(shards), np.concatenate(homes)


_CODES = "label int, length int, shard int, home int, own int, n long, chunks long, ids binary, homes binary, codes binary"


def _packed(label: int, length: int, chunks: np.ndarray, visits: list[tuple]) -> pa.RecordBatch:
    """A row for each shard: of all that visit it the ids, homes and codes, ``own`` of them at home there and first.

    There are MAX_SHARDS homes at most, so two bytes hold one.
    """
    shard, ids, homes, codes = (np.concatenate(v) for v in zip(*visits))
    turn = np.lexsort((homes != shard, shard))
    shard, ids, homes, codes = shard[turn], ids[turn], homes[turn].astype(np.uint16), codes[turn]
    shards, first, counts = np.unique(shard, return_index=True, return_counts=True)
    own = np.add.reduceat(homes == shard, first, dtype=np.int64)
    cuts = [slice(a, a + n) for a, n in zip(first.tolist(), counts.tolist())]
    columns = [np.full(len(shards), label), np.full(len(shards), length), shards, np.where(own > 0, shards, -1), own]
    columns = [pa.array(c.astype(np.int32)) for c in columns] + [pa.array(counts), pa.array(chunks[shards])]
    columns += [pa.array([v[cut].tobytes() for cut in cuts], pa.binary()) for v in (ids, homes, codes)]
    return pa.RecordBatch.from_arrays(columns, ["label", "length", "shard", "home", "own", "n", "chunks", "ids", "homes", "codes"])


def _visitor(layouts: dict, radius: float):
    """Codes of the classes, for each shard that they visit."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = {}, 0
        for batch in batches:
            labels, lengths = batch.column("label").to_numpy(zero_copy_only=False), _lengths(batch.column("vector"))
            ids = batch.column("class").to_numpy()
            for kind in set(zip(labels.tolist(), lengths.tolist())) & set(layouts):
                of_kind = np.flatnonzero((labels == kind[0]) & (lengths == kind[1]))
                x = _unit(_matrix(batch.column("vector").take(pa.array(of_kind))))
                row, shard, home = _places(x, layouts[kind].centers, radius)
                waiting.setdefault(kind, []).append((shard, ids[of_kind][row], home[row], layouts[kind].codes(x)[row]))
                n += len(row)
            if n >= VISITS_AT_ONCE:
                yield from (_packed(*kind, layouts[kind].chunks, visits) for kind, visits in waiting.items())
                waiting, n = {}, 0
        yield from (_packed(*kind, layouts[kind].chunks, visits) for kind, visits in waiting.items())

    return visit


def _unpacked(group: pa.Table, own: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, homes and codes of packed rows, and which are at home; of those at home only where ``own``."""
    counts, at_home = group.column("n").to_numpy(), group.column("own").to_numpy()
    ids, homes, codes = (
        np.concatenate([np.frombuffer(v.as_buffer(), kind) for v in group.column(name)] or [np.zeros(0, kind)])
        for name, kind in (("ids", np.int64), ("homes", np.uint16), ("codes", np.int8))
    )
    place = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
    here = place < np.repeat(at_home, counts)
    codes = codes.reshape(len(ids), -1) if len(ids) else codes.reshape(0, 0)
    return (ids[here], homes[here], codes[here], here[here]) if own else (ids, homes, codes, here)


def _regions(codes: np.ndarray, centers: np.ndarray, reach: float) -> tuple[np.ndarray, list[np.ndarray]] | None:
    """The region of each code, that of its nearest center, and the codes that are in or visit each region, ascending.

    None if too many visit.
    """
    half = (centers * centers).sum(axis=1) / 2
    apart = np.sqrt(np.maximum(half[:, None] + half[None, :] - centers @ centers.T, 0) * 2)
    # Products of codes stay below 2^19: single precision errs by less than 1 there.
    slack = (reach / 2 * apart + 4).astype(np.float32)
    centers, half = centers.astype(np.float32), half.astype(np.float32)
    step = max(1, DISTANCES_AT_ONCE // len(centers))
    own, rows, regions, n = [], [], [], 0
    for at in range(0, len(codes), step):
        near = codes[at : at + step] @ centers.T - half
        best = near.argmax(axis=1)
        row, region = np.nonzero(near >= near[np.arange(len(near)), best][:, None] - slack[best])
        n += len(row)
        if n > REGION_VISITS:
            return None
        own.append(best)
        rows.append(row + at)
        regions.append(region.astype(np.int16))
    rows, regions = np.concatenate(rows), np.concatenate(regions)
    turn = np.argsort(regions, kind="stable")
    return np.concatenate(own), np.split(rows[turn], np.searchsorted(regions[turn], np.arange(1, len(centers))))


def _centers(codes: np.ndarray, count: int) -> np.ndarray:
    centers = codes[np.linspace(0, len(codes) - 1, count).astype(np.int64)].astype(np.float64)
    for _ in range(2):
        some = codes[:: max(1, len(codes) // (64 * count))]
        nearest = (some @ centers.T.astype(np.float32) - (centers * centers).sum(axis=1) / 2).argmax(axis=1)
        for c in np.unique(nearest):
            centers[c] = some[nearest == c].mean(axis=0)
    return centers


def _blocks(codes: np.ndarray, asking: np.ndarray, ask_codes: np.ndarray, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of those that ask and of all members to be compared: no pair within reach is left out.

    Either is dealt to regions as classes are to shards, and of two that are near one visits the
    other's region. ``asking`` are the members that ask, if they are members. Where regions save
    little all are compared.
    """
    count = min(MOST_REGIONS, len(ask_codes) // REGION)
    centers = _centers(ask_codes, count) if count > 1 else None
    dealt = _regions(codes, centers, reach) if count > 1 else None
    if dealt and len(asking):
        at = np.full(len(codes), -1)
        at[asking] = np.arange(len(asking))
        asks = dealt[0][asking], [found[found >= 0] for found in (at[v] for v in dealt[1])]
    else:
        asks = dealt and _regions(ask_codes, centers, reach)
    if not asks:
        yield np.arange(len(ask_codes)), np.arange(len(codes))
        return
    (own, there), (ask_own, ask_there) = dealt, asks
    for region, (visit, ask_visit) in enumerate(zip(there, ask_there)):
        at_home = ask_own[ask_visit] == region
        yield ask_visit[at_home], visit
        yield ask_visit[~at_home], visit[own[visit] == region]


def _near(group: pa.Table, reaches: dict) -> pa.Table:
    """The classes of a cell whose codes come near another one's, of which one at least is at home."""
    label, length, here = (group.column(c)[0].as_py() for c in _SHARD)
    reach = reaches[label, length]
    own_chunk = group.column("asking")[0] == group.column("asked")[0]
    member = group.column("member").combine_chunks()
    ids, homes, codes, at_home = _unpacked(group.filter(member))
    if own_chunk:
        asking = np.flatnonzero(at_home)
        ask_ids, ask_homes, ask_codes = ids[asking], homes[asking], codes[asking]
    else:
        asking = np.zeros(0, np.int64)
        ask_ids, ask_homes, ask_codes, _ = _unpacked(group.filter(pa.array(~member.to_numpy(zero_copy_only=False))), own=True)
    near, ask_near = np.zeros(len(ids), bool), np.zeros(len(ask_ids), bool)
    if len(ids) and len(ask_ids):
        # Minus the squared distance is a product of longer vectors.
        codes, ask_codes = codes.astype(np.float32), ask_codes.astype(np.float32)
        to = np.hstack([codes, (codes * codes).sum(axis=1, keepdims=True), np.ones((len(ids), 1), np.float32)])
        ask = np.hstack([2 * ask_codes, np.full((len(ask_ids), 1), -1, np.float32), -(ask_codes * ask_codes).sum(axis=1, keepdims=True)])
        least = np.float32(-math.floor(reach * reach))
        for some, others in _blocks(codes, asking, ask_codes, reach):
            for left in range(0, len(others) if len(some) else 0, COLUMNS):
                asked = others[left : left + COLUMNS]
                right = to[asked].T
                for at in range(0, len(some), ROWS):
                    rows = some[at : at + ROWS]
                    found = ask[rows] @ right >= least
                    if own_chunk:
                        spot = np.searchsorted(asked, asking[rows])
                        itself = np.flatnonzero(asked[np.minimum(spot, len(asked) - 1)] == asking[rows])
                        found[itself, spot[itself]] = False
                    hit = found.any(axis=1)
                    if hit.any():
                        ask_near[rows[hit]] = True
                        near[asked[found[hit].any(axis=0)]] = True
    said, said_homes = np.concatenate([ids[near], ask_ids[ask_near]]), np.concatenate([homes[near], ask_homes[ask_near]])
    said, first = np.unique(said, return_index=True)
    n = len(said)
    columns = [pa.array(said), *(pa.array(np.full(n, v, np.int32)) for v in (label, length, here)), pa.array(said_homes[first].astype(np.int32))]
    return pa.table(columns, names=["class", *_SHARD, "home"])


_SHARD = ("label", "length", "shard")


class _Groups:
    """Which of a cell's classes links connect: each points to the least one known of its group."""

    def __init__(self, n: int):
        self.least = np.arange(n)

    def of(self, nodes: np.ndarray) -> np.ndarray:
        found = self.least[nodes]
        while True:
            further = self.least[found]
            if (further == found).all():
                self.least[nodes] = found
                return found
            found = further

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            low, high = self.of(a), self.of(b)
            low, high = np.minimum(low, high), np.maximum(low, high)
            apart = low < high
            a, b = low[apart], high[apart]
            np.minimum.at(self.least, b, a)

    def join_block(self, rows: np.ndarray, columns: np.ndarray, found: np.ndarray) -> None:
        """The same for a block of pairs: a pair of each row and of each column at a time, until all agree."""
        while True:
            row_of, column_of = self.of(rows), self.of(columns)
            apart = found & (row_of[:, None] != column_of[None, :])
            some = np.flatnonzero(apart.any(axis=1))
            if not len(some):
                return
            others = np.flatnonzero(apart.any(axis=0))
            self.join(rows[some], columns[apart[some].argmax(axis=1)])
            self.join(columns[others], rows[apart[:, others].argmax(axis=0)])


def _weighed(found: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The sum of ``n`` over what was found in each row; most are 1."""
    several = np.flatnonzero(n > 1)
    return np.count_nonzero(found, axis=1) + found[:, several] @ (n[several] - 1)


def _search(group: pa.Table, threshold: float) -> pa.Table:
    """(class, linked vectors, a class it is connected with) of a cell's classes.

    The members are a chunk. Those at home here are compared with all of them, or where another
    chunk asks, its classes at home; each link found counts for a visitor as well.
    """
    group = group.sort_by([("member", "descending"), ("class", "ascending")])
    ids, n = group.column("class").to_numpy(), group.column("n").to_numpy().astype(np.float64)
    members = int(group.column("member").combine_chunks().to_numpy(zero_copy_only=False).sum())
    home = group.column("home").to_numpy()
    here = group.column("shard")[0].as_py()
    own_chunk = group.column("asking")[0] == group.column("asked")[0]
    at_home = np.flatnonzero(home[:members] == here) if own_chunk else np.arange(members, len(ids))
    links, groups = np.zeros(len(ids)), _Groups(len(ids))
    if not members or not len(at_home):
        return pa.table({"class": ids[:0], "links": pa.array([], pa.int64()), "with": ids[:0]})
    vectors = group.column("vector").combine_chunks()
    raw = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
    norms = np.sqrt(np.einsum("nd,nd->n", raw, raw, dtype=np.float64))
    x = (raw / norms[:, None]).astype(np.float32)
    # What the roundings of a product in single precision add up to at most.
    doubt = 1e-6 + 1.2e-7 * raw.shape[1]
    pairs_at_once = max(1, PAIR_BYTES // (16 * raw.shape[1]))
    # A visitor whose own home this class visits meets it there too: the pair counts in the
    # shard with the lower number, for both.
    shards = group.column("shards").combine_chunks()
    goes = np.unique(np.repeat(np.arange(len(ids)), _lengths(shards)) << 32 | shards.flatten().to_numpy(zero_copy_only=False))
    for at in range(0, len(at_home), ROWS):
        asking = at_home[at : at + ROWS]
        for left in range(0, members, COLUMNS):
            asked = np.arange(left, min(left + COLUMNS, members))
            product = x[asking] @ x[asked].T
            found = product >= threshold - doubt
            if own_chunk:
                itself = np.flatnonzero((asking >= left) & (asking < left + len(asked)))
                found[itself, asking[itself] - left] = False
            rows = np.flatnonzero(found.any(axis=1))
            if not len(rows):
                continue
            columns = np.flatnonzero(found[rows].any(axis=0))
            asks, answers = asking[rows], asked[columns]
            if found.size > 2 * len(rows) * len(columns):
                part = np.ix_(rows, columns)
                found, product = found[part], product[part]
            else:
                asks, answers = asking, asked
            r, c = np.nonzero(found & (product < threshold + doubt))
            for some in range(0, len(r), pairs_at_once):
                i, j = r[some : some + pairs_at_once], c[some : some + pairs_at_once]
                p, q = asks[i], answers[j]
                exact = np.einsum("nd,nd->n", raw[p].astype(np.float64), raw[q].astype(np.float64)) / (norms[p] * norms[q])
                found[i, j] = exact >= threshold
            groups.join_block(asks, answers, found)
            other = home[answers]
            lower = np.flatnonzero(other < here)
            if len(lower):
                wanted = asks[:, None] << 32 | other[lower][None, :].astype(np.int64)
                spot = np.minimum(np.searchsorted(goes, wanted), len(goes) - 1)
                found[:, lower] &= goes[spot] != wanted
            links[asks] += _weighed(found, n[answers])
            visitors = np.flatnonzero(other != here)
            if len(visitors):
                links[answers[visitors]] += _weighed(found[:, visitors].T, n[asks])
    root = groups.of(np.arange(len(ids)))
    said = (links > 0) | (root != np.arange(len(ids)))
    return pa.table({"class": ids[said], "links": links[said].astype(np.int64), "with": ids[root[said]]})


def _chunked(placed: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """``placed`` with the ``chunk`` of each class and the number of ``chunks`` of its shard.

    ``counted`` has a row for each of them without their vectors.
    """
    fitting = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(CELL_BYTES) / (12 * F.col("length"))))
    size = F.least(F.lit(CELL_SIZE).cast("long"), fitting)
    counts = (counted or placed).groupBy(*_SHARD).agg(F.count(F.lit(1)).alias("n")).select(*_SHARD, F.ceil(F.col("n") / size).alias("chunks"))
    cut = stored(counts.where("chunks > 1"), "cut-shards")
    chunks = F.coalesce("chunks", F.lit(1).cast("long"))
    return placed.join(cut, list(_SHARD), "left").withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("class"), "chunks"))


def _cells() -> Column:
    """Where a class goes: to the members of its chunk, for each chunk that asks, and to ask the others."""
    every = F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)
    serves = F.transform(every, lambda c: F.struct(c.alias("asking"), F.col("chunk").alias("asked"), F.lit(True).alias("member")))
    asks = F.transform(every, lambda c: F.struct(F.col("chunk").alias("asking"), c.alias("asked"), F.lit(False).alias("member")))
    others = F.filter(asks, lambda cell: (F.col("home") == F.col("shard")) & (cell["asked"] != F.col("chunk")))
    return F.concat(serves, others)


def _visits(classes: DataFrame, layouts: dict, radius: float) -> DataFrame:
    """(``class``, ``label``, ``length``, ``shard``, ``home``, ``shards``) of the classes that come near another, stored.

    A row for each shard in which they do; ``shards`` are all of these.
    """
    reaches = {kind: layout.reach(radius) for kind, layout in layouts.items()}
    codes = classes.select("class", "label", "vector").mapInArrow(_visitor(layouts, radius), _CODES)
    cells = codes.withColumn("chunk", F.pmod(F.xxhash64("ids"), "chunks")).withColumn("cell", F.explode(_cells()))
    near = (
        cells.select(*_SHARD, "own", "n", "ids", "homes", "codes", "cell.*")
        .groupBy(*_SHARD, "asking", "asked")
        .applyInArrow(lambda g: _near(g, reaches), "class long, label int, length int, shard int, home int")
    )
    facts = [F.first(c).alias(c) for c in ("label", "length", "home")]
    of_class = near.groupBy("class").agg(*facts, F.array_sort(F.collect_set("shard")).alias("shards"))
    return stored(of_class.withColumn("shard", F.explode("shards")).select("class", *_SHARD, "home", "shards"), "vector-shards")


def _links(classes: DataFrame, threshold: float) -> DataFrame:
    """(``class``, ``links``, ``with``) per cell, stored."""
    radius = math.sqrt(2 - 2 * threshold)
    layouts = _layouts(classes, radius)
    kind = F.shiftleft(F.col("label").cast("long"), 32) + F.size("vector")
    sharded = kind.isin([(label << 32) + length for label, length in layouts]) if layouts else F.lit(False)
    one = F.lit(0)
    at = [F.size("vector").alias("length"), one.alias("shard"), one.alias("home"), F.array(one).alias("shards")]
    placed = classes.where(~sharded).select("class", "label", *at, "n", "vector")
    counted = placed.select("class", *_SHARD)
    if layouts:
        visits = _visits(classes.where(sharded), layouts, radius)
        counted = counted.unionAll(visits.select("class", *_SHARD))
        placed = placed.unionByName(visits.join(classes.select("class", "n", "vector"), "class"))
    searched = (
        _chunked(placed, counted)
        .withColumn("cell", F.explode(_cells()))
        .select("class", *_SHARD, "home", "shards", "n", "vector", "cell.*")
        .groupBy(*_SHARD, "asking", "asked")
        .applyInArrow(lambda g: _search(g, threshold), "class long, links long, with long")
    )
    return stored(searched, "vector-links")


@dataclass(frozen=True)
class Audit:
    """The mean share of a linked class' links that were found, over so many of a sample's classes."""

    recall: float
    linked: int
    sample: int


def audit_recall(classes: DataFrame, links: DataFrame, threshold: float) -> Audit:
    """A sample of classes, by a hash of their keys, compared with all classes of their label.

    The sample goes to every task; all classes pass by it once. Where it holds no class with
    links the recall is 1.
    """
    place = F.xxhash64(F.lit("audit"), "key")
    n, known = classes.count(), links.where("links > 0").select(F.col("class").alias("linked")).distinct()
    # Of the many no more than a few times as many as wanted are put in order.
    few = classes.where(place < (-1 << 63) + (4 * AUDIT_MOST << 64) // n) if n > 8 * AUDIT_MOST else classes
    drawn = stored(few.orderBy(place, "key").limit(AUDIT_MOST), "audit-sample")
    # What was found has links: the sample that would do by that alone is not too small.
    order = drawn.join(known, F.col("class") == F.col("linked"), "left").orderBy(place, "key").select("linked").toArrow()
    linked = np.cumsum(order.column("linked").is_valid().to_numpy())
    size = min(AUDIT_FIRST, AUDIT_MOST)
    while size < min(AUDIT_MOST, len(linked)) and linked[size - 1] < AUDIT_LINKED:
        size = min(2 * size, AUDIT_MOST)
    sample = drawn.orderBy(place, "key").limit(size).select("class", "label", "vector").toArrow()
    truth = _true_links(classes, sample, threshold).groupBy("class").agg(F.sum("links").alias("all"))
    found = links.groupBy("class").agg(F.sum("links").alias("found"))
    share = F.least("all", F.coalesce("found", F.lit(0))) / F.col("all")
    facts = truth.where("all > 0").join(found, "class", "left").agg(F.count(F.lit(1)).alias("linked"), F.avg(share).alias("recall")).first()
    return Audit(facts["recall"] if facts["linked"] else 1.0, facts["linked"], len(sample))


def _true_links(classes: DataFrame, sample: pa.Table, threshold: float) -> DataFrame:
    """(``class``, ``links``) of the sampled classes with each batch of all classes."""
    labels, lengths = sample.column("label").to_numpy(), _lengths(sample.column("vector").combine_chunks())
    known = {}
    for kind in set(zip(labels.tolist(), lengths.tolist())):
        own = sample.filter(pa.array((labels == kind[0]) & (lengths == kind[1])))
        known[kind] = own.column("class").to_numpy(), _unit(_matrix(own.column("vector")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            lengths = _lengths(batch.column("vector"))
            for label, length in set(zip(labels.tolist(), lengths.tolist())) & set(known):
                ids, queries = known[label, length]
                rows = np.flatnonzero((labels == label) & (lengths == length))
                near = queries @ _unit(_matrix(batch.column("vector").take(pa.array(rows)))).T >= threshold
                own = batch.column("class").to_numpy()[rows]
                near &= ids[:, None] != own
                counts = near @ batch.column("n").to_numpy()[rows]
                yield pa.RecordBatch.from_arrays([pa.array(ids[counts > 0]), pa.array(counts[counts > 0])], ["class", "links"])

    return classes.select("class", "label", "n", "vector").mapInArrow(compare, "class long, links long")


def embedding_dedup(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(``vec_id``, ``n_links``, ``component_id``, ``kept``), one row per row of ``vectors``.

    Vectors of equal, non-null labels are linked where their cosine, in double precision, is at
    least ``threshold``; ``n_links`` counts the other vectors linked directly, copies each,
    and ``component_id`` is the least id that links reach. A vector that is null, zero or holds
    a null or non-finite component, and one without a label, links with nothing; nor do vectors
    of different lengths. Repeated rows are linked vectors. A null id names no component with
    ids. Other columns are not read. An empty table gives an empty result.

    The audited recall is logged; below ``MIN_RECALL`` an error is raised.
    """
    prepare(vectors.sparkSession)
    with _shuffles_removed(vectors.sparkSession):
        return _embedding_dedup(vectors, id_column, vector_column, label_column, threshold)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a stored step has shuffled goes when it is written, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _embedding_dedup(vectors, id_column, vector_column, label_column, threshold):
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).cast("int").alias("label"),
        F.col(vector_column).cast("array<float>").alias("vector"),
    )
    # Minus zero counts as zero.
    rows = rows.withColumn("vector", F.transform("vector", lambda v: v + F.lit(0).cast("float")))
    key = F.struct(F.xxhash64(F.lit(1), "label", "vector").alias("a"), F.xxhash64(F.lit(2), "label", "vector").alias("b"))
    rows = rows.withColumn("key", key)
    classes = classes_of(rows)
    links = _links(classes, threshold)
    audit = audit_recall(classes, links, threshold)
    _log.info("recall %.4f over %d linked classes of %d", audit.recall, audit.linked, audit.sample)
    if audit.recall < MIN_RECALL:
        raise RuntimeError(f"the search reaches a recall of {audit.recall:.3f} only")
    roots = components(links.select(F.col("class").alias("a"), F.col("with").alias("b")))
    direct = links.groupBy("class").agg(F.sum("links").alias("links"))
    facts = (
        classes.select("class", "key", "first_id", "n")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .join(direct, "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    least = facts.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = facts.join(least, "root").select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    joined = rows.select("vec_id", "key").join(of_class.withColumn("linked", F.lit(True)), "key", "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
