"""SimHash near-dedup: fingerprints in vantage-point trees, exact pairs within each shard.

A fingerprint has 64 bits. Two that differ in at most ``max_bits`` of them differ in at most
``max_bits // blocks`` of one of ``blocks`` ranges of bits, so there is one vantage-point
tree per range. The Hamming distance within a range is a metric, and with the smaller
radius far fewer fingerprints lie near a boundary: at 4 bits, 1 of 21 instead of 4 of 64.

A tree node holds a vantage point and a distance. A fingerprint goes to the inner side if it
lies within that distance, else to the outer side. By the triangle inequality a pair that the
boundary parts has an inner end within the radius of it; such an end also visits the outer
shard. A pair therefore meets in a shard where at least one end is at home, and there all
64 bits are compared.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import signed, stored, text_pieces, unsigned
from tarnlake.llm.components import components

SEED = 42
#: Shingles hashed at a time, which bounds the memory that one very long text takes.
SHINGLES_AT_ONCE = 1 << 18
#: The trees are grown on a sample of so many fingerprints, or of so many per leaf.
TREE_SAMPLE = 200_000
SAMPLE_PER_LEAF = 6
#: A tree's leaves follow the number of fingerprints up to this; a range of bits has 8 times as many values.
MAX_LEAVES = 1 << 18
MAX_DEPTH = 32
#: Fingerprints that go down a tree together.
PLACED_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """The SimHash of a text: a bit is 1 if set in over half its shingles' hashes.

    A-Z are lower-cased; a shingle is ``shingle_words`` words joined by a space, and each
    occurrence counts. Fewer words make one shingle; no words (or null) make 0.
    """
    if not text:
        return 0
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = memoryview(b" ".join(tokens))
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    ends = ends[min(shingle_words, len(tokens)) - 1 :]
    ones = np.zeros(64, dtype=np.int64)
    hashed = xxhash.xxh64_intdigest
    for i in range(0, len(ends), SHINGLES_AT_ONCE):
        to = ends[i : i + SHINGLES_AT_ONCE].tolist()
        spans = zip(starts[i : i + len(to)].tolist(), to)
        hashes = np.array([hashed(joined[s:e], SEED) for s, e in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * ones > len(ends)))


def fingerprints(name: Column, text: Column, docs: DataFrame, shingle_words: int = 4) -> DataFrame:
    """(``name``, ``fp``) per row of ``docs``; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_pieces(batches, "text"):
            found = np.array([fingerprint(t, shingle_words) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(signed(found))], ["name", "fp"])

    rows = docs.select(name.alias("name"), text.alias("text"))
    return rows.mapInArrow(run, rows.select("name").schema.add("fp", "long"))


class Tree:
    """A vantage-point tree over one range of bits, as arrays: vantage, boundary and children.

    Children below zero are leaves. It is grown on a sample; it places any fingerprint.
    """

    def __init__(self, sample: np.ndarray, mask: int, radius: int, leaves: int, rng: np.random.Generator):
        self.mask, self.radius = np.uint64(mask), radius
        self.vantage, self.boundary, self.inner, self.outer = [], [], [], []
        self.leaves = 0
        self._leaf_size = max(1.0, len(sample) / max(1, leaves))
        self.root = self._grow(sample & self.mask, 0, rng)
        self.vantage = np.array(self.vantage, dtype=np.uint64)

    def _grow(self, points, depth, rng) -> int:
        if len(points) <= self._leaf_size or depth >= MAX_DEPTH:
            return self._leaf()
        best = None
        for vantage in points[rng.integers(len(points), size=4)]:
            away = np.bitwise_count(points ^ vantage)
            counts = np.cumsum(np.bincount(away, minlength=65))
            uneven = np.abs(2 * counts - len(points))
            boundary = int(np.argmin(uneven))
            if best is None or uneven[boundary] < best[0]:
                best = (uneven[boundary], vantage, boundary, away)
        _, vantage, boundary, away = best
        within = away <= boundary
        if within.all() or not within.any():
            return self._leaf()
        node = len(self.vantage)
        self.vantage.append(vantage)
        self.boundary.append(boundary)
        self.inner.append(0)
        self.outer.append(0)
        self.inner[node] = self._grow(points[within], depth + 1, rng)
        self.outer[node] = self._grow(points[~within], depth + 1, rng)
        return node

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def place(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, at home) for every shard that each fingerprint is at home in or visits.

        With a radius of 1 the ball around a fingerprint holds one point per bit. Each of them moves a
        bit nearer to a vantage point or farther from it, so a visitor takes along the flips that can
        still be on its side, and turns back where none is left: it visits no shard without such a point.
        """
        rows, leaves, homes = [], [], []
        points = points & self.mask
        todo = [(self.root, np.arange(len(points)), np.ones(len(points), dtype=bool), np.full(len(points), self.mask))]
        while todo:
            node, at, home, flips = todo.pop()
            if not len(at):
                continue
            if node < 0:
                rows.append(at)
                leaves.append(np.full(len(at), -node - 1, dtype=np.int32))
                homes.append(home)
                continue
            differing = points[at] ^ self.vantage[node]
            away = np.bitwise_count(differing).astype(np.int64) - self.boundary[node]
            inside = away <= 0
            if self.radius == 1:
                inward = np.where(away < 0, flips, np.where(away <= 1, flips & differing, np.uint64(0)))
                outward = flips & ~inward
                reaches_in, reaches_out = inward != 0, outward != 0
            else:
                inward = outward = flips
                reaches_in, reaches_out = away <= self.radius, away > -self.radius
            # The inner end of a parted pair visits the outer side; one at home outside stays there.
            # A visitor at home elsewhere goes on to every side its ball touches.
            into = np.where(home, inside, reaches_in)
            over = np.where(home, ~inside | reaches_out, reaches_out)
            todo.append((self.inner[node], at[into], home[into], inward[into]))
            todo.append((self.outer[node], at[over], home[over] & ~inside[over], outward[over]))
        return np.concatenate(rows or [np.empty(0, np.int64)]), np.concatenate(leaves or [np.empty(0, np.int32)]), np.concatenate(homes or [np.empty(0, bool)])


def masks(blocks: int) -> list[int]:
    """The 64 bits cut into ranges of nearly equal length."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [sum(1 << bit for bit in range(low, high)) for low, high in zip(cuts, cuts[1:])]


def shard_links(points: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the points of a shard as all pairs within ``max_bits`` would.

    Exact: a point is compared with every point that no earlier one has reached, visitors
    only with points at home. Each point found is linked to the one that found it, so the
    number of links stays below the number of points, however dense the shard.
    """
    order = np.arange(len(points))
    left_home, left_visit = order[home], order[~home]
    found_from, found_to = [], []
    while len(left_home):  # visitors that no point at home reaches are compared elsewhere
        queue, left_home = [int(left_home[0])], left_home[1:]
        while queue:
            p = queue.pop()
            near = np.bitwise_count(points[left_home] ^ points[p]) <= max_bits
            new = left_home[near]
            left_home = left_home[~near]
            if home[p] and len(left_visit):
                near = np.bitwise_count(points[left_visit] ^ points[p]) <= max_bits
                new = np.concatenate([new, left_visit[near]])
                left_visit = left_visit[~near]
            if len(new):
                found_from.append(np.full(len(new), p))
                found_to.append(new)
                queue.extend(new.tolist())
    if not found_from:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_from), np.concatenate(found_to)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The fingerprints of several batches at a time."""
    held, count = [], 0
    for batch in batches:
        held.append(unsigned(batch.column("fp").to_numpy(zero_copy_only=False)))
        count += len(batch)
        if count >= PLACED_AT_ONCE:
            yield np.concatenate(held)
            held, count = [], 0
    if count:
        yield np.concatenate(held)


def fingerprint_links(prints: DataFrame, max_bits: int = 4, blocks: int = 3, leaf_size: int = 1000, cell_size: int = 8192) -> DataFrame:
    """(``a``, ``b``): links that connect distinct fingerprints ``fp`` as all pairs within ``max_bits`` do.

    Only a sample of ``TREE_SAMPLE`` fingerprints (``SAMPLE_PER_LEAF`` times ``MAX_LEAVES`` at most: 13 MB) comes to the driver,
    to grow the trees. A shard of more than ``cell_size`` points is dealt into chunks, and every two chunks meet in a task of their own.
    """
    spark = prints.sparkSession
    total = prints.count()
    schema = "a long, b long"
    if total < 2:
        return spark.createDataFrame([], schema)
    leaves = max(1, min(MAX_LEAVES, total // leaf_size))
    wanted = max(TREE_SAMPLE, SAMPLE_PER_LEAF * leaves)
    share = min(1.0, 1.2 * wanted / total)
    # By the fingerprint itself, so that every run draws the same.
    drawn = prints.where(F.pmod(F.xxhash64(F.lit("tree"), "fp"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = unsigned(drawn.orderBy(F.xxhash64(F.lit("order"), "fp")).limit(wanted).select("fp").toArrow().column("fp").to_numpy())
    if len(sample) == 0:
        sample = np.zeros(1, dtype=np.uint64)
    rng = np.random.default_rng(SEED)
    radius = max_bits // blocks
    trees = [Tree(sample, mask, radius, leaves, rng) for mask in masks(blocks)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for points in gathered(batches):
            for number, tree in enumerate(trees):
                row, leaf, home = tree.place(points)
                columns = [pa.array(np.full(len(row), number, dtype=np.int32)), pa.array(leaf), pa.array(signed(points[row])), pa.array(home)]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "leaf", "fp", "home"])

    placed = stored(prints.select("fp").mapInArrow(place, "tree int, leaf int, fp long, home boolean"), "shards")
    # A row per shard that is cut: bounded by blocks * MAX_LEAVES, whatever the corpus.
    cut = placed.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / cell_size).alias("chunks")).where("chunks > 1")
    celled = (
        placed.join(F.broadcast(cut), ["tree", "leaf"], "left")
        .withColumn("chunks", F.coalesce("chunks", F.lit(1).cast("long")))
        .withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("tree", "leaf", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "fp", "home")
    )

    def link(group: pa.Table) -> pa.Table:
        points = unsigned(group.column("fp").to_numpy())
        home = group.column("home").to_numpy()
        a, b = shard_links(points, home, max_bits)
        return pa.table({"a": signed(points[a]), "b": signed(points[b])})

    return celled.groupBy("tree", "leaf", "i", "j").applyInArrow(link, schema)


def _rooted(prints: DataFrame, max_bits: int, leaf_size: int) -> DataFrame:
    """(``fp``, ``first``, ``root``) per distinct fingerprint: its least name and its component's root."""
    classes = stored(prints.groupBy("fp").agg(F.min("name").alias("first")), "classes")
    roots = components(fingerprint_links(classes, max_bits, leaf_size=leaf_size))
    return classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def simhash_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 4,
    max_bits: int = 4,
    leaf_size: int = 1000,
) -> DataFrame:
    """(``doc_id``, ``fingerprint``, ``component_id``, ``kept``), one row per row of ``docs``.

    Rows whose fingerprints differ in at most ``max_bits`` bits are linked;
    ``component_id`` is the least id reachable. Equal fingerprints are grouped before any
    search, so thousands of copies count once; the search sees distinct fingerprints only.

    Null or empty texts have fingerprint zero and are linked like any other. A null id takes
    part in links and never names a component with ids; a component of null ids alone has a
    null ``component_id``. Repeated rows each get their row. Other columns are not read.
    """
    prints = stored(fingerprints(F.col(id_column).cast("long"), F.col(text_column), docs, shingle_words), "fingerprints")
    rooted = _rooted(prints, max_bits, leaf_size)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.withColumnRenamed("name", "doc_id").join(of_class, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull() & F.col("component_id").isNull()).alias("kept"),
    )


def drop_near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 4,
    max_bits: int = 4,
    leaf_size: int = 1000,
) -> DataFrame:
    """One row of ``docs`` of each component that ``simhash_dedup`` finds, with all its columns.

    Decided by row, not by id: the row that stays has the component's least id, and of the rows
    with that id the least text digest, then the least other columns. So a row goes only if its
    fingerprint is linked, over others or directly, to that of the row that stays; an id
    repeated with unlike texts stays once per component. Ids come before null ids, and a
    component of null ids alone keeps one row too. The other columns have to be orderable.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_column, text_column)]
    of_row = [F.col(id_column).isNull(), F.col(id_column), F.sha2(F.col(text_column).cast("binary"), 256), *others]
    # A row's name: rows that agree in it agree in all columns.
    name = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(of_row)])
    prints = stored(fingerprints(name, F.col(text_column), docs, shingle_words), "fingerprints")
    kept = _rooted(prints, max_bits, leaf_size).groupBy("root").agg(F.min("first").alias("kept"))
    # Rows and names meet by a digest of the name; the join has brought equal rows together.
    digest = lambda row: F.sha2(F.to_json(row), 256)
    found = docs.select(F.struct("*").alias("row"), digest(name).alias("key")).join(kept.select(digest(F.col("kept")).alias("key")), "key", "left_semi")
    return found.dropDuplicates(["key"]).select("row.*")
