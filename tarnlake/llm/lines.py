"""Line dedup: repeated lines looked up in sharded minimal perfect hashes.

The index holds, for each distinct key of a line that several documents share, a fingerprint,
the number of documents and the least document id, in arrays without keys: a minimal perfect
hash gives the place in the arrays. A key that is not in the index is told by its fingerprint.
Documents send only the 16 bytes of a line's hash to a shard, never a line.
"""

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import SPACE, UPPER, LOWER, mixed, prepare, stored, text_pieces, unsigned

#: Distinct keys of a shard, and line hashes that one task looks up in it. At the check's sizes a
#: shard's arrays take about 2 MB.
KEYS_PER_SHARD = 100_000
PROBES_PER_TASK = 500_000
MIN_CHARS = 10
#: Bits per key of each level of the hash; more bits, fewer levels.
SPREAD = 2

_LOWER = str.maketrans(UPPER, LOWER)
#: Where a null document id counts: after all others.
NULL_ID = 2**63 - 1


class PerfectHash:
    """A minimal perfect hash of distinct (high, low) pairs of 64 bits.

    Level by level, keys that are alone at their place of a bit array are settled and the
    others go on to the next, smaller level, until none is left. A key's number is the count
    of set bits before its place. ``levels`` is a list of packed bit arrays.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.levels, self.sizes = [], []
        while len(high):
            size = SPREAD * len(high) + 1
            at = self._places(high, low, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append(alone)
            self.sizes.append(size)
            stay = ~alone[at]
            high, low = high[stay], low[stay]
        self._count()

    def _count(self):
        bits = np.concatenate(self.levels or [np.empty(0, bool)])
        self.before = np.cumsum(bits, dtype=np.int64) - bits
        self.starts = np.cumsum([0, *self.sizes[:-1]]) if self.sizes else np.empty(0, np.int64)
        self.total = int(bits.sum())

    @staticmethod
    def _places(high, low, level, size):
        return (mixed(high ^ mixed(low, level + 1), level) % np.uint64(size)).astype(np.int64)

    def index(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The number of each key, from 0 on without gaps; any number or -1 for a key not put in."""
        found = np.full(len(high), -1, dtype=np.int64)
        todo = np.arange(len(high))
        for level, (bits, size) in enumerate(zip(self.levels, self.sizes)):
            if not len(todo):
                break
            at = self._places(high[todo], low[todo], level, size)
            hit = bits[at]
            found[todo[hit]] = self.before[self.starts[level] + at[hit]]
            todo = todo[~hit]
        return found

    def pack(self) -> bytes:
        head = np.array([len(self.sizes), *self.sizes], dtype="<i8").tobytes()
        return head + b"".join(np.packbits(level).tobytes() for level in self.levels)

    @classmethod
    def unpack(cls, data: bytes) -> "PerfectHash":
        made = cls(np.empty(0, np.uint64), np.empty(0, np.uint64))
        count = int(np.frombuffer(data, "<i8", 1)[0])
        made.sizes = np.frombuffer(data, "<i8", count, 8).tolist()
        at = 8 * (count + 1)
        for size in made.sizes:
            length = -(-size // 8)
            made.levels.append(np.unpackbits(np.frombuffer(data, np.uint8, length, at), count=size).astype(bool))
            at += length
        made._count()
        return made


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> tuple[list[str], list[bytes | None]]:
    """The lines of a text, and the hash of each one's key, None where the key is too short."""
    lines = (text or "").split("\n")
    keys = [line.strip(SPACE).translate(_LOWER) if len(line) >= min_chars else "" for line in lines]
    digest = xxhash.xxh3_128_digest
    return lines, [digest(k.encode("utf-8", "surrogatepass")) if len(k) >= min_chars else None for k in keys]


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(``doc``, ``text_hash``, ``high``, ``low``): each distinct key of each row's text as 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_pieces(batches, "text"):
            ids, marks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "text_hash"))
            counts, hashes = [], []
            for text in texts:
                distinct = dict.fromkeys(line_keys(text, min_chars)[1])
                distinct.pop(None, None)
                counts.append(len(distinct))
                hashes.extend(distinct)
            pairs = np.frombuffer(b"".join(hashes), dtype=">i8").astype(np.int64).reshape(-1, 2)
            columns = [np.repeat(ids, counts), np.repeat(marks, counts), np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "text_hash", "high", "low"])

    return docs.mapInArrow(run, "doc long, text_hash long, high long, low long")


def build_index(hashes: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> tuple[DataFrame, int]:
    """The stored index, one row per shard, and the number of shards.

    (``shard``, ``hash``, ``prints``, ``counts``, ``firsts``). Keys that one
    document alone holds decide nothing and are left out: a probe for one fails its
    fingerprint. Counting combines in each task first, so a line in a third of all documents
    costs a row per task.
    """
    shared = stored(
        hashes.groupBy("high", "low")
        .agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"))
        .where(F.col("first") < F.col("last"))
        .drop("last"),
        "shared-lines",
    )
    shards = max(1, -(-shared.count() // keys_per_shard))

    def build(group: pa.Table) -> pa.Table:
        high, low = (unsigned(group.column(c).to_numpy()) for c in ("high", "low"))
        table = PerfectHash(high, low)
        place = table.index(high, low)
        prints, counts, firsts = (np.empty(len(high), dtype) for dtype in ("<u8", "<i8", "<i8"))
        prints[place] = low
        counts[place] = group.column("n").to_numpy()
        firsts[place] = group.column("first").to_numpy()
        row = {"shard": group.column("shard")[0].as_py(), "hash": table.pack()}
        row |= {"prints": prints.tobytes(), "counts": counts.tobytes(), "firsts": firsts.tobytes()}
        return pa.Table.from_pylist([row], schema=_INDEX)

    index = shared.withColumn("shard", _shard(shards)).groupBy("shard").applyInArrow(
        build, "shard int, hash binary, prints binary, counts binary, firsts binary"
    )
    return stored(index, "line-index"), shards


_INDEX = pa.schema(
    [("shard", pa.int32()), ("hash", pa.binary()), ("prints", pa.binary()), ("counts", pa.binary()), ("firsts", pa.binary())]
)


_PROBE = ["doc", "text_hash", "high", "low"]


def _shard(shards):
    return F.pmod(F.col("high"), F.lit(shards)).cast("int")


def _probe(key, probes: pa.Table, index: pa.Table) -> pa.Table:
    """The probes that lose their lines: keys of several documents, of which this is not the first."""
    if not len(index) or not len(probes):
        return probes.select(_PROBE).slice(0, 0)
    row = index.to_pylist()[0]
    table = PerfectHash.unpack(row["hash"])
    prints, counts, firsts = (np.frombuffer(row[c], t) for c, t in (("prints", "<u8"), ("counts", "<i8"), ("firsts", "<i8")))
    high, low = (unsigned(probes.column(c).to_numpy()) for c in ("high", "low"))
    place = table.index(high, low)
    known = (place >= 0) & (prints[place] == low)
    lost = known & (counts[place] >= 2) & (firsts[place] != probes.column("doc").to_numpy())
    return probes.select(_PROBE).filter(pa.array(lost))


def dealt_probes(hashes: DataFrame, index: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """All line hashes, unique ones too, and the index, dealt into parts (``shard``, ``part``) that belong together.

    A shard has as many parts, and copies of its arrays, as all its line hashes make up by
    ``PROBES_PER_TASK``. Hashes are dealt in turn of the stored rows, not by document, so no
    id, null id or repeated text fills a part. The numbers of parts are broadcast: 12 bytes
    for ``KEYS_PER_SHARD`` repeated lines.
    """
    sharded = hashes.withColumn("shard", _shard(shards))
    count = F.count(F.lit(1))
    parts = sharded.groupBy("shard").agg(F.ceil(count / PROBES_PER_TASK).alias("parts")).join(index.select("shard"), "shard", "left_semi")
    parts = stored(parts, "line-parts")
    probes = sharded.withColumn("turn", F.xxhash64(F.monotonically_increasing_id())).join(F.broadcast(parts), "shard")
    probes = probes.select("shard", F.pmod("turn", "parts").alias("part"), *_PROBE)
    copies = index.join(F.broadcast(parts), "shard").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return probes, copies.drop("parts")


def lost_lines(texts: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(``doc``, ``text_hash``, ``lost``): the line keys that each distinct row of ``texts`` loses.

    A null or repeated id holds many texts; each has its own row here, with its own keys only.
    Should two texts of an id agree in ``text_hash``, they share a row and nothing changes:
    whether a key is lost depends on the id and the key alone.
    """
    hashes = stored(line_hashes(texts, min_chars), "line-hashes")
    probes, copies = dealt_probes(hashes, *build_index(hashes))
    return (
        probes.groupBy("shard", "part")
        .cogroup(copies.groupBy("shard", "part"))
        .applyInArrow(_probe, "doc long, text_hash long, high long, low long")
        .groupBy("doc", "text_hash")
        .agg(F.collect_set(F.struct("high", "low")).alias("lost"))
    )


def line_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated lines dropped, and ``n_lines``, ``n_dropped``, ``kept_text``.

    A line's key is the line stripped of ASCII white space with A-Z lower-cased. Keys of at
    least ``min_chars`` code points in at least two documents lose their lines everywhere but
    in the document with the least id that holds them; a document keeps its own repeats.

    A null or empty text is one empty line and becomes the empty text. Rows with equal ids
    count as one document and keep alike; null ids are one document after all others. All
    columns of ``docs`` pass through, under their own names; a column named like a result is
    replaced.
    """
    spark = prepare(docs.sparkSession)
    doc = F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID))
    named = [doc.alias("doc"), F.xxhash64(text_column).alias("text_hash"), F.col(text_column).alias("text")]
    lost = lost_lines(docs.select(*named), min_chars)
    made = ("n_lines", "n_dropped", "kept_text")
    own = [c for c in docs.columns if c not in made]
    row = F.struct(*[F.col(f"`{c}`") for c in own]).alias("row")
    marked = docs.select(*named, row).join(lost, ["doc", "text_hash"], "left")
    kept = marked.select("text", "lost", "row").mapInArrow(
        _render(min_chars), marked.select("row").schema.add("n_lines", "long").add("n_dropped", "long").add("kept_text", "string")
    )
    return kept.select("row.*", *made)


def _render(min_chars):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_pieces(batches, "text"):
            dropped = batch.column("lost")
            totals, losses, kept = [], [], []
            for i, text in enumerate(texts):
                lost = dropped[i]
                if not lost.is_valid:
                    totals.append((text or "").count("\n") + 1)
                    losses.append(0)
                    kept.append(text or "")
                    continue
                gone = np.array([(h["high"], h["low"]) for h in lost.as_py()], dtype=">i8").tobytes()
                gone = {gone[k : k + 16] for k in range(0, len(gone), 16)}
                lines, keys = line_keys(text, min_chars)
                stay = [k not in gone for k in keys]
                totals.append(len(lines))
                losses.append(len(lines) - sum(stay))
                kept.append("\n".join(compress(lines, stay)))
            arrays = [batch.column("row"), pa.array(totals, pa.int64()), pa.array(losses, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "n_lines", "n_dropped", "kept_text"])

    return run


ORACLE = """
WITH lines AS (
  SELECT doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents)
), firsts AS (
  SELECT key, min(doc_id) AS first_id FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT l.doc_id, l.i, l.line, f.key IS NOT NULL AND l.doc_id <> f.first_id AS dropped
  FROM lines l LEFT JOIN firsts f ON l.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
