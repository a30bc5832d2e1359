"""Quality rules: counts per document, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed words and word pairs, one from trusted documents and one from the
whole corpus. A document's score is the mean log ratio of its n-grams; a document below the
threshold is rejected. There is no drawing of documents: equal inputs give equal verdicts.
"""

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import SPACE, mixed, prepare, stored, text_pieces, words

#: Buckets of the two multinomials: at least so many for the square root of the corpus' distinct
#: n-grams, and 2^LEAST_BITS. They grow with the corpus; 2^25 (16 bytes each) serve 10^12 n-grams.
BUCKETS_PER_ROOT = 32
LEAST_BITS = 16
#: The distinct n-grams are counted in this many registers, to some two percent.
REGISTER_BITS = 12
#: Up to so many labelled ids, some 100 MB, are sent to every task; more are joined as Spark chooses.
SENT_LABELS = 2_000_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: Share of trusted documents, held out from the fit, below which the threshold begins.
TRUSTED_TAIL = 0.001
#: Scores are counted in bins of this width to find the threshold.
BIN = 0.005

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


@dataclass(frozen=True)
class QualityModel:
    """Log ratios by bucket and the least score that is kept; no ratios: every document is kept."""

    ratios: np.ndarray | None
    threshold: float


def hashes(tokens: list[bytes]) -> np.ndarray:
    """64-bit hashes of a document's words and of its pairs of neighbouring words."""
    single = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    pairs = mixed(single[:-1], 1) + single[1:]
    return mixed(np.concatenate([single, pairs]), 2)


def buckets(tokens: list[bytes], bits: int) -> np.ndarray:
    return (hashes(tokens) >> np.uint64(64 - bits)).astype(np.int64)


def distinct_ngrams(rows: DataFrame) -> float:
    """About how many different words and pairs the texts hold (HyperLogLog, over all of them)."""
    size = 1 << REGISTER_BITS

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        registers = np.zeros(size, np.int64)
        for _, texts in text_pieces(batches, "text"):
            found = np.concatenate([hashes(words(text)) for text in texts])
            place = (found >> np.uint64(64 - REGISTER_BITS)).astype(np.int64)
            rest = (found << np.uint64(REGISTER_BITS)) | np.uint64(1 << (REGISTER_BITS - 1))
            zeros = 63 - np.floor(np.log2(rest.astype(np.float64))).astype(np.int64)
            np.maximum.at(registers, place, np.maximum(zeros, 0) + 1)
        seen = np.flatnonzero(registers)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(registers[seen])], ["register", "most"])

    table = rows.select("text").mapInArrow(observe, "register long, most long").groupBy("register").agg(F.max("most").alias("most")).toArrow()
    registers = np.zeros(size)
    registers[table.column("register").to_numpy()] = table.column("most").to_numpy()
    estimate = 0.7213 / (1 + 1.079 / size) * size**2 / np.exp2(-registers).sum()
    empty = int((registers == 0).sum())
    return size * np.log(size / empty) if empty and estimate <= 2.5 * size else float(estimate)


def bucket_bits(distinct: float) -> int:
    return max(LEAST_BITS, math.ceil(math.log2(BUCKETS_PER_ROOT * math.sqrt(max(distinct, 1.0)))))


def repeat_words(tokens: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(tokens) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    n = np.fromiter((numbers.setdefault(t, len(numbers)) for t in tokens), np.int64, len(tokens))
    base = len(numbers)
    pairs = n[:-1] * base + n[1:]
    if base >= 1 << 20:  # ranks instead of values, which would not fit into 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, window, counts = np.unique(pairs[:-1] * base + n[2:], return_inverse=True, return_counts=True)
    often = counts[window] >= 2
    covered = np.zeros(len(tokens), dtype=bool)
    for shift in range(3):
        covered[shift : len(often) + shift] |= often
    return int(covered.sum())


def rules(text: str | None, tokens: list[bytes]) -> tuple:
    """The base counts of a text, in the order of ``FEATURES``."""
    text = text or ""
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    n, repeated = len(tokens), repeat_words(tokens)
    return (
        n,
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n,
    )


def score(tokens: list[bytes], ratios: np.ndarray) -> float:
    """Mean log ratio of the n-grams; a text without words scores zero."""
    return float(ratios[buckets(tokens, len(ratios).bit_length() - 1)].mean()) if tokens else 0.0


#: What a labelled document is for.
FITS, HOLDS, REJECTED = 0, 1, 2


def _label_uses(labels, id_column):
    """All labelled ids (``id``) with their ``use``, the same on every run; toxic ones are never trusted."""
    judged = labels.groupBy(F.col(id_column).cast("long").alias("id")).agg(
        F.min("quality").alias("low"), F.max("quality").alias("high"), F.max("toxic").alias("toxic")
    )
    both = lambda quality: (F.col("low") == quality) & (F.col("high") == quality)
    half = F.pmod(F.xxhash64(F.lit("quality"), "id"), F.lit(2)).cast("int")
    use = F.when(both(1) & (F.coalesce("toxic", F.lit(0)) == 0), half).when(both(0), F.lit(REJECTED))
    return judged.where("id IS NOT NULL").select("id", use.alias("use")).where("use IS NOT NULL")


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", bits: int | None = None) -> QualityModel:
    """The model: n-gram counts over all documents, the trusted side from labelled ones.

    Of all documents labelled 1 (and not toxic) one half, by a hash of the id, fits the
    trusted side; the other half, and all documents labelled 0, set the threshold. It lies a third
    of the way from the score that all but ``TRUSTED_TAIL`` of the trusted documents reach to
    the median of the rejected ones, so that clean documents are well above it; with no
    rejected ones it is one unit below the former. Without trusted documents nothing is rejected.
    """
    spark = prepare(docs.sparkSession)
    uses = stored(_label_uses(labels, id_column), "label-uses")
    numbers = {r["use"]: r["count"] for r in uses.groupBy("use").count().collect()}
    if FITS not in numbers:
        return QualityModel(None, 0.0)
    # Of labels sent to all tasks, the texts of the documents stay where they are.
    sent = F.broadcast if sum(numbers.values()) <= SENT_LABELS else lambda df: df
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    bits = bits or bucket_bits(distinct_ngrams(rows))
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch, texts in text_pieces(batches, "text"):
            good = batch.column("use").fill_null(REJECTED).to_numpy() == FITS
            found = [buckets(words(text), bits) for text in texts]
            raw += np.bincount(np.concatenate(found), minlength=size)
            if good.any():
                target += np.bincount(np.concatenate([f for f, is_good in zip(found, good) if is_good]), minlength=size)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])

    marked = rows.join(sent(uses), "id", "left").select("text", "use")
    table = marked.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    counted = table.toArrow()
    raw, target = np.zeros(size), np.zeros(size)
    place = counted.column("bucket").to_numpy()
    raw[place], target[place] = counted.column("raw").to_numpy(), counted.column("target").to_numpy()
    # One more count per bucket on either side: what neither has seen says nothing.
    ratios = np.log((target + 1) / (target.sum() + size)) - np.log((raw + 1) / (raw.sum() + size))

    def score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_pieces(batches, "text"):
            bins, good = [], []
            for text, is_good in zip(texts, batch.column("good").to_pylist()):
                tokens = words(text)
                if not rules(text, tokens)[-1]:
                    bins.append(int(np.floor(score(tokens, ratios) / BIN)))
                    good.append(is_good)
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.int64()), pa.array(good, pa.bool_())], ["bin", "good"])

    held_out = uses.where(F.col("use") != FITS).select("id", (F.col("use") == HOLDS).alias("good"))
    bins = rows.join(sent(held_out), "id").select("text", "good").mapInArrow(score_rows, "bin long, good boolean")
    seen = bins.groupBy("good", "bin").agg(F.count(F.lit(1)).alias("n")).orderBy("good", "bin").collect()
    good = [(r["bin"], r["n"]) for r in seen if r["good"]]
    bad = [(r["bin"], r["n"]) for r in seen if not r["good"]]
    if not good:
        return QualityModel(None, 0.0)
    low = _quantile(good, TRUSTED_TAIL)
    middle = _quantile(bad, 0.5) if bad else low - 3.0
    return QualityModel(ratios, min(low, low + (middle - low) / 3))


def _quantile(bins: list[tuple[int, int]], share: float) -> float:
    """The lower edge of the bin that holds the quantile."""
    wanted, so_far = share * sum(n for _, n in bins), 0
    for number, n in bins:
        so_far += n
        if so_far > wanted:
            return number * BIN
    return bins[-1][0] * BIN


def quality_rules(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: QualityModel | None = None
) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``quality_score`` and ``kept``.

    ``kept`` is false where the base rules fail (under ``MIN_WORDS`` words, or more than
    ``MAX_REPEAT_PERCENT`` percent repeated words), else whether the score reaches the
    model's threshold. Whole texts count. A null or empty text has no words and fails.
    Repeated rows are judged each; a null id is never a labelled one; other columns pass
    through, one named like a result is replaced. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    model = model or fit(docs, labels, id_column, text_column)
    made = [*[f.split()[0] for f in FEATURES.split(", ")], "quality_score", "kept"]
    own = [c for c in docs.columns if c not in made]
    rows = docs.select(F.col(text_column).alias("text"), F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    schema = rows.select("row").schema
    for field in (FEATURES + ", quality_score double, kept boolean").split(", "):
        schema = schema.add(*field.split())
    ratios, threshold = model.ratios, model.threshold

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_pieces(batches, "text"):
            found = []
            for text in texts:
                tokens = words(text)
                counts = rules(text, tokens)
                points = score(tokens, ratios) if ratios is not None else 0.0
                found.append((*counts, points, not counts[-1] and points >= threshold))
            arrays = [pa.array(column) for column in zip(*found)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *arrays], ["row", *made])

    return rows.mapInArrow(judge, schema).select("row.*", *made)
