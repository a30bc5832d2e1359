"""URL filter: host and path rules, and two character language models for what no rule decides.

Each model is a Markov chain of variable order over the bytes of a URL: the estimate of a
longer context leans on that of the next shorter one, the more so the more different bytes have
followed the context and the less often it was seen (Witten-Bell smoothing, down to an even
share of all bytes). URLs that a rule allows train one model, blocked ones the other, each
without the part that the rule has matched: the models learn from what the rules do not say.

What a byte adds to a score depends on itself and the ``ORDER`` bytes before it alone. These
windows meet the counted n-grams in as many tasks as there are n-grams for; no task and no
driver holds a whole model.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import lower_ascii, prepare, stored

#: (action, host and path) in the order of the contract.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Longest context, in bytes.
ORDER = 4
#: No bound on the distinct n-grams of the models: contexts have ``ORDER`` bytes whatever the size of
#: the table. Whoever sets a bound gets contexts as much shorter as it takes to keep it.
MAX_GRAMS: int | None = None
#: About so many n-grams, and so many windows at a time, are in one task.
GRAMS_PER_SHARD = 500_000
#: What bytes add is summed up in units of 2^-36, which come to the same in any order.
UNITS = 1 << 36
#: Of five parts of the rows that rules decide, four train the models, one sets the threshold.
FOLDS = 5
BIN = 0.01

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url) -> Column:
    """What is between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as (``action``, ``rule``); null where none does.

    A rule fits its host and all subdomains where the path starts with the rule's path.
    """
    found = F.lit(None).cast("struct<action:string,rule:string>")
    for action, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        found = F.when(fits, F.struct(F.lit(action).alias("action"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


@dataclass(frozen=True)
class Counts:
    """Of one class, exactly: how often each n-gram and each context was seen, and how many
    different bytes followed the context. Keys are sorted; ``order`` is the longest context."""

    order: int
    grams: np.ndarray
    gram_counts: np.ndarray
    contexts: np.ndarray
    context_counts: np.ndarray
    followers: np.ndarray


_PLACE = 56  # bits of the bytes in a key; the n-gram's order stands above them


def gram_keys(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the texts one after the other (with an end mark) the key of the n-gram it
    ends, by order; and the number of bytes of each text. A key holds the bytes themselves."""
    raw = [b"\x02" * ORDER + t.encode("utf-8", "surrogatepass") + b"\x03" for t in texts]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw)) - ORDER
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
    starts = np.cumsum(lengths + ORDER) - lengths
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
    keys, code = [], data[at]
    for n in range(order + 1):
        if n:
            code = code | (data[at - n] << (8 * n))
        keys.append(code | (n << _PLACE))
    return np.array(keys, dtype=np.int64), lengths


def context_of(keys: np.ndarray) -> np.ndarray:
    """The key of an n-gram without its last byte; its order stays the n-gram's."""
    return ((keys & ((1 << _PLACE) - 1)) >> 8) | (keys >> _PLACE << _PLACE)


def _found(known: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[place] == keys, counts[place], 0)


def _log_chances(keys: np.ndarray, counts: Counts) -> np.ndarray:
    """Log probability of the last byte of n-grams, given by their keys of every order from 0 on."""
    chance = np.full(keys.shape[1], 1 / 256)
    for own in keys:
        context = context_of(own)
        seen = _found(counts.contexts, counts.context_counts, context)
        kinds = _found(counts.contexts, counts.followers, context)
        total = seen + kinds
        here = _found(counts.grams, counts.gram_counts, own)
        chance = np.where(total > 0, (here + kinds * chance) / np.maximum(total, 1), chance)
    return np.log(chance)


def mean_log_likelihood(texts: list[str], counts: Counts) -> np.ndarray:
    """Mean log probability of a byte of each text, its end included."""
    keys, lengths = gram_keys(texts, counts.order)
    ends = np.cumsum(lengths)
    sums = np.concatenate([[0.0], np.cumsum(_log_chances(keys, counts))])
    return (sums[ends] - sums[ends - lengths]) / lengths


def scores(texts: list[str], allowed: Counts, blocked: Counts) -> np.ndarray:
    """Log-likelihood difference per byte; above zero speaks for allowed."""
    return mean_log_likelihood(texts, allowed) - mean_log_likelihood(texts, blocked) if texts else np.empty(0)


def _counts(order: int, keys: np.ndarray, counts: np.ndarray) -> Counts:
    keys, counts = keys[counts > 0], counts[counts > 0]
    contexts, first = np.unique(context_of(keys), return_index=True)  # sorted keys keep contexts together
    return Counts(order, keys, counts, contexts, np.add.reduceat(counts, first), np.diff(np.append(first, len(keys))))


def _fit(decided: DataFrame) -> tuple[DataFrame, int, int] | None:
    """From (``text``, ``allow``) rows the stored counts ``gram``, ``blocked`` and ``allowed``, the
    longest context and the number of n-grams up to it; None where a class has no row.

    Each task counts its n-grams, Spark adds the counts up by n-gram.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            allow = batch.column("allow").to_numpy(zero_copy_only=False).astype(bool)
            texts = batch.column("text").to_pylist()
            for side in (False, True):
                if own := [t for t, a in zip(texts, allow) if a == side]:
                    keys, n = np.unique(gram_keys(own)[0], return_counts=True)
                    columns = [pa.array(keys), pa.array(np.zeros(len(n), np.int64) if side else n), pa.array(n if side else np.zeros(len(n), np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["gram", "blocked", "allowed"])

    counted = decided.mapInArrow(count, "gram long, blocked long, allowed long").groupBy("gram")
    grams = stored(counted.agg(F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed")), "url-grams")
    by_order = grams.groupBy(F.shiftright("gram", _PLACE).alias("n")).agg(F.count(F.lit(1)).alias("grams"), F.sum("blocked"), F.sum("allowed"))
    found = {r[0]: r[1:] for r in by_order.collect()}
    if not found or not found[0][1] or not found[0][2]:
        return None
    sizes = [sum(found[i][0] for i in range(n + 1)) for n in range(ORDER + 1)]
    order = max(n for n in range(ORDER + 1) if n == 0 or MAX_GRAMS is None or sizes[n] <= MAX_GRAMS)
    return grams, order, sizes[order]


def _window_points(windows: DataFrame, model: tuple[DataFrame, int, int]) -> DataFrame:
    """``window`` and ``points``: what its last byte adds to a score, in ``UNITS``.

    ``windows`` holds different keys of order ``ORDER``. N-grams of two bytes at most, some
    65 000, go to all tasks. The others go to the task of the two bytes before their last one;
    so do the windows that ask for them, and all that has followed a context is in one task.
    """
    grams, order, size = model
    shards = size // GRAMS_PER_SHARD + 1
    few = grams.where(F.shiftright("gram", _PLACE) < 2).toArrow()

    def shard(key):
        return F.pmod(F.xxhash64(F.shiftright(key, 8).bitwiseAND(0xFFFF)), F.lit(shards)).alias("shard")

    def judge(asked: pa.Table, own: pa.Table) -> pa.Table:
        known = pa.concat_tables([few.select(["gram", "blocked", "allowed"]), own.select(["gram", "blocked", "allowed"])]).sort_by("gram")
        keys, blocked, allowed = (known.column(c).to_numpy() for c in ("gram", "blocked", "allowed"))
        models = _counts(order, keys, allowed), _counts(order, keys, blocked)
        all_windows, points = asked.column("window").to_numpy(), []
        for start in range(0, len(all_windows), GRAMS_PER_SHARD):
            part = all_windows[start : start + GRAMS_PER_SHARD]
            own_keys = np.array([(part & ((1 << 8 * (n + 1)) - 1)) | (n << _PLACE) for n in range(order + 1)])
            good, bad = (_log_chances(own_keys, m) for m in models)
            points.append(np.rint((good - bad) * UNITS).astype(np.int64))
        return pa.table({"window": all_windows, "points": np.concatenate(points) if points else np.empty(0, np.int64)})

    asked = windows.select("window", shard(F.col("window"))).groupBy("shard")
    more = grams.where(F.shiftright("gram", _PLACE).between(2, order)).select("gram", "blocked", "allowed", shard(F.col("gram")))
    return asked.cogroup(more.groupBy("shard")).applyInArrow(judge, "window long, points long")


def _scored(texts: DataFrame, model: tuple[DataFrame, int, int]) -> DataFrame:
    """Different texts (``text``) with ``url_score``, the difference of the models' mean log
    probabilities of a byte; above zero speaks for allowed."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lengths = gram_keys(batch.column("text").to_pylist())
            ids = np.repeat(batch.column("id").to_numpy(), lengths)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys[ORDER])], ["id", "window"])

    numbered = stored(texts.select("text", F.monotonically_increasing_id().alias("id")), "url-texts")
    windows = numbered.mapInArrow(cut, "id long, window long")
    points = stored(_window_points(windows.select("window").distinct(), model), "url-windows")
    means = windows.join(points, "window").groupBy("id").agg((F.sum("points") / F.count(F.lit(1)) / UNITS).alias("url_score"))
    return numbered.join(means, "id").select("text", "url_score")


def _threshold(decided: DataFrame) -> float:
    """From (``allow``, ``url_score``) rows the score from which a URL is allowed: the best mean of
    the shares of allowed URLs at or above it and of blocked URLs below it. Of equally good ones,
    the middle of the longest run nearest to zero is taken."""
    seen = decided.groupBy(F.floor(F.col("url_score") / BIN).alias("bin")).agg(
        F.count_if("allow").alias("allowed"), F.count_if(~F.col("allow")).alias("blocked")
    )
    rows = sorted((r["bin"], r["allowed"], r["blocked"]) for r in seen.collect())
    allowed, blocked = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not allowed or not blocked:
        return 0.0
    steps = list(range(rows[0][0], rows[-1][0] + 2))
    counts = {b: (a, k) for b, a, k in rows}
    kept, below, quality = allowed, 0, []
    for step in steps:
        quality.append(kept / allowed + below / blocked)
        a, k = counts.get(step, (0, 0))
        kept, below = kept - a, below + k
    best = max(quality)
    runs, run = [], []
    for step, q in zip(steps, quality):
        if q == best:
            run.append(step)
        elif run:
            runs.append(run)
            run = []
    runs += [run] if run else []
    run = min(runs, key=lambda r: (-len(r), abs(r[len(r) // 2]), r[0]))
    return run[len(run) // 2] * BIN


def url_filter(pages: DataFrame, url_column: str = "url", rules=RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``url_score`` and ``verdict`` (allow or block).

    Where a rule fits, the longest one decides; else a URL is allowed if its score reaches the
    threshold. The score is the difference of the two models' mean log probabilities per byte of
    host and path. All rows that rules decide train or calibrate, split by a hash of the URL.

    A null URL, or one without ``://``, has empty host and path; no rule fits it, and the models
    see an empty text. Where rules decide no URL of a class there is no model and what no
    rule decides is allowed. Repeated rows get equal verdicts; other columns pass through, one
    named like a result is replaced. An empty table gives an empty result.
    """
    prepare(pages.sparkSession)
    made = ("host", "path", "rule", "url_score", "verdict")
    own = [c for c in pages.columns if c not in made]
    url = F.col(f"`{url_column}`")
    row = F.struct(*[F.col(f"`{c}`") for c in own]).alias("row")
    parsed = pages.select(row, host_of(url).alias("host"), path_of(url).alias("path"), F.pmod(F.xxhash64(url), F.lit(FOLDS)).alias("fold"))
    parsed = parsed.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    rule_host = F.split_part(F.col("found.rule"), F.lit("/"), F.lit(1))
    rest_host = F.substring(F.col("host"), F.lit(1), F.length("host") - F.length(rule_host))
    rest_path = F.substring(F.col("path"), F.length("found.rule") - F.length(rule_host) + 1, F.length("path"))
    decided = parsed.where("found IS NOT NULL").select(
        F.concat(rest_host, F.lit("/"), rest_path).alias("text"), (F.col("found.action") == "allow").alias("allow"), "fold"
    )
    asked = parsed.select("row", "host", "path", "found", F.concat("host", "path").alias("text"))
    model = _fit(decided.where("fold > 0").select("text", "allow"))
    if model:
        held_out = decided.where("fold = 0").select("text", "allow")
        scored = stored(_scored(asked.select("text").unionAll(held_out.select("text")).distinct(), model), "url-scores")
        threshold = _threshold(held_out.join(scored, "text"))
        judged = asked.join(scored, "text")
    else:
        threshold, judged = 0.0, asked.withColumn("url_score", F.lit(0.0))
    learnt = F.when(F.col("url_score") >= threshold, "allow").otherwise("block")
    return judged.select(
        "row.*", "host", "path", F.col("found.rule").alias("rule"), "url_score", F.coalesce(F.col("found.action"), learnt).alias("verdict")
    )
