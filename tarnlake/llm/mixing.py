"""Mixing sources to target weights by Pareto order sampling.

A source's target says how often its documents are taken on average. The whole part of that
number is certain: every document gets so many copies. For one copy more, documents are ranked
by the odds of a fixed random number divided by the odds of their inclusion, and the mix takes
them in that order until the source has its words: a sample of fixed size, with unequal
probabilities where sources, or documents by their importance, have different ones.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.common import stored

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"
#: Ranks are cut into so many ranges per source; only the range in which a source's words
#: run out is sorted. It holds a few thousandths of the source at most.
RANK_BINS = 4096
#: Equal rows of a step taken in part that one task writes at a time.
COPIES_PER_BUNDLE = 1000


def word_count(column) -> Column:
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """(``source``, ``source_size``) with ``target``, in words; one row per source.

    Sources by code point, null last, have the weights in turn and share all words. No target
    is above ``most`` times its source; what is over goes to the others by weight until none
    is above. Sources that hit the bound are those with the least size per weight, so one
    sorted pass finds them, in whole numbers up to the last division.

    That pass is one task with a row per source: it grows with the number of sources alone. A column
    of some million different values is better mapped to fewer sources first.
    """
    in_turn = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(in_turn) - 1, F.lit(len(weights))).cast("int")
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("long"))
    by_size = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_size.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_size.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(most * F.sum("source_size").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    bound = weighed.withColumn("capped", F.col("weight") * left > most * F.col("source_size") * weight_left)
    free = everything
    words_left = F.sum("source_size").over(free) - most * F.sum(F.when(F.col("capped"), F.col("source_size")).otherwise(0)).over(free)
    weights_left = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(free)
    shared = (F.col("weight") * words_left).cast("double") / weights_left
    target = F.when(F.col("capped"), (most * F.col("source_size")).cast("double")).otherwise(shared)
    return bound.select("source", "source_size", target.alias("target"))


def _random(id_column, text_column) -> Column:
    """A number in (0, 1) that stays the same for a document."""
    name = F.coalesce(F.col(id_column).cast("string"), F.md5(F.col(text_column).cast("binary")), F.lit(""))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit("mix|"), name).cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits + 0.5) / float(1 << 52)


def _with_excess_dealt_out(slim: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """``sources`` with a ``rate`` at which documents of high importance, held at ``most`` copies,
    leave their source's target to the others: raised until no further document is held."""
    while True:
        facts = sources.select(F.col("source").alias("s"), "rate")
        held = F.col("rate") * F.col("weight") >= most
        placed = slim.join(facts, F.col("source").eqNullSafe(F.col("s")))
        sums = placed.groupBy("s").agg(
            F.sum(F.when(held, F.col("size")).otherwise(0)).alias("held_words"),
            F.sum(F.when(held, 0.0).otherwise(F.col("size") * F.col("weight"))).alias("free"),
        )
        left = F.col("target") - most * F.col("held_words")
        raised = F.when((F.col("free") > 0) & (left > 0), F.greatest("rate", left / F.col("free"))).otherwise(F.col("rate"))
        both = sources.join(sums, F.col("source").eqNullSafe(F.col("s"))).drop("s")
        both = stored(both.withColumns({"before": F.col("rate"), "rate": raised}), "rates")
        sources = both.select("source", "source_size", "target", "rate")
        if both.where(F.col("rate") > F.col("before") * (1 + 1e-9)).isEmpty():
            return sources


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights=WEIGHTS,
    most: int = MAX_COPIES,
    importance: str | None = None,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``size`` is the number of words of the text (null: 0), ``copies`` how often the mix takes
    the document (0 to ``most``), ``taken`` the words that makes. The ranked documents are taken
    as long as they fit into the source's words, and then the one whose size is nearest to what
    is left, if that brings the words nearer to the target. ``importance`` names a column of numbers that
    shift copies between the documents of a source (default: all alike); null or negative ones
    count as 0. What documents held at ``most`` copies leave goes to the others of their source.

    Runs agree: the random number comes from the id (from the text where the id is null).
    Rows that agree in that and in size are one step of the order; where the words run out, as
    many rows of the step are taken as fit, by a digest of their columns, and one row closes. A null source is a source. A source
    without words has target 0 and no copies of its rows. Other columns pass through; one
    named like a result is replaced. An empty table gives an empty result.
    """
    made = ("size", "source_size", "target", "copies", "taken")
    own = [c for c in docs.columns if c not in made]
    weight = F.greatest(F.coalesce(F.col(f"`{importance}`").cast("double"), F.lit(0.0)), F.lit(0.0)) if importance else F.lit(1.0)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"),
        word_count(F.col(f"`{text_column}`")).alias("size"),
        F.col(f"`{source_column}`").alias("source"),
        _random(f"`{id_column}`", f"`{text_column}`").alias("random"),
        weight.alias("weight"),
    )
    slim = stored(rows.drop("row"), "sizes")
    sums = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("weight")).alias("weighted"))
    targets = source_targets(sums.select("source", "source_size"), weights, most)
    rate = F.when(F.col("weighted") > 0, F.col("target") / F.col("weighted")).otherwise(0.0)
    same = F.col("s").eqNullSafe(F.col("source"))
    sources = targets.withColumnRenamed("source", "s").join(sums.select("source", "weighted"), same).drop("s")
    sources = stored(sources.withColumn("rate", rate).drop("weighted"), "sources")
    if importance:
        sources = _with_excess_dealt_out(slim, sources, most)

    def ranked(df):
        """Certain copies and rank of each row, by its source's target."""
        rate = F.col("rate") * F.col("weight")
        certain = F.floor(F.least(rate, F.lit(float(most))))
        chance = F.least(rate, F.lit(float(most))) - certain
        odds = (F.col("random") / (1 - F.col("random"))) / (chance / (1 - chance))
        return df.withColumns({"certain": certain, "rank": F.when(chance > 0, odds)})

    def with_source(df, columns, key="source"):
        facts = sources.select(F.col("source").alias("__s"), *columns)
        return df.join(facts, F.col(key).eqNullSafe(F.col("__s")), "left").drop("__s")

    bin_of = F.floor(F.col("rank") / (1 + F.col("rank")) * RANK_BINS)
    placed = ranked(with_source(slim, ["rate", "target"])).withColumn("bin", bin_of)
    by_bin = placed.groupBy("source", "bin").agg(
        F.sum(F.col("size") * F.col("certain")).alias("certain_words"), F.sum(F.when(F.col("rank").isNotNull(), F.col("size"))).alias("words")
    )
    whole = Window.partitionBy("source")
    up_to = whole.orderBy(F.col("bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = (
        with_source(by_bin, ["target"])
        .withColumn("wanted", F.col("target") - F.sum("certain_words").over(whole))
        .withColumn("after", F.coalesce(F.sum("words").over(up_to), F.lit(0)))
        .withColumn("before", F.col("after") - F.coalesce("words", F.lit(0)))
    )
    # The range of ranks in which a source's words run out; ranges before it are taken whole.
    edges = bins.where(F.col("bin").isNotNull() & (F.col("after") > F.col("wanted"))).groupBy("source").agg(
        F.min(F.struct("bin", "before", "wanted")).alias("edge")
    )
    edges = stored(edges.select("source", "edge.bin", "edge.before", "edge.wanted"), "edges")
    at_edge = placed.alias("p").join(
        edges.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")) & (F.col("p.bin") == F.col("e.bin"))
    ).select("p.source", "rank", "size", "before", "wanted", F.lit(1).alias("one"))
    # Rows of equal rank and size are one step. The first step that does not fit whole is the cut;
    # ``m`` of its ``k`` rows fit.
    steps = at_edge.groupBy("source", "rank", "size", "before", "wanted").agg(F.sum("one").alias("rows"))
    in_order = Window.partitionBy("source").orderBy("rank", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.col("before") + F.sum(F.col("size") * F.col("rows")).over(in_order)
    room = F.greatest(F.floor("wanted") - (F.col("reached") - F.col("size") * F.col("rows")), F.lit(0))
    m = F.floor(room / F.col("size"))
    gap = F.col("wanted") - (F.col("reached") - F.col("size") * (F.col("rows") - m))
    cuts = (
        steps.withColumn("reached", reached)
        .where(F.col("reached") > F.col("wanted"))
        .groupBy("source")
        .agg(F.min(F.struct("rank", "size", F.col("rows").alias("k"), m.alias("m"), gap.alias("gap"))).alias("found"))
        .select("source", F.struct("found.rank", "found.size").alias("cut"), "found.k", "found.m", "found.gap")
    )
    cuts = stored(cuts, "cut-steps")
    # What the words up to the target still lack, one more document makes up for best: one row of
    # the step that comes nearest.
    here = F.struct("rank", "size")
    cut_rows = placed.alias("p").join(cuts.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")))
    behind = F.col("rank").isNotNull() & (here >= F.col("cut"))
    off = F.abs(F.col("size") - F.col("gap"))
    closing = (
        cut_rows.where(behind & (off < F.col("gap")))
        .groupBy("p.source")
        .agg(F.min(F.struct(off.alias("off"), "rank", "size")).alias("closing"))
        .select("source", F.struct("closing.rank", "closing.size").alias("closing"))
    )
    closing = stored(closing, "closing")
    closing_rows = (
        placed.alias("p")
        .join(closing.alias("k"), F.col("p.source").eqNullSafe(F.col("k.source")) & (here == F.col("closing")))
        .groupBy("p.source", "closing")
        .agg(F.count(F.lit(1)).alias("closing_k"))
    )
    both = F.col("cut") == F.col("closing")
    facts = stored(
        sources.alias("a")
        .join(cuts.alias("c"), F.col("a.source").eqNullSafe(F.col("c.source")), "left")
        .join(closing_rows.alias("k"), F.col("a.source").eqNullSafe(F.col("k.source")), "left")
        .select(
            F.col("a.source").alias("__s"), "source_size", "rate", "target", "cut", "k", "closing", "closing_k",
            (F.col("m") + F.when(both, 1).otherwise(0)).alias("m"),
        ),
        "cuts",
    )
    joined = ranked(rows.join(facts, F.col("source").eqNullSafe(F.col("__s")), "left"))
    # Of so many rows of a step, so many are taken: nulls where all are, or none.
    at_cut = F.coalesce(here == F.col("cut"), F.lit(False))
    at_closing = F.coalesce(here == F.col("closing"), F.lit(False)) & ~at_cut
    of = F.when(at_cut, F.col("k")).when(at_closing, F.col("closing_k"))
    take = F.when(at_cut, F.col("m")).when(at_closing, F.lit(1))
    split = F.col("rank").isNotNull() & F.coalesce((take > 0) & (take < of), F.lit(False))
    whole_step = F.when(F.col("cut").isNull() | (here < F.col("cut")), True).otherwise(F.coalesce(take == of, F.lit(False)))
    chosen = F.col("rank").isNotNull() & (F.col("source_size") > 0) & whole_step

    def result(df, copies):
        words = F.col("size") * copies
        return df.select("row.*", "size", "source_size", "target", copies.cast("long").alias("copies"), words.cast("long").alias("taken"))

    plain = result(joined.where(~split), F.col("certain") + F.when(chosen, 1).otherwise(0))
    if facts.where(((F.col("m") > 0) & (F.col("m") < F.col("k"))) | ((F.col("cut") != F.col("closing")) & (F.col("closing_k") > 1))).isEmpty():
        return plain  # no step is taken in part
    return plain.unionAll(result(_part_of(joined.withColumns({"of": of, "take": take}).where(split)), F.col("certain") + F.col("more")))


def _part_of(rows: DataFrame) -> DataFrame:
    """Rows of steps that are taken in part, with ``more`` 1 for ``take`` rows of each step, else 0.

    Rows that agree in all columns are counted and counted only, so that a row repeated without
    end needs no numbers; unlike rows of a step are in order of their digest.
    """
    step = ["source", "rank", "size"]
    digest = F.sha2(F.to_json("row"), 256).alias("digest")
    alike = stored(
        rows.groupBy(*step, digest).agg(
            F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("row", "source_size", "target", "certain", "take")]
        ),
        "alike-rows",
    )
    earlier = Window.partitionBy(*step).orderBy("digest").rowsBetween(Window.unboundedPreceding, -1)
    own = F.greatest(F.least(F.col("take") - F.coalesce(F.sum("n").over(earlier), F.lit(0)), F.col("n")), F.lit(0))
    numbered = alike.select(*step, "digest", own.alias("own")).withColumnsRenamed({"source": "s", "rank": "r", "size": "z", "digest": "d"})
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("rank") == F.col("r")) & (F.col("size") == F.col("z")) & (F.col("digest") == F.col("d"))
    # Bundles of a bounded number of rows, written by several tasks.
    bundles = (
        alike.join(numbered, same)
        .withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES_PER_BUNDLE).cast("long"))))
        .repartition("digest", "start")
    )
    last = F.least(F.col("start") + COPIES_PER_BUNDLE, F.col("n")) - 1
    return bundles.withColumn("at", F.explode(F.sequence("start", last))).withColumn("more", F.when(F.col("at") < F.col("own"), 1).otherwise(0))


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         (('0x' || substr(md5('mix|' || doc_id::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS random
  FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM sums
), bound AS (
  SELECT *, weight * (sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER b, 0))
            > 3 * source_size * (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS capped
  FROM weighed
  WINDOW b AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN (3 * source_size)::DOUBLE
              ELSE (weight * (sum(source_size) OVER () - 3 * sum(CASE WHEN capped THEN source_size ELSE 0 END) OVER ()))::DOUBLE
                   / (sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM bound
), rated AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, d.random,
         CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size::DOUBLE, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), ranked AS (
  SELECT *, floor(rate)::BIGINT AS certain, rate - floor(rate) AS chance,
         CASE WHEN rate > floor(rate) THEN (random / (1 - random)) / ((rate - floor(rate)) / (1 - (rate - floor(rate)))) END AS rank
  FROM rated
), run AS (
  SELECT *, target - sum(size * certain) OVER (PARTITION BY source) AS wanted,
         sum(CASE WHEN rank IS NULL THEN 0 ELSE size END) OVER (PARTITION BY source ORDER BY rank NULLS FIRST, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reached
  FROM ranked
), gaps AS (
  SELECT *, wanted - max(CASE WHEN reached <= wanted THEN reached ELSE 0 END) OVER (PARTITION BY source) AS gap FROM run
), closing AS (
  SELECT doc_id FROM gaps WHERE rank IS NOT NULL AND reached > wanted AND abs(size - gap) < gap
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(size - gap), rank, size) = 1
)
SELECT doc_id, size, source_size, target,
       (size * (certain + CASE WHEN rank IS NOT NULL AND (reached <= wanted OR doc_id IN (SELECT doc_id FROM closing)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM gaps
"""
