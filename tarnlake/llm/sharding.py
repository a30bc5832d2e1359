"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of slots. Every shard owns ``virtual_nodes`` places on it; a row
goes to the next place clockwise from its slot. A shard takes no more than its capacity: rows
that find it full go on clockwise to the next place whose shard has room. Capacities differ
by one row at most and add up to the number of rows, so in the end every shard is full.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLOT_BITS = 14
VIRTUAL_NODES = 64
#: Rows of a ring slot that one task numbers, about, and copies of a row that go on as one bundle.
ROWS_PER_TASK = 1_000_000
COPIES_PER_BUNDLE = 1000


def ring_slot(*keys, bits: int = SLOT_BITS):
    """The place of a key on the ring: the top bits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits).cast("int")


def ring(spark, shards: int, virtual_nodes: int = VIRTUAL_NODES, bits: int = SLOT_BITS) -> list[int]:
    """The shard next clockwise from each slot. A shard's places do not depend on the other shards.

    Where two shards claim a slot, the lower one has it.
    """
    places = (
        spark.range(shards)
        .select(F.col("id").cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(virtual_nodes - 1))).alias("node"))
        .select("shard", ring_slot(F.lit("node"), "shard", "node", bits=bits).alias("slot"))
        .collect()
    )
    owner: list = [None] * (1 << bits)
    for place in sorted(places, key=lambda p: -p["shard"]):
        owner[place["slot"]] = place["shard"]
    following = next(o for o in owner if o is not None)
    for slot in reversed(range(len(owner))):
        following = owner[slot] = owner[slot] if owner[slot] is not None else following
    return owner


def allot(counts: dict[int, int], owner: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(slot of the ring, first row, end row, shard, shard's rows before) for all rows.

    ``counts`` has the rows of each slot. First every slot fills its own shard as far as there is
    room; then what is left goes on clockwise.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    out, over = [], []

    def take(slot, first, end, shard):
        n = min(end - first, room[shard])
        if n:
            out.append((slot, first, first + n, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return first + n

    for slot in sorted(counts):
        first = take(slot, 0, counts[slot], owner[slot])
        if first < counts[slot]:
            over.append((slot, first))
    for slot, first in over:
        at = slot
        while first < counts[slot]:
            first = take(slot, first, counts[slot], owner[at % len(owner)])
            at += 1
            while first < counts[slot] and not room[owner[at % len(owner)]]:
                at += 1
    return out


def shard_rows(df: DataFrame, key: str, content: str, shards: int = 16, virtual_nodes: int = VIRTUAL_NODES, bits: int = SLOT_BITS) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot``, the row's number in it from 0.

    The shards' row counts differ by one at most. Rows are placed by ``key``; where that is
    null, by ``content``. A row leaves its own shard only if that is full, so with another
    number of shards most rows that need not move stay. Rows that agree in key and content
    share a slot of the ring, and shards cut through slots, so equal rows may part. Repeated
    rows each get a place; other columns pass through, one named ``shard`` or ``slot`` is
    replaced (and minus zero becomes zero). An empty table gives an empty result.

    To the driver comes one count per slot of the ring, ``1 << bits`` at most, and that many
    rows (and one for each slot a full shard cuts) are broadcast back. Equal rows are counted
    before the shuffle and go on in bundles. A slot that holds more than ``ROWS_PER_TASK`` rows,
    for a key or a row that is repeated that often, is numbered by several tasks.
    """
    spark = df.sparkSession
    own = [c for c in df.columns if c not in ("shard", "slot")]
    name = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("-"), F.md5(F.col(content).cast("string").cast("binary"))), F.lit("-"))
    placed = df.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), name.alias("name"))
    placed = placed.withColumn("place", ring_slot("name", bits=bits))
    counts = {r["place"]: r["n"] for r in placed.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = allot(counts, ring(spark, shards, virtual_nodes, bits), shards)
    table = spark.createDataFrame(parts, "at int, first long, end long, shard int, before long")
    tasks = spark.createDataFrame([(place, -(-n // ROWS_PER_TASK)) for place, n in counts.items()], "at int, parts long")

    zero = F.lit(0).cast("long")
    same = placed.groupBy("place", "name", "row").agg(F.count(F.lit(1)).alias("copies"))
    bundles = same.withColumn("bundle", F.explode(F.sequence(zero, F.floor((F.col("copies") - 1) / COPIES_PER_BUNDLE))))
    bundles = (
        bundles.withColumn("copies", F.least(F.lit(COPIES_PER_BUNDLE), F.col("copies") - F.col("bundle") * COPIES_PER_BUNDLE))
        .join(F.broadcast(tasks), F.col("place") == F.col("at"))
        .withColumn("part", F.pmod(F.xxhash64("row", "bundle"), F.col("parts")))
        .drop("at", "parts")
    )
    # A row's number in its slot: the rows of the parts ahead, and those before it in its own part.
    earlier = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = bundles.groupBy("place", "part").agg(F.sum("copies").alias("rows")).select(
        "place", "part", F.coalesce(F.sum("rows").over(earlier), zero).alias("ahead")
    )
    in_part = Window.partitionBy("place", "part").orderBy("name", "row", "bundle").rowsBetween(Window.unboundedPreceding, -1)
    numbered = bundles.withColumn("n", F.coalesce(F.sum("copies").over(in_part), zero)).join(ahead, ["place", "part"])
    numbered = numbered.withColumn("n", F.col("n") + F.col("ahead"))
    end = F.col("n") + F.col("copies")
    found = numbered.join(F.broadcast(table), (F.col("place") == F.col("at")) & (F.col("n") < F.col("end")) & (end > F.col("first")))
    numbers = F.sequence(F.greatest("n", "first"), F.least(end, F.col("end")) - 1)
    each = found.select("row", "shard", "before", "first", F.explode(numbers).alias("number"))
    return each.select("row.*", "shard", (F.col("before") + F.col("number") - F.col("first")).alias("slot"))
