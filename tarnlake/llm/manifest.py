"""Merkle manifest of a dataset: a tree of digests per group, one over the groups, proofs per row.

Rows are ranked within their group and cut into blocks of consecutive ranks. Inside a block the
rank's digits are grouped away one after the other: the rows that differ in the last digit only
become the child structs of one node, then the nodes that differ in the next digit, up to one
struct per block. The rows were dealt out by block, so no further shuffle is needed. Block roots
are the rows of the next tier, until every group is one node; the groups' roots make a tree of
their own. Down again, a transform per level hands every child the digests beside it, and an
explode gives a proof per row. A block learns the path above it by grouping: proofs join nothing.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.common import prepare, stored

ARITY = 2
#: Digits grouped away within a block: of two children each, 1024 rows.
BLOCK_DIGITS = 10
#: Rows of a sorted slice, about, that one task ranks.
ROWS_PER_SLICE = 200_000

_STEP = "struct<left:string,right:string>"


def field(column: Column | str) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*columns: Column | str) -> Column:
    """Lower-case hex SHA-256 of the fields one after the other."""
    return F.sha2(F.concat(*map(field, columns)), 256)


def proof_digest(proof: Column | str) -> Column:
    """SHA-256 of all digests of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, proof: Column | str) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(proof, leaf, lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256))


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their ``rank`` within ``grp``, from 0, and the number ``n`` of its rows.

    The rows are cut into sorted slices; one of a group is ranked behind the group's rows of
    earlier slices. ``order`` has to tell all rows apart, so that slices can cut a hot group.
    """
    slices = max(math.ceil(rows.count() / ROWS_PER_SLICE), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = rows.repartitionByRange(slices, "grp", *order).sortWithinPartitions("grp", *order)
    # The number counts the rows of a partition from a multiple of 2^33 on.
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    cut = stored(cut.select("*", F.spark_partition_id().alias("slice"), place.alias("place")), "manifest-order")
    parts = cut.groupBy("grp", "slice").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    group = Window.partitionBy("grp")
    shifts = parts.select(
        F.col("grp").alias("of"),
        F.col("slice").alias("in"),
        (F.sum("rows").over(group.orderBy("slice")) - F.col("rows") - F.col("first")).alias("shift"),
        F.sum("rows").over(group).alias("n"),
    )
    # A row for each slice and one for each further group in it.
    same = F.col("grp").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("in"))
    ranked = cut.join(shifts, same).withColumn("rank", F.col("place") + F.col("shift"))
    return ranked.drop("of", "in", "slice", "place", "shift")


def _rolled(nodes: DataFrame, arity: int, digits: int) -> DataFrame:
    """Stored blocks (``grp, n, block, tree``) of nodes (``grp, n, rank, hash, item``).

    A level at which the group is one node already adds nothing to it.
    """
    names = [f"d{i}" for i in range(digits)]
    rows = nodes.select(
        "grp",
        "n",
        F.floor(F.col("rank") / F.lit(arity**digits)).alias("block"),
        *[F.pmod(F.floor(F.col("rank") / F.lit(arity**i)), F.lit(arity)).alias(d) for i, d in enumerate(names)],
        F.struct("hash", "item").alias("node"),
    ).repartition("grp", "block")
    for level, digit in enumerate(names):
        own = ["grp", "n", "block", *names[level + 1 :]]
        rows = rows.groupBy(*own).agg(F.sort_array(F.collect_list(F.struct(digit, "node"))).alias("kids"))
        rows = rows.withColumn("kids", F.transform("kids", lambda k: k["node"]))
        joined = F.sha2(F.array_join(F.transform("kids", lambda k: k["hash"]), ""), 256)
        digest = F.when(F.col("n") > arity**level, joined).otherwise(F.col("kids")[0]["hash"])
        rows = rows.select(*own, F.struct(digest.alias("hash"), "kids").alias("node"))
    return stored(rows.withColumnRenamed("node", "tree"), "manifest-blocks")


def _climb(nodes: DataFrame, arity: int, digits: int) -> list[DataFrame]:
    """Tiers of stored blocks, from the rows up to one block for each group."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    tiers = []
    while not tiers or most > 1:
        tiers.append(_rolled(nodes, arity, digits))
        size = arity**digits
        nodes = tiers[-1].select(
            "grp",
            F.ceil(F.col("n") / size).alias("n"),
            F.col("block").alias("rank"),
            F.col("tree.hash").alias("hash"),
            F.struct(F.col("block").alias("rank")).alias("item"),
        )
        most = math.ceil(most / size)
    return tiers


def _step(kids: Column, i: Column) -> Column:
    """What stands left and right of child ``i``."""
    digests = F.transform(kids, lambda k: k["hash"])
    left = F.array_join(F.slice(digests, F.lit(1), i), "")
    right = F.array_join(F.slice(digests, i + 2, F.size(digests)), "")
    return F.struct(left.alias("left"), right.alias("right"))


def _children(split: Column):
    """From a node to its children, each with the step beside it where the level is one of the tree's."""

    def children(at):
        def child(kid, i):
            steps = F.when(split, F.concat(F.array(_step(at["node"]["kids"], i)), at["steps"])).otherwise(at["steps"])
            return F.struct(kid.alias("node"), steps.alias("steps"))

        return F.transform(at["node"]["kids"], child)

    return children


def _unrolled(blocks: DataFrame, above: DataFrame, arity: int, digits: int) -> DataFrame:
    """(``grp, item, hash, proof, top``) of each node below ``blocks``.

    ``above`` has (``grp, block, proof, top``) of the blocks themselves.
    """
    both = blocks.select("*", F.lit(None).cast(f"array<{_STEP}>").alias("proof"), F.lit(None).cast("struct<subroot:string,root:string>").alias("top"))
    both = both.unionByName(above, allowMissingColumns=True)
    met = both.groupBy("grp", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "tree", "proof", "top")])
    spread = F.array(F.struct(F.col("tree").alias("node"), F.array().cast(f"array<{_STEP}>").alias("steps")))
    for level in reversed(range(digits)):
        spread = F.flatten(F.transform(spread, _children(F.col("n") > arity**level)))
    rows = met.select("grp", "proof", "top", F.explode(spread).alias("at"))
    return rows.select("grp", "at.node.item", "at.node.hash", F.concat("at.steps", "proof").alias("proof"), "top")


def _proved(tiers: list[DataFrame], above: DataFrame, arity: int, digits: int) -> DataFrame:
    for tier in reversed(tiers[1:]):
        above = _unrolled(tier, above, arity, digits).select("grp", F.col("item.rank").alias("block"), "proof", "top")
    return _unrolled(tiers[0], above, arity, digits)


def merkle_manifest(
    rows: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    carry: dict[str, Column] | None = None,
    arity: int = ARITY,
    digits: int = BLOCK_DIGITS,
) -> DataFrame:
    """(``key``, ``leaf``, ``subroot``, ``root``, ``proof``, and what is carried), one row per row.

    A leaf is the digest of the row's ``columns`` (``leaf_digest``). The leaves of a ``group``
    ascend by ``key``; every ``arity`` consecutive nodes become one until one is left, the
    subroot. The subroots, by group, give the root in the same way. ``proof`` has a (``left``,
    ``right``) pair for each level from the leaf to the root: the joined digests of the nodes
    beside the row's; ``fold`` recomputes the root from it. ``carry`` are further columns
    computed from a row, by name; they ride along with its leaf.

    A null group is one group and comes first; so does a null key. Rows of one key are in the
    order of their digests, repeated rows in any: they are the same leaf. Nulls in columns are
    told from empty texts. Other columns are not read, whatever their names. An empty table
    gives an empty result. A group may hold all rows: it is ranked and rolled up by blocks.
    """
    prepare(rows.sparkSession)
    carry = carry or {}
    quoted = {c: F.col(f"`{c}`") for c in (key, group, *columns)}
    leaves = rows.select(
        quoted[group].alias("grp"),
        quoted[key].alias("key"),
        leaf_digest(*[quoted[c] for c in columns]).alias("hash"),
        F.struct(quoted[key].alias("key"), *[c.alias(n) for n, c in carry.items()]).alias("item"),
    )
    leaves = stored(leaves.withColumn("row", F.monotonically_increasing_id()), "manifest-leaves")
    tiers = _climb(_ranked(leaves, ["key", "hash", "row"]), arity, digits)
    subroots = tiers[-1].select(F.lit(0).alias("grp"), F.col("grp").alias("key"), F.col("tree.hash").alias("hash"))
    subroots = stored(subroots.withColumn("item", F.struct(F.col("key").alias("of"), "hash")), "manifest-subroots")
    over = _climb(_ranked(subroots, ["key"]), arity, digits)
    root = over[-1].select("grp", "block", F.array().cast(f"array<{_STEP}>").alias("proof"), F.struct(F.lit("").alias("subroot"), F.col("tree.hash").alias("root")).alias("top"))
    tops = _proved(over, root, arity, digits)
    above = tops.select(
        F.col("item.of").alias("grp"),
        F.lit(0).cast("long").alias("block"),
        "proof",
        F.struct(F.col("item.hash").alias("subroot"), F.col("top.root").alias("root")).alias("top"),
    )
    proved = _proved(tiers, stored(above, "manifest-tops"), arity, digits)
    made = [F.col(f"item.`{n}`").alias(n) for n in carry]
    return proved.select(F.col("item.key").alias(key), F.col("hash").alias("leaf"), "top.subroot", "top.root", "proof", *made)


#: Levels that the SQL spells out: enough for 2^LEVELS rows of a language and as many languages.
LEVELS = 17


def _sql_field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c} END"


def _sql_tree(name: str, levels: int) -> list[str]:
    """Levels ``name0`` to ``nameN`` of (grp, pos, hash, n)."""
    return [
        f"{name}{i + 1} AS MATERIALIZED (SELECT grp, pos // 2 AS pos, CASE WHEN n = 1 THEN max(hash) ELSE sha256(string_agg(hash, '' ORDER BY pos)) END AS hash, "
        f"(n + 1) // 2 AS n FROM {name}{i} GROUP BY grp, pos // 2, n)"
        for i in range(levels)
    ]


def _sql_walk(walk: str, start: str, tree: str, levels: int) -> list[str]:
    """Steps ``walk0`` to ``walkN``: (id, grp, pos, n, siblings, folded) up a tree."""
    return [f"{walk}0 AS MATERIALIZED ({start})"] + [
        f"""{walk}{i + 1} AS MATERIALIZED (SELECT w.* EXCLUDE (pos, n, siblings, folded), w.pos // 2 AS pos, (w.n + 1) // 2 AS n, w.siblings || coalesce(s.hash, '') AS siblings,
        CASE WHEN w.n = 1 THEN w.folded WHEN w.pos % 2 = 1 THEN sha256(s.hash || w.folded) ELSE sha256(w.folded || coalesce(s.hash, '')) END AS folded
        FROM {walk}{i} w LEFT JOIN {tree}{i} s ON s.grp IS NOT DISTINCT FROM w.grp AND s.pos = xor(w.pos, 1))"""
        for i in range(levels)
    ]


_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

ORACLE = ",\n".join(
    [
        f"""WITH hashed AS MATERIALIZED (
  SELECT doc_id, lang AS grp, sha256({' || '.join(map(_sql_field, ('doc_id', 'source', 'lang', 'n_chars', 'text')))}) AS hash,
         sha256({' || '.join(map(_sql_field, ('doc_id', 'source', 'lang', '(n_chars + 1)', 'text')))}) AS tampered, {_CRC32} AS crc
  FROM documents
), leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, hash) AS id, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, hash) - 1 AS pos,
         count(*) OVER (PARTITION BY grp) AS n FROM hashed
), t0 AS MATERIALIZED (SELECT grp, pos, hash, n FROM leaves)""",
        *_sql_tree("t", LEVELS),
        f"""g0 AS MATERIALIZED (SELECT 0 AS grp, row_number() OVER (ORDER BY encode(grp) NULLS FIRST) - 1 AS pos, hash, count(*) OVER () AS n, grp AS lang FROM t{LEVELS})""",
        *_sql_tree("g", LEVELS),
        *_sql_walk("w", "SELECT id, doc_id, grp, pos, n, '' AS siblings, CASE WHEN crc % 7 = 0 THEN tampered ELSE hash END AS folded, hash AS leaf FROM leaves", "t", LEVELS),
        *_sql_walk(
            "v",
            f"SELECT w.id, w.doc_id, w.leaf, w.siblings, w.folded, 0 AS grp, g0.pos, g0.n, g0.hash AS subroot FROM w{LEVELS} w JOIN g0 ON g0.lang IS NOT DISTINCT FROM w.grp",
            "g",
            LEVELS,
        ),
    ]
) + f"""
SELECT v.doc_id, v.leaf, v.subroot, r.hash AS root, sha256(v.siblings) AS proof_sha256, v.folded AS folded_root, v.folded = r.hash AS verified
FROM v{LEVELS} v CROSS JOIN g{LEVELS} r
"""
