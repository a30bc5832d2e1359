"""Connected components of a link table, for any length of chain and any size of component."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``root``) for every node that has a link; ``root`` is its component's least node.

    Large-star and small-star steps in turn (Kiveris et al., "Connected Components in
    MapReduce and Beyond"): a step points the neighbours of a node to the least of them. The
    links become a star around each component's least node after a number of steps that
    grows with the logarithm of the longest chain. Every step is an aggregate that tasks
    combine before the shuffle and a join that adaptive execution splits at hot nodes; the
    links are written after each pair of steps, and only two counts go to the driver.

    Links with a null end or two equal ends count for nothing. No links: no rows.
    """
    edges = stored(_proper(links, a, b), "links")
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        # A forest of stars: each node points to one root, and no root points on.
        facts = (
            edges.select("a", F.col("b").alias("points_to"), F.lit(0).alias("as_root"))
            .unionAll(edges.select("b", F.lit(None).cast("long"), F.lit(1)))
            .groupBy("a")
            .agg(F.count("points_to").alias("n"), F.max("as_root").alias("as_root"))
            .agg(F.count_if((F.col("n") > 1) | ((F.col("n") > 0) & (F.col("as_root") > 0))).alias("open"))
        )
        if not facts.first()["open"]:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b"), F.col("b")).distinct()
    )


def _proper(links, a, b):
    """Links from the greater to the smaller end, each once."""
    return (
        links.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y"))
        .where("x IS NOT NULL AND y IS NOT NULL AND x != y")
        .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        .distinct()
    )


def _large_star(edges):
    """Greater neighbours of each node point to the least of the node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return (
        both.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .distinct()
    )


def _small_star(edges):
    """Smaller neighbours of each node, and the node, point to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionAll(least.select("a", F.col("low").alias("b"))).distinct()
