"""Connected components of a link table that never leaves the executors."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import frozen, sent_if_small


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; a component is named by its smallest node.

    Random-mate contraction: in each round every node joins the neighbour (or itself) with the smallest hash of that
    round, links are rewritten to the joined nodes, and inner ones vanish. Chains, stars and cliques alike shrink by a
    constant factor a round, so there are O(log n) rounds; each is one aggregate that combines before its shuffle, and
    joins whose hot keys Spark may split. Every round is cut off by a checkpoint.

    Null ends and links of a node with itself are left out. An empty table gives an empty one.
    """
    edge = F.col("a") != F.col("b")
    left = frozen(links.select(F.col("a").cast("long"), F.col("b").cast("long")).where(edge).distinct())
    steps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        rank = lambda c, k=len(steps): F.struct(F.xxhash64(F.col(c), F.lit(k)).alias("h"), F.col(c).alias("v"))
        best = both.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("m"))
        to = F.least(F.col("m"), rank("node"))["v"]
        steps.append(frozen(best.select("node", to.alias("to"))))
        a = steps[-1].select(F.col("node").alias("a"), F.col("to").alias("x"))
        b = steps[-1].select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = left.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        ordered = moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        left = frozen(ordered.where(edge).distinct())
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))

    def follow(at: DataFrame, step: DataFrame) -> DataFrame:
        s = sent_if_small(step.select(F.col("node").alias("root"), F.col("to")))
        return at.join(s, "root", "left").select("node", F.coalesce("to", "root").alias("root"))

    # every node of a later round is one of an earlier round, so the first round names all nodes
    first = steps[0].select("node", F.col("to").alias("root"))
    roots = frozen(reduce(follow, steps[1:], first))
    least = sent_if_small(frozen(roots.groupBy("root").agg(F.min("node").alias("component"))))
    return roots.join(least, "root").select("node", "component")


def reached(known: DataFrame) -> DataFrame:
    """Add ``reached``, the smallest id of a node's component, to ``known(component, least, ...)``, where a node is named
    by its smallest id ``least``, or by some number where that is null, and has no component where it has no link.

    A component is named by its smallest node. So that name is the smallest id, unless nodes without an id are in the
    component: only those components are joined, and a large component is not brought together.
    """
    per = known.where("component IS NOT NULL").groupBy("component")
    unnamed = per.agg(F.min("least").alias("smallest"), F.max(F.col("least").isNull()).alias("unnamed")).where("unnamed")
    joined = known.join(sent_if_small(frozen(unnamed)), "component", "left")
    return joined.withColumn(
        "reached", F.when(F.col("unnamed"), F.col("smallest")).otherwise(F.coalesce("component", "least"))
    ).drop("smallest", "unnamed")
