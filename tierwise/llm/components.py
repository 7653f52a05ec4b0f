"""Connected components over links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierwise.llm import skew
from tierwise.llm.frames import checkpointed
from tierwise.llm.skew import heavy_keys, spread_join


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links(a, b)``; the label is the least node reached.

    Each round moves a node to its least neighbour, that one's and so on, and then its links with
    it: links inside a class are gone and equal ones are one, so a link is only joined again while
    its ends are apart.  Rows of a node with very many links, and of a label that very many nodes
    have, are dealt to slices in the joins.  Nodes without links are not listed; a null on either
    side is no link.
    """
    edges = _apart(links.where("a is not null and b is not null"))
    moves = []
    while n := edges.count():
        # Links go from the lesser node, so that a node without a lesser one stays.
        move = _to_ends(checkpointed(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))))
        moves.append(move)
        edges = _apart(_moved(_moved(edges, "a", move, n), "b", move, n))
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = moves.pop()
    while moves:
        labels = checkpointed(_moved(moves[-1], "label", labels, moves.pop().count()).unionByName(labels))
    # Each class has another node than its least.
    ends = labels.select(F.col("label").alias("node")).distinct()
    return checkpointed(labels.unionByName(ends.withColumn("label", F.col("node"))))


def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The ``labels`` of ``components`` after more ``links``; only these are joined."""
    links = links.where("a is not null and b is not null and a <> b").select("a", "b")
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    new = ends.join(labels, "node", "left_anti").withColumn("label", F.col("node"))
    labels, n = checkpointed(labels.unionByName(new)), links.count()
    between = components(_moved(_moved(links, "a", labels, n), "b", labels, n))
    return checkpointed(_moved(labels, "label", between, labels.count()))


def _apart(links: DataFrame) -> DataFrame:
    """Each two different nodes that are linked, once, the lesser as ``a``."""
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return checkpointed(ordered.where("a <> b").distinct())


def _moved(rows: DataFrame, column: str, moves: DataFrame, n: int) -> DataFrame:
    """The ``n`` ``rows`` with the label of each node in ``column`` that ``moves(node, label)`` lists."""
    heavy = None
    # Only among more rows than stay together can one key have that many.
    if n > skew.HEAVY:
        heavy = heavy_keys(rows.groupBy(column).agg(F.count(F.lit(1)).alias("_n")), column, "_n")
    to = moves.select(F.col("node").alias(column), F.col("label").alias("_to"))
    others = [c for c in rows.columns if c != column]
    found = spread_join(rows, to, column, heavy, others, "left")
    return found.withColumn(column, F.coalesce("_to", column)).select(*rows.columns)


def _to_ends(moves: DataFrame) -> DataFrame:
    """``moves`` followed until they end; each step doubles how far."""
    n = moves.count()
    while moves.join(moves.select(F.col("node").alias("label")), "label", "left_semi").limit(1).count():
        moves = checkpointed(_moved(moves, "label", moves, n))
    return moves
