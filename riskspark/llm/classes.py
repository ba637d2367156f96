"""Classes of linked nodes, by contraction: every link table is a Spark table."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _flat(parent: DataFrame) -> DataFrame:
    """Pointer jumping: (node, parent) with every parent a root."""
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        if parent.join(up, "parent", "left_semi").isEmpty():
            return parent
        parent = stored(parent.join(up, "parent", "left").select(
            "node", F.coalesce("above", "parent").alias("parent")), "parents")


def linked_classes(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of ``links``; root is the same all over a class.

    Each round, every node with a smaller neighbour points at its least one; the
    trees that this makes become single nodes, and links inside them go.  The
    rounds end when no link is left.  A node with very many links costs one
    row a task in the grouping; nothing but a flag comes to the driver.
    """
    open_links = stored(_canonical(links.select(F.col(a).alias("a"), F.col(b).alias("b"))), "links")
    roots = None
    while not open_links.isEmpty():
        parent = _flat(stored(open_links.groupBy(F.col("b").alias("node")).agg(
            F.min("a").alias("parent")), "parents"))
        seen = open_links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        own = seen.join(parent, "node", "left").select("node", F.coalesce("parent", "node").alias("root"))
        if roots is None:
            roots = stored(own, "roots")
        else:
            up = own.select(F.col("node").alias("root"), F.col("root").alias("above"))
            roots = stored(roots.join(up, "root", "left").select(
                "node", F.coalesce("above", "root").alias("root")), "roots")
        up = parent.select(F.col("node").alias("n"), F.col("parent").alias("p"))
        moved = (open_links.join(up, F.col("a") == F.col("n"), "left")
                 .select(F.coalesce("p", "a").alias("a"), "b")
                 .join(up, F.col("b") == F.col("n"), "left")
                 .select("a", F.coalesce("p", "b").alias("b")))
        open_links = stored(_canonical(moved), "links")
    if roots is None:
        kind = links.schema[a].dataType
        return open_links.select(F.col("a").cast(kind).alias("node"), F.col("a").cast(kind).alias("root"))
    return roots


def _canonical(links: DataFrame) -> DataFrame:
    return (links.where(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
