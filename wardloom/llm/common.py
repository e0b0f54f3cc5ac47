"""What the operators share: the definition of a word, table access, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.session import materialize

# White space that separates words.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def part_of(doc_id: Column, parts: int) -> Column:
    """The fold of a document: crc32 of its id written as text, modulo ``parts``; NULL for no id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` of every node of ``edges (a, b)``; a component is named by its smallest node.

    Each round hands every node the smallest label among its neighbours and then jumps to the
    label of that label, so a chain of n nodes takes about log n rounds. Labels are written out
    after each round; nothing but the number of changed labels reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "edges")
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    for _ in range(max_rounds):
        heard = both.join(labels.select(F.col("node").alias("b"), F.col("label")), "b").groupBy("a").agg(F.min("label").alias("heard"))
        lower = labels.join(heard.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        roots = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
        moved = lower.join(roots, "label").select("node", "old", F.least("label", "root").alias("label"))
        moved = materialize(moved, "labels")
        labels = moved.select("node", "label")
        if moved.filter("old <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
