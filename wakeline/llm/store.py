"""Intermediate tables in the shared folder, and connected components over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.session import shared_dir


def text(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def keep(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back: a cut in the lineage that
    survives lost executors, and a measured size for the joins that follow."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _stars(edges: DataFrame) -> bool:
    """Whether every ``a`` has one ``b`` and no ``b`` is an ``a``: each node then hangs on the smallest of its component."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.filter("up > 1 or (up > 0 and down > 0)").agg(F.count("*")).first()[0]


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long, a <> b, any order, repeats allowed);
    the component is its smallest node.

    Alternating large-star and small-star steps.  Each minimum is folded before its shuffle and
    written, so that the join back to a hub's edges is between two shuffles that Spark can split.
    The number of rounds grows with the logarithm of the longest path; edges that are stars already take none.
    """
    now = keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .filter("a <> b").distinct(), "edges")
    while not _stars(now):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = keep(both.groupBy("u").agg(F.min("v").alias("m"))
                     .select("u", F.least("u", "m").alias("m")), "least")
        large = keep(both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                     .distinct(), "large-star")
        least = keep(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        now = keep(large.join(least, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*").filter("a <> b").distinct(), "small-star")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
