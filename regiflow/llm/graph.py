"""Connected components of links, as iterated joins with reliable checkpoints."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiflow.session import checkpoint_dir

FEW = 100_000    # links that one task connects: a step over them costs less than its shuffles


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; component: smallest node reachable.

    Alternates the large-star and small-star steps: every node points its
    neighbours to the smallest one it knows.  Each step is a partial ``min``
    aggregate and a join that adaptive execution may split, so a node with very
    many links is no hot spot; the number of rounds is logarithmic in practice.
    ``FEW`` links at most lie in one partition, where no step needs a shuffle.
    Null ends and loops are dropped.  No links: an empty result.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                  .where("hi is not null and lo is not null and hi <> lo").distinct())
    few = edges.count() <= FEW          # and they get no more on the way
    together = (lambda df: df.coalesce(1)) if few else (lambda df: df)
    edges, before = together(edges), None
    while True:
        both = edges.select(F.explode(F.array(F.struct("hi", "lo"), F.struct(F.col("lo").alias("hi"), F.col("hi").alias("lo")))).alias("e")).select("e.*")
        # large star: every larger neighbour of a node goes to the node's least
        large = _with_least(both, few).where("lo > hi").select(F.col("lo").alias("hi"), F.least("hi", "m").alias("lo")).distinct()
        # small star: a node and its smaller neighbours go to the least of them
        small = (_with_least(large, few).select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")),
                                                                  F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
                 .select("e.*").where("hi <> lo").distinct())
        edges = together(saved(small))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")),
                          F.count_distinct("hi")).first()
        if state == before or state[0] == 0 or (state[0] == state[2] and _flat(edges)):
            break
        before = state
    lows = edges.select(F.col("lo").alias("node")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        lows.select("node", F.col("node").alias("component")))


def _with_least(edges: DataFrame, few: bool) -> DataFrame:
    """``edges(hi, lo)`` with ``m``, the least ``lo`` of each ``hi``; few of them as a window, which one partition needs no shuffle for."""
    if few:
        return edges.withColumn("m", F.min("lo").over(Window.partitionBy("hi")))
    return edges.join(edges.groupBy("hi").agg(F.min("lo").alias("m")), "hi")


def _flat(edges: DataFrame) -> bool:
    """True if every edge leads to a root: no node is both an end and a start."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("hi").alias("node"), F.lit(1).alias("from")),
                                          F.struct(F.col("lo").alias("node"), F.lit(0).alias("from")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.min("from").alias("a"), F.max("from").alias("b")).where("a < b").isEmpty()


def saved_table(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder (compressed, read column-wise)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()      # the cleaner drops shuffle files of finished steps when they are collected
    return spark.read.schema(df.schema).parquet(path)
