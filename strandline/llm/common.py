"""Helpers shared by the corpus operators: tables, shared storage, components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..storage import Scratch, discard, keep, shared_dir

__all__ = ["WHITE", "WORD", "Scratch", "components", "keep", "shared_dir", "table"]

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges(a, b): one row (node, root) for each node that has an edge, root its smallest reachable node.

    Alternating large-star and small-star steps (Kiveris et al., 2014): the edge list is
    rewritten until each node points at its root. A step is a grouped minimum, combined on the
    map side, and a join that adaptive execution splits where a node is hot. Null ends and loops
    carry no link.
    """
    spark = edges.sparkSession
    mark, old = None, None

    def written(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        """df in shared storage, its path, and its count and hash, observed while it is written."""
        path, seen = f"{shared_dir(spark)}/edges-{uuid.uuid4().hex}", Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).write.parquet(path)
        return spark.read.schema("u " + df.schema["u"].dataType.simpleString() + ", v " + df.schema["v"].dataType.simpleString()).parquet(path), path, (seen.get["n"], seen.get["h"])

    now, path, found = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    for _ in range(max_rounds):
        if old:
            discard(spark, old)
        if found == mark or not found[0]:
            break
        mark, old = found, path
        both = now.select("u", "v").union(now.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = now.select(F.col("v").alias("u"), F.col("u").alias("v")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("v", "m").where("v != m").union(low)
        now, path, found = written(small.toDF("u", "v").distinct())
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # Settled: every node that isn't a root points at its root, and roots point nowhere.
    top = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(top.select("node", F.col("node").alias("root")))
