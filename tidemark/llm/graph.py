"""Connected components of links, for graphs of any degree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder: later steps start from there."""
    folder = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


class Scratch:
    """Tables of one computation in the shared folder, deleted when they have served."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folders: list[str] = []

    def keep(self, df: DataFrame, purpose: str) -> DataFrame:
        self.folders.append(scratch_dir(self.spark, purpose))
        df.write.parquet(self.folders[-1])
        return self.spark.read.parquet(self.folders[-1])

    def release(self) -> None:
        """Deletes the tables so far; only for those that nothing unwritten is derived from."""
        jvm = self.spark.sparkContext._jvm
        for folder in self.folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.folders = []


def components(links: DataFrame, one: str, other: str) -> DataFrame:
    """(id, component) of every linked id: the smallest id that can be reached from it.

    Large and small stars take turns until nothing changes, a logarithmic number of rounds. Each
    round joins links with the least neighbour of their end, which is combined before the shuffle,
    and writes its links; nothing is gathered by neighbourhood, and no link reaches the driver.
    Repeated links and links of an id with itself or null change nothing.
    """
    ends = F.greatest(one, other).alias("u"), F.least(one, other).alias("v")
    edges = links.where(F.col(one) != F.col(other)).select(*ends).distinct()
    scratch = Scratch(links.sparkSession)
    edges, before = scratch.keep(edges, "links"), None
    while True:
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        )
        scratch, older = Scratch(links.sparkSession), scratch
        large = older.keep(large.distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("v"))
        small = large.join(least.withColumnRenamed("v", "m"), "u")
        small = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = scratch.keep(small.unionByName(least).distinct(), "links")
        older.release()
    centres = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(centres)
