"""Records in key buckets: joins that shuffle only new rows, merges that leave other buckets alone.

A folder holds ``bucket=<n>/version=<ticket>``, each with files that Spark names by bucket. Which
version of each bucket counts is kept by the caller, so a merge that ends halfway changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "record_key"


class Buckets:
    """The buckets of one folder; ``count`` of them, by the hash that Spark's bucketing uses.

    The folder is a bucketed external table of the session's catalog, since only those are joined
    without a shuffle. It is registered on first use, under a name that follows from the folder;
    dropping the table leaves the files. Choose ``count`` so that a bucket fits one task: a task
    reads and merges a bucket as a whole, and the list of versions has one number per bucket.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, count: int):
        if count < 1:
            raise ValueError("a snapshot needs at least one bucket")
        self.spark = spark
        self.folder = folder
        self.schema = schema
        self.count = count
        self.table = f"tidemark_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"

    def bucket_of(self) -> Column:
        """The bucket of a row, as Spark deals rows into buckets."""
        return F.pmod(F.hash(KEY), F.lit(self.count))

    def _register(self) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        location = self.folder.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}, bucket INT, version BIGINT) "
            f"USING parquet PARTITIONED BY (bucket, version) "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.count} BUCKETS "
            f"LOCATION '{location}'"
        )

    def rows(self, versions: Sequence[int], only: Sequence[int] | None = None) -> DataFrame:
        """The rows of the given version of each bucket; of all buckets or some.

        Both conditions are on partition columns: folders of other versions are not opened.
        """
        self._register()
        if self.spark.conf.get("spark.sql.hive.manageFilesourcePartitions") == "true":
            self.spark.catalog.recoverPartitions(self.table)  # what other sessions have added
        self.spark.catalog.refreshTable(self.table)
        numbers = F.array(*map(F.lit, versions)).cast("array<bigint>")
        of_bucket = F.element_at(numbers, F.col("bucket") + 1)
        rows = self.spark.table(self.table).where(F.col("version") == of_bucket)
        if only is not None:
            rows = rows.where(F.col("bucket").isin(list(only)))
        return rows.select(*self.schema.fieldNames())

    def spread(self, rows: DataFrame) -> DataFrame:
        """Rows with one partition per bucket, as a join with the buckets needs them."""
        return rows.repartition(self.count, KEY)

    def write(self, rows: DataFrame, version: int) -> None:
        """Adds rows as a version of the buckets they belong to."""
        self._register()
        marked = rows.select(
            *self.schema.fieldNames(),
            self.bucket_of().alias("bucket"),
            F.lit(version).cast("bigint").alias("version"),
        )
        marked.write.insertInto(self.table)

    def path(self, bucket: int, version: int) -> str:
        return f"{self.folder}/bucket={bucket}/version={version}"


def newer_of(base: DataFrame, fresh: DataFrame, order: Sequence[str]) -> DataFrame:
    """Per key the later of two rows, where both sides have one row per key.

    Later is as in ``latest``: by ``order``, then by all other columns.
    """
    rest = [*order, *(c for c in base.columns if c != KEY and c not in order)]
    packed = F.struct(*rest)
    both = base.select(KEY, packed.alias("_old")).join(
        fresh.select(KEY, packed.alias("_new")), KEY, "full_outer"
    )
    later = F.greatest("_old", "_new")
    return both.select(KEY, later.alias("_row")).select(
        *(F.col(c) if c == KEY else F.col("_row").getField(c).alias(c) for c in base.columns)
    )
