"""Batch numbers in key order, and batch ledgers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.defaults import batch_size_or_default
from tidemark.functions.values import column_of, require_column
from tidemark.session import scratch_dir

# monotonically_increasing_id keeps the row's place within its partition in the low 33 bits.
_PLACE_BITS = 33
# Elements of one generated array; larger executions are expanded in two steps.
_ARRAY_STEP = 10_000


def number_rows(
    df: DataFrame,
    key: str,
    batch_size: int,
    tie_break: Sequence[str] = (),
    partitions: int | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Adds ``batch_number``: pages of ``batch_size`` rows in key order, from 1.

    No window over the whole table: rows are range-partitioned and sorted once and written to
    the shared scratch folder together with their place in the partition; the page then
    follows from the row count of the partitions before it. ``tie_break`` columns and a hash
    of the row take part in the ranges, so rows of one hot key are spread over several
    partitions and the numbers do not depend on task order. The result reads from ``folder``,
    by default a new one in the shared scratch folder, until the caller removes it.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    spark = df.sparkSession
    wanted = [key, *tie_break]
    order = [column_of(require_column(df, c).name).asc_nulls_last() for c in wanted]
    # Maps cannot be hashed; such a column takes part by its JSON text.
    order.append(
        F.xxhash64(
            *(
                F.to_json(F.struct(column_of(f.name))) if "map<" in f.dataType.simpleString()
                else column_of(f.name)
                for f in df.schema.fields
            )
        ).asc()
    )
    ranged = (
        df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    )
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    folder = folder or scratch_dir(spark, "numbered")
    (
        ranged.sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_range"), place.alias("_place"))
        .write.parquet(folder)
    )
    placed = spark.read.parquet(folder)
    # One row per range, so the ordered window and the broadcast stay as small as the
    # number of shuffle partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    page = F.floor((F.col("_start") + F.col("_place")) / batch_size).cast("bigint") + 1
    return placed.join(F.broadcast(starts), "_range").select(
        *(column_of(c) for c in df.columns), page.alias("batch_number")
    )


def batch_ledger(
    df: DataFrame,
    key: str,
    batch_size: int,
    tie_break: Sequence[str] = (),
    folder: str | None = None,
) -> DataFrame:
    """Rows and key range of every batch (A2). Only the ordering columns are moved.

    Reads from ``folder`` as ``number_rows`` does, until the caller removes it.
    """
    fields = [require_column(df, c).name for c in (key, *tie_break)]
    ordering = df.select(*map(column_of, fields))
    numbered = number_rows(ordering, key, batch_size, tie_break, folder=folder)
    first = column_of(fields[0])
    return numbered.groupBy("batch_number").agg(
        F.count(F.lit(1)).alias("records_in_batch"),
        F.min(first).alias("first_key"),
        F.max(first).alias("last_key"),
    )


def batch_count(records: Column, batch_size: Column) -> Column:
    """Pages needed for so many records."""
    size = batch_size_or_default(batch_size)
    return F.floor((records + size - 1) / size).cast("bigint")


def batches_of(executions: DataFrame) -> DataFrame:
    """One row per batch of each execution, from ``total_records`` and ``batch_size`` alone.

    Pages are full except the last, so no data row has to be read or sorted again.
    """
    size = batch_size_or_default(F.col("batch_size")).cast("bigint")
    pages = batch_count(F.col("total_records"), F.col("batch_size"))
    counted = executions.where(F.col("total_records") > 0).withColumn("_pages", pages)
    last_step = F.floor((F.col("_pages") - 1) / _ARRAY_STEP).cast("bigint")
    stepped = counted.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("bigint"), last_step)))
    # One huge execution is expanded by many tasks.
    stepped = stepped.repartition("execution_id", "_step")
    low = F.col("_step") * _ARRAY_STEP + 1
    high = F.least((F.col("_step") + 1) * _ARRAY_STEP, F.col("_pages"))
    numbered = stepped.withColumn("batch_number", F.explode(F.sequence(low, high)))
    rows = F.least(size, F.col("total_records") - (F.col("batch_number") - 1) * size)
    return numbered.withColumn("records_in_batch", rows).drop("_pages", "_step")
