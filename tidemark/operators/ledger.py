"""Execution ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.upsert import latest


def final_status(error: Column) -> Column:
    """``failed`` with an error text, else ``completed``."""
    return F.when(error.isNotNull(), F.lit("failed")).otherwise(F.lit("completed"))


def records_per_execution(log: DataFrame) -> DataFrame:
    """Rows persisted by each execution (A1)."""
    return log.groupBy(*schemas.IDENTITY, "execution_id").agg(
        F.count(F.lit(1)).alias("total_records")
    )


def latest_executions(executions: DataFrame) -> DataFrame:
    """The newest execution of each dataset."""
    return latest(executions, schemas.IDENTITY, ["started_at", "execution_id"])


def untouched_since_full(records: DataFrame, executions: DataFrame) -> DataFrame:
    """Current records that the newest completed full run of their dataset did not see.

    ``executions`` are the completed full runs. A record of a later incremental run is not
    listed.
    """
    newest = latest_executions(executions).select(
        *schemas.IDENTITY,
        F.col("execution_id").alias("_full"),
        F.col("started_at").alias("_full_at"),
    )
    runs = records.join(newest, schemas.IDENTITY)
    older = (F.col("started_at") < F.col("_full_at")) & (F.col("execution_id") != F.col("_full"))
    return runs.where(older).select(*records.columns)


def changes_between(rows: DataFrame, before: str, after: str) -> DataFrame:
    """How each record of two executions differs: inserted, changed, unchanged or vanished.

    ``rows`` has (identity columns, execution_id, record_key, payload). Payloads are compared by
    their SHA-256, so only keys and digests are shuffled, one row per key and task; a key that an
    execution has written repeatedly counts by its greatest digest.
    """
    digest = F.sha2("payload", 256)
    run = F.col("execution_id")
    both = (
        rows.where(run.isin(before, after))
        .groupBy(*schemas.IDENTITY, "record_key")
        .agg(
            F.max(F.when(run == before, digest)).alias("_old"),
            F.max(F.when(run == after, digest)).alias("_new"),
        )
    )
    change = (
        F.when(F.col("_old").isNull(), "inserted")
        .when(F.col("_new").isNull(), "vanished")
        .when(F.col("_old") == F.col("_new"), "unchanged")
        .otherwise("changed")
    )
    return both.select(*schemas.IDENTITY, "record_key", change.alias("change"))
