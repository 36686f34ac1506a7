"""Lifecycle and result messages as ``(topic, key, value)`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.defaults import empty_to_null
from tidemark.functions.payload import message_body
from tidemark.functions.values import utc_text
from tidemark.operators.batches import batches_of

# Message topics.
SYNC_STARTED = "data.connect.sync.started"
BATCH_PROCESSED = "data.connect.batch.processed"
SYNC_COMPLETED = "data.connect.sync.completed"
SYNC_FAILED = "data.connect.sync.failed"
TEST_RESULT = "data.connect.test.result"
DISCOVERY_RESULT = "data.connect.discovery.result"


def _instant(at: Column) -> Column:
    return utc_text(at, T.TimestampType()).alias("timestamp")


def _messages(rows: DataFrame, topic: str, key: str, *fields: Column) -> DataFrame:
    return rows.select(
        F.lit(topic).alias("topic"),
        F.col(key).alias("key"),
        message_body(*fields).alias("value"),
    )


def sync_started(executions: DataFrame, at: Column) -> DataFrame:
    """One message per execution that began (K8)."""
    return _messages(executions, SYNC_STARTED, "execution_id", F.col("execution_id"), _instant(at))


def sync_completed(executions: DataFrame, at: Column) -> DataFrame:
    """One message per completed execution."""
    done = executions.where(F.col("status") == "completed")
    return _messages(done, SYNC_COMPLETED, "execution_id", F.col("execution_id"), _instant(at))


def sync_failed(executions: DataFrame, at: Column) -> DataFrame:
    """One message per failed execution, with its error."""
    failed = executions.where(F.col("status") == "failed")
    return _messages(
        failed,
        SYNC_FAILED,
        "execution_id",
        F.col("execution_id"),
        _instant(at),
        F.coalesce("error_message", F.lit("")).alias("error_message"),
    )


def batch_processed(batches: DataFrame, at: Column) -> DataFrame:
    """One message per batch, with the execution's identity (K9)."""
    extra = F.struct(F.col("batch_number"), F.col("records_in_batch")).alias("extra")
    identity = [
        F.coalesce(F.col(name), F.lit("")).alias(name)
        for name in (
            "tenant_id", "source_id", "dataset_id", "execution_id", "connector_type",
            "trigger_type", "correlation_id",
        )
    ]
    return _messages(
        batches,
        BATCH_PROCESSED,
        "execution_id",
        F.lit(BATCH_PROCESSED).alias("event_type"),
        *identity,
        _instant(at),
        extra,
    )


def completion(executions: DataFrame, at: Column) -> DataFrame:
    """The closing messages of completed executions: their batches, then the outcome."""
    completed = executions.where(F.col("status") == "completed")
    return batch_processed(batches_of(completed), at).unionByName(sync_completed(completed, at))


def lifecycle(executions: DataFrame, started: Column, finished: Column) -> DataFrame:
    """All messages of finished executions: started, batches, then the outcome (T5).

    A failed execution has written nothing, so it has no batches.
    """
    return (
        sync_started(executions, started)
        .unionByName(completion(executions, finished))
        .unionByName(sync_failed(executions, finished))
    )


def test_results(checked: DataFrame, at: Column) -> DataFrame:
    """Connection-test results keyed by request."""
    return _messages(
        checked,
        TEST_RESULT,
        "request_id",
        F.col("request_id"),
        F.col("tenant_id"),
        F.col("source_id"),
        F.col("success"),
        F.col("message"),
        F.col("response_time_ms").cast("bigint").alias("response_time_ms"),
        empty_to_null(F.col("error")).alias("error"),
        _instant(at),
    )


def discovery_results(found: DataFrame, at: Column) -> DataFrame:
    """Discovery summaries keyed by request."""
    return _messages(
        found,
        DISCOVERY_RESULT,
        "request_id",
        F.col("request_id"),
        F.col("tenant_id"),
        F.col("source_id"),
        F.col("success"),
        F.coalesce("schema_count", F.lit(0)).alias("schema_count"),
        F.coalesce("table_count", F.lit(0)).alias("table_count"),
        empty_to_null(F.col("error")).alias("error"),
        _instant(at),
    )
