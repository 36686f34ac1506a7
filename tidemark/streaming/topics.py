"""Streams of JSON requests, one job per request kind."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.plans.discovery import process_discoveries
from tidemark.plans.registration import check_sources, reset_checkpoints
from tidemark.plans.requests import process_requests
from tidemark.sinks.store import Store
from tidemark.sources.catalogs import Catalog

_CORRUPT = "_malformed"


def read_messages(
    spark: SparkSession, source: str, options: Mapping[str, str], path: str | None = None
) -> DataFrame:
    """A stream with one ``value`` text per message: Kafka topics, or files of JSON lines.

    ``source`` is ``kafka`` or ``text``; ``options`` go to the stream reader, such as
    ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger`` to bound a micro-batch.
    """
    stream = spark.readStream.format(source).options(**options).load(path)
    return stream.select(F.col("value").cast("string").alias("value"))


def parse(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Messages as columns; ``error`` is set and ``body`` keeps the text of a malformed one."""
    tolerant = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = F.from_json(F.col("value"), tolerant, options).alias("message")
    malformed = F.col("message").isNull() | F.col(f"message.{_CORRUPT}").isNotNull()
    return messages.select("value", parsed).select(
        *(F.col(f"message.{name}").alias(name) for name in schema.fieldNames()),
        F.col("value").alias("body"),
        F.when(malformed, F.lit("malformed message")).alias("error"),
    )


def _start(
    store: Store,
    kind: str,
    messages: DataFrame,
    schema: T.StructType,
    handle: Callable[[DataFrame, str], None],
    checkpoint_location: str,
    trigger: Mapping[str, object],
) -> StreamingQuery:
    """Parses each micro-batch, keeps malformed messages, hands on the rest.

    Malformed messages are kept under the batch's own name, so a repeated batch keeps them once.
    """

    stream = hashlib.sha256(checkpoint_location.encode()).hexdigest()[:16]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        rows = parse(batch, schema).persist()  # bounded by the reader's options
        try:
            bad = rows.where(F.col("error").isNotNull())
            if not bad.isEmpty():
                refused = bad.select(F.lit(kind).alias("kind"), "body", "error")
                store.reject(refused, f"{stream}-{batch_id}")
            good = rows.where(F.col("error").isNull()).select(*schema.fieldNames())
            handle(good, f"{stream}-{batch_id}-refused")
        finally:
            rows.unpersist()

    return (
        messages.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint_location)
        .trigger(**trigger)
        .start()
    )


_ALL_WAITING = {"availableNow": True}


def sync_requests(
    store: Store,
    messages: DataFrame,
    open_dataset: Callable[[Row], DataFrame],
    checkpoint_location: str,
    trigger: Mapping[str, object] = _ALL_WAITING,
    workers: int = 4,
    limit: float | None = None,
) -> StreamingQuery:
    """Runs each requested sync (S11, T4); one that takes ``limit`` seconds fails."""

    def handle(requests: DataFrame, batch: str) -> None:
        process_requests(store, requests, open_dataset, workers, batch=batch, limit=limit)

    return _start(
        store, "sync", messages, schemas.SYNC_REQUEST, handle, checkpoint_location, trigger
    )


def test_requests(
    store: Store,
    messages: DataFrame,
    read_schemata: Callable[[], DataFrame],
    checkpoint_location: str,
    trigger: Mapping[str, object] = _ALL_WAITING,
) -> StreamingQuery:
    """Checks the schema of each requested source."""

    def handle(requests: DataFrame, batch: str) -> None:
        check_sources(store, requests, read_schemata(), batch)

    return _start(
        store, "test", messages, schemas.TEST_REQUEST, handle, checkpoint_location, trigger
    )


def discovery_requests(
    store: Store,
    messages: DataFrame,
    open_catalog: Callable[[Row], Catalog],
    checkpoint_location: str,
    trigger: Mapping[str, object] = _ALL_WAITING,
    workers: int = 4,
) -> StreamingQuery:
    """Discovers each requested source."""

    def handle(requests: DataFrame, batch: str) -> None:
        process_discoveries(store, requests, open_catalog, workers, batch)

    return _start(
        store, "discovery", messages, schemas.DISCOVERY_REQUEST, handle, checkpoint_location,
        trigger,
    )


def reset_requests(
    store: Store,
    messages: DataFrame,
    checkpoint_location: str,
    trigger: Mapping[str, object] = _ALL_WAITING,
) -> StreamingQuery:
    """Deletes the cursor of each requested dataset."""

    def handle(requests: DataFrame, batch: str) -> None:
        reset_checkpoints(store, requests, batch)

    return _start(
        store, "reset", messages, schemas.RESET_REQUEST, handle, checkpoint_location, trigger
    )
