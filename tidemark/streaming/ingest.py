"""Streaming ingest of new rows into the layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import cursors
from tidemark.functions.defaults import DEFAULT_BATCH_SIZE
from tidemark.functions.values import require_column
from tidemark.operators.envelope import log_rows
from tidemark.plans.sync import (
    Dataset,
    Execution,
    SyncResult,
    error_text,
    move_checkpoint,
    now,
    record_outcome,
    started_messages,
    tell,
)
from tidemark.sinks.store import Attempt, Store


def _write(
    store: Store,
    batch: DataFrame,
    dataset: Dataset,
    name: str,
    attempt: Attempt,
    old: str | None,
    key_bits: int,
) -> tuple[int, str | None]:
    """Count of a micro-batch and the cursor after it, which never falls behind ``old``.

    A batch that is repeated after it was committed is not written again, also when its rows are
    part of a snapshot by then.
    """
    known = store.committed(attempt)
    if known:
        return known.records, known.last_value
    compacted = store.compacted_batch(dataset.identity, name)
    if compacted and attempt.attempt <= compacted.batch_id:
        # Of earlier batches than the last only the fact is known, not their size.
        last = attempt.attempt == compacted.batch_id
        return compacted.records if last else 0, compacted.last_value if last else old
    started = now()
    column = dataset.incremental_column
    top = None
    if column:
        kind = require_column(batch, column).dataType
        top = cursors.checkpoint_text(cursors.never_before(F.max("cursor"), old, kind), kind)
    written = store.write(
        log_rows(batch, dataset.technical_key, column, key_bits), attempt, started, now(), top
    )
    store.commit(attempt, started, written.records, written.last_value)
    return written.records, written.last_value


def stream_rows(
    store: Store,
    rows: DataFrame,
    dataset: Dataset,
    name: str,
    checkpoint_location: str,
    trigger: Mapping[str, object] | None = None,
    key_bits: int = 64,
) -> StreamingQuery:
    """Writes each micro-batch as one execution of the dataset.

    A batch tells of its start and outcome and has a ledger row like any sync, also when it
    fails; an incremental dataset's cursor advances with it, so a later ``run_sync`` reads only
    what came after. Empty batches leave nothing. A repeated batch that was committed is not
    written again.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        started = now()
        execution = Execution(f"{name}-{batch_id:012d}", trigger_type="event")
        attempt = Attempt(*dataset.identity, execution.execution_id, batch_id)
        tell(store, started_messages(store, execution, started))
        try:
            old = store.last_value(dataset.identity)
            records, last = _write(store, batch, dataset, name, attempt, old, key_bits)
        except Exception as error:
            failed = SyncResult(execution.execution_id, "failed", error=error_text(error))
            tell(store, record_outcome(store, dataset, execution, started, failed))
            raise
        size = dataset.batch_size if dataset.batch_size > 0 else DEFAULT_BATCH_SIZE
        result = SyncResult(
            execution.execution_id, "completed", records, -(-records // size), last,
            total_persisted=records,
        )
        recorded = record_outcome(store, dataset, execution, started, result)
        if dataset.sync_mode == "incremental":
            move_checkpoint(store, dataset, old, result)
        tell(store, recorded)

    return (
        rows.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint_location)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
