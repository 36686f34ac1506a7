"""One sync of one dataset: read, write both layers, keep the ledgers, move the cursor."""

from __future__ import annotations

import datetime
import logging
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import cursors
from tidemark.functions.defaults import DEFAULT_BATCH_SIZE
from tidemark.functions.values import require_column
from tidemark.operators import messages
from tidemark.operators.envelope import log_rows
from tidemark.operators.requests import INCREMENTAL_TYPES
from tidemark.sinks.control import next_ticket
from tidemark.sinks.store import Attempt, Store

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Dataset:
    """What a sync has to know about a dataset."""

    tenant_id: str
    source_id: str
    dataset_id: str
    sync_mode: str = "full"
    incremental_column: str | None = None
    incremental_type: str | None = None
    technical_key: str | None = None
    batch_size: int = DEFAULT_BATCH_SIZE

    @property
    def identity(self) -> tuple[str, str, str]:
        return self.tenant_id, self.source_id, self.dataset_id


@dataclass(frozen=True)
class Execution:
    """Who asked for a sync, and under which id."""

    execution_id: str
    connector_type: str = ""
    trigger_type: str = "manual"
    correlation_id: str = ""


@dataclass(frozen=True)
class SyncResult:
    execution_id: str
    status: str
    total_records: int = 0
    total_batches: int = 0
    last_value: str | None = None
    error: str | None = None
    total_persisted: int = 0


def now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


@contextmanager
def time_limit(spark: SparkSession, seconds: float | None) -> Iterator[None]:
    """Ends the Spark jobs that this thread starts when ``seconds`` are over (None: never).

    Jobs are known by a tag, so those of other threads go on. What runs outside of a job, such as
    a driver that waits for a database, is not interrupted: the next job after it is.
    """
    if seconds is None:
        yield
        return
    context = spark.sparkContext
    tag = f"tidemark-{uuid.uuid4().hex}"
    done, late = threading.Event(), threading.Event()

    def watch() -> None:
        if not done.wait(seconds):
            late.set()
            while not done.is_set():
                context.cancelJobsWithTag(tag)
                done.wait(0.5)

    watcher = threading.Thread(target=watch, name=tag, daemon=True)
    context.addJobTag(tag)
    watcher.start()
    try:
        yield
    except Exception as error:
        if late.is_set():
            raise TimeoutError(f"not finished within {seconds:g} seconds") from error
        raise
    finally:
        done.set()
        watcher.join()
        context.removeJobTag(tag)


def run_sync(
    store: Store,
    dataset: Dataset,
    open_source: Callable[[], DataFrame],
    execution: Execution,
    lookback: int | float = 0,
    key_bits: int = 64,
    limit: float | None = None,
) -> SyncResult:
    """Runs a sync and records its outcome; an error ends as a ``failed`` result.

    So does reading and writing that takes longer than ``limit`` seconds; nothing of it is seen.

    Order of effects: layers, then the ledger, then the checkpoint, then messages. Whatever a
    lost driver leaves out is repeated by the next run, and an upsert of the same rows changes
    nothing.
    """
    started = now()
    tell(store, started_messages(store, execution, started))
    old = None
    try:
        old = store.last_value(dataset.identity)
        with time_limit(store.spark, limit):
            result = _read_and_write(
                store, dataset, open_source, execution, started, old, lookback, key_bits
            )
    except Exception as error:  # noqa: BLE001 - every failure belongs in the ledger
        log.warning("sync %s failed", execution.execution_id, exc_info=True)
        result = SyncResult(execution.execution_id, "failed", error=error_text(error))
    recorded = record_outcome(store, dataset, execution, started, result)
    if result.status == "completed":
        move_checkpoint(store, dataset, old, result)
    tell(store, recorded)
    return result


def error_text(error: Exception) -> str:
    return str(error).strip() or type(error).__name__


def _read_and_write(
    store: Store,
    dataset: Dataset,
    open_source: Callable[[], DataFrame],
    execution: Execution,
    started: datetime.datetime,
    old: str | None,
    lookback: int | float,
    key_bits: int,
) -> SyncResult:
    column = None
    if dataset.sync_mode == "full":
        rows = open_source()
        if dataset.technical_key:
            require_column(rows, dataset.technical_key)
    elif dataset.sync_mode == "incremental":
        column = dataset.incremental_column
        if not column:
            raise ValueError(
                f"incremental_column not configured for dataset {dataset.dataset_id}"
            )
        if dataset.incremental_type not in INCREMENTAL_TYPES:
            raise ValueError(f"unsupported incremental type: {dataset.incremental_type}")
        rows = cursors.newer_than(open_source(), column, old, lookback)
    else:
        raise ValueError(f"unsupported sync mode: {dataset.sync_mode}")

    attempt = Attempt(*dataset.identity, execution.execution_id, next_ticket())
    top = None
    if column:
        kind = require_column(rows, column).dataType
        top = cursors.checkpoint_text(cursors.never_before(F.max("cursor"), old, kind), kind)
    # Count and cursor are taken from the rows as they pass into the files, so they always match
    # them: a task's share counts once, when Spark accepts that task's files.
    written = store.write(
        log_rows(rows, dataset.technical_key, column, key_bits), attempt, started, now(), top
    )
    last = written.last_value if written.records else None
    if written.records:
        store.commit(attempt, started, written.records, last)
    else:
        store.discard(attempt)
    size = dataset.batch_size if dataset.batch_size > 0 else DEFAULT_BATCH_SIZE
    batches = -(-written.records // size)
    return SyncResult(
        execution.execution_id, "completed", written.records, batches, last,
        total_persisted=written.records,
    )


def move_checkpoint(
    store: Store, dataset: Dataset, old: str | None, result: SyncResult
) -> None:
    """Clears the cursor after a full load, advances it after an incremental one (F8)."""
    key = store.checkpoints.one_row(
        tenant_id=dataset.tenant_id,
        source_id=dataset.source_id,
        dataset_id=dataset.dataset_id,
        last_value=result.last_value,
        updated_at=now(),
    )
    if dataset.sync_mode == "full":
        if old is not None:
            store.checkpoints.delete(key)
    elif result.last_value and result.last_value != old:
        store.checkpoints.upsert(key)


def record_outcome(
    store: Store,
    dataset: Dataset,
    execution: Execution,
    started: datetime.datetime,
    result: SyncResult,
) -> DataFrame:
    """Writes the ledger row of an execution; returns its closing messages (K5, T5)."""
    completed = now()
    row = store.executions.one_row(
        execution_id=execution.execution_id,
        tenant_id=dataset.tenant_id,
        source_id=dataset.source_id,
        dataset_id=dataset.dataset_id,
        connector_type=execution.connector_type,
        trigger_type=execution.trigger_type,
        status=result.status,
        total_records=result.total_records,
        total_persisted=result.total_persisted,
        total_batches=result.total_batches,
        duration_ms=int((completed - started).total_seconds() * 1000),
        error_message=result.error,
        started_at=started,
        completed_at=completed,
    )
    store.executions.upsert(row)
    if result.status == "failed":
        return messages.sync_failed(row, F.lit(completed))
    told = row.withColumns(
        {
            "correlation_id": F.lit(execution.correlation_id),
            "batch_size": F.lit(dataset.batch_size),
        }
    )
    return messages.completion(told, F.lit(completed))


def started_messages(
    store: Store, execution: Execution, started: datetime.datetime
) -> DataFrame:
    row = store.executions.one_row(execution_id=execution.execution_id)
    return messages.sync_started(row, F.lit(started))


def tell(store: Store, rows: DataFrame) -> None:
    """Publishes messages; a failure to do so never fails a sync."""
    try:
        store.publish(rows)
    except Exception:  # noqa: BLE001
        log.warning("messages could not be published", exc_info=True)
