"""Many sync requests at once."""

from __future__ import annotations

import threading
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.requests import resolve
from tidemark.plans.sync import (
    Dataset,
    Execution,
    SyncResult,
    now,
    record_outcome,
    run_sync,
    started_messages,
    tell,
)
from tidemark.sinks.store import Store


#: Requests that are held in the driver at a time; a request is a row of short texts.
AHEAD = 1_000

Identity = tuple[str, str, str]


def process_requests(
    store: Store,
    requests: DataFrame,
    open_dataset: Callable[[Row], DataFrame],
    workers: int = 4,
    on_result: Callable[[SyncResult], None] | None = None,
    batch: str | None = None,
    limit: float | None = None,
) -> None:
    """Resolves and runs sync requests (X6); ``batch`` names a micro-batch that may be repeated.

    Requests are resolved by joins; each runnable one is a Spark job of its own, with a few
    jobs at a time. Requests for one dataset run one after another in timestamp order, and
    datasets take turns: one with many requests holds one worker at most. A sync that takes
    longer than ``limit`` seconds (None: any time) fails, and the next one runs. Jobs go to the scheduler pool of
    their tenant, which shares the cluster among tenants where ``spark.scheduler.mode`` is FAIR.
    Rows of requests reach the driver one partition at a time, never all together.
    """
    resolved = resolve(
        requests, store.sources.current(), store.datasets.current(), store.checkpoints.current()
    )
    store.reject(
        resolved.where(F.col("outcome") == "rejected").select(
            F.lit("sync").alias("kind"),
            F.to_json(F.struct(*schemas.SYNC_REQUEST.fieldNames())).alias("body"),
            "error",
        ),
        batch,
    )
    todo = resolved.where(F.col("outcome").isin("run", "failed")).orderBy(
        "timestamp", "execution_id"
    )

    def run(row: Row) -> None:
        result = _run_one(store, row, open_dataset, limit)
        if on_result is not None:
            on_result(result)

    with ThreadPoolExecutor(workers) as pool:
        turns = _Turns(pool, run, AHEAD)
        for row in todo.toLocalIterator():
            if not turns.add((row.tenant_id, row.source_id, row.dataset_id), row):
                break
        turns.finish()


class _Turns:
    """Runs rows one at a time per dataset, without a worker waiting for another one."""

    def __init__(self, pool: ThreadPoolExecutor, run: Callable[[Row], None], ahead: int):
        self._pool = pool
        self._run = run
        self._ahead = ahead
        self._held = 0
        self._queues: dict[Identity, deque[Row]] = {}
        self._changed = threading.Condition()
        # A failed sync is a result; this is a store that could not be written.
        self._trouble: BaseException | None = None

    def add(self, dataset: Identity, row: Row) -> bool:
        """Queues a row, once there is room; False after trouble."""
        with self._changed:
            self._changed.wait_for(lambda: self._trouble or self._held < self._ahead)
            if self._trouble:
                return False
            self._held += 1
            if dataset in self._queues:
                self._queues[dataset].append(row)
            else:
                self._queues[dataset] = deque([row])
                self._pool.submit(self._next, dataset)
            return True

    def _next(self, dataset: Identity) -> None:
        with self._changed:
            row = None if self._trouble else self._queues[dataset][0]
        try:
            if row is not None:
                self._run(row)
        except BaseException as error:  # noqa: BLE001 - raised by ``finish``
            self._trouble = self._trouble or error
        with self._changed:
            queue = self._queues[dataset]
            gone = len(queue) if self._trouble else 1
            for _ in range(gone):
                queue.popleft()
            self._held -= gone
            if queue:
                self._pool.submit(self._next, dataset)  # behind the other datasets
            else:
                del self._queues[dataset]
            self._changed.notify_all()

    def finish(self) -> None:
        """Waits for all rows. After trouble the caller, or the stream, has to repeat them."""
        with self._changed:
            self._changed.wait_for(lambda: self._held == 0)
        if self._trouble:
            raise self._trouble


@contextmanager
def _pool_of(spark: SparkSession, tenant: str) -> Iterator[None]:
    """Sends the jobs of this thread to the scheduler pool named after a tenant."""
    name = "spark.scheduler.pool"
    before = spark.sparkContext.getLocalProperty(name)
    spark.sparkContext.setLocalProperty(name, tenant)
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty(name, before)


def _run_one(
    store: Store, row: Row, open_dataset: Callable[[Row], DataFrame], limit: float | None
) -> SyncResult:
    dataset = Dataset(
        row.tenant_id,
        row.source_id,
        row.dataset_id,
        row.sync_mode,
        row.incremental_column,
        row.incremental_type,
        row.technical_key,
        row.batch_size,
    )
    execution = Execution(
        row.execution_id,
        row.connector_type or "",
        row.trigger_type or "",
        row.correlation_id or "",
    )
    with _pool_of(store.spark, row.tenant_id):
        if row.outcome == "run":
            return run_sync(store, dataset, lambda: open_dataset(row), execution, limit=limit)
        started = now()
        tell(store, started_messages(store, execution, started))
        result = SyncResult(row.execution_id, "failed", error=row.error)
        tell(store, record_outcome(store, dataset, execution, started, result))
        return result
