"""Current records of a stream by state: a micro-batch writes only what it changes."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.upsert import latest
from tidemark.sinks.control import read_parquet

_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: State is kept on the executors' disks, and a checkpoint uploads only what a batch changed.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": _STATE_STORE,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Settings for the streams that are started inside; each keeps a copy from then on."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def changed_records(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The records that a micro-batch makes current: one row for each key it gives a later one.

    Rows are compared as in ``latest``: by ``order``, then by all other columns, which therefore
    must not be maps. A row that comes late, with an ``order`` before the key's current one, and
    one that repeats the current row give nothing, in whichever batch they come. The state has one
    row per key and no end, so it grows with the keys. Rows are combined before the shuffle, so a
    key with a third of all rows leaves each task as one row. Null keys are one key; a null sorts
    before any other value. Of a table that is no stream this is ``latest``.
    """
    mark, last = "first_seen", "last"
    while mark in rows.columns:
        mark += "_"
    while last in rows.columns:
        last += "_"
    others = [c for c in rows.columns if c not in keys and c not in order]
    # One moment per micro-batch, the same when it is repeated. Of equal rows the first counts.
    moment = -F.unix_micros(F.current_timestamp())
    packed = F.max(F.struct(*order, *others, mark)).alias(last)
    kept = rows.withColumn(mark, moment).groupBy(*keys).agg(packed)
    fresh = kept.where(F.col(last).getField(mark) == moment)
    return fresh.select(
        *(F.col(c) if c in keys else F.col(last).getField(c).alias(c) for c in rows.columns)
    )


def stream_upserts(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    path: str,
    checkpoint_location: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Appends what each micro-batch changes to ``path``; ``current_records`` reads it.

    A repeated micro-batch replaces the folder it left. A stream that begins anew with another
    checkpoint has no state and writes every key's record again, beside the earlier ones.
    """
    spark = rows.sparkSession

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = f"{path}/stream={stream}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(folder)

    with _settings(spark, STATE_SETTINGS):
        return (
            changed_records(rows, keys, order)
            .writeStream.outputMode("update")
            .foreachBatch(on_batch)
            .option("checkpointLocation", checkpoint_location)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


def changes(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every record that was current at the end of some micro-batch, with its stream and batch.

    ``schema`` is that of the rows, which must not have columns named ``stream`` or ``batch``.
    """
    places = [T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType())]
    return read_parquet(spark, path, T.StructType([*schema.fields, *places]))


def current_records(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key: the last that any micro-batch made current."""
    written = changes(spark, path, schema).select(*schema.fieldNames())
    return latest(written, keys, order)
