"""Streams: requests as messages, and rows ingested as they arrive."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from tidemark.plans.sync import Dataset, Execution, run_sync
from tidemark.session import scratch_dir
from tidemark.sources.catalogs import from_frames
from tidemark.sources.tables import parquet_folder
from tidemark.streaming import topics
from tidemark.streaming.ingest import stream_rows
from tidemark.streaming.upserts import changes, current_records, stream_upserts
from workload import catalogs, inputs, sql
from workload.inputs import as_sql, derive, table
from workload.syncs import (
    EVENTS,
    REQUESTED_SQL,
    SOURCE_ROWS,
    SYNC_ROWS,
    new_store,
    registered_store,
)


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _as_messages(spark, rows, broken=None):
    """Rows as a stream of JSON messages from files, with broken ones among them."""
    folder = scratch_dir(spark, "messages")
    values = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
    if broken is not None:
        values = values.unionByName(broken)
    values.write.text(folder)
    return topics.read_messages(spark, "text", {}, folder)


def stream_sync_requests(spark, sf):
    store = registered_store(spark, sf)
    rows = derive(spark, sf, SYNC_ROWS)
    broken = rows.select(F.concat(F.lit("{bad "), "execution_id").alias("value"))
    stream = _as_messages(spark, rows, broken)
    _finish(
        topics.sync_requests(store, stream, parquet_folder(spark, sf), scratch_dir(spark, "offsets"))
    )
    return store.normalized().select("dataset_id", "execution_id", "record_key", "payload")


def stream_rejected(spark, sf):
    """Malformed messages, one per order, and resets without a dataset."""
    store = new_store(spark)
    orders = table(spark, sf, "orders")
    resets = orders.select(
        F.lit("t").alias("tenant_id"), F.lit("s").alias("source_id"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("dataset_id"),
        F.col("o_orderkey").cast("string").alias("request_id"),
    )
    broken = orders.select(F.concat(F.lit("{bad "), F.col("o_orderkey")).alias("value"))
    stream = _as_messages(spark, resets, broken)
    _finish(topics.reset_requests(store, stream, scratch_dir(spark, "offsets")))
    return store.rejected().select("kind", "body", "error")


def stream_rejected_replayed(spark, sf):
    """The same micro-batch twice: a stream that begins anew with the offsets of the first."""
    store = new_store(spark)
    orders = table(spark, sf, "orders")
    broken = orders.select(F.concat(F.lit("{bad "), F.col("o_orderkey")).alias("value"))
    folder = scratch_dir(spark, "messages")
    broken.write.text(folder)
    offsets = scratch_dir(spark, "offsets")
    for _ in range(2):
        _finish(topics.reset_requests(store, topics.read_messages(spark, "text", {}, folder), offsets))
        _forget_offsets(spark, offsets)
    return store.rejected().select("kind", "body", "error")


def _forget_offsets(spark, folder):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stream_resets(spark, sf):
    """Cursors of all customers, of which those with failed executions are reset."""
    store = new_store(spark)
    store.checkpoints.upsert(derive(spark, sf, inputs.NEW_MARKS))
    failed = derive(spark, sf, inputs.EXECUTIONS).where(F.col("status") == "failed").select(
        "tenant_id", "source_id", "dataset_id", F.col("execution_id").alias("request_id")
    )
    stream = _as_messages(spark, failed)
    _finish(topics.reset_requests(store, stream, scratch_dir(spark, "offsets")))
    return store.checkpoints.current().select(
        "tenant_id", "source_id", "dataset_id", "last_value"
    )


def stream_tests(spark, sf):
    """Schema checks of every supplier that is registered as a source."""
    store = new_store(spark)
    store.sources.upsert(derive(spark, sf, inputs.SOURCES))
    requests = table(spark, sf, "supplier").select(
        F.concat(F.lit("t"), F.col("s_suppkey") % 5).alias("tenant_id"),
        F.concat(F.lit("s"), F.col("s_suppkey")).alias("source_id"),
        F.concat(F.lit("r"), F.col("s_suppkey")).alias("request_id"),
    )
    stream = _as_messages(spark, requests)
    visible = derive(spark, sf, inputs.VISIBLE_SCHEMAS)
    _finish(
        topics.test_requests(store, stream, lambda: visible, scratch_dir(spark, "offsets"))
    )
    result = F.from_json("value", "request_id string, success boolean, error string")
    return store.messages().select(result.alias("r")).select("r.request_id", "r.success", "r.error")


def stream_tests_replayed(spark, sf):
    """Schema checks of every supplier, registered or not, whose micro-batch comes twice."""
    store = new_store(spark)
    store.sources.upsert(derive(spark, sf, inputs.SOURCES))
    folder, offsets = scratch_dir(spark, "messages"), scratch_dir(spark, "offsets")
    requests = table(spark, sf, "supplier").select(
        F.concat(F.lit("t"), F.col("s_suppkey") % 5).alias("tenant_id"),
        F.concat(F.lit("s"), F.col("s_suppkey")).alias("source_id"),
        F.concat(F.lit("r"), F.col("s_suppkey")).alias("request_id"),
    )
    requests.select(F.to_json(F.struct("*")).alias("value")).write.text(folder)
    visible = derive(spark, sf, inputs.VISIBLE_SCHEMAS)
    for _ in range(2):
        stream = topics.read_messages(spark, "text", {}, folder)
        _finish(topics.test_requests(store, stream, lambda: visible, offsets))
        _forget_offsets(spark, offsets)
    refused = store.rejected().select(
        F.get_json_object("body", "$.request_id").alias("request_id"), F.lit("refused").alias("outcome")
    )
    told = store.messages().select(F.col("key").alias("request_id"), F.lit("told").alias("outcome"))
    return refused.unionByName(told)


def stream_ingest_replayed_after_compaction(spark, sf):
    """A micro-batch that comes again when its rows are in a snapshot and a later run has passed."""
    store = new_store(spark)
    folder, offsets = scratch_dir(spark, "arrivals"), scratch_dir(spark, "offsets")
    events = table(spark, sf, "events")
    events.write.parquet(folder)

    def ingest():
        arriving = spark.readStream.schema(events.schema).parquet(folder)
        _finish(stream_rows(store, arriving, EVENTS, "arrivals", offsets))

    ingest()
    store.drop(store.compact(EVENTS.identity))
    later = events.where("event_id % 2 = 0").withColumn("event_type", F.lit("later"))
    store.checkpoints.delete(store.checkpoints.current())
    run_sync(store, EVENTS, lambda: later, Execution("inc-2"))
    _forget_offsets(spark, offsets)
    ingest()
    records = store.normalized(EVENTS.identity)
    return records.select("dataset_id", "execution_id", "record_key", "payload")


def stream_discoveries(spark, sf):
    """Discovery of every nation's source: three are known, and one of them is filtered."""
    store = registered_store(spark, sf)
    requests = derive(
        spark, sf,
        """
        SELECT 'acme' AS tenant_id, lower(n_name) AS source_id,
               concat('r', cast(n_nationkey AS string)) AS request_id,
               CASE n_nationkey WHEN 1 THEN 'schema7' ELSE '' END AS filter_schema
        FROM {nation}
        """,
    )
    stream = _as_messages(spark, requests)
    _finish(
        topics.discovery_requests(
            store, stream, lambda row: catalogs.postgres(spark, sf), scratch_dir(spark, "offsets")
        )
    )
    result = F.from_json(
        "value", "request_id string, success boolean, schema_count int, table_count int"
    )
    return store.messages().select(result.alias("r")).select("r.*")


def stream_ingest(spark, sf):
    """Events arriving as files, one micro-batch per file."""
    store = new_store(spark)
    folder = scratch_dir(spark, "arrivals")
    events = table(spark, sf, "events")
    events.repartitionByRange(3, "ts").write.parquet(folder)
    arriving = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    )
    dataset = Dataset("acme", "web", "events", "incremental", "ts", "date", "event_id")
    _finish(stream_rows(store, arriving, dataset, "arrivals", scratch_dir(spark, "offsets")))
    return store.normalized(dataset.identity).select("dataset_id", "record_key", "payload")


def stream_ingest_then_incremental(spark, sf):
    """Early events by stream, then a sync of all events, which reads what came after."""
    store = new_store(spark)
    folder = scratch_dir(spark, "arrivals")
    events = table(spark, sf, "events")
    early = events.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    early.write.parquet(folder)
    arriving = spark.readStream.schema(events.schema).parquet(folder)
    _finish(stream_rows(store, arriving, EVENTS, "arrivals", scratch_dir(spark, "offsets")))
    result = run_sync(store, EVENTS, lambda: events, Execution("inc-2"))
    if result.status != "completed":
        raise RuntimeError(result.error)
    records = store.normalized(EVENTS.identity)
    return records.select("dataset_id", "execution_id", "record_key", "payload")


def stream_upsert_state(spark, sf):
    """Order lines in three runs of one stream, each with later and earlier ones of the orders.

    Returns the current line of each order and how often a micro-batch has changed it.
    """
    arrivals, offsets = scratch_dir(spark, "arrivals"), scratch_dir(spark, "offsets")
    written = scratch_dir(spark, "changes")
    keys, order = ["l_orderkey"], ["l_shipdate", "l_linenumber"]
    lines = table(spark, sf, "lineitem").select(*keys, *order, "l_extendedprice")
    for part in range(3):
        lines.where(F.col("l_linenumber") % 3 == part).write.mode("append").parquet(arrivals)
        arriving = spark.readStream.schema(lines.schema).parquet(arrivals)
        _finish(stream_upserts(arriving, keys, order, written, offsets))
    counted = changes(spark, written, lines.schema).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("changes")
    )
    return current_records(spark, written, lines.schema, keys, order).join(counted, keys)


_PG_OBJECTS = catalogs.QUERIES["catalog_tables"][1]
_PG_SCHEMAS = catalogs.QUERIES["catalog_schemas_postgres"][1]

QUERIES = {
    "stream_sync_requests": (stream_sync_requests, REQUESTED_SQL),
    "stream_rejected": (
        stream_rejected,
        f"""
        SELECT 'reset' AS kind, '{{bad ' || o_orderkey AS body, 'malformed message' AS error
        FROM orders UNION ALL
        SELECT 'reset', {sql.body({"tenant_id": "'t'", "source_id": "'s'",
                                   "request_id": "cast(o_orderkey AS varchar)"})},
               'tenant_id, source_id and dataset_id are required'
        FROM orders WHERE o_orderstatus = 'F'
        """,
    ),
    "stream_rejected_replayed": (
        stream_rejected_replayed,
        "SELECT 'reset' AS kind, '{bad ' || o_orderkey AS body, 'malformed message' AS error "
        "FROM orders",
    ),
    "stream_ingest_then_incremental": (
        stream_ingest_then_incremental,
        f"""
        SELECT 'events' AS dataset_id,
               CASE WHEN ts < timestamp '2024-01-20 00:00:00' THEN 'arrivals-000000000000'
                    ELSE 'inc-2' END AS execution_id,
               cast(event_id AS varchar) AS record_key, {sql.json(sql.EVENTS)} AS payload
        FROM events
        """,
    ),
    "stream_resets": (
        stream_resets,
        f"""
        SELECT tenant_id, source_id, dataset_id, last_value
        FROM {as_sql(inputs.NEW_MARKS)} m WHERE NOT EXISTS (
            SELECT 1 FROM {as_sql(inputs.EXECUTIONS)} e
            WHERE e.status = 'failed' AND e.dataset_id = m.dataset_id)
        """,
    ),
    "stream_tests": (
        stream_tests,
        f"""
        SELECT 'r' || substr(s.source_id, 2) AS request_id, success,
               CASE WHEN NOT success THEN 'schema "' || schema_name ||
                    '" does not exist or is not accessible to the configured user' END AS error
        FROM (SELECT *, schema_name IS NULL OR EXISTS (
                  SELECT 1 FROM {as_sql(inputs.VISIBLE_SCHEMAS)} v
                  WHERE v.tenant_id = s.tenant_id AND v.source_id = s.source_id
                    AND v.schema_name = s.schema_name) AS success
              FROM {as_sql(inputs.SOURCES)} s
              WHERE s.source_id NOT LIKE 'spare%') s  -- nobody asks for these
        """,
    ),
    "stream_tests_replayed": (
        stream_tests_replayed,
        f"""
        SELECT 'r' || s_suppkey AS request_id,
               CASE WHEN EXISTS (SELECT 1 FROM {as_sql(inputs.SOURCES)} s
                                 WHERE s.source_id = 's' || s_suppkey) THEN 'told' ELSE 'refused' END
                   AS outcome
        FROM supplier
        """,
    ),
    "stream_ingest_replayed_after_compaction": (
        stream_ingest_replayed_after_compaction,
        f"""
        SELECT 'events' AS dataset_id,
               CASE WHEN event_id % 2 = 0 THEN 'inc-2' ELSE 'arrivals-000000000000' END AS execution_id,
               cast(event_id AS varchar) AS record_key,
               {sql.json({**sql.EVENTS, "event_type":
                   "CASE WHEN event_id % 2 = 0 THEN 'later' ELSE event_type END"})} AS payload
        FROM events
        """,
    ),
    "stream_discoveries": (
        stream_discoveries,
        f"""
        SELECT 'r' || n_nationkey AS request_id, n_nationkey < 3 AS success,
               CASE WHEN n_nationkey < 3 THEN cast((SELECT count(*) FROM ({_PG_SCHEMAS})) AS integer)
                    ELSE 0 END AS schema_count,
               CASE WHEN n_nationkey = 1 THEN cast((SELECT count(*) FROM ({_PG_OBJECTS})
                                                   WHERE schema_name = 'schema7') AS integer)
                    WHEN n_nationkey < 3 THEN cast((SELECT count(*) FROM ({_PG_OBJECTS})) AS integer)
                    ELSE 0 END AS table_count
        FROM nation
        """,
    ),
    "stream_upsert_state": (
        stream_upsert_state,
        """
        WITH best AS (
            SELECT l_orderkey, l_linenumber % 3 AS part,
                   max({'d': l_shipdate, 'n': l_linenumber, 'p': l_extendedprice}) AS line
            FROM lineitem GROUP BY ALL
        ), marked AS (
            SELECT *, max(line) OVER (PARTITION BY l_orderkey ORDER BY part
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM best
        )
        SELECT l_orderkey, max(line).d AS l_shipdate, max(line).n AS l_linenumber,
               max(line).p AS l_extendedprice,
               count(*) FILTER (before IS NULL OR line > before) AS changes
        FROM marked GROUP BY l_orderkey
        """,
    ),
    "stream_ingest": (
        stream_ingest,
        f"SELECT 'events' AS dataset_id, cast(event_id AS varchar) AS record_key, "
        f"{sql.json(sql.EVENTS)} AS payload FROM events",
    ),
}
