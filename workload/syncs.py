"""Whole syncs through a store in the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.envelope import log_rows
from tidemark.operators.ledger import changes_between
from tidemark.plans.registration import register_datasets, register_sources, reset_checkpoints
from tidemark.plans.requests import process_requests
from tidemark.plans.sync import Dataset, Execution, now, run_sync
from tidemark.session import scratch_dir
from tidemark.sinks.store import Attempt, Store
from tidemark.sources.tables import parquet_folder
from workload import sql
from workload.inputs import table

CUSTOMER = Dataset("acme", "erp", "customer", "full", technical_key="c_custkey")
EVENTS = Dataset("acme", "web", "events", "incremental", "ts", "date", "event_id")
ORDERS = Dataset("acme", "erp", "orders", "incremental", "o_orderkey", "key", "o_orderkey")
LINES = Dataset("acme", "erp", "lineitem", "incremental", "l_shipdate", "date", "l_orderkey")


def new_store(spark) -> Store:
    return Store(spark, scratch_dir(spark, "store"))


def _sync(store, dataset, rows, execution_id):
    result = run_sync(store, dataset, lambda: rows, Execution(execution_id))
    if result.status != "completed":
        raise RuntimeError(result.error)


def _records(layer):
    return layer.select("dataset_id", "execution_id", "record_key", "payload")


def sync_full(spark, sf):
    store = new_store(spark)
    _sync(store, CUSTOMER, table(spark, sf, "customer"), "full-1")
    return _records(store.normalized(CUSTOMER.identity))


def sync_unfinished_attempt(spark, sf):
    """A run that is written but not committed is neither read nor compacted away."""
    store = new_store(spark)
    customer = table(spark, sf, "customer")
    _sync(store, CUSTOMER, customer, "full-1")
    stray = log_rows(customer.withColumn("c_name", F.upper("c_name")), "c_custkey")
    store.write(stray, Attempt(*CUSTOMER.identity, "full-2", 1), now(), now())
    store.drop(store.compact(CUSTOMER.identity))
    return _records(store.normalized(CUSTOMER.identity))


def sync_full_by_hash(spark, sf):
    store = new_store(spark)
    pages = Dataset("acme", "web", "pages")
    _sync(store, pages, table(spark, sf, "pages"), "full-1")
    return _records(store.raw(pages.identity))


def sync_incremental(spark, sf):
    store = new_store(spark)
    _sync(store, EVENTS, table(spark, sf, "events"), "inc-1")
    return _records(store.normalized(EVENTS.identity))


def sync_incremental_resumed(spark, sf):
    """A first run sees the first twenty days; the second reads the rest past the cursor."""
    store = new_store(spark)
    events = table(spark, sf, "events")
    _sync(store, EVENTS, events.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")),
          "inc-1")
    _sync(store, EVENTS, events, "inc-2")
    return _records(store.raw(EVENTS.identity))


def sync_last_write_wins(spark, sf):
    """Order lines keyed by order: the line with the latest ship date stays."""
    store = new_store(spark)
    _sync(store, LINES, table(spark, sf, "lineitem"), "inc-1")
    return _records(store.normalized(LINES.identity))


def sync_repeated(spark, sf):
    """Reset and run again: the second run replaces every record of the first."""
    store = new_store(spark)
    orders = table(spark, sf, "orders")
    _sync(store, ORDERS, orders, "inc-1")
    store.checkpoints.delete(
        store.checkpoints.one_row(tenant_id="acme", source_id="erp", dataset_id="orders")
    )
    _sync(store, ORDERS, orders, "inc-2")
    return _records(store.normalized(ORDERS.identity))


def sync_compacted(spark, sf):
    """A snapshot of a first run, then a second run on top of it."""
    store = new_store(spark)
    customer = table(spark, sf, "customer")
    _sync(store, CUSTOMER, customer, "full-1")
    store.drop(store.compact(CUSTOMER.identity))
    richer = customer.where(F.col("c_acctbal") >= 0).withColumn(
        "c_mktsegment", F.lower("c_mktsegment")
    )
    _sync(store, CUSTOMER, richer, "full-2")
    return _records(store.normalized(CUSTOMER.identity))


def sync_bucketed_merge(spark, sf):
    """A snapshot in key buckets, merged with a second run, then a third run on top of it."""
    store = new_store(spark)
    orders = table(spark, sf, "orders")
    full = Dataset("acme", "erp", "orders", "full", technical_key="o_orderkey")
    _sync(store, full, orders, "full-1")
    store.drop(store.compact(full.identity, buckets=16))
    lower = F.lower("o_orderpriority")
    _sync(store, full, orders.where("o_orderkey % 9 = 0").withColumn("o_orderpriority", lower), "full-2")
    store.drop(store.compact(full.identity))
    shifted = orders.where("o_orderkey % 6 = 0").withColumn("o_orderstatus", F.lit("X"))
    _sync(store, full, shifted, "full-3")
    return _records(store.normalized(full.identity))


def incremental_lookback_resume(spark, sf):
    """A second run reads ten days again and finds only rows of those: the cursor stays."""
    store = new_store(spark)
    events = table(spark, sf, "events")
    _sync(store, EVENTS, events, "inc-1")
    day = F.date_trunc("day", F.col("ts"))
    last = events.agg(F.max(day)).first()[0]
    earlier = events.where(day < F.lit(last))
    run_sync(store, EVENTS, lambda: earlier, Execution("inc-2"), lookback=10 * 86_400)
    stored = store.checkpoints.current().select("dataset_id", "last_value")
    runs = store.executions.current().where("execution_id = 'inc-2'")
    return stored.join(runs.select("dataset_id", "total_records"), "dataset_id")


def changes_between_runs(spark, sf):
    """Two full runs: some customers are new, some changed, some gone."""
    store = new_store(spark)
    customer = table(spark, sf, "customer")
    segment = F.when(F.col("c_custkey") % 5 == 1, F.lower("c_mktsegment")).otherwise(
        F.col("c_mktsegment")
    )
    _sync(store, CUSTOMER, customer.where("c_custkey % 7 != 0"), "full-1")
    later = customer.where("c_custkey % 11 != 0").withColumn("c_mktsegment", segment)
    _sync(store, CUSTOMER, later, "full-2")
    rows = store.log(CUSTOMER.identity).select(
        "tenant_id", "source_id", "dataset_id", "execution_id",
        F.col("normalized_key").alias("record_key"), F.col("normalized_payload").alias("payload"),
    )
    return changes_between(rows, "full-1", "full-2").select("dataset_id", "record_key", "change")


def records_by_key(spark, sf):
    """The records of all customers with an order, from a snapshot and a run after it."""
    store = new_store(spark)
    customer = table(spark, sf, "customer")
    _sync(store, CUSTOMER, customer, "full-1")
    store.drop(store.compact(CUSTOMER.identity))
    lower = customer.where("c_acctbal < 0").withColumn("c_mktsegment", F.lower("c_mktsegment"))
    _sync(store, CUSTOMER, lower, "full-2")
    wanted = table(spark, sf, "orders").select("o_custkey")
    return _records(store.records_of("normalized", wanted, CUSTOMER.identity))


def execution_persisted(spark, sf):
    """Rows read and rows persisted of a full run, a first incremental one, and one without news."""
    store = new_store(spark)
    _sync(store, CUSTOMER, table(spark, sf, "customer"), "full-1")
    _sync(store, EVENTS, table(spark, sf, "events"), "inc-1")
    _sync(store, EVENTS, table(spark, sf, "events"), "inc-2")
    return store.executions.current().select("execution_id", "total_records", "total_persisted")


SOURCE_ROWS = """
SELECT 'acme' AS tenant_id,
       concat(CASE WHEN n_nationkey < 3 THEN '' ELSE 'spare ' END, lower(n_name)) AS source_id,
       'postgres' AS connector_type,
       'db' AS host, cast(5432 AS int) AS port, 'sales' AS database, '' AS schema,
       'reader' AS username, 'ref' AS password_ref, cast(NULL AS string) AS ssl_mode
FROM {nation}
"""
DATASET_ROWS = """
SELECT 'acme' AS tenant_id, lower(n_name) AS source_id,
       CASE WHEN n_nationkey = 0 THEN 'orders' WHEN n_nationkey = 1 THEN 'customer'
            WHEN n_nationkey < 4 THEN 'part' ELSE 'supplier' END AS dataset_id,
       CASE n_nationkey WHEN 0 THEN 'orders' WHEN 1 THEN 'customer' ELSE 'part' END AS table_name,
       CASE n_nationkey WHEN 0 THEN 'incremental' ELSE 'full' END AS sync_mode,
       '' AS schema_name, '' AS object_type,
       CASE n_nationkey WHEN 0 THEN 'o_orderkey' ELSE '' END AS incremental_column,
       CASE n_nationkey WHEN 0 THEN 'key' ELSE '' END AS incremental_type,
       CASE n_nationkey WHEN 0 THEN 'o_orderkey' WHEN 1 THEN 'c_custkey' ELSE 'p_partkey'
       END AS technical_key,
       cast(0 AS int) AS batch_size, n_nationkey <> 2 AS enabled
FROM {nation}
"""
SYNC_ROWS = """
SELECT 'acme' AS tenant_id, lower(n_name) AS source_id,
       CASE n_nationkey WHEN 0 THEN 'orders' WHEN 1 THEN 'customer' ELSE 'part' END AS dataset_id,
       concat('run-', cast(n_nationkey AS string)) AS execution_id,
       'postgres' AS connector_type, 'manual' AS trigger_type, 'c' AS correlation_id,
       cast('2024-01-01 00:00:00' AS timestamp) AS timestamp
FROM {nation}
"""


def registered_store(spark, sf) -> Store:
    from workload.inputs import derive

    store = new_store(spark)
    register_sources(store, derive(spark, sf, SOURCE_ROWS))
    register_datasets(store, derive(spark, sf, DATASET_ROWS))
    return store


def sync_requests(spark, sf):
    """A request of every nation: three have a source, of whose datasets one is disabled."""
    from workload.inputs import derive

    store = registered_store(spark, sf)
    process_requests(store, derive(spark, sf, SYNC_ROWS), parquet_folder(spark, sf))
    return _records(store.normalized())


def sync_requests_after_reset(spark, sf):
    """The ledger after a run, a reset of all cursors, and a second run."""
    from workload.inputs import derive

    store = registered_store(spark, sf)
    requests = derive(spark, sf, SYNC_ROWS)
    again = requests.withColumn("execution_id", F.concat(F.lit("again-"), "execution_id"))
    process_requests(store, requests, parquet_folder(spark, sf))
    reset_checkpoints(store, requests)
    process_requests(store, again, parquet_folder(spark, sf))
    return store.executions.current().select(
        "execution_id", "dataset_id", "status", "total_records", "total_batches"
    )


ORDERS_JSON = sql.json(sql.ORDERS)
CUSTOMER_JSON = sql.json(sql.CUSTOMER)
_LINES_SQL = f"""
SELECT 'lineitem' AS dataset_id, 'inc-1' AS execution_id,
       cast(l_orderkey AS varchar) AS record_key, r.payload AS payload
FROM (SELECT l_orderkey, max(struct_pack(l_shipdate := l_shipdate,
             payload := {sql.json(sql.LINEITEM)})) AS r
      FROM lineitem GROUP BY l_orderkey)
"""
REQUESTED_SQL = f"""
SELECT 'orders' AS dataset_id, 'run-0' AS execution_id,
       cast(o_orderkey AS varchar) AS record_key, {ORDERS_JSON} AS payload FROM orders
UNION ALL
SELECT 'customer', 'run-1', cast(c_custkey AS varchar), {CUSTOMER_JSON} FROM customer
"""

QUERIES = {
    "sync_full_end_to_end": (
        sync_full,
        f"SELECT 'customer' AS dataset_id, 'full-1' AS execution_id, "
        f"cast(c_custkey AS varchar) AS record_key, {CUSTOMER_JSON} AS payload FROM customer",
    ),
    "sync_unfinished_attempt": (
        sync_unfinished_attempt,
        f"SELECT 'customer' AS dataset_id, 'full-1' AS execution_id, "
        f"cast(c_custkey AS varchar) AS record_key, {CUSTOMER_JSON} AS payload FROM customer",
    ),
    "sync_full_by_hash": (
        sync_full_by_hash,
        f"SELECT DISTINCT 'pages' AS dataset_id, 'full-1' AS execution_id, "
        f"{sql.hash_key(sql.json(sql.PAGES))} AS record_key, {sql.json(sql.PAGES)} AS payload "
        "FROM pages",
    ),
    "sync_incremental_end_to_end": (
        sync_incremental,
        f"SELECT 'events' AS dataset_id, 'inc-1' AS execution_id, "
        f"cast(event_id AS varchar) AS record_key, {sql.json(sql.EVENTS)} AS payload FROM events",
    ),
    "incremental_resume": (
        sync_incremental_resumed,
        f"""
        SELECT 'events' AS dataset_id,
               CASE WHEN ts < timestamp '2024-01-20 00:00:00' THEN 'inc-1' ELSE 'inc-2' END
                   AS execution_id,
               cast(event_id AS varchar) AS record_key, {sql.json(sql.EVENTS)} AS payload
        FROM events
        """,
    ),
    "sync_last_write_wins": (sync_last_write_wins, _LINES_SQL),
    "sync_repeated": (
        sync_repeated,
        f"SELECT 'orders' AS dataset_id, 'inc-2' AS execution_id, "
        f"cast(o_orderkey AS varchar) AS record_key, {ORDERS_JSON} AS payload FROM orders",
    ),
    "sync_compacted": (
        sync_compacted,
        f"""
        SELECT 'customer' AS dataset_id,
               CASE WHEN c_acctbal >= 0 THEN 'full-2' ELSE 'full-1' END AS execution_id,
               cast(c_custkey AS varchar) AS record_key,
               {sql.json({**sql.CUSTOMER, "c_mktsegment":
                   "CASE WHEN c_acctbal >= 0 THEN lower(c_mktsegment) ELSE c_mktsegment END"})}
                   AS payload
        FROM customer
        """,
    ),
    "sync_bucketed_merge": (
        sync_bucketed_merge,
        f"""
        SELECT 'orders' AS dataset_id,
               CASE WHEN o_orderkey % 6 = 0 THEN 'full-3' WHEN o_orderkey % 9 = 0 THEN 'full-2'
                    ELSE 'full-1' END AS execution_id,
               cast(o_orderkey AS varchar) AS record_key,
               {sql.json({**sql.ORDERS, "o_orderstatus":
                   "CASE WHEN o_orderkey % 6 = 0 THEN 'X' ELSE o_orderstatus END",
                   "o_orderpriority": "CASE WHEN o_orderkey % 6 <> 0 AND o_orderkey % 9 = 0 "
                   "THEN lower(o_orderpriority) ELSE o_orderpriority END"})} AS payload
        FROM orders
        """,
    ),
    "incremental_lookback_resume": (
        incremental_lookback_resume,
        f"""
        SELECT 'events' AS dataset_id, {sql.utc("max(ts)")} AS last_value,
               count(*) FILTER (date_trunc('day', ts) < (SELECT max(date_trunc('day', ts)) FROM events)
                   AND ts > (SELECT max(ts) FROM events) - INTERVAL 10 DAY) AS total_records
        FROM events
        """,
    ),
    "changes_between_runs": (
        changes_between_runs,
        """
        SELECT 'customer' AS dataset_id, cast(c_custkey AS varchar) AS record_key,
               CASE WHEN c_custkey % 7 = 0 THEN 'inserted' WHEN c_custkey % 11 = 0 THEN 'vanished'
                    WHEN c_custkey % 5 = 1 AND c_mktsegment <> lower(c_mktsegment) THEN 'changed'
                    ELSE 'unchanged' END AS change
        FROM customer WHERE c_custkey % 7 <> 0 OR c_custkey % 11 <> 0
        """,
    ),
    "records_by_key": (
        records_by_key,
        f"""
        SELECT 'customer' AS dataset_id,
               CASE WHEN c_acctbal < 0 THEN 'full-2' ELSE 'full-1' END AS execution_id,
               cast(c_custkey AS varchar) AS record_key,
               {sql.json({**sql.CUSTOMER, "c_mktsegment":
                   "CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) ELSE c_mktsegment END"})}
                   AS payload
        FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
        """,
    ),
    "execution_persisted": (
        execution_persisted,
        """
        SELECT execution_id, records AS total_records, records AS total_persisted
        FROM (SELECT 'full-1' AS execution_id, count(*) AS records FROM customer UNION ALL
              SELECT 'inc-1', count(*) FROM events UNION ALL SELECT 'inc-2', 0)
        """,
    ),
    "sync_requests": (sync_requests, REQUESTED_SQL),
    "sync_requests_after_reset": (
        sync_requests_after_reset,
        """
        SELECT prefix || execution_id AS execution_id, dataset_id, 'completed' AS status,
               total_records, cast((total_records + 999) // 1000 AS bigint) AS total_batches
        FROM (SELECT 'run-0' AS execution_id, 'orders' AS dataset_id, count(*) AS total_records
              FROM orders UNION ALL
              SELECT 'run-1', 'customer', count(*) FROM customer),
             (VALUES (''), ('again-')) AS runs(prefix)
        """,
    ),
}
