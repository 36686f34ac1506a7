"""Resolution and validation of requests, and registry upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import requests
from tidemark.operators.upsert import upsert
from workload.inputs import (
    CHECKPOINTS,
    DATASET_REQUESTS,
    DATASETS,
    REQUESTS,
    SOURCE_REQUESTS,
    SOURCES,
    as_sql,
    derive,
)

RESOLVED = [
    "execution_id", "tenant_id", "source_id", "dataset_id", "source_connector", "host",
    "source_schema", "table_name", "sync_mode", "batch_size", "last_value", "outcome", "error",
]


def resolve_requests(spark, sf):
    return requests.resolve(
        derive(spark, sf, REQUESTS),
        derive(spark, sf, SOURCES),
        derive(spark, sf, DATASETS),
        derive(spark, sf, CHECKPOINTS),
    ).select(*RESOLVED)


def lookup_sources(spark, sf):
    found = requests.with_source(derive(spark, sf, REQUESTS), derive(spark, sf, SOURCES))
    return found.select("execution_id", "source_found", "source_connector", "host", "port")


def skipped_requests(spark, sf):
    return resolve_requests(spark, sf).where(F.col("outcome") == "skipped").select(
        "execution_id", "dataset_id"
    )


def _validated(kind, key):
    def query(spark, sf):
        rows = derive(spark, sf, SOURCE_REQUESTS)
        if kind == "reset":
            rows = rows.withColumn("dataset_id", F.col("host"))
        return requests.check_required(rows, kind).select(
            "l_orderkey", "l_linenumber", "l_extendedprice", "error"
        )

    return query


def validate_datasets(spark, sf):
    checked = requests.check_required(derive(spark, sf, DATASET_REQUESTS), "dataset")
    return checked.select("dataset_id", "error")


def register_datasets(spark, sf):
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    valid, _ = requests.split_by_error(
        requests.check_required(derive(spark, sf, DATASET_REQUESTS), "dataset")
    )
    return requests.dataset_rows(valid, at).drop("created_at", "updated_at")


def register_sources(spark, sf):
    """Every order line registers its supplier again; the last one stays, the first is dated."""
    valid, _ = requests.split_by_error(
        requests.check_required(derive(spark, sf, SOURCE_REQUESTS), "source")
    )
    order = ["l_extendedprice", "l_orderkey"]
    rows = requests.source_rows(valid, F.col("l_extendedprice"))
    keyed = rows.withColumnRenamed("updated_at", "changed").withColumn(
        "tie", F.col("password_ref")
    )
    early = keyed.where(F.col("changed") < 500)
    late = keyed.where(F.col("changed") >= 500)
    return upsert(
        early, late, ["tenant_id", "source_id"], ["changed", "tie"], ["created_at"]
    ).select("tenant_id", "source_id", "ssl_mode", "password_ref", "created_at", "changed")


def orphan_datasets(spark, sf):
    valid, _ = requests.split_by_error(
        requests.check_required(derive(spark, sf, DATASET_REQUESTS), "dataset")
    )
    return requests.orphans(valid, derive(spark, sf, SOURCES)).select(
        "tenant_id", "source_id", "dataset_id"
    )


def read_back_optional(spark, sf):
    from tidemark.functions.defaults import batch_size_or_default, null_to_empty

    return derive(spark, sf, DATASETS).select(
        "dataset_id",
        null_to_empty(F.col("schema_name")).alias("schema_name"),
        null_to_empty(F.col("technical_key")).alias("technical_key"),
        null_to_empty(F.col("incremental_column")).alias("incremental_column"),
        batch_size_or_default(F.col("batch_size")).alias("batch_size"),
    )


_RESOLVED_SQL = f"""
SELECT r.execution_id, r.tenant_id, r.source_id, r.dataset_id,
       s.connector_type AS source_connector, s.host, s.schema_name AS source_schema,
       d.table_name, d.sync_mode,
       CASE WHEN d.dataset_id IS NULL THEN NULL WHEN d.batch_size > 0 THEN d.batch_size
            ELSE 1000 END AS batch_size,
       c.last_value,
       CASE WHEN s.source_id IS NULL OR d.dataset_id IS NULL THEN 'rejected'
            WHEN NOT d.enabled THEN 'skipped'
            WHEN s.connector_type = 'oracle' OR d.sync_mode = 'mirror'
                 OR d.sync_mode = 'incremental'
                    AND (d.incremental_column IS NULL OR d.incremental_type = 'serial')
            THEN 'failed' ELSE 'run' END AS outcome,
       CASE WHEN s.source_id IS NULL
            THEN 'source not registered: ' || r.tenant_id || '/' || r.source_id
            WHEN d.dataset_id IS NULL
            THEN 'dataset not registered: ' || r.tenant_id || '/' || r.source_id || '/'
                 || r.dataset_id
            WHEN NOT d.enabled THEN NULL
            WHEN s.connector_type = 'oracle' THEN 'create connector: unsupported connector type: oracle'
            WHEN d.sync_mode = 'mirror' THEN 'unsupported sync mode: mirror'
            WHEN d.sync_mode = 'incremental' AND d.incremental_column IS NULL
            THEN 'incremental_column not configured for dataset ' || r.dataset_id
            WHEN d.sync_mode = 'incremental' AND d.incremental_type = 'serial'
            THEN 'unsupported incremental type: serial' END AS error
FROM {as_sql(REQUESTS)} r
LEFT JOIN {as_sql(SOURCES)} s ON s.tenant_id = r.tenant_id AND s.source_id = r.source_id
LEFT JOIN {as_sql(DATASETS)} d ON d.tenant_id = r.tenant_id AND d.source_id = r.source_id
     AND d.dataset_id = r.dataset_id
LEFT JOIN {as_sql(CHECKPOINTS)} c ON c.tenant_id = r.tenant_id AND c.source_id = r.source_id
     AND c.dataset_id = r.dataset_id
"""

_CONNECTION_FIELDS = (
    "host, port, database, username and password_ref are required"
)


def _line_check(condition: str, message: str) -> str:
    return (
        f"SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN {condition} "
        f"THEN '{message}' END AS error FROM lineitem"
    )


_VALID_DATASET = (
    "tenant_id <> '' AND source_id IS NOT NULL AND table_name IS NOT NULL AND sync_mode <> ''"
)

QUERIES = {
    "resolve_requests": (resolve_requests, _RESOLVED_SQL),
    "lookup_sources": (
        lookup_sources,
        f"""
        SELECT r.execution_id, s.source_id IS NOT NULL AS source_found,
               s.connector_type AS source_connector, s.host, s.port
        FROM {as_sql(REQUESTS)} r
        LEFT JOIN {as_sql(SOURCES)} s
          ON s.tenant_id = r.tenant_id AND s.source_id = r.source_id
        """,
    ),
    "skipped_requests": (
        skipped_requests,
        f"SELECT execution_id, dataset_id FROM ({_RESOLVED_SQL}) WHERE outcome = 'skipped'",
    ),
    "validate_connection_requests": (
        _validated("connection", "request_id"),
        _line_check(
            "l_linenumber IN (1, 2, 3)",
            f"tenant_id, request_id, connector_type, {_CONNECTION_FIELDS}",
        ),
    ),
    "validate_discovery_requests": (
        _validated("discovery", "request_id"),
        _line_check(
            "l_linenumber IN (1, 2, 3)",
            f"tenant_id, request_id, connector_type, {_CONNECTION_FIELDS}",
        ),
    ),
    "validate_source_requests": (
        _validated("source", "source_id"),
        _line_check(
            "l_linenumber IN (1, 2, 3)",
            f"tenant_id, source_id, connector_type, {_CONNECTION_FIELDS}",
        ),
    ),
    "validate_reset_requests": (
        _validated("reset", "dataset_id"),
        _line_check(
            "l_linenumber IN (1, 2)", "tenant_id, source_id and dataset_id are required"
        ),
    ),
    "validate_dataset_requests": (
        validate_datasets,
        """
        SELECT 'd' || p_partkey AS dataset_id,
               CASE WHEN p_size = 2 THEN 'source_id is required in path'
                    WHEN p_size IN (1, 3, 4)
                    THEN 'tenant_id, dataset_id, table_name and sync_mode are required'
               END AS error
        FROM part
        """,
    ),
    "register_datasets": (
        register_datasets,
        f"""
        SELECT tenant_id, source_id, dataset_id, nullif(schema_name, '') AS schema_name,
               table_name, coalesce(nullif(object_type, ''), 'table') AS object_type, sync_mode,
               nullif(incremental_column, '') AS incremental_column,
               nullif(incremental_type, '') AS incremental_type,
               nullif(technical_key, '') AS technical_key,
               CASE WHEN coalesce(batch_size, 0) = 0 THEN 1000 ELSE batch_size END AS batch_size,
               coalesce(enabled, true) AS enabled
        FROM {as_sql(DATASET_REQUESTS)} q WHERE {_VALID_DATASET}
        """,
    ),
    "register_sources": (
        register_sources,
        f"""
        SELECT tenant_id, source_id, r.ssl_mode AS ssl_mode, r.password_ref AS password_ref,
               created_at, r.changed AS changed
        FROM (SELECT tenant_id, source_id, min(l_extendedprice) AS created_at,
                     max(struct_pack(changed := l_extendedprice, tie := password_ref,
                         connector_type := connector_type, host := host, port := port,
                         database_name := database, schema_name := nullif(schema, ''),
                         username := username, password_ref := password_ref,
                         ssl_mode := coalesce(ssl_mode, 'disable'))) AS r
              FROM {as_sql(SOURCE_REQUESTS)} q
              WHERE tenant_id IS NOT NULL AND host <> '' AND port <> 0
              GROUP BY tenant_id, source_id)
        """,
    ),
    "orphan_datasets": (
        orphan_datasets,
        f"""
        SELECT tenant_id, source_id, dataset_id FROM {as_sql(DATASET_REQUESTS)} q
        WHERE {_VALID_DATASET} AND NOT EXISTS (
            SELECT 1 FROM {as_sql(SOURCES)} s
            WHERE s.tenant_id = q.tenant_id AND s.source_id = q.source_id)
        """,
    ),
    "read_back_optional": (
        read_back_optional,
        f"""
        SELECT dataset_id, coalesce(schema_name, '') AS schema_name,
               coalesce(technical_key, '') AS technical_key,
               coalesce(incremental_column, '') AS incremental_column,
               CASE WHEN batch_size > 0 THEN batch_size ELSE 1000 END AS batch_size
        FROM {as_sql(DATASETS)} d
        """,
    ),
}
