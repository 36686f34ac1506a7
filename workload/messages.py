"""Lifecycle and result messages."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidemark.operators import access, messages
from tidemark.operators.batches import batches_of
from workload import inputs, sql
from workload.inputs import as_sql, derive, table

AT = datetime.datetime(2024, 6, 1, 12, 0, tzinfo=datetime.timezone.utc)
AT_TEXT = "'2024-06-01T12:00:00Z'"


def _executions(spark, sf):
    return derive(spark, sf, inputs.EXECUTIONS)


def started(spark, sf):
    return messages.sync_started(_executions(spark, sf), F.lit(AT))


def completed(spark, sf):
    return messages.sync_completed(_executions(spark, sf), F.lit(AT))


def failed(spark, sf):
    return messages.sync_failed(_executions(spark, sf), F.lit(AT))


def batches(spark, sf):
    done = _executions(spark, sf).where(F.col("status") == "completed")
    return messages.batch_processed(batches_of(done), F.lit(AT))


def lifecycle(spark, sf):
    return messages.lifecycle(_executions(spark, sf), F.lit(AT), F.lit(AT))


def test_results(spark, sf):
    requests = derive(spark, sf, inputs.SOURCES).select(
        "tenant_id", "source_id", "schema_name", F.col("host").alias("request_id")
    )
    checked = access.check_schemas(requests, derive(spark, sf, inputs.VISIBLE_SCHEMAS))
    return messages.test_results(checked.withColumn("response_time_ms", F.lit(12)), F.lit(AT))


def discovery_results(spark, sf):
    """Every nation's customers as one source's tables; sources without customers failed."""
    found = (
        table(spark, sf, "customer")
        .groupBy("c_nationkey", "c_mktsegment")
        .agg(
            F.countDistinct(F.col("c_custkey") % 7).cast("int").alias("schema_count"),
            F.count(F.lit(1)).cast("int").alias("table_count"),
            F.max("c_acctbal").alias("top"),
        )
        .select(
            F.concat_ws("-", F.col("c_nationkey").cast("string"), "c_mktsegment").alias(
                "request_id"
            ),
            F.lit("t").alias("tenant_id"),
            F.concat(F.lit("s"), F.col("c_nationkey")).alias("source_id"),
            (F.col("top") >= 5000).alias("success"),
            F.when(F.col("top") >= 5000, F.col("schema_count")).alias("schema_count"),
            F.when(F.col("top") >= 5000, F.col("table_count")).alias("table_count"),
            F.when(F.col("top") < 5000, F.lit("connect: refused")).otherwise("").alias("error"),
        )
    )
    return messages.discovery_results(found, F.lit(AT))


_ID = {"execution_id": "execution_id", "timestamp": AT_TEXT}
_STARTED = f"""
SELECT 'data.connect.sync.started' AS topic, execution_id AS key, {sql.body(_ID)} AS value
FROM {as_sql(inputs.EXECUTIONS)} e
"""
_COMPLETED = f"""
SELECT 'data.connect.sync.completed' AS topic, execution_id AS key, {sql.body(_ID)} AS value
FROM {as_sql(inputs.EXECUTIONS)} e WHERE status = 'completed'
"""
_FAILED = f"""
SELECT 'data.connect.sync.failed' AS topic, execution_id AS key,
       {sql.body({**_ID, "error_message": "error_message"})} AS value
FROM {as_sql(inputs.EXECUTIONS)} e WHERE status = 'failed'
"""
_BATCH_BODY = sql.body(
    {
        "event_type": "'data.connect.batch.processed'",
        "tenant_id": "tenant_id",
        "source_id": "source_id",
        "dataset_id": "dataset_id",
        "execution_id": "execution_id",
        "connector_type": "connector_type",
        "trigger_type": "trigger_type",
        "correlation_id": "correlation_id",
        "timestamp": AT_TEXT,
        "extra": "struct_pack(batch_number := batch_number, records_in_batch := "
        "least(size, total_records - (batch_number - 1) * size))",
    }
)
_BATCHES = f"""
SELECT 'data.connect.batch.processed' AS topic, execution_id AS key, {_BATCH_BODY} AS value
FROM (SELECT *, unnest(range(1, cast((total_records + size - 1) // size AS bigint) + 1))
             AS batch_number
      FROM (SELECT *, cast(CASE WHEN batch_size > 0 THEN batch_size ELSE 1000 END AS bigint)
                      AS size
            FROM {as_sql(inputs.EXECUTIONS)} e WHERE total_records > 0 AND status = 'completed'))
"""
_CHECKED = f"""
SELECT *, schema_name IS NULL OR EXISTS (
    SELECT 1 FROM {as_sql(inputs.VISIBLE_SCHEMAS)} v
    WHERE v.tenant_id = s.tenant_id AND v.source_id = s.source_id
      AND v.schema_name = s.schema_name) AS success
FROM {as_sql(inputs.SOURCES)} s
"""
_TEST_FIELDS = {
    "request_id": "host", "tenant_id": "tenant_id", "source_id": "source_id",
    "success": "success",
    "message": "CASE WHEN success THEN 'connection validated: host reachable, authentication "
    "ok, database and schema accessible' ELSE 'connection ok but schema \"' || schema_name || "
    "'\" is not accessible' END",
    "response_time_ms": "12",
}
_TEST_ERROR = {
    **_TEST_FIELDS,
    "error": "'schema \"' || schema_name || '\" does not exist or is not accessible to the "
    "configured user'",
    "timestamp": AT_TEXT,
}
_DISCOVERY_FIELDS = {
    "request_id": "c_nationkey || '-' || c_mktsegment", "tenant_id": "'t'",
    "source_id": "'s' || c_nationkey", "success": "top >= 5000",
    "schema_count": "CASE WHEN top >= 5000 THEN schema_count ELSE 0 END",
    "table_count": "CASE WHEN top >= 5000 THEN table_count ELSE 0 END",
}

QUERIES = {
    "messages_started": (started, _STARTED),
    "messages_completed": (completed, _COMPLETED),
    "messages_failed": (failed, _FAILED),
    "messages_batches": (batches, _BATCHES),
    "messages_lifecycle": (
        lifecycle, f"{_STARTED} UNION ALL {_BATCHES} UNION ALL {_COMPLETED} UNION ALL {_FAILED}",
    ),
    "messages_test_results": (
        test_results,
        f"""
        SELECT 'data.connect.test.result' AS topic, host AS key,
               CASE WHEN success THEN {sql.body({**_TEST_FIELDS, "timestamp": AT_TEXT})}
                    ELSE {sql.body(_TEST_ERROR)} END AS value
        FROM ({_CHECKED})
        """,
    ),
    "messages_discovery_results": (
        discovery_results,
        f"""
        SELECT 'data.connect.discovery.result' AS topic, c_nationkey || '-' || c_mktsegment AS key,
               CASE WHEN top >= 5000
                    THEN {sql.body({**_DISCOVERY_FIELDS, "timestamp": AT_TEXT})}
                    ELSE {sql.body({**_DISCOVERY_FIELDS, "error": "'connect: refused'",
                                    "timestamp": AT_TEXT})} END AS value
        FROM (SELECT c_nationkey, c_mktsegment, count(DISTINCT c_custkey % 7) AS schema_count,
                     count(*) AS table_count, max(c_acctbal) AS top
              FROM customer GROUP BY c_nationkey, c_mktsegment)
        """,
    ),
}
