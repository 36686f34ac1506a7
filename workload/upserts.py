"""Upserts of both layers, the ledger views and what a full run leaves behind."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.ledger import (
    final_status,
    latest_executions,
    records_per_execution,
    untouched_since_full,
)
from tidemark.operators.upsert import latest, upsert, upsert_newer
from workload.inputs import EXECUTIONS, as_sql, derive, table

LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_linenumber", "l_partkey", "l_suppkey"]
IDENTITY = ["tenant_id", "source_id", "dataset_id"]

# Two runs of one dataset per nation: the second sees only customers without debts and doubles
# their balance.
FIRST_RUN = """
SELECT 't' AS tenant_id, 's' AS source_id, concat('customer', cast(c_nationkey AS string)) AS dataset_id,
       cast(c_custkey AS string) AS record_key, 'run1' AS execution_id,
       c_acctbal AS balance, cast('2024-01-01 00:00:00' AS timestamp) AS started_at
FROM {customer}
"""
SECOND_RUN = """
SELECT 't' AS tenant_id, 's' AS source_id, concat('customer', cast(c_nationkey AS string)) AS dataset_id,
       cast(c_custkey AS string) AS record_key, 'run2' AS execution_id,
       c_acctbal * 2 AS balance, cast('2024-01-02 00:00:00' AS timestamp) AS started_at
FROM {customer} WHERE c_acctbal >= 0
"""
FULL_RUNS = """
SELECT 't' AS tenant_id, 's' AS source_id, concat('customer', cast(c_nationkey AS string)) AS dataset_id,
       max(CASE WHEN c_acctbal >= 0 THEN 'run2' ELSE 'run1' END) AS execution_id,
       cast('2024-01-02 00:00:00' AS timestamp) AS started_at
FROM {customer} GROUP BY c_nationkey
"""


def upsert_last_write_wins(spark, sf):
    columns = ["l_orderkey", *LINE_ORDER]
    return latest(table(spark, sf, "lineitem").select(*columns), ["l_orderkey"], LINE_ORDER)


def upsert_keep_first(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_custkey",
        "o_orderdate",
        "o_orderkey",
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderpriority").alias("priority"),
    )
    return latest(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["created_at"])


def upsert_idempotent(spark, sf):
    rows = table(spark, sf, "orders")
    again = rows.select("*")
    return upsert(rows, again, ["o_orderkey"], ["o_orderdate"])


def upsert_hot_key(spark, sf):
    """A third of all rows carry one key."""
    rows = table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", F.lit(-1).cast("bigint"))
        .otherwise(F.col("l_orderkey"))
        .alias("key"),
        *LINE_ORDER,
    )
    return latest(rows, ["key"], LINE_ORDER)


def _runs(spark, sf):
    return derive(spark, sf, FIRST_RUN), derive(spark, sf, SECOND_RUN)


def upsert_second_run(spark, sf):
    first, second = _runs(spark, sf)
    return upsert(first, second, [*IDENTITY, "record_key"], ["started_at"]).drop("started_at")


def upsert_onto_snapshot(spark, sf):
    first, second = _runs(spark, sf)
    return upsert_newer(first, second, [*IDENTITY, "record_key"], ["started_at"]).drop(
        "started_at"
    )


def stale_after_full(spark, sf):
    first, second = _runs(spark, sf)
    current = upsert(first, second, [*IDENTITY, "record_key"], ["started_at"])
    full = derive(spark, sf, FULL_RUNS)
    return untouched_since_full(current, full).select("record_key", "execution_id", "balance")


def records_of_executions(spark, sf):
    log = table(spark, sf, "lineitem").select(
        F.lit("t").alias("tenant_id"),
        F.lit("s").alias("source_id"),
        F.concat(F.lit("d"), F.col("l_suppkey")).alias("dataset_id"),
        F.concat(F.lit("e"), F.col("l_orderkey")).alias("execution_id"),
    )
    return records_per_execution(log)


def execution_ledger(spark, sf):
    """First ledger rows of every execution, then their final rows."""
    rows = derive(spark, sf, EXECUTIONS).select(
        "execution_id", *IDENTITY, "started_at", "total_records", "error_message"
    )
    opened = rows.select(
        "execution_id", *IDENTITY, "started_at",
        F.lit(0).cast("bigint").alias("total_records"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit("pending").alias("status"),
        F.lit(1).alias("change"),
    )
    closed = rows.withColumn("status", final_status(F.col("error_message"))).withColumn(
        "started_at", F.col("started_at") + F.expr("INTERVAL 1 DAY")
    ).withColumn("change", F.lit(2))
    return upsert(
        opened, closed, ["execution_id"], ["change"], [*IDENTITY, "started_at"]
    ).drop("change")


def latest_execution(spark, sf):
    return latest_executions(
        derive(spark, sf, EXECUTIONS).select(
            *IDENTITY, "execution_id", "status", "total_records", "started_at"
        )
    )


_LINE_STRUCT = "struct_pack(" + ", ".join(f"{c} := {c}" for c in LINE_ORDER) + ")"
_PICK = ", ".join(f"r.{c} AS {c}" for c in LINE_ORDER)
_CURRENT = f"""
    SELECT * FROM {as_sql(SECOND_RUN)} b UNION ALL
    SELECT * FROM {as_sql(FIRST_RUN)} a WHERE NOT EXISTS (
        SELECT 1 FROM {as_sql(SECOND_RUN)} b
        WHERE b.dataset_id = a.dataset_id AND b.record_key = a.record_key)
"""
_CURRENT_COLUMNS = "tenant_id, source_id, dataset_id, record_key, execution_id, balance"

QUERIES = {
    "upsert_last_write_wins": (
        upsert_last_write_wins,
        f"SELECT l_orderkey, {_PICK} FROM (SELECT l_orderkey, max({_LINE_STRUCT}) AS r "
        "FROM lineitem GROUP BY l_orderkey)",
    ),
    "upsert_keep_first": (
        upsert_keep_first,
        """
        SELECT o_custkey, r.o_orderdate AS o_orderdate, r.o_orderkey AS o_orderkey,
               created_at, r.priority AS priority
        FROM (SELECT o_custkey, min(o_orderdate) AS created_at,
                     max(struct_pack(o_orderdate := o_orderdate, o_orderkey := o_orderkey,
                                     priority := o_orderpriority)) AS r
              FROM orders GROUP BY o_custkey)
        """,
    ),
    "upsert_idempotent": (upsert_idempotent, "SELECT * FROM orders"),
    "upsert_hot_key": (
        upsert_hot_key,
        f"""
        SELECT key, {_PICK} FROM (
            SELECT CASE WHEN l_returnflag = 'A' THEN -1 ELSE l_orderkey END AS key,
                   max({_LINE_STRUCT}) AS r FROM lineitem GROUP BY 1)
        """,
    ),
    "upsert_second_run": (
        upsert_second_run, f"SELECT {_CURRENT_COLUMNS} FROM ({_CURRENT})",
    ),
    "upsert_onto_snapshot": (
        upsert_onto_snapshot, f"SELECT {_CURRENT_COLUMNS} FROM ({_CURRENT})",
    ),
    "stale_after_full": (
        stale_after_full,
        "SELECT cast(c_custkey AS varchar) AS record_key, 'run1' AS execution_id, "
        "c_acctbal AS balance FROM customer c WHERE c_acctbal < 0 AND EXISTS "
        "(SELECT 1 FROM customer d WHERE d.c_acctbal >= 0 AND d.c_nationkey = c.c_nationkey)",
    ),
    "records_of_executions": (
        records_of_executions,
        "SELECT 't' AS tenant_id, 's' AS source_id, 'd' || l_suppkey AS dataset_id, "
        "'e' || l_orderkey AS execution_id, count(*) AS total_records FROM lineitem "
        "GROUP BY l_suppkey, l_orderkey",
    ),
    "execution_ledger": (
        execution_ledger,
        f"SELECT execution_id, tenant_id, source_id, dataset_id, started_at, total_records, "
        f"error_message, status FROM {as_sql(EXECUTIONS)} e",
    ),
    "latest_execution": (
        latest_execution,
        f"""
        SELECT tenant_id, source_id, dataset_id, execution_id, status, total_records, started_at
        FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, source_id, dataset_id
                  ORDER BY started_at DESC, execution_id DESC) AS rn
              FROM {as_sql(EXECUTIONS)} e) WHERE rn = 1
        """,
    ),
}
