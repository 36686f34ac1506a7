"""Input tables of the queries: the given tables, and control data derived from them.

The derivations are written once in SQL that both Spark and the checking engine understand;
``{orders}`` and the like stand for the given tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A derived table in Spark."""
    used = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in used})


def as_sql(sql: str) -> str:
    """The same derived table as a parenthesised subquery for the checking engine."""
    return "(" + sql.format(**{name: name for name in TABLES}) + ")"


# --- registry -------------------------------------------------------------------------
# Suppliers act as sources, customers as datasets, orders as requests and as executions.

SOURCES = """
SELECT concat('t', cast(s_suppkey % 5 AS string)) AS tenant_id,
       concat(CASE WHEN s_acctbal >= 0 THEN 's' ELSE 'spare' END, cast(s_suppkey AS string))
           AS source_id,
       CASE s_nationkey % 4 WHEN 0 THEN 'oracle' WHEN 1 THEN 'mysql'
            WHEN 2 THEN 'sqlserver' ELSE 'postgres' END AS connector_type,
       lower(s_name) AS host,
       cast(5432 + s_nationkey AS int) AS port,
       'sales' AS database_name,
       CASE WHEN s_acctbal < 2000 THEN NULL
            ELSE concat('schema', cast(s_nationkey AS string)) END AS schema_name,
       'reader' AS username,
       concat('ref', cast(s_suppkey AS string)) AS password_ref,
       'disable' AS ssl_mode
FROM {supplier}
"""

DATASETS = """
SELECT concat('t', cast(c_custkey % 120 % 5 AS string)) AS tenant_id,
       concat('s', cast(c_custkey % 120 AS string)) AS source_id,
       concat(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'spare' ELSE 'd' END,
              cast(c_custkey AS string)) AS dataset_id,
       CASE WHEN c_nationkey < 5 THEN NULL
            ELSE concat('schema', cast(c_nationkey AS string)) END AS schema_name,
       lower(c_name) AS table_name,
       'table' AS object_type,
       CASE c_custkey % 7 WHEN 0 THEN 'mirror' WHEN 1 THEN 'full' WHEN 2 THEN 'full'
            ELSE 'incremental' END AS sync_mode,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'updated_at' END AS incremental_column,
       CASE c_custkey % 3 WHEN 0 THEN 'date' WHEN 1 THEN 'key'
            ELSE 'serial' END AS incremental_type,
       CASE WHEN c_custkey % 2 = 0 THEN 'id' ELSE NULL END AS technical_key,
       cast(c_nationkey * 100 AS int) AS batch_size,
       c_acctbal >= 500 AS enabled
FROM {customer}
"""

REQUESTS = """
SELECT concat('t', cast(o_custkey % 120 % 5 AS string)) AS tenant_id,
       concat('s', cast(o_custkey % 120 AS string)) AS source_id,
       concat('d', cast(o_custkey AS string)) AS dataset_id,
       concat('e', cast(o_orderkey AS string)) AS execution_id,
       'postgres' AS connector_type,
       CASE o_orderstatus WHEN 'F' THEN 'manual' WHEN 'O' THEN 'scheduled'
            ELSE 'event' END AS trigger_type,
       concat('c', cast(o_orderkey AS string)) AS correlation_id,
       o_orderdate AS requested_at
FROM {orders}
"""

CHECKPOINTS = """
SELECT concat('t', cast(o_custkey % 120 % 5 AS string)) AS tenant_id,
       concat('s', cast(o_custkey % 120 AS string)) AS source_id,
       concat('d', cast(o_custkey AS string)) AS dataset_id,
       cast(max(o_orderkey) AS string) AS last_value
FROM {orders} WHERE o_orderstatus = 'F' GROUP BY o_custkey
"""

NEW_MARKS = """
SELECT concat('t', cast(o_custkey % 120 % 5 AS string)) AS tenant_id,
       concat('s', cast(o_custkey % 120 AS string)) AS source_id,
       concat('d', cast(o_custkey AS string)) AS dataset_id,
       nullif(cast(max(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END)
                   AS string), '0') AS last_value
FROM {orders} GROUP BY o_custkey
"""

EXECUTIONS = """
SELECT concat('t', cast(o_custkey % 120 % 5 AS string)) AS tenant_id,
       concat('s', cast(o_custkey % 120 AS string)) AS source_id,
       concat('d', cast(o_custkey AS string)) AS dataset_id,
       concat('e', cast(o_orderkey AS string)) AS execution_id,
       'postgres' AS connector_type,
       'scheduled' AS trigger_type,
       concat('c', cast(o_orderkey AS string)) AS correlation_id,
       CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'completed' END AS status,
       CASE WHEN o_orderstatus = 'F' THEN concat('connect to "', o_orderpriority, '"')
            ELSE NULL END AS error_message,
       CASE WHEN o_orderstatus = 'F' THEN cast(0 AS bigint)
            ELSE o_custkey % 5000 END AS total_records,
       cast(o_orderkey % 4 * 250 AS int) AS batch_size,
       o_orderdate AS started_at
FROM {orders}
"""

# --- requests with gaps, for validation -----------------------------------------------

SOURCE_REQUESTS = """
SELECT CASE WHEN l_linenumber = 1 THEN NULL
            ELSE concat('t', cast(l_suppkey % 5 AS string)) END AS tenant_id,
       concat('s', cast(l_suppkey AS string)) AS source_id,
       CASE l_returnflag WHEN 'A' THEN 'postgres' WHEN 'N' THEN 'mysql'
            ELSE 'sqlserver' END AS connector_type,
       CASE WHEN l_linenumber = 2 THEN '' ELSE 'db.internal' END AS host,
       cast(CASE WHEN l_linenumber = 3 THEN 0 ELSE 5432 END AS int) AS port,
       'sales' AS database,
       CASE WHEN l_linestatus = 'F' THEN '' ELSE 'public' END AS schema,
       'reader' AS username,
       concat('ref', cast(l_partkey AS string)) AS password_ref,
       CASE WHEN l_linestatus = 'F' THEN NULL ELSE 'require' END AS ssl_mode,
       concat('r', cast(l_orderkey AS string)) AS request_id,
       l_orderkey, l_linenumber, l_extendedprice
FROM {lineitem}
"""

DATASET_REQUESTS = """
SELECT CASE WHEN p_size = 1 THEN '' ELSE concat('t', cast(p_partkey % 150 % 5 AS string))
       END AS tenant_id,
       CASE WHEN p_size = 2 THEN NULL ELSE concat('s', cast(p_partkey % 150 AS string))
       END AS source_id,
       concat('d', cast(p_partkey AS string)) AS dataset_id,
       CASE WHEN p_size = 3 THEN NULL ELSE p_name END AS table_name,
       CASE WHEN p_size = 4 THEN '' ELSE 'full' END AS sync_mode,
       CASE WHEN p_size % 2 = 0 THEN '' ELSE 'public' END AS schema_name,
       CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN NULL
            ELSE 'view' END AS object_type,
       CASE WHEN p_size % 5 = 0 THEN '' ELSE 'updated_at' END AS incremental_column,
       CASE WHEN p_size % 5 = 0 THEN '' ELSE 'date' END AS incremental_type,
       CASE WHEN p_size % 7 = 0 THEN '' ELSE 'id' END AS technical_key,
       cast(CASE WHEN p_size % 4 = 0 THEN 0 WHEN p_size % 4 = 1 THEN NULL
                 ELSE p_size END AS int) AS batch_size,
       CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN false
            ELSE true END AS enabled
FROM {part}
"""

# --- catalogs -------------------------------------------------------------------------
# Customers act as tables, orders as their columns, order lines as key columns.

PG_SCHEMATA = """
SELECT DISTINCT CASE o_custkey % 25 WHEN 0 THEN 'pg_catalog' WHEN 1 THEN 'information_schema'
       WHEN 2 THEN 'pg_toast' ELSE concat('schema', cast(o_custkey % 25 AS string))
       END AS schema_name
FROM {orders}
"""

PG_TABLES = """
SELECT CASE c_custkey % 25 WHEN 0 THEN 'pg_catalog' WHEN 1 THEN 'information_schema'
       WHEN 2 THEN 'pg_toast' ELSE concat('schema', cast(c_custkey % 25 AS string))
       END AS table_schema,
       c_name AS table_name,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'VIEW' WHEN 'FURNITURE' THEN 'FOREIGN'
            ELSE 'BASE TABLE' END AS table_type
FROM {customer}
"""

PG_COLUMNS = """
SELECT CASE o_custkey % 25 WHEN 0 THEN 'pg_catalog' WHEN 1 THEN 'information_schema'
       WHEN 2 THEN 'pg_toast' ELSE concat('schema', cast(o_custkey % 25 AS string))
       END AS table_schema,
       c_name AS table_name,
       concat('c', cast(o_orderkey AS string)) AS column_name,
       lower(o_orderpriority) AS data_type,
       CASE WHEN o_orderstatus = 'F' THEN 'NO' ELSE 'YES' END AS is_nullable,
       cast(o_orderkey AS int) AS ordinal_position
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

PG_KEY_COLUMNS = """
SELECT CASE o_custkey % 25 WHEN 0 THEN 'pg_catalog' WHEN 1 THEN 'information_schema'
       WHEN 2 THEN 'pg_toast' ELSE concat('schema', cast(o_custkey % 25 AS string))
       END AS table_schema,
       c_name AS table_name,
       concat('c', cast(l_orderkey AS string)) AS column_name,
       CASE WHEN l_returnflag = 'A' THEN 'pk' ELSE 'fk' END AS constraint_name
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
     JOIN {customer} ON o_custkey = c_custkey
"""

PG_CONSTRAINTS = """
SELECT CASE c_custkey % 25 WHEN 0 THEN 'pg_catalog' WHEN 1 THEN 'information_schema'
       WHEN 2 THEN 'pg_toast' ELSE concat('schema', cast(c_custkey % 25 AS string))
       END AS table_schema,
       c_name AS table_name,
       'pk' AS constraint_name,
       CASE WHEN c_acctbal >= 2000 THEN 'PRIMARY KEY' ELSE 'UNIQUE' END AS constraint_type
FROM {customer}
UNION ALL
SELECT CASE c_custkey % 25 WHEN 0 THEN 'pg_catalog' WHEN 1 THEN 'information_schema'
       WHEN 2 THEN 'pg_toast' ELSE concat('schema', cast(c_custkey % 25 AS string))
       END AS table_schema,
       c_name AS table_name, 'fk' AS constraint_name, 'FOREIGN KEY' AS constraint_type
FROM {customer}
"""

MYSQL_SCHEMATA = """
SELECT DISTINCT CASE o_custkey % 25 WHEN 0 THEN 'mysql' WHEN 1 THEN 'information_schema'
       WHEN 2 THEN 'performance_schema' WHEN 3 THEN 'sys'
       ELSE concat('schema', cast(o_custkey % 25 AS string)) END AS schema_name
FROM {orders}
"""

MYSQL_COLUMNS = """
SELECT concat('schema', cast(o_custkey % 25 AS string)) AS table_schema,
       concat('table', cast(o_custkey AS string)) AS table_name,
       concat('c', cast(o_orderkey AS string)) AS column_name,
       lower(o_orderpriority) AS data_type,
       CASE WHEN o_orderstatus = 'F' THEN 'NO' ELSE 'YES' END AS is_nullable,
       CASE o_orderstatus WHEN 'F' THEN 'PRI' WHEN 'O' THEN '' ELSE NULL END AS column_key,
       cast(o_orderkey AS int) AS ordinal_position
FROM {orders}
"""

MSSQL_SCHEMAS = """
SELECT n_nationkey AS schema_id, n_name AS name, n_regionkey AS principal_id FROM {nation}
"""

MSSQL_OBJECTS = """
SELECT c_custkey AS object_id, c_nationkey AS schema_id, c_name AS name,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'V' WHEN 'FURNITURE' THEN 'P' ELSE 'U'
       END AS type,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'VIEW' WHEN 'FURNITURE'
            THEN 'SQL_STORED_PROCEDURE' ELSE 'USER_TABLE' END AS type_desc
FROM {customer}
"""

MSSQL_COLUMNS = """
SELECT o_custkey AS object_id, cast(o_orderkey AS int) AS column_id,
       concat('c', cast(o_orderkey AS string)) AS name,
       cast(substr(o_orderpriority, 1, 1) AS int) AS user_type_id,
       o_orderstatus <> 'F' AS is_nullable
FROM {orders}
"""

MSSQL_TYPES = """
SELECT DISTINCT cast(substr(o_orderpriority, 1, 1) AS int) AS user_type_id,
       lower(substr(o_orderpriority, 3)) AS name
FROM {orders}
"""

MSSQL_INDEX_COLUMNS = """
SELECT o_custkey AS object_id, cast(l_orderkey AS int) AS column_id,
       cast(l_linenumber AS int) AS index_id, cast(1 AS int) AS index_column_id
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

MSSQL_INDEXES = """
SELECT c_custkey AS object_id, cast(1 AS int) AS index_id, c_acctbal >= 2000 AS is_primary_key
FROM {customer}
UNION ALL
SELECT c_custkey AS object_id, cast(2 AS int) AS index_id, c_acctbal < 2000 AS is_primary_key
FROM {customer}
"""

# Schemas that each source's catalog shows.
VISIBLE_SCHEMAS = """
SELECT concat('t', cast(l_suppkey % 5 AS string)) AS tenant_id,
       concat('s', cast(l_suppkey AS string)) AS source_id,
       concat('schema', cast(l_partkey % 25 AS string)) AS schema_name
FROM {lineitem} WHERE (l_partkey % 25 + l_suppkey) % 3 <> 0
"""
