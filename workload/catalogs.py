"""Discovery over catalogs derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import access, catalog
from tidemark.plans.discovery import discover
from tidemark.sources.catalogs import from_frames
from workload import inputs
from workload.inputs import as_sql, derive, table


def postgres(spark, sf):
    return from_frames(
        "postgres",
        {
            "schemata": derive(spark, sf, inputs.PG_SCHEMATA),
            "tables": derive(spark, sf, inputs.PG_TABLES),
            "columns": derive(spark, sf, inputs.PG_COLUMNS),
            "key_column_usage": derive(spark, sf, inputs.PG_KEY_COLUMNS),
            "table_constraints": derive(spark, sf, inputs.PG_CONSTRAINTS),
        },
    )


def mysql(spark, sf):
    columns = derive(spark, sf, inputs.MYSQL_COLUMNS)
    tables = columns.select(
        "table_schema", "table_name", F.lit("BASE TABLE").alias("table_type")
    ).distinct()
    return from_frames(
        "mysql",
        {
            "schemata": derive(spark, sf, inputs.MYSQL_SCHEMATA),
            "tables": tables,
            "columns": columns,
        },
    )


def sqlserver(spark, sf):
    views = {
        "schemata": inputs.MSSQL_SCHEMAS,
        "objects": inputs.MSSQL_OBJECTS,
        "columns": inputs.MSSQL_COLUMNS,
        "types": inputs.MSSQL_TYPES,
        "index_columns": inputs.MSSQL_INDEX_COLUMNS,
        "indexes": inputs.MSSQL_INDEXES,
    }
    return from_frames(
        "sqlserver", {name: derive(spark, sf, text) for name, text in views.items()}
    )


def schemas_postgres(spark, sf):
    return catalog.in_catalog_order(postgres(spark, sf).schemas)


def schemas_mysql(spark, sf):
    return catalog.in_catalog_order(mysql(spark, sf).schemas)


def schemas_sqlserver(spark, sf):
    return catalog.in_catalog_order(sqlserver(spark, sf).schemas)


def tables_postgres(spark, sf):
    return discover(postgres(spark, sf)).objects


def tables_filtered(spark, sf):
    return discover(postgres(spark, sf), filter_schema="schema7").objects


def tables_allowed(spark, sf):
    """The allow-list is a table of names: those of customers with a low balance."""
    allowed = table(spark, sf, "customer").where(F.col("c_acctbal") < 1000).select(
        F.col("c_name").alias("table_name")
    )
    return discover(postgres(spark, sf), allowed_tables=allowed).objects


def tables_allowed_by_name(spark, sf):
    names = ["Customer#000000003", "Customer#000000004", "Customer#000000025", "none"]
    return discover(postgres(spark, sf), allowed_tables=names).objects


def tables_sqlserver(spark, sf):
    return discover(sqlserver(spark, sf)).objects


def columns_postgres(spark, sf):
    return postgres(spark, sf).columns


def columns_mysql(spark, sf):
    return mysql(spark, sf).columns


def columns_sqlserver(spark, sf):
    return sqlserver(spark, sf).columns


def columns_ordered(spark, sf):
    found = discover(postgres(spark, sf))
    return catalog.in_catalog_order(found.columns)


def roll_up(spark, sf):
    nested = discover(postgres(spark, sf)).nested()
    return nested.select(
        "schema_name", "table_name", "object_type",
        F.size("columns").alias("width"), F.to_json("columns").alias("columns"),
    )


def roll_up_turns(spark, sf):
    """Conversations act as tables, turns as columns."""
    columns = table(spark, sf, "conversations").select(
        F.lit("public").alias("schema_name"),
        F.concat(F.lit("conv"), F.col("conv_id")).alias("table_name"),
        F.lit("table").alias("object_type"),
        F.col("turn").cast("int").alias("ordinal_position"),
        F.concat(F.lit("turn"), F.col("turn")).alias("name"),
        F.col("role").alias("data_type"),
        (F.col("role") == "user").alias("nullable"),
        (F.col("turn") == 0).alias("is_primary"),
    )
    nested = catalog.roll_up(columns)
    return nested.select("table_name", F.to_json("columns").alias("columns"))


def discovery_summary(spark, sf):
    return discover(postgres(spark, sf), filter_schema="schema7").summary()


def schema_access(spark, sf):
    sources = derive(spark, sf, inputs.SOURCES).select("tenant_id", "source_id", "schema_name")
    return access.check_schemas(sources, derive(spark, sf, inputs.VISIBLE_SCHEMAS))


def schema_inaccessible(spark, sf):
    sources = derive(spark, sf, inputs.SOURCES).select("tenant_id", "source_id", "schema_name")
    return access.inaccessible(sources, derive(spark, sf, inputs.VISIBLE_SCHEMAS))


_SYSTEM = "('pg_catalog', 'information_schema', 'pg_toast')"
_PG_SCHEMAS = f"""
SELECT schema_name FROM {as_sql(inputs.PG_SCHEMATA)} s WHERE schema_name NOT IN {_SYSTEM}
"""
_PG_OBJECTS = f"""
SELECT table_schema AS schema_name, table_name,
       CASE WHEN table_type IN ('VIEW', 'V') THEN 'view' ELSE 'table' END AS object_type
FROM {as_sql(inputs.PG_TABLES)} t WHERE table_schema IN ({_PG_SCHEMAS})
"""
_PG_COLUMNS = f"""
SELECT c.table_schema AS schema_name, c.table_name, c.column_name AS name, c.data_type,
       c.is_nullable = 'YES' AS nullable,
       EXISTS (SELECT 1 FROM {as_sql(inputs.PG_KEY_COLUMNS)} k
               JOIN {as_sql(inputs.PG_CONSTRAINTS)} p
                 ON p.table_schema = k.table_schema AND p.table_name = k.table_name
                AND p.constraint_name = k.constraint_name
               WHERE p.constraint_type = 'PRIMARY KEY' AND k.table_schema = c.table_schema
                 AND k.table_name = c.table_name AND k.column_name = c.column_name)
           AS is_primary,
       c.ordinal_position
FROM {as_sql(inputs.PG_COLUMNS)} c
"""
_OBJECT_COLUMNS = f"""
SELECT o.schema_name, o.table_name, o.object_type, c.name, c.data_type, c.nullable,
       c.is_primary, c.ordinal_position
FROM ({_PG_OBJECTS}) o LEFT JOIN ({_PG_COLUMNS}) c
  ON c.schema_name = o.schema_name AND c.table_name = o.table_name
"""
_MSSQL_TABLES = f"""
SELECT o.object_id, s.name AS schema_name, o.name AS table_name, s.principal_id,
       CASE o.type WHEN 'V' THEN 'view' ELSE 'table' END AS object_type
FROM {as_sql(inputs.MSSQL_OBJECTS)} o
JOIN {as_sql(inputs.MSSQL_SCHEMAS)} s ON s.schema_id = o.schema_id WHERE o.type IN ('U', 'V')
"""

_COLUMN_STRUCT = (
    "struct_pack(ordinal_position := ordinal_position, name := name, data_type := data_type, "
    "nullable := nullable, is_primary := is_primary)"
)

QUERIES = {
    "catalog_schemas_postgres": (schemas_postgres, _PG_SCHEMAS),
    "catalog_schemas_mysql": (
        schemas_mysql,
        f"SELECT schema_name FROM {as_sql(inputs.MYSQL_SCHEMATA)} s "
        "WHERE schema_name LIKE 'schema%'",
    ),
    "catalog_schemas_sqlserver": (
        schemas_sqlserver, "SELECT n_name AS schema_name FROM nation WHERE n_regionkey = 1",
    ),
    "catalog_tables": (tables_postgres, _PG_OBJECTS),
    "catalog_tables_filtered": (
        tables_filtered, f"SELECT * FROM ({_PG_OBJECTS}) WHERE schema_name = 'schema7'",
    ),
    "catalog_tables_allowed": (
        tables_allowed,
        f"SELECT * FROM ({_PG_OBJECTS}) WHERE table_name IN "
        "(SELECT c_name FROM customer WHERE c_acctbal < 1000)",
    ),
    "catalog_tables_allowed_by_name": (
        tables_allowed_by_name,
        f"SELECT * FROM ({_PG_OBJECTS}) WHERE table_name IN "
        "('Customer#000000003', 'Customer#000000004', 'Customer#000000025')",
    ),
    "catalog_tables_sqlserver": (
        tables_sqlserver,
        f"SELECT schema_name, table_name, object_type FROM ({_MSSQL_TABLES}) "
        "WHERE principal_id = 1",
    ),
    "catalog_columns_postgres": (columns_postgres, _PG_COLUMNS),
    "catalog_columns_mysql": (
        columns_mysql,
        f"""
        SELECT table_schema AS schema_name, table_name, column_name AS name, data_type,
               is_nullable = 'YES' AS nullable, coalesce(column_key = 'PRI', false) AS is_primary,
               ordinal_position
        FROM {as_sql(inputs.MYSQL_COLUMNS)} c
        """,
    ),
    "catalog_columns_sqlserver": (
        columns_sqlserver,
        f"""
        SELECT t.schema_name, t.table_name, c.name, y.name AS data_type,
               c.is_nullable AS nullable,
               EXISTS (SELECT 1 FROM {as_sql(inputs.MSSQL_INDEX_COLUMNS)} i
                       JOIN {as_sql(inputs.MSSQL_INDEXES)} x
                         ON x.object_id = i.object_id AND x.index_id = i.index_id
                       WHERE x.is_primary_key AND i.object_id = c.object_id
                         AND i.column_id = c.column_id) AS is_primary,
               c.column_id AS ordinal_position
        FROM {as_sql(inputs.MSSQL_COLUMNS)} c
        JOIN ({_MSSQL_TABLES}) t ON t.object_id = c.object_id
        JOIN {as_sql(inputs.MSSQL_TYPES)} y ON y.user_type_id = c.user_type_id
        """,
    ),
    "catalog_columns_of_tables": (columns_ordered, _OBJECT_COLUMNS),
    "catalog_roll_up": (
        roll_up,
        f"""
        SELECT schema_name, table_name, object_type,
               cast(count(name) AS integer) AS width,
               cast(to_json(coalesce(list({_COLUMN_STRUCT} ORDER BY ordinal_position)
                   FILTER (WHERE name IS NOT NULL), [])) AS varchar) AS columns
        FROM ({_OBJECT_COLUMNS})
        GROUP BY schema_name, table_name, object_type
        """,
    ),
    "catalog_roll_up_turns": (
        roll_up_turns,
        """
        SELECT 'conv' || conv_id AS table_name, cast(to_json(list(struct_pack(
                   ordinal_position := turn, name := 'turn' || turn, data_type := role,
                   nullable := role = 'user', is_primary := turn = 0) ORDER BY turn))
               AS varchar) AS columns
        FROM conversations GROUP BY conv_id
        """,
    ),
    "discovery_summary": (
        discovery_summary,
        f"""
        SELECT cast((SELECT count(*) FROM ({_PG_SCHEMAS})) AS integer) AS schema_count,
               cast((SELECT count(*) FROM ({_PG_OBJECTS}) WHERE schema_name = 'schema7')
                    AS integer) AS table_count
        """,
    ),
    "schema_access": (
        schema_access,
        f"""
        SELECT tenant_id, source_id, schema_name, success,
               CASE WHEN success THEN 'connection validated: host reachable, authentication ok, '
                                      || 'database and schema accessible'
                    ELSE 'connection ok but schema "' || schema_name || '" is not accessible'
               END AS message,
               CASE WHEN NOT success THEN 'schema "' || schema_name ||
                    '" does not exist or is not accessible to the configured user' END AS error
        FROM (SELECT *, schema_name IS NULL OR EXISTS (
                  SELECT 1 FROM {as_sql(inputs.VISIBLE_SCHEMAS)} v
                  WHERE v.tenant_id = s.tenant_id AND v.source_id = s.source_id
                    AND v.schema_name = s.schema_name) AS success
              FROM {as_sql(inputs.SOURCES)} s)
        """,
    ),
    "schema_inaccessible": (
        schema_inaccessible,
        f"""
        SELECT tenant_id, source_id, schema_name FROM {as_sql(inputs.SOURCES)} s
        WHERE schema_name IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM {as_sql(inputs.VISIBLE_SCHEMAS)} v
            WHERE v.tenant_id = s.tenant_id AND v.source_id = s.source_id
              AND v.schema_name = s.schema_name)
        """,
    ),
}
