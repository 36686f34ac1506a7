"""System-catalog rows of a source, read whole: a few queries per source, not per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import catalog

# The catalog views of each server and the columns used.
CATALOG_QUERIES = {
    "postgres": {
        "schemata": "SELECT schema_name FROM information_schema.schemata",
        "tables": "SELECT table_schema, table_name, table_type FROM information_schema.tables",
        "columns": (
            "SELECT table_schema, table_name, column_name, data_type, is_nullable, "
            "ordinal_position FROM information_schema.columns"
        ),
        "key_column_usage": (
            "SELECT table_schema, table_name, column_name, constraint_name "
            "FROM information_schema.key_column_usage"
        ),
        "table_constraints": (
            "SELECT table_schema, table_name, constraint_name, constraint_type "
            "FROM information_schema.table_constraints"
        ),
    },
    "mysql": {
        "schemata": "SELECT schema_name AS schema_name FROM information_schema.schemata",
        "tables": (
            "SELECT table_schema AS table_schema, table_name AS table_name, "
            "table_type AS table_type FROM information_schema.tables"
        ),
        "columns": (
            "SELECT table_schema AS table_schema, table_name AS table_name, "
            "column_name AS column_name, data_type AS data_type, is_nullable AS is_nullable, "
            "column_key AS column_key, ordinal_position AS ordinal_position "
            "FROM information_schema.columns"
        ),
    },
    "sqlserver": {
        "schemata": "SELECT schema_id, name, principal_id FROM sys.schemas",
        "objects": "SELECT object_id, schema_id, name, RTRIM(type) AS type, type_desc FROM sys.objects",
        "columns": (
            "SELECT object_id, column_id, name, user_type_id, is_nullable FROM sys.columns"
        ),
        "types": "SELECT user_type_id, name FROM sys.types",
        "index_columns": (
            "SELECT object_id, column_id, index_id, index_column_id FROM sys.index_columns"
        ),
        "indexes": "SELECT object_id, index_id, is_primary_key FROM sys.indexes",
    },
}


@dataclass(frozen=True)
class Catalog:
    """What a source's catalog says: user schemas, all objects, all columns."""

    schemas: DataFrame
    objects: DataFrame
    columns: DataFrame


def from_frames(connector: str, frames: Mapping[str, DataFrame]) -> Catalog:
    """A catalog from the rows of its system views."""
    if connector not in CATALOG_QUERIES:
        raise ValueError(f"unsupported connector: {connector}")
    schemata = frames["schemata"]
    if connector == "sqlserver":
        objects = catalog.objects_sqlserver(frames["objects"], schemata)
        columns = catalog.columns_sqlserver(
            frames["columns"],
            frames["objects"],
            schemata,
            frames["types"],
            frames["index_columns"],
            frames["indexes"],
        )
    else:
        objects = catalog.objects_information_schema(frames["tables"])
        if connector == "postgres":
            columns = catalog.columns_postgres(
                frames["columns"], frames["key_column_usage"], frames["table_constraints"]
            )
        else:
            columns = catalog.columns_mysql(frames["columns"])
    return Catalog(catalog.user_schemas(schemata, connector), objects, columns)


def read_catalog(
    spark: SparkSession,
    connector: str,
    options: Mapping[str, str],
    load: Callable[[str], DataFrame] | None = None,
) -> Catalog:
    """The catalog of a JDBC source (S8-S10); ``load`` replaces the JDBC read of one query."""

    def jdbc(query: str) -> DataFrame:
        rows = spark.read.format("jdbc").options(**options).option("query", query).load()
        return rows.toDF(*(name.lower() for name in rows.columns))

    read = load or jdbc
    if connector not in CATALOG_QUERIES:
        raise ValueError(f"unsupported connector: {connector}")
    frames = {view: read(query) for view, query in CATALOG_QUERIES[connector].items()}
    return from_frames(connector, frames)
