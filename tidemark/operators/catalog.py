"""Discovery of schemas, tables, columns and primary keys from system-catalog rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Schemas that belong to the server itself, and the names of view types.
SYSTEM_SCHEMAS = {
    "postgres": ("pg_catalog", "information_schema", "pg_toast"),
    "mysql": ("mysql", "information_schema", "performance_schema", "sys"),
}
SQLSERVER_OWNER = 1
SQLSERVER_OBJECTS = ("U", "V")
VIEW_TYPES = ("VIEW", "VIEW (SQL View)", "V")


def user_schemas(schemata: DataFrame, connector: str) -> DataFrame:
    """``schema_name`` of the schemas that belong to users."""
    if connector == "sqlserver":
        owned = schemata.where(F.col("principal_id") == SQLSERVER_OWNER)
        return owned.select(F.col("name").alias("schema_name"))
    return schemata.where(~F.col("schema_name").isin(*SYSTEM_SCHEMAS[connector])).select(
        "schema_name"
    )


def object_type(kind: Column) -> Column:
    """``view`` or ``table``."""
    return F.when(kind.isin(*VIEW_TYPES), F.lit("view")).otherwise(F.lit("table"))


def objects_information_schema(tables: DataFrame) -> DataFrame:
    """Tables and views of all schemas at once."""
    return tables.select(
        F.col("table_schema").alias("schema_name"),
        "table_name",
        object_type(F.col("table_type")).alias("object_type"),
    )


def objects_sqlserver(objects: DataFrame, schemata: DataFrame) -> DataFrame:
    """Tables and views of all schemas at once."""
    named = schemata.select("schema_id", F.col("name").alias("schema_name"))
    return (
        objects.where(F.col("type").isin(*SQLSERVER_OBJECTS))
        .join(named, "schema_id")
        .select(
            "schema_name",
            F.col("name").alias("table_name"),
            object_type(F.col("type_desc")).alias("object_type"),
        )
    )


def select_objects(
    objects: DataFrame,
    schemas: DataFrame,
    filter_schema: str | None = None,
    allowed_tables: Sequence[str] | DataFrame = (),
) -> DataFrame:
    """Objects in user schemas, in the chosen schema, on the allow-list.

    ``allowed_tables`` is a list of names or a DataFrame with a ``table_name`` column; an
    empty list allows everything.
    """
    kept = objects.join(schemas.select("schema_name"), "schema_name", "left_semi")
    if filter_schema:
        kept = kept.where(F.col("schema_name") == filter_schema)
    if isinstance(allowed_tables, DataFrame):
        kept = kept.join(allowed_tables.select("table_name"), "table_name", "left_semi")
    elif allowed_tables:
        kept = kept.where(F.col("table_name").isin(*allowed_tables))
    return kept.select(*objects.columns)


def columns_postgres(
    columns: DataFrame, key_column_usage: DataFrame, table_constraints: DataFrame
) -> DataFrame:
    """Columns with their primary-key flag.

    Constraints are matched by schema, table and name, and key columns are reduced to one row
    each before the join, so a column appears once whatever constraints it is part of.
    """
    table = ["table_schema", "table_name"]
    primary = table_constraints.where(F.col("constraint_type") == "PRIMARY KEY")
    key_columns = (
        key_column_usage.join(
            primary.select(*table, "constraint_name"), [*table, "constraint_name"], "left_semi"
        )
        .select(*table, "column_name")
        .distinct()
        .withColumn("_primary", F.lit(True))
    )
    return columns.join(key_columns, [*table, "column_name"], "left").select(
        F.col("table_schema").alias("schema_name"),
        "table_name",
        F.col("column_name").alias("name"),
        "data_type",
        (F.col("is_nullable") == "YES").alias("nullable"),
        F.coalesce("_primary", F.lit(False)).alias("is_primary"),
        "ordinal_position",
    )


def columns_mysql(columns: DataFrame) -> DataFrame:
    """Columns with their primary-key flag."""
    return columns.select(
        F.col("table_schema").alias("schema_name"),
        "table_name",
        F.col("column_name").alias("name"),
        "data_type",
        (F.col("is_nullable") == "YES").alias("nullable"),
        F.coalesce(F.col("column_key") == "PRI", F.lit(False)).alias("is_primary"),
        "ordinal_position",
    )


def columns_sqlserver(
    columns: DataFrame,
    objects: DataFrame,
    schemata: DataFrame,
    types: DataFrame,
    index_columns: DataFrame,
    indexes: DataFrame,
) -> DataFrame:
    """Columns with their primary-key flag, from the primary-key index."""
    index = ["object_id", "index_id"]
    primary = indexes.where(F.col("is_primary_key"))
    key_columns = (
        index_columns.join(primary.select(*index), index, "left_semi")
        .select("object_id", "column_id")
        .distinct()
        .withColumn("_primary", F.lit(True))
    )
    tables = (
        objects.where(F.col("type").isin(*SQLSERVER_OBJECTS))
        .select("object_id", "schema_id", F.col("name").alias("table_name"))
        .join(schemata.select("schema_id", F.col("name").alias("schema_name")), "schema_id")
    )
    kinds = types.select("user_type_id", F.col("name").alias("data_type"))
    return (
        columns.withColumnRenamed("name", "column_name")
        .join(tables, "object_id")
        .join(kinds, "user_type_id")
        .join(key_columns, ["object_id", "column_id"], "left")
        .select(
            "schema_name",
            "table_name",
            F.col("column_name").alias("name"),
            "data_type",
            F.col("is_nullable").alias("nullable"),
            F.coalesce("_primary", F.lit(False)).alias("is_primary"),
            F.col("column_id").alias("ordinal_position"),
        )
    )


def columns_of_objects(objects: DataFrame, columns: DataFrame) -> DataFrame:
    """Columns of the selected objects; an object without columns keeps one row of nulls."""
    return objects.join(columns, ["schema_name", "table_name"], "left")


def roll_up(columns: DataFrame) -> DataFrame:
    """One row per table with its columns as an array in ordinal order.

    The servers bound the number of columns of a table, and so the array.
    """
    fields = ["ordinal_position", "name", "data_type", "nullable", "is_primary"]
    listed = F.when(F.col("name").isNotNull(), F.struct(*fields))
    return columns.groupBy("schema_name", "table_name", "object_type").agg(
        F.array_sort(F.collect_list(listed)).alias("columns")
    )


def summary(schemas: DataFrame, objects: DataFrame) -> DataFrame:
    """Number of user schemas, unfiltered, and of selected tables (A4)."""
    counted = schemas.select("schema_name", F.lit(None).cast("string").alias("table_name"))
    listed = objects.select(F.lit(None).cast("string").alias("schema_name"), "table_name")
    return counted.unionByName(listed).agg(
        F.count("schema_name").cast("int").alias("schema_count"),
        F.count("table_name").cast("int").alias("table_count"),
    )


def in_catalog_order(rows: DataFrame) -> DataFrame:
    """Catalog rows by schema, table and column position (O3)."""
    order = ["schema_name", "table_name", "ordinal_position"]
    return rows.orderBy(*(c for c in order if c in rows.columns))
