"""Validation of requests and their resolution against the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.defaults import (
    DEFAULT_BATCH_SIZE,
    batch_size_or_default,
    empty_to_null,
    enabled_or_default,
    null_to_empty,
    object_type_or_default,
    registered_batch_size,
    ssl_mode_or_default,
)

# What a source or dataset may say, and the text of refusals.
CONNECTORS = ("postgres", "mysql", "sqlserver")
SYNC_MODES = ("full", "incremental")
INCREMENTAL_TYPES = ("date", "key")
REQUIRED_FIELDS = {
    "connection": (
        "tenant_id", "request_id", "connector_type", "host", "port", "database",
        "username", "password_ref",
    ),
    "discovery": (
        "tenant_id", "request_id", "connector_type", "host", "port", "database",
        "username", "password_ref",
    ),
    "reset": ("tenant_id", "source_id", "dataset_id"),
    "source": (
        "tenant_id", "source_id", "connector_type", "host", "port", "database",
        "username", "password_ref",
    ),
    "dataset": ("tenant_id", "dataset_id", "table_name", "sync_mode"),
}


def _is_missing(df: DataFrame, name: str) -> Column:
    if df.schema[name].dataType.typeName() == "string":
        return null_to_empty(F.col(name)) == ""
    return F.coalesce(F.col(name), F.lit(0)) == 0


def check_required(df: DataFrame, kind: str) -> DataFrame:
    """Adds ``error``: null for a request with every required field."""
    fields = REQUIRED_FIELDS[kind]
    missing = F.lit(False)
    for name in fields:
        missing = missing | _is_missing(df, name)
    message = f"{', '.join(fields[:-1])} and {fields[-1]} are required"
    error = F.when(missing, F.lit(message))
    if kind == "dataset":
        no_source = _is_missing(df, "source_id")
        error = F.when(no_source, F.lit("source_id is required in path")).otherwise(error)
    return df.withColumn("error", error)


def split_by_error(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the ``error`` column, and refused rows with it."""
    valid = checked.where(F.col("error").isNull()).drop("error")
    return valid, checked.where(F.col("error").isNotNull())


def source_rows(requests: DataFrame, at: Column) -> DataFrame:
    """Registry rows of valid source requests."""
    return requests.select(
        "tenant_id",
        "source_id",
        "connector_type",
        "host",
        "port",
        F.col("database").alias("database_name"),
        empty_to_null(F.col("schema")).alias("schema_name"),
        "username",
        "password_ref",
        ssl_mode_or_default(F.col("ssl_mode")).alias("ssl_mode"),
        at.alias("created_at"),
        at.alias("updated_at"),
    )


def dataset_rows(requests: DataFrame, at: Column) -> DataFrame:
    """Registry rows of valid dataset requests."""
    return requests.select(
        "tenant_id",
        "source_id",
        "dataset_id",
        empty_to_null(F.col("schema_name")).alias("schema_name"),
        "table_name",
        object_type_or_default(F.col("object_type")).alias("object_type"),
        "sync_mode",
        empty_to_null(F.col("incremental_column")).alias("incremental_column"),
        empty_to_null(F.col("incremental_type")).alias("incremental_type"),
        empty_to_null(F.col("technical_key")).alias("technical_key"),
        registered_batch_size(F.col("batch_size")).alias("batch_size"),
        enabled_or_default(F.col("enabled")).alias("enabled"),
        at.alias("created_at"),
        at.alias("updated_at"),
    )


def orphans(datasets: DataFrame, sources: DataFrame) -> DataFrame:
    """Datasets whose source is not registered."""
    keys = ["tenant_id", "source_id"]
    return datasets.join(sources.select(*keys), keys, "left_anti").select(*datasets.columns)


def with_source(requests: DataFrame, sources: DataFrame) -> DataFrame:
    """Requests with their source row; ``source_found`` tells a missing one."""
    looked_up = sources.select(
        "tenant_id",
        "source_id",
        F.col("connector_type").alias("source_connector"),
        "host",
        "port",
        "database_name",
        F.col("schema_name").alias("source_schema"),
        "username",
        "password_ref",
        "ssl_mode",
        F.lit(True).alias("source_found"),
    )
    return requests.join(looked_up, ["tenant_id", "source_id"], "left").withColumn(
        "source_found", F.coalesce("source_found", F.lit(False))
    )


def resolve(
    requests: DataFrame, sources: DataFrame, datasets: DataFrame, checkpoints: DataFrame
) -> DataFrame:
    """Sync requests with source, dataset and cursor, and what is to be done with each.

    ``outcome`` is ``rejected`` (no ledger row), ``skipped`` (dataset disabled), ``failed``
    (a ledger row with the error, nothing read) or ``run`` (J4, J5, F6, F10).
    """
    dataset = datasets.select(
        *schemas.IDENTITY,
        F.col("schema_name").alias("dataset_schema"),
        "table_name",
        "object_type",
        "sync_mode",
        "incremental_column",
        "incremental_type",
        "technical_key",
        batch_size_or_default(F.col("batch_size")).alias("batch_size"),
        "enabled",
        F.lit(True).alias("dataset_found"),
    )
    cursor = checkpoints.select(*schemas.IDENTITY, "last_value")
    found = (
        with_source(requests, sources)
        .join(dataset, schemas.IDENTITY, "left")
        .join(cursor, schemas.IDENTITY, "left")
        .withColumn("dataset_found", F.coalesce("dataset_found", F.lit(False)))
    )
    return found.withColumn("error", _sync_error()).withColumn("outcome", _outcome())


def _named(*parts: str) -> Column:
    return F.concat_ws("/", *(F.coalesce(F.col(p), F.lit("")) for p in parts))


def _sync_error() -> Column:
    incremental = F.col("sync_mode") == "incremental"
    kind = null_to_empty(F.col("incremental_type"))
    return (
        F.when(
            ~F.col("source_found"),
            F.concat(F.lit("source not registered: "), _named("tenant_id", "source_id")),
        )
        .when(
            ~F.col("dataset_found"),
            F.concat(
                F.lit("dataset not registered: "),
                _named("tenant_id", "source_id", "dataset_id"),
            ),
        )
        .when(~F.col("enabled"), F.lit(None))
        .when(
            ~F.col("source_connector").isin(*CONNECTORS),
            F.concat(
                F.lit("create connector: unsupported connector type: "), F.col("source_connector")
            ),
        )
        .when(
            ~F.col("sync_mode").isin(*SYNC_MODES),
            F.concat(F.lit("unsupported sync mode: "), F.col("sync_mode")),
        )
        .when(
            incremental & (null_to_empty(F.col("incremental_column")) == ""),
            F.concat(
                F.lit("incremental_column not configured for dataset "), F.col("dataset_id")
            ),
        )
        .when(
            incremental & ~kind.isin(*INCREMENTAL_TYPES),
            F.concat(F.lit("unsupported incremental type: "), kind),
        )
    )


def _outcome() -> Column:
    return (
        F.when(~F.col("source_found") | ~F.col("dataset_found"), F.lit("rejected"))
        .when(~F.col("enabled"), F.lit("skipped"))
        .when(F.col("error").isNotNull(), F.lit("failed"))
        .otherwise(F.lit("run"))
    )
