"""Registration of sources and datasets, checkpoint resets, source checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import access, messages
from tidemark.operators.requests import (
    check_required,
    dataset_rows,
    orphans,
    source_rows,
    split_by_error,
    with_source,
)
from tidemark.sinks.store import Store


def _refuse(store: Store, kind: str, refused: DataFrame, batch: str | None = None) -> None:
    if refused.isEmpty():
        return
    body = F.to_json(F.struct(*(c for c in refused.columns if c != "error")))
    store.reject(refused.select(F.lit(kind).alias("kind"), body.alias("body"), "error"), batch)


def register_sources(store: Store, requests: DataFrame) -> None:
    """Validates and upserts sources; refused requests are kept with their reason."""
    valid, refused = split_by_error(check_required(requests, "source"))
    _refuse(store, "source", refused)
    store.sources.upsert(source_rows(valid, F.current_timestamp()))


def register_datasets(store: Store, requests: DataFrame) -> None:
    """Validates and upserts datasets of registered sources."""
    valid, refused = split_by_error(check_required(requests, "dataset"))
    sources = store.sources.current()
    homeless = orphans(valid, sources).withColumn("error", F.lit("source is not registered"))
    _refuse(store, "dataset", refused.unionByName(homeless))
    keys = ["tenant_id", "source_id"]
    known = valid.join(sources.select(*keys), keys, "left_semi")
    store.datasets.upsert(dataset_rows(known, F.current_timestamp()))


def reset_checkpoints(store: Store, requests: DataFrame, batch: str | None = None) -> None:
    """Deletes stored cursors, so the next incremental run is a first run."""
    valid, refused = split_by_error(check_required(requests, "reset"))
    _refuse(store, "reset", refused, batch)
    store.checkpoints.delete(valid.dropDuplicates(["tenant_id", "source_id", "dataset_id"]))


def check_sources(
    store: Store, requests: DataFrame, schemata: DataFrame, batch: str | None = None
) -> None:
    """Checks the configured schema of registered sources and publishes results.

    ``schemata`` lists (tenant_id, source_id, schema_name) as the catalogs show them. Requests
    for an unknown source are refused without a result. A micro-batch that is repeated under its
    name ``batch`` leaves its refusals and results once.
    """
    found = with_source(requests, store.sources.current())
    unknown = found.where(~F.col("source_found")).select(
        *requests.columns, F.lit("source not registered").alias("error")
    )
    _refuse(store, "test", unknown, batch)
    known = found.where("source_found").select(
        "request_id", "tenant_id", "source_id", F.col("source_schema").alias("schema_name")
    )
    checked = access.check_schemas(known, schemata).withColumn(
        "response_time_ms", F.lit(0).cast("bigint")
    )
    store.publish(messages.test_results(checked, F.current_timestamp()), batch)
