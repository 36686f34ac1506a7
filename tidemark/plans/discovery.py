"""Discovery of a source's schemas, tables and columns."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import catalog, messages
from tidemark.operators.requests import with_source
from tidemark.sinks.store import Store
from tidemark.sources.catalogs import Catalog


@dataclass(frozen=True)
class Discovery:
    """User schemas, selected objects, and the columns of those objects."""

    schemas: DataFrame
    objects: DataFrame
    columns: DataFrame

    def nested(self) -> DataFrame:
        """One row per table with its columns."""
        return catalog.roll_up(self.columns)

    def summary(self) -> DataFrame:
        """Schema and table counts (A4)."""
        return catalog.summary(self.schemas, self.objects)


def discover(
    found: Catalog,
    filter_schema: str | None = None,
    allowed_tables: Sequence[str] | DataFrame = (),
) -> Discovery:
    """Applies the schema filter and the allow-list to a catalog.

    Columns are joined to the selected objects, so those of other tables are dropped before
    anything is collected per table.
    """
    objects = catalog.select_objects(found.objects, found.schemas, filter_schema, allowed_tables)
    return Discovery(
        found.schemas, objects, catalog.columns_of_objects(objects, found.columns)
    )


_RESULT = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("tenant_id", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("schema_count", T.LongType()),
        T.StructField("table_count", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)
#: Results that are published together; each is a row of counts.
RESULTS_TOGETHER = 1000


def process_discoveries(
    store: Store,
    requests: DataFrame,
    open_catalog: Callable[[Row], Catalog],
    workers: int = 4,
    batch: str | None = None,
) -> None:
    """Runs discovery requests for registered sources and publishes their counts.

    Each request reads another database, so each is a job of its own, ``workers`` at a time.
    Requests reach the driver partition by partition; results are published by the thousand. A
    micro-batch that is repeated under its name ``batch`` leaves its results once.
    """
    spark: SparkSession = store.spark

    def counted(row: Row) -> tuple:
        try:
            if not row.source_found:
                raise ValueError(f"source not registered: {row.tenant_id}/{row.source_id}")
            discovery = discover(open_catalog(row), row.filter_schema, row.allowed_tables or ())
            counts = discovery.summary().first()
            outcome = (True, counts.schema_count, counts.table_count, None)
        except Exception as error:  # noqa: BLE001 - a failed discovery is a result too
            outcome = (False, 0, 0, str(error))
        return (row.request_id, row.tenant_id, row.source_id, *outcome)

    found = with_source(requests, store.sources.current()).toLocalIterator()
    with ThreadPoolExecutor(workers) as pool:
        for number in itertools.count():
            some = list(itertools.islice(found, RESULTS_TOGETHER))
            if not some:
                break
            results = spark.createDataFrame(list(pool.map(counted, some)), _RESULT)
            name = f"{batch}-{number}" if batch else None
            store.publish(messages.discovery_results(results, F.current_timestamp()), name)
