"""Schemas of control tables, layers and messages."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "strings": T.ArrayType(T.StringType()),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "bigints": T.ArrayType(T.LongType()),
    "double": T.DoubleType(),
    "decimal": T.DecimalType(38, 10),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(columns: str) -> T.StructType:
    """Columns as ``name type``; unlike a DDL string this needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


IDENTITY = ["tenant_id", "source_id", "dataset_id"]

# --- control tables -------------------------------------------------------------------

DATA_SOURCES = _schema(
    "tenant_id string, source_id string, connector_type string, host string, port int, "
    "database_name string, schema_name string, username string, password_ref string, "
    "ssl_mode string, created_at timestamp, updated_at timestamp"
)

DATA_DATASETS = _schema(
    "tenant_id string, source_id string, dataset_id string, schema_name string, "
    "table_name string, object_type string, sync_mode string, incremental_column string, "
    "incremental_type string, technical_key string, batch_size int, enabled boolean, "
    "created_at timestamp, updated_at timestamp"
)

SYNC_EXECUTIONS = _schema(
    "execution_id string, tenant_id string, source_id string, dataset_id string, "
    "connector_type string, trigger_type string, status string, total_records bigint, "
    "total_batches bigint, duration_ms bigint, error_message string, started_at timestamp, "
    "completed_at timestamp, total_persisted bigint"
)

SYNC_CHECKPOINTS = _schema(
    "tenant_id string, source_id string, dataset_id string, last_value string, "
    "updated_at timestamp"
)

# A written attempt of an execution; without this row its files do not count.
SYNC_ATTEMPTS = _schema(
    "tenant_id string, source_id string, dataset_id string, execution_id string, "
    "attempt bigint, started_at timestamp, records bigint, last_value string"
)

# --- layers ---------------------------------------------------------------------------

# A cursor of any supported type: exactly one field is filled, so the struct sorts by it.
CURSOR = _schema("at timestamp_ntz, number decimal, real double, word string")
_TYPES["cursor"] = CURSOR

_PARTITIONS = "tenant_id string, source_id string, dataset_id string, execution_id string"

# One row per source row; both layers are column subsets of the same files.
SYNC_LOG = _schema(
    "raw_key string, raw_payload string, normalized_key string, normalized_payload string, "
    "cursor cursor, started_at timestamp, written_at timestamp, "
    f"{_PARTITIONS}, attempt bigint"
)

LAYER_SNAPSHOT = _schema(
    "record_key string, payload string, cursor cursor, "
    "execution_id string, started_at timestamp, written_at timestamp, "
    "layer string, tenant_id string, source_id string, dataset_id string, compaction bigint"
)

COMPACTIONS = _schema(
    "layer string, tenant_id string, source_id string, dataset_id string, compaction bigint, "
    "last_started timestamp, versions bigints"
)

# Records of a snapshot in key buckets, without the columns that folders tell.
BUCKET_ROWS = _schema(
    "record_key string, payload string, cursor cursor, "
    "execution_id string, started_at timestamp, written_at timestamp"
)
BUCKET_FOLDERS = _schema(
    "layer string, tenant_id string, source_id string, dataset_id string, buckets int, "
    "bucket int, version bigint"
)

# The last batch of each stream whose rows are part of a snapshot.
STREAM_BATCHES = _schema(
    "tenant_id string, source_id string, dataset_id string, stream string, batch_id bigint, "
    "records bigint, last_value string"
)

# --- request messages -----------------------------------------------------------------

SYNC_REQUEST = _schema(
    "tenant_id string, source_id string, dataset_id string, execution_id string, "
    "connector_type string, trigger_type string, correlation_id string, timestamp timestamp"
)
TEST_REQUEST = _schema("tenant_id string, source_id string, request_id string")
DISCOVERY_REQUEST = _schema(
    "tenant_id string, source_id string, request_id string, filter_schema string, "
    "allowed_tables strings"
)
RESET_REQUEST = _schema(
    "tenant_id string, source_id string, dataset_id string, request_id string"
)
SOURCE_REQUEST = _schema(
    "tenant_id string, source_id string, connector_type string, host string, port int, "
    "database string, schema string, username string, password_ref string, ssl_mode string"
)
DATASET_REQUEST = _schema(
    "tenant_id string, source_id string, dataset_id string, table_name string, "
    "sync_mode string, schema_name string, object_type string, incremental_column string, "
    "incremental_type string, technical_key string, batch_size int, enabled boolean"
)

# --- outgoing messages and refused input ----------------------------------------------

MESSAGE = _schema("topic string, key string, value string")
REJECTED = _schema("kind string, body string, error string")
