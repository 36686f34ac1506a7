"""The record envelope around a payload, in the layers' shape and in the log's shape."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cursors
from tidemark.functions.keys import (
    hash_key,
    normalized_key,
    normalized_key_or,
    raw_key,
    raw_key_or,
)
from tidemark.functions.payload import normalized_payload, raw_payload
from tidemark.functions.values import alters, column_of, find_column, require_column


def _stamped(df: DataFrame, identity: dict[str, str]) -> DataFrame:
    return df.select(*(F.lit(v).alias(k) for k, v in identity.items()), "*")


def raw_records(
    df: DataFrame,
    identity: dict[str, str],
    at: datetime.datetime,
    technical_key: str | None = None,
    key_bits: int = 64,
) -> DataFrame:
    """Raw-layer records of source rows."""
    payload = raw_payload(df)
    records = df.select(
        raw_key(df, technical_key, payload, key_bits).alias("record_key"),
        payload.alias("payload"),
        F.lit(at).alias("ingested_at"),
    )
    return _stamped(records, identity)


def normalized_records(
    df: DataFrame,
    identity: dict[str, str],
    at: datetime.datetime,
    technical_key: str | None = None,
    key_bits: int = 64,
) -> DataFrame:
    """Normalized-layer records of source rows."""
    payload = normalized_payload(df)
    records = df.select(
        normalized_key(df, technical_key, payload, key_bits).alias("record_key"),
        payload.alias("payload"),
        F.lit(at).alias("normalized_at"),
    )
    return _stamped(records, identity)


def _unused_name(df: DataFrame, name: str) -> str:
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name += "_"
    return name


def log_rows(
    df: DataFrame,
    technical_key: str | None = None,
    cursor_column: str | None = None,
    key_bits: int = 64,
) -> DataFrame:
    """Both layers' keys and payloads and the cursor, in one narrow pass over the source.

    Encoding and hashing are most of the work. Where normalisation leaves a row as it is, the
    normalized payload and hash are those of the raw layer and are not computed again.
    """
    # Steps of their own, so that each is evaluated once however often it is used.
    raw_name, normal_name = _unused_name(df, "raw_json"), _unused_name(df, "normal_json")
    hash_name = _unused_name(df, "raw_hash")
    raw, normal = F.col(raw_name), F.col(normal_name)
    encoded = df.withColumn(raw_name, raw_payload(df))
    changes = alters(df)
    payload = raw if changes is None else F.when(changes, normalized_payload(df)).otherwise(raw)
    encoded = encoded.withColumn(normal_name, payload)
    if technical_key and find_column(df, technical_key):
        # Hashes are taken only of rows whose key is null.
        raw_hash, normal_hash = hash_key(raw, key_bits), hash_key(normal, key_bits)
    else:
        encoded = encoded.withColumn(hash_name, hash_key(raw, key_bits))
        raw_hash = F.col(hash_name)
        normal_hash = F.when(normal == raw, raw_hash).otherwise(hash_key(normal, key_bits))
    if cursor_column:
        field = require_column(df, cursor_column)
        cursor = cursors.sortable(column_of(field.name), field.dataType)
    else:
        cursor = cursors.no_cursor()
    return encoded.select(
        raw_key_or(df, technical_key, raw_hash).alias("raw_key"),
        raw.alias("raw_payload"),
        normalized_key_or(df, technical_key, normal_hash).alias("normalized_key"),
        normal.alias("normalized_payload"),
        cursor.alias("cursor"),
    )
