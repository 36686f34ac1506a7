"""Deterministic record keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.payload import hashed_form
from tidemark.functions.values import (
    column_of,
    find_column,
    normalized_value,
    value_text,
)


def hash_key(payload: Column, bits: int = 64) -> Column:
    """Leading hex digits of the payload's SHA-256.

    64 bits is the compatible width; use 256 where a dataset nears 2^32 rows.
    """
    if bits % 4 or not 4 <= bits <= 256:
        raise ValueError(f"key width of {bits} bits")
    return F.substring(F.sha2(hashed_form(payload), 256), 1, bits // 4)


def raw_key_or(df: DataFrame, technical_key: str | None, fallback: Column) -> Column:
    """Text of the technical key as scanned, else the fallback."""
    field = find_column(df, technical_key) if technical_key else None
    if field is None:
        return fallback
    return F.coalesce(value_text(column_of(field.name), field.dataType), fallback)


def normalized_key_or(df: DataFrame, technical_key: str | None, fallback: Column) -> Column:
    """Text of the normalised technical key, else the fallback."""
    field = find_column(df, technical_key) if technical_key else None
    if field is None:
        return fallback
    text = normalized_value(column_of(field.name), field.dataType).cast("string")
    return F.coalesce(text, fallback)


def raw_key(df: DataFrame, technical_key: str | None, payload: Column, bits: int = 64) -> Column:
    """Text of the technical key as scanned, else the hash key."""
    return raw_key_or(df, technical_key, hash_key(payload, bits))


def normalized_key(
    df: DataFrame, technical_key: str | None, payload: Column, bits: int = 64
) -> Column:
    """Text of the normalised technical key, else the hash key."""
    return normalized_key_or(df, technical_key, hash_key(payload, bits))
