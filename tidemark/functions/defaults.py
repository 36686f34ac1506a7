"""Optional values and their defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DEFAULT_BATCH_SIZE = 1000
DEFAULT_OBJECT_TYPE = "table"
DEFAULT_SSL_MODE = "disable"


def empty_to_null(text: Column) -> Column:
    """Optional text as stored."""
    return F.nullif(text, F.lit(""))


def null_to_empty(text: Column) -> Column:
    """Optional text as read back."""
    return F.coalesce(text, F.lit(""))


def text_or(text: Column, default: str) -> Column:
    return F.coalesce(empty_to_null(text), F.lit(default))


def batch_size_or_default(size: Column) -> Column:
    """A usable batch size."""
    return F.when(size > 0, size).otherwise(F.lit(DEFAULT_BATCH_SIZE))


def registered_batch_size(size: Column) -> Column:
    """Batch size as registered: only a missing one is replaced."""
    return F.when(F.coalesce(size, F.lit(0)) == 0, F.lit(DEFAULT_BATCH_SIZE)).otherwise(size)


def object_type_or_default(kind: Column) -> Column:
    return text_or(kind, DEFAULT_OBJECT_TYPE)


def ssl_mode_or_default(mode: Column) -> Column:
    return text_or(mode, DEFAULT_SSL_MODE)


def enabled_or_default(enabled: Column) -> Column:
    return F.coalesce(enabled, F.lit(True))
