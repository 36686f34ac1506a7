"""Small ordered excerpts for a person to look at; syncs never page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tidemark.functions.values import column_of, require_column


def _in_order(df: DataFrame, key: str) -> Column:
    return column_of(require_column(df, key).name).asc_nulls_last()


def first_rows(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The first rows in key order (O1)."""
    return df.orderBy(_in_order(df, key)).limit(rows)


def page(df: DataFrame, key: str, rows: int, skip: int) -> DataFrame:
    """A page in key order (O2)."""
    return df.orderBy(_in_order(df, key)).offset(skip).limit(rows)
