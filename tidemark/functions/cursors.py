"""Cursors: typed comparison in scans, sortable form in the log, text in checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.values import (
    column_of,
    is_moment,
    require_column,
    utc_clock,
    value_text,
)


def _slot(kind: T.DataType) -> str:
    if is_moment(kind):
        return "at"
    if isinstance(kind, T.IntegralType):
        return "number"
    if isinstance(kind, T.DecimalType) and kind.scale <= 10 and kind.precision - kind.scale <= 28:
        return "number"
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return "real"
    if isinstance(kind, (T.StringType, T.DecimalType)):
        return "word"
    raise ValueError(f"a column of type {kind.simpleString()} cannot be a cursor")


def sortable(value: Column, kind: T.DataType) -> Column:
    """The value inside the sortable cursor struct; all fields null for a null value."""
    slot = _slot(kind)
    if slot == "at":
        value = utc_clock(value, kind)
    elif slot == "word" and isinstance(kind, T.DecimalType):
        value = _ordered_text(value, kind)
    return F.struct(
        *(
            (value if f.name == slot else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.CURSOR.fields
        )
    )


# Digits in ascending order, and what stands for them in numbers below zero.
_DIGITS, _MIRRORED = "0123456789", "9876543210"


def _ordered_text(value: Column, kind: T.DecimalType) -> Column:
    """A decimal that the log's number field does not hold exactly, as text that sorts like it.

    All digits of the type, after ``+``; below zero after ``#``, which sorts before it, each digit
    replaced by what it lacks to nine, so that greater amounts come first.
    """
    # Not ``abs`` and ``< 0``, which do not keep 38 digits of a decimal.
    plain = F.format_number(value, kind.scale)
    digits = F.lpad(F.translate(plain, ",-", ""), kind.precision + 2, "0")
    below = F.concat(F.lit("#"), F.translate(digits, _DIGITS, _MIRRORED))
    return F.when(plain.startswith("-"), below).otherwise(F.concat(F.lit("+"), digits))


def _number_of(text: Column, kind: T.DecimalType) -> Column:
    """The decimal of such a text."""
    digits = F.substring(text, 2, 80)
    below = F.concat(F.lit("-"), F.translate(digits, _MIRRORED, _DIGITS))
    return F.when(text.startswith("#"), below).otherwise(digits).cast(kind)


def no_cursor() -> Column:
    """The cursor of a row that was read without one."""
    return F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.CURSOR.fields))


def cursor_text(value: Column, kind: T.DataType) -> Column:
    """Checkpoint text of a cursor value."""
    return value_text(value, kind)


def checkpoint_text(cursor: Column, kind: T.DataType) -> Column:
    """Checkpoint text of a value kept in the sortable struct."""
    value = cursor.getField(_slot(kind))
    if is_moment(kind):
        return value_text(value, T.TimestampNTZType())
    if isinstance(kind, T.DecimalType) and _slot(kind) == "word":
        return value_text(_number_of(value, kind), kind)
    return value_text(value.cast(kind), kind)


def never_before(greatest: Column, old: str | None, kind: T.DataType) -> Column:
    """A cursor in its sortable form, or the stored one where that is greater.

    Rows that were read again by a lookback may all lie before the stored cursor.
    """
    if not old:
        return greatest
    return F.greatest(greatest, sortable(cursor_value(old, kind), kind))


def cursor_value(text: str, kind: T.DataType) -> Column:
    """Checkpoint text as a typed literal; text that does not fit the type is an error."""
    _slot(kind)
    return F.lit(text).cast(kind)


def newer_than(
    df: DataFrame, column: str, last_value: str | None, lookback: int | float = 0
) -> DataFrame:
    """Rows past the stored cursor (F1); all rows, nulls included, when there is none.

    ``lookback`` re-reads that many seconds (moments) or units (numbers) before the cursor.
    """
    field = require_column(df, column)
    if not last_value:
        return df
    bound = cursor_value(last_value, field.dataType)
    if lookback:
        if isinstance(field.dataType, T.DateType):
            bound = F.date_sub(bound, -(-int(lookback) // 86400))
        elif is_moment(field.dataType):
            micros = int(lookback * 1_000_000)
            bound = bound - F.lit(micros) * F.expr("INTERVAL '0.000001' SECOND")
        elif isinstance(field.dataType, T.NumericType):
            bound = (bound - F.lit(lookback)).cast(field.dataType)
        else:
            raise ValueError("lookback needs a date, timestamp or numeric cursor")
    return df.where(column_of(field.name) > bound)


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    """One row with the checkpoint text of the greatest non-null cursor (A3)."""
    field = require_column(df, column)
    top = df.agg(F.max(column_of(field.name)).alias("top"))
    return top.select(cursor_text(F.col("top"), field.dataType).alias("last_value"))


def should_save(new: Column, old: Column) -> Column:
    """A checkpoint is saved only when it is non-empty and differs from the old one (F8)."""
    return new.isNotNull() & (new != "") & ~new.eqNullSafe(old)
