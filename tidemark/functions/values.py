"""Normalisation of column names and values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def column_of(name: str) -> Column:
    """A top-level column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def trimmed(text: Column) -> Column:
    """Text without Unicode white space at either end."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def utc_clock(moment: Column, kind: T.DataType) -> Column:
    """A date or timestamp as ``timestamp_ntz`` in UTC, under any session time zone.

    Timestamps without a zone are taken to be UTC already.
    """
    if isinstance(kind, T.TimestampType):
        epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
        return epoch + F.unix_micros(moment) * F.expr("INTERVAL '0.000001' SECOND")
    return moment.cast(T.TimestampNTZType())


def utc_text(moment: Column, kind: T.DataType) -> Column:
    """RFC 3339 text in UTC with trailing zeros of the fraction dropped."""
    # Casting timestamp_ntz to text is zone-free and already drops those zeros.
    clock = utc_clock(moment, kind).cast("string")
    return F.concat(F.translate(clock, " ", "T"), F.lit("Z"))


def is_moment(kind: T.DataType) -> bool:
    return isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType))


def raw_value(value: Column, kind: T.DataType) -> Column:
    """A value as the raw layer encodes it; only moments need help before JSON encoding."""
    return utc_text(value, kind) if is_moment(kind) else value


def normalized_value(value: Column, kind: T.DataType) -> Column:
    """A value as the normalized layer holds it."""
    if is_moment(kind):
        return utc_text(value, kind)
    if isinstance(kind, T.BinaryType):
        return F.make_valid_utf8(value.cast("string"))
    if isinstance(kind, T.StringType):
        return trimmed(value)
    return value


def value_text(value: Column, kind: T.DataType) -> Column:
    """Plain text of a value, for keys and cursors."""
    if is_moment(kind):
        return utc_text(value, kind)
    if isinstance(kind, T.BinaryType):
        return F.make_valid_utf8(value.cast("string"))
    return value.cast("string")


def normalized_name(name: str) -> str:
    """Column name in lower case without outer white space."""
    return name.strip(WHITE_SPACE).lower()


def normalized_names(names: list[str]) -> dict[str, str]:
    """Original to normalised name; two columns must not end up with one name."""
    taken: dict[str, str] = {}
    for name in names:
        wanted = normalized_name(name)
        if wanted in taken:
            raise ValueError(
                f"columns {taken[wanted]!r} and {name!r} both normalise to {wanted!r}"
            )
        taken[wanted] = name
    return {name: wanted for wanted, name in taken.items()}


def find_column(df: DataFrame, name: str) -> T.StructField | None:
    """The column a configured name refers to, compared by normalised name."""
    wanted = normalized_name(name)
    for field in df.schema.fields:
        if normalized_name(field.name) == wanted:
            return field
    return None


def require_column(df: DataFrame, name: str) -> T.StructField:
    field = find_column(df, name)
    if field is None:
        raise ValueError(f"column {name!r} not found among {df.columns}")
    return field


def alters(df: DataFrame) -> Column | None:
    """Whether normalisation gives a row another payload; None if it never does for this table."""
    names = normalized_names(df.columns)
    if any(name != wanted for name, wanted in names.items()):
        return F.lit(True)
    changed = None
    for field in df.schema.fields:
        if isinstance(field.dataType, T.BinaryType):
            return F.lit(True)
        if isinstance(field.dataType, T.StringType):
            text = column_of(field.name)
            differs = F.coalesce(text != trimmed(text), F.lit(False))
            changed = differs if changed is None else changed | differs
    return changed


def normalized(df: DataFrame) -> DataFrame:
    """All rows with normalised names and values."""
    names = normalized_names(df.columns)
    return df.select(
        *(
            normalized_value(column_of(field.name), field.dataType).alias(names[field.name])
            for field in df.schema.fields
        )
    )
