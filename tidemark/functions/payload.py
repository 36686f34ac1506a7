"""JSON payloads and message bodies."""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import (
    column_of,
    is_moment,
    normalized_names,
    normalized_value,
    raw_value,
    utc_text,
)

try:
    import pyarrow as pa
    import pyarrow.compute as pc
except ImportError:  # doubles are then written by expressions alone
    pa = None

# Moments nested in arrays, maps or structs keep their microseconds too.
_PAYLOAD_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Numbers from 10^21 on, and those below 10^-6, are written with an exponent.
_PLAIN_BELOW, _PLAIN_FROM = 21, -6
#: Significant digits that tell any two doubles apart, and those that any double can do without.
_MOST_DIGITS, _SURE_DIGITS = 17, 15

# Characters that the hashed form of a payload writes as escapes.
HASH_ESCAPES = {
    "&": "\\u0026",
    "<": "\\u003c",
    ">": "\\u003e",
    "\u2028": "\\u2028",
    "\u2029": "\\u2029",
}


def _digits_text(exponential: Column, always_plain: bool = False) -> Column:
    """A number in the form d.dddE±x, with as few digits as it has, plain or with an exponent."""
    parts = F.struct(
        F.rtrim(F.translate(F.substring_index(exponential, "E", 1), "-.", ""), F.lit("0")).alias("digits"),
        F.substring_index(exponential, "E", -1).cast("int").alias("power"),
        F.when(F.startswith(exponential, F.lit("-")), "-").otherwise("").alias("sign"),
    )

    def placed(number: Column) -> Column:
        digits, power, sign = number["digits"], number["power"], number["sign"]
        count, point = F.length(digits), power + 1  # the point stands after so many digits
        fraction = F.when(count > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise("")
        with_power = F.concat(
            F.substring(digits, 1, 1), fraction, F.when(power < 0, "e-").otherwise("e+"),
            F.abs(power).cast("string"),
        )
        plain = (
            F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
            .when(point >= count, F.concat(digits, F.repeat(F.lit("0"), point - count)))
            .otherwise(
                F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1))
            )
        )
        exponent = (power < _PLAIN_FROM) | (power >= _PLAIN_BELOW)
        if always_plain:
            exponent = F.lit(False)
        return F.when(digits == "", F.concat(sign, F.lit("0"))).otherwise(
            F.concat(sign, F.when(exponent, with_power).otherwise(plain))
        )

    return _bound(parts, placed)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _shortest(value: Column, text: Column) -> Column:
    """The fewest digits that read back as the double; the virtual machine may write one too many.

    Whole numbers of 64 bits are rounded exactly; of others, the digits at hand are.
    """
    shortest, whole = text, text
    size = F.abs(value).cast("bigint")
    count = F.length(size.cast("string"))
    sign = F.when(value < 0, "-").otherwise("")
    for digits in range(_MOST_DIGITS, _SURE_DIGITS - 1, -1):
        shorter = F.format_string(f"%.{digits - 1}E", value)
        shortest = F.when(shorter.try_cast("double") == value, shorter).otherwise(shortest)
        unit = F.element_at(
            F.array(*(F.lit(10**k).cast("decimal(20,0)") for k in range(6))),
            F.greatest(count - digits, F.lit(0)) + 1,
        )
        places = F.floor((size.cast("decimal(20,0)") + unit / 2) / unit).cast("decimal(20,0)") * unit
        near = places.cast("decimal(20,0)").cast("string")
        whole = F.when(near.cast("double") == F.abs(value), F.concat(sign, near)).otherwise(whole)
    exact = (F.abs(value) >= 1e15) & (F.abs(value) < 9.2e18)
    return F.when(F.length(text) <= _SURE_DIGITS, text).when(exact, whole).otherwise(shortest)


def _without_zeros(plain: Column) -> Column:
    return F.when(
        F.contains(plain, F.lit(".")), F.rtrim(F.rtrim(plain, F.lit("0")), F.lit("."))
    ).otherwise(plain)


def _text_type(kind: T.DataType) -> T.DataType:
    """The type of a value whose doubles have become text."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_text_type(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _text_type(kind.valueType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _text_type(f.dataType)) for f in kind.fields])
    return T.StringType() if isinstance(kind, T.DoubleType) else kind


def _passes_arrow(kind: T.DataType) -> bool:
    """Whether values of a nested type come back from Arrow as they were, but for their doubles."""
    unchanged = (T.StringType, T.BooleanType, T.IntegralType)
    if isinstance(kind, T.ArrayType):
        return _passes_arrow(kind.elementType)
    if isinstance(kind, T.MapType):
        return isinstance(kind.keyType, unchanged) and _passes_arrow(kind.valueType)
    if isinstance(kind, T.StructType):
        named = 0 < len(kind.fields) == len(set(kind.names))
        return named and all(_passes_arrow(f.dataType) for f in kind.fields)
    return isinstance(kind, (*unchanged, T.DoubleType))


def _written(value: Column, kind: T.DataType) -> Column:
    """The value with its doubles, at any depth, as canonical text; whole batches at a time.

    Arrow writes the shortest digits that read back as the double, nearest to it of equally short
    ones, plain from 10^-6 to below 10^10. Where it writes an exponent up to 10^20, digits are
    placed here.
    """

    @F.arrow_udf(_text_type(kind))
    def written(values: pa.Array) -> pa.Array:
        def plain(written: str) -> str:
            mantissa, power = written.split("e+")
            whole, _, fraction = mantissa.partition(".")
            point = int(power)
            rest = fraction[point:]
            return whole + fraction[:point].ljust(point, "0") + (rest and "." + rest)

        def text(doubles: pa.Array) -> pa.Array:
            texts = pc.cast(doubles, pa.string())
            placed = pc.and_(pc.match_substring(texts, "e+"), pc.less(pc.abs(doubles), 1e21))
            if pc.any(placed).as_py():
                moved = [plain(t) for t in texts.filter(placed).to_pylist()]
                placed = pc.fill_null(placed, False)
                texts = pc.replace_with_mask(texts, placed, pa.array(moved, pa.string()))
            if not pc.all(pc.is_finite(doubles)).as_py():  # JSON has no number for these
                names = pc.if_else(pc.less(doubles, 0.0), '"-Infinity"', '"Infinity"')
                texts = pc.if_else(pc.is_inf(doubles), names, texts)
                texts = pc.if_else(pc.is_nan(doubles), '"NaN"', texts)
            return texts

        def inside(some: pa.Array) -> pa.Array:
            if pa.types.is_float64(some.type):
                return text(some)
            if pa.types.is_map(some.type):
                items = inside(some.items)
                return pa.MapArray.from_arrays(some.offsets, some.keys, items, mask=some.is_null())
            if pa.types.is_list(some.type):
                return pa.ListArray.from_arrays(some.offsets, inside(some.values), mask=some.is_null())
            if pa.types.is_struct(some.type):
                names = [field.name for field in some.type]
                fields = [inside(some.field(i)) for i in range(len(names))]
                return pa.StructArray.from_arrays(fields, names, mask=some.is_null())
            return some

        return inside(values)

    return written(value)


def number_text(value: Column, kind: T.DataType, nested: bool = False) -> Column:
    """A number as canonical JSON writes it: the shortest digits that read back as the same value.

    Whole numbers have no fraction (``100``); from 10^21 on, and below 10^-6, the form is
    ``1.5e+21`` and ``1e-7``. Decimals keep all their digits but trailing zeros of the fraction,
    and never have an exponent. Values that JSON has no number for are text (``"NaN"``). Null
    stays null. ``nested`` values, of which Spark has no column, are written by expressions, which
    is far slower for doubles of many digits.
    """
    if isinstance(kind, T.DoubleType) and pa and not nested:
        return _written(value, kind)
    text = value.cast("string")
    if isinstance(kind, T.DecimalType):
        if kind.scale == 0:
            return text
        # Very small values come with an exponent.
        small = F.contains(text, F.lit("E"))
        return F.when(small, _digits_text(text, always_plain=True)).otherwise(_without_zeros(text))
    # The usual case first: neither an exponent nor more digits than a double surely needs.
    usual = ~F.contains(text, F.lit("E")) & (F.length(text) <= _SURE_DIGITS)
    shortest = _shortest(value, text) if isinstance(kind, T.DoubleType) else text
    exponential = _bound(
        shortest,
        lambda t: F.when(F.contains(t, F.lit("E")), _digits_text(t)).otherwise(_without_zeros(t)),
    )
    return (
        F.when(usual & ~F.isnan(value) & (F.abs(value) != float("inf")), _without_zeros(text))
        .when(F.isnan(value) | (F.abs(value) == float("inf")), F.concat(F.lit('"'), text, F.lit('"')))
        .otherwise(exponential)
    )


def _is_plain(kind: T.DataType) -> bool:
    """Whether Spark's own JSON writer gives the canonical form."""
    if isinstance(kind, T.ArrayType):
        return _is_plain(kind.elementType)
    nested = isinstance(kind, (T.StructType, T.MapType))
    return not (nested or isinstance(kind, T.FractionalType))


def _joined(parts: Column, begin: str, end: str) -> Column:
    return F.concat(F.lit(begin), F.array_join(parts, ","), F.lit(end))


def _number_inside(value: Column, kind: T.DataType) -> Column:
    return number_text(value, kind, nested=True)


def _number_written(value: Column, kind: T.DataType) -> Column:
    return value if isinstance(kind, T.DoubleType) else _number_inside(value, kind)


def json_text(
    value: Column,
    kind: T.DataType,
    number: Callable[[Column, T.DataType], Column] = number_text,
) -> Column:
    """Canonical JSON of a value of any type (P6): keys of structs and maps ascend at every depth.

    Keys of maps are the text of their values. Numbers are as in ``number_text``, moments as
    Spark's writer has them with all their microseconds; null is ``null``. ``number`` gives the text
    of numbers.
    """
    if isinstance(kind, (T.ArrayType, T.MapType)) and not _is_plain(kind) and number is number_text:
        number = _number_inside
        if pa and _text_type(kind) != kind and _passes_arrow(kind):
            value, number = _written(value, kind), _number_written
    if isinstance(kind, T.FractionalType):
        text = number(value, kind)
    elif _is_plain(kind):
        whole = F.to_json(F.struct(value.alias("v")), _PAYLOAD_OPTIONS)
        text = F.substr(whole, F.lit(6), F.length(whole) - 6)
    elif isinstance(kind, T.ArrayType):
        text = _joined(F.transform(value, lambda e: json_text(e, kind.elementType, number)), "[", "]")
    elif isinstance(kind, T.MapType):

        def by_key(one: Column, other: Column) -> Column:
            return F.when(one["key"] < other["key"], -1).when(one["key"] > other["key"], 1).otherwise(0)

        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                _key_text(e["key"], kind.keyType).alias("key"),
                json_text(e["value"], kind.valueType, number).alias("value"),
            ),
        )
        parts = F.transform(
            F.array_sort(entries, by_key),
            lambda e: F.concat(json_text(e["key"], T.StringType()), F.lit(":"), e["value"]),
        )
        text = _joined(parts, "{", "}")
    else:
        fields = [
            F.concat(
                F.lit(_name_text(f.name)), json_text(value.getField(f.name), f.dataType, number)
            )
            for f in sorted(kind.fields, key=lambda f: f.name.encode())
        ]
        text = F.when(value.isNotNull(), _joined(F.array(*fields), "{", "}"))
    return F.coalesce(text, F.lit("null"))


def _key_text(key: Column, kind: T.DataType) -> Column:
    if is_moment(kind):
        return utc_text(key, kind)
    if isinstance(kind, T.FractionalType):
        return F.translate(number_text(key, kind, True), '"', "")
    return key.cast("string")


def _name_text(name: str) -> str:
    return json.dumps(name, ensure_ascii=False) + ":"


def _sorted_json(values: dict[str, tuple[Column, T.DataType]]) -> Column:
    """JSON of named values, keys ascending; neighbours that Spark's writer can do go together."""
    parts: list[Column] = []
    names = sorted(values, key=str.encode)
    for plain, some in groupby(names, key=lambda name: _is_plain(values[name][1])):
        if plain:
            run = F.to_json(F.struct(*(values[n][0].alias(n) for n in some)), _PAYLOAD_OPTIONS)
            parts.append(F.substr(run, F.lit(2), F.length(run) - 2))
        else:
            parts += [F.concat(F.lit(_name_text(n)), json_text(*values[n])) for n in some]
    if len(parts) == 1 and names and _is_plain(values[names[0]][1]):
        return F.to_json(F.struct(*(values[n][0].alias(n) for n in names)), _PAYLOAD_OPTIONS)
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def raw_payload(df: DataFrame) -> Column:
    """Canonical JSON of a row with its original names and values."""
    if len(set(df.columns)) != len(df.columns):
        raise ValueError(f"duplicate column names in {df.columns}")
    return _sorted_json(
        {
            f.name: (raw_value(column_of(f.name), f.dataType), _text_kind(f.dataType))
            for f in df.schema.fields
        }
    )


def normalized_payload(df: DataFrame) -> Column:
    """Canonical JSON of a row after normalisation (P6 over P1-P5)."""
    names = normalized_names(df.columns)
    return _sorted_json(
        {
            names[f.name]: (
                normalized_value(column_of(f.name), f.dataType),
                _text_kind(f.dataType, T.BinaryType),
            )
            for f in df.schema.fields
        }
    )


def _text_kind(kind: T.DataType, *also: type) -> T.DataType:
    """The type of a value once moments, and ``also`` others, have become text."""
    return T.StringType() if is_moment(kind) or isinstance(kind, also) else kind


def hashed_form(payload: Column) -> Column:
    """The payload with its escapes written as the hash expects them."""
    escaped, concerned = payload, F.lit(False)
    for character, escape in HASH_ESCAPES.items():
        concerned = concerned | F.contains(payload, F.lit(character))
        escaped = F.replace(escaped, F.lit(character), F.lit(escape))
    # Most payloads hold none of these; looking for them costs far less than replacing.
    return F.when(concerned, escaped).otherwise(payload)


def message_body(*fields: Column) -> Column:
    """JSON of named fields in the given order; null fields are left out."""
    return F.to_json(F.struct(*fields))
