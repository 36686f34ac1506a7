"""Canonical JSON of numbers and nested values."""

import decimal
import json
import math
import random
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.payload import json_text, number_text, raw_payload


def plain_number(x):
    """The shortest digits, placed by the rules of the format."""
    if math.isnan(x) or math.isinf(x):
        return '"NaN"' if math.isnan(x) else ('"Infinity"' if x > 0 else '"-Infinity"')
    text = format(decimal.Decimal(repr(x)), "f") if x else "0"
    if x and not 1e-6 <= abs(x) < 1e21:
        mantissa, _, power = f"{decimal.Decimal(repr(x)).normalize():e}".partition("e")
        sign = "-" if power.startswith("-") else "+"
        return f"{mantissa}e{sign}{power.lstrip('+-')}"
    if "." in text:
        text = text.rstrip("0").rstrip(".")
    return ("-" if not x and math.copysign(1, x) < 0 else "") + text


def doubles():
    rng = random.Random(4)
    known = [
        0.0, -0.0, 1.0, 100.0, -100.0, 0.1, 123.45, 1e-6, 9.999e-7, 1e-7, 1.5e-10, 1e20, 1e21,
        123456789012345680000.0, 1.2345e21, -1e21, 1e22, 1e23, 2e23, 9.007199254740993e15, 1e7,
        12345678.9, 0.001, 0.0009, 1e100, 1.7976931348623157e308, 2.2250738585072014e-308,
        282879384806159008.0, 1.0000000000000002, 2.0**60, 5e15, 0.30000000000000004,
        float("nan"), float("inf"), float("-inf"),
    ]
    bits = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(1500)]
    cents = [round(rng.uniform(-1e6, 1e6), 2) for _ in range(500)]
    sums = [rng.random() * 10 ** rng.randint(-8, 24) for _ in range(1000)]
    sums += [rng.uniform(1, 10) * 10.0 ** rng.randint(15, 20) for _ in range(2000)]
    return [x for x in known + bits + cents + sums if not 0 < abs(x) < 2.3e-308]


def test_doubles(spark):
    values = doubles()
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double")
    got = dict(frame.select("i", number_text(F.col("x"), T.DoubleType())).collect())
    assert {i: got[i] for i in got} == {i: plain_number(x) for i, x in enumerate(values)}


def test_doubles_of_rows_take_no_formatting_expressions(spark):
    """Formatting by expressions took some 60 microseconds a row of five doubles of many digits."""
    values = [x for x in doubles() if math.isfinite(x)] + [5e-324, -1.5e-320, None]
    frame = spark.createDataFrame([(x, (x,)) for x in values], "x double, s struct<y: double>")
    encoded = frame.select("x", raw_payload(frame).alias("p"))
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert "format_string" not in plan and "lambda" not in plan
    for x, text in encoded.collect():
        number = "null" if x is None else plain_number(x)
        assert text == f'{{"s":{{"y":{number}}},"x":{number}}}'


@pytest.mark.parametrize("values", [[], [None], [1e15, None, 1.5e10, float("nan"), None]])
def test_doubles_in_arrays_and_rows_agree(spark, values):
    frame = spark.createDataFrame([(x, [x]) for x in values], "x double, a array<double>")
    rows = frame.select(json_text(F.col("x"), T.DoubleType()), json_text(F.col("a"), frame.schema["a"].dataType))
    assert all(f"[{one}]" == many for one, many in rows.collect())


def test_nested_doubles_take_no_formatting_expressions(spark):
    """Arrays, maps and structs of doubles, null at every depth; keys that are doubles still do."""
    rows = spark.sql(
        "SELECT array(array(5e-324D, null), null, array()) AS a, map('k', 1.5e15D, 'j', null) AS m,"
        " array(named_struct('z', map(1, array(double('NaN'))), 'y', 1L, 'x', true), null) AS s,"
        " cast(null AS array<double>) AS n, cast(null AS map<string, struct<a: double>>) AS o,"
        " array(timestamp_ntz'2024-01-02 03:04:05') AS t FROM range(3)"
    )
    encoded = rows.select(raw_payload(rows).alias("p"))
    assert "format_string" not in encoded._jdf.queryExecution().executedPlan().toString()
    assert [r.p for r in encoded.collect()] == [
        '{"a":[[5e-324,null],null,[]],"m":{"j":null,"k":1500000000000000},"n":null,"o":null,'
        '"s":[{"x":true,"y":1,"z":{"1":["NaN"]}},null],"t":["2024-01-02T03:04:05.000000"]}'
    ] * 3
    keyed = spark.sql("SELECT map(1.5e15D, 2.5e15D) AS m")
    assert keyed.select(raw_payload(keyed)).first()[0] == '{"m":{"1500000000000000":2500000000000000}}'


def test_floats_and_decimals(spark):
    frame = spark.sql(
        "SELECT CAST('0.1' AS float) AS f, CAST('1e10' AS float) AS g, CAST('100' AS decimal(10,2)) AS d,"
        " CAST('0.0000000000000000010' AS decimal(38,19)) AS e, CAST('-12.50' AS decimal(10,2)) AS h,"
        " CAST('123456789012345678901234567890' AS decimal(38,0)) AS k, CAST(NULL AS decimal(5,2)) AS n,"
        " CAST('0.00' AS decimal(5,2)) AS z"
    )
    assert json.loads(frame.select(raw_payload(frame).alias("p")).first().p, parse_float=str, parse_int=str) == {
        "f": "0.1", "g": "10000000000", "d": "100", "e": "0.000000000000000001", "h": "-12.5",
        "k": "123456789012345678901234567890", "n": None, "z": "0",
    }


NESTED = """
SELECT named_struct('b', 1.0D, 'a', named_struct('z', 'q"', 'y', timestamp_ntz'2024-01-02 03:04:05.5'),
                    'C', cast(null AS int)) AS s,
       map('k2', 2.50D, 'k1', cast(null AS double), 'K', 1e21D) AS m,
       map(10, array(1.0D, null), 9, array()) AS n,
       array(named_struct('y', 1, 'x', date'2024-05-06'), null) AS l,
       cast(null AS struct<a: int>) AS o, cast(null AS map<string, int>) AS p,
       cast(array() AS array<double>) AS q, 'plain' AS r, 3 AS `a b`, X'0102' AS t
"""


def test_nested_keys_ascend(spark):
    frame = spark.sql(NESTED)
    assert frame.select(raw_payload(frame).alias("p")).first().p == (
        '{"a b":3,"l":[{"x":"2024-05-06","y":1},null],"m":{"K":1e+21,"k1":null,"k2":2.5},'
        '"n":{"10":[1,null],"9":[]},"o":null,"p":null,"q":[],"r":"plain",'
        '"s":{"C":null,"a":{"y":"2024-01-02T03:04:05.500000","z":"q\\""},"b":1},"t":"AQI="}'
    )


def test_order_of_columns_and_keys_does_not_matter(spark):
    one = spark.sql("SELECT map('a', 1, 'b', 2) AS m, named_struct('x', 1, 'y', 2) AS s")
    other = spark.sql("SELECT named_struct('y', 2, 'x', 1) AS s, map('b', 2, 'a', 1) AS m")
    assert one.select(raw_payload(one)).first()[0] == other.select(raw_payload(other)).first()[0]


@pytest.mark.parametrize("rows", [0, 2])
def test_empty_and_null(spark, rows):
    frame = spark.createDataFrame([(None, None)] * rows, "x double, s struct<a: double>")
    got = frame.select(raw_payload(frame).alias("p"), json_text(F.col("x"), T.DoubleType()).alias("x"))
    assert [tuple(r) for r in got.collect()] == [('{"s":null,"x":null}', "null")] * rows
