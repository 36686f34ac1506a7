import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import hash_key, normalized_key, raw_key
from tidemark.functions.payload import normalized_payload, raw_payload


def keys_of(rows, technical_key, bits=64):
    got = rows.select(
        raw_key(rows, technical_key, raw_payload(rows), bits).alias("raw"),
        normalized_key(rows, technical_key, normalized_payload(rows), bits).alias("normal"),
    )
    return [(r.raw, r.normal) for r in got.collect()]


def digest(value, digits=16):
    text = json.dumps(value, separators=(",", ":"), ensure_ascii=False, sort_keys=True)
    for c in "&<>  ":
        text = text.replace(c, f"\\u{ord(c):04x}")
    return hashlib.sha256(text.encode()).hexdigest()[:digits]


def test_hash_of_payload(spark):
    rows = spark.createDataFrame([(1, 'a<b>&"  \\u003cé')], "n int, t string")
    value = {"n": 1, "t": 'a<b>&"  \\u003cé'}
    assert keys_of(rows, None) == [(digest(value), digest(value))]
    assert keys_of(rows, None, 256) == [(digest(value, 64),) * 2]


def test_key_does_not_depend_on_column_order(spark):
    rows = spark.createDataFrame([(1, "x", None)], "b int, a string, c string")
    assert keys_of(rows, None) == keys_of(rows.select("c", "a", "b"), None)


def test_technical_key_by_normalised_name(spark):
    rows = spark.createDataFrame([(" k ", 1)], "` Id ` string, n int")
    assert keys_of(rows, "ID") == [(" k ", "k")]


def test_null_and_absent_technical_key_fall_back(spark):
    rows = spark.createDataFrame([(None, 1)], "id int, n int")
    expected = digest({"id": None, "n": 1})
    assert keys_of(rows, "id") == [(expected, expected)]
    assert keys_of(rows, "missing") == [(expected, expected)]


def test_moment_and_binary_keys(spark):
    rows = spark.sql("SELECT timestamp_ntz '2024-01-02 03:04:05.5' AS t, X'2041' AS b")
    assert keys_of(rows, "t") == [("2024-01-02T03:04:05.5Z",) * 2]
    assert keys_of(rows, "b") == [(" A", " A")]


def test_equal_rows_have_one_key(spark):
    rows = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x")], "n int, t string")
    assert len({raw for raw, _ in keys_of(rows, None)}) == 2


def test_width_is_checked(spark):
    with pytest.raises(ValueError):
        hash_key(F.lit("x"), 6)
