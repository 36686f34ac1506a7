import decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import cursors
from tidemark.functions.values import column_of


def texts(rows, column):
    """Checkpoint text through the sortable struct, and straight from the column."""
    kind = rows.schema[column].dataType
    packed = rows.select(cursors.sortable(column_of(column), kind).alias("cursor"))
    through = packed.agg(cursors.checkpoint_text(F.max("cursor"), kind).alias("v")).first().v
    return through, cursors.high_water_mark(rows, column).first().last_value


@pytest.mark.parametrize(
    "sql, expected",
    [
        ("SELECT explode(array(9L, 10L, NULL)) AS c", "10"),
        ("SELECT explode(array(9, -10)) AS c", "9"),
        ("SELECT explode(array(9.25BD, 10.5BD)) AS c", "10.50"),
        ("SELECT explode(array(9.5D, 10.25D)) AS c", "10.25"),
        ("SELECT explode(array('b', 'a')) AS c", "b"),
        ("SELECT explode(array(date '2024-01-02', date '2023-01-01')) AS c",
         "2024-01-02T00:00:00Z"),
        ("SELECT explode(array(timestamp_ntz '2024-01-02 00:00:00.5', NULL)) AS c",
         "2024-01-02T00:00:00.5Z"),
        ("SELECT explode(array(timestamp '2024-01-02 00:00:00+01:00')) AS c",
         "2024-01-01T23:00:00Z"),
        ("SELECT cast(NULL AS bigint) AS c", None),
    ],
)
def test_high_water_mark(spark, sql, expected):
    assert texts(spark.sql(sql), "c") == (expected, expected)


@pytest.mark.parametrize("kind", ["boolean", "binary", "array<int>"])
def test_unusable_cursor_types(spark, kind):
    rows = spark.sql(f"SELECT cast(NULL AS {kind}) AS c")
    with pytest.raises(ValueError, match="cannot be a cursor"):
        texts(rows, "c")


@pytest.mark.parametrize(
    "sql, last, left",
    [
        ("SELECT explode(array(9L, 10L, 11L, NULL)) AS c", "9", 2),
        ("SELECT explode(array(timestamp_ntz '2024-01-02 00:00:00', "
         "timestamp_ntz '2024-01-02 00:00:00.000001')) AS c", "2024-01-02T00:00:00Z", 1),
        ("SELECT explode(array(timestamp '2024-01-02 00:00:00Z', "
         "timestamp '2024-01-02 00:00:01Z')) AS c", "2024-01-02T00:00:00Z", 1),
        ("SELECT explode(array(date '2024-01-02', date '2024-01-03')) AS c",
         "2024-01-02T00:00:00Z", 1),
        ("SELECT explode(array('a', 'b', 'c')) AS c", "a", 2),
    ],
)
def test_strictly_newer(spark, sql, last, left):
    rows = spark.sql(sql)
    assert cursors.newer_than(rows, "C", last).count() == left
    assert cursors.newer_than(rows, "c", None).count() == rows.count()
    assert cursors.newer_than(rows, "c", "").count() == rows.count()


def test_bad_checkpoint_text_is_an_error(spark):
    rows = spark.sql("SELECT 1L AS c")
    with pytest.raises(PySparkException):
        cursors.newer_than(rows, "c", "<nil>").collect()


@pytest.mark.parametrize(
    "sql, last, back, left",
    [
        ("SELECT explode(array(5L, 9L, 10L)) AS c", "9", 4, 2),
        ("SELECT explode(array(timestamp_ntz '2024-01-01 23:59:59.5', "
         "timestamp_ntz '2024-01-01 23:00:00')) AS c", "2024-01-02T00:00:00Z", 1, 1),
        ("SELECT explode(array(date '2024-01-01', date '2024-01-02')) AS c",
         "2024-01-02T00:00:00Z", 86400 * 1.5, 2),
    ],
)
def test_lookback(spark, sql, last, back, left):
    assert cursors.newer_than(spark.sql(sql), "c", last, back).count() == left


def test_lookback_needs_an_orderable_distance(spark):
    with pytest.raises(ValueError, match="lookback"):
        cursors.newer_than(spark.sql("SELECT 'a' AS c"), "c", "a", 1)


def test_filter_reaches_the_scan(spark, testdata):
    events = spark.read.parquet(f"{testdata}/events.parquet")
    rows = cursors.newer_than(events, "ts", "2024-01-20T00:00:00Z").select("event_id")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,2024-01-20T00:00)" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_should_save(spark):
    rows = spark.createDataFrame(
        [("2", "1"), ("1", "1"), (None, "1"), ("", None), ("1", None)], "new string, old string"
    )
    got = rows.select(cursors.should_save(F.col("new"), F.col("old")).alias("s")).collect()
    assert [r.s for r in got] == [True, False, False, False, True]


@pytest.mark.parametrize("kind", ["decimal(38,12)", "decimal(38,0)", "decimal(14,14)", "decimal(38,38)"])
def test_any_decimal_is_a_cursor(spark, kind):
    """Decimals beyond the log's number field sort and read back exactly."""
    precision, scale = map(int, kind[8:-1].split(","))
    top = decimal.Decimal(10 ** precision - 1).scaleb(-scale, decimal.Context(prec=60))
    step = decimal.Decimal(1).scaleb(-scale)
    close = decimal.Context(prec=60)
    numbers = [
        top.copy_negate(), close.add(top.copy_negate(), step), -10 * step, -9 * step, -step,
        0 * step, step, 9 * step, 10 * step, close.subtract(top, step), top,
    ]
    told = spark.createDataFrame([(f"{n:f}",) for n in reversed(numbers)], "c string")
    rows = told.select(F.col("c").cast(kind))
    field = rows.schema["c"].dataType
    packed = rows.select("c", cursors.sortable(F.col("c"), field).alias("cursor"))
    by_cursor = packed.orderBy("cursor").select(
        "c", cursors.checkpoint_text(F.col("cursor"), field).alias("text")
    ).collect()
    assert [row.c for row in by_cursor] == numbers
    assert [decimal.Decimal(row.text) for row in by_cursor] == numbers
    for place, row in enumerate(by_cursor):
        assert cursors.newer_than(rows, "c", row.text).count() == len(numbers) - 1 - place
    none = spark.createDataFrame([(None,)], f"c {kind}")
    assert texts(none, "c") == (None, None)
