"""Read ranges by counts, with Spark in the place of the source."""

import datetime
import itertools
import random
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tidemark.sources.ranges import KeyRanges, literal


def layout(spark, values, kind, shares, tolerance=0.0):
    """(keys per share, predicates, queries) of a source that holds ``values``."""
    rows = spark.createDataFrame([(v,) for v in values], f"k {kind}")
    rows.createOrReplaceTempView("source_keys")
    asked = []

    def fetch(query):
        asked.append(query)
        return spark.sql(query).collect()

    ranges = KeyRanges(fetch, "mysql", "source_keys", "`k`", rows.schema["k"].dataType, "", tolerance)
    found = ranges.predicates(shares)
    flags = rows.selectExpr("k", *(f"coalesce({p}, false) AS p{n}" for n, p in enumerate(found)))
    parts = [[] for _ in found]
    for row in flags.collect():
        hit = [n for n, flag in enumerate(row[1:]) if flag]
        assert len(hit) == 1, (row, found)
        parts[hit[0]].append(row[0])
    return parts, found, asked


def exact(values, shares):
    """Sizes of the shares by the definition, over keys that are not null."""
    keys = sorted(v for v in values if v is not None)
    edges = []
    for share in range(1, shares):
        starts = [k for n, k in enumerate(keys) if (not n or keys[n - 1] != k) and n * shares >= share * len(keys)]
        if starts and starts[0] not in edges:
            edges.append(starts[0])
    sizes = [sum(1 for k in keys if sum(e <= k for e in edges) == n) for n in range(len(edges) + 1)]
    return sizes


RNG = random.Random(5)
START = datetime.datetime(2024, 1, 1)
KEYS = {
    "bigint": [int(RNG.lognormvariate(9, 4)) for _ in range(900)] + [7] * 300 + [2**62, -(2**62)],
    "double": [RNG.lognormvariate(0, 20) for _ in range(700)] + [-1e308, 1e308, 0.0],
    "decimal(30,6)": [Decimal(RNG.randrange(10**9)) / 1000 for _ in range(600)],
    "timestamp_ntz": [START + datetime.timedelta(milliseconds=int(RNG.lognormvariate(10, 3))) for _ in range(800)],
    "date": [START.date() + datetime.timedelta(days=int(RNG.expovariate(0.01))) for _ in range(500)],
    "string": ["".join(RNG.choices("aab'\\%é漢", k=RNG.randrange(9))) for _ in range(700)] + ["b" * 5_000] * 40,
}


@pytest.mark.parametrize("kind", KEYS)
def test_shares_are_even(spark, kind):
    values = KEYS[kind]
    parts, found, asked = layout(spark, values, kind, 12)
    assert [len(part) for part in parts] == exact(values, 12)
    assert len(asked) <= 20
    for one, other in itertools.pairwise(parts):
        assert max(one) < min(other)
    rough, _, fewer = layout(spark, values, kind, 12, 0.5)
    assert sum(map(len, rough)) == len(values) and len(fewer) <= len(asked)
    heaviest = max(values.count(v) for v in set(values))
    assert max(map(len, rough)) <= max(heaviest, 0) + 2 * len(values) / 12 + 1


def test_a_hot_key_is_a_share_of_its_own(spark):
    values = list(range(1000)) + [500] * 2000 + [10**15]
    parts, _, _ = layout(spark, values, "bigint", 6)
    assert [len(part) for part in parts] == exact(values, 6)
    assert sorted(map(len, parts))[-1] >= 2001


def test_null_keys(spark):
    few, found, _ = layout(spark, [None, *range(100)], "bigint", 4)
    assert [len(part) for part in few] == [26, 25, 25, 25] and "OR `k` IS NULL" in found[0]
    many, found, _ = layout(spark, [None] * 100 + list(range(100)), "bigint", 4)
    assert [len(part) for part in many] == [100, 25, 25, 25, 25] and found[0] == "`k` IS NULL"


@pytest.mark.parametrize(
    "kind, values",
    [("bigint", []), ("bigint", [None, None]), ("string", ["a", "a"]), ("double", [float("nan"), 1.0]),
     ("double", [float("inf"), 2.0]), ("bigint", [3])],
)
def test_keys_without_ranges(spark, kind, values):
    assert layout(spark, values, kind, 5)[1] == ["1 = 1"]


def test_literals():
    assert literal("mysql", "a'\\b") == "'a\\'\\\\b'"
    assert literal("postgres", "a'\\b") == "'a''\\b'"
    assert literal("sqlserver", "é'") == "N'é'''"
    assert literal("postgres", 1e21) == "1000000000000000000000"
    assert literal("mysql", datetime.datetime(2024, 1, 2, 3, 4, 5, 678901)) == "'2024-01-02 03:04:05.678'"
    assert literal("mysql", datetime.date(2024, 1, 2)) == "'2024-01-02'"


@pytest.mark.parametrize("connector", ["postgres", "mysql", "sqlserver"])
def test_every_connector_has_a_place_for_keys(connector):
    for kind in (T.LongType(), T.DateType(), T.TimestampNTZType(), T.StringType()):
        asked = []

        def fetch(query):
            asked.append(query)
            return [(0, 4, None, None, None, None)]

        assert KeyRanges(fetch, connector, "t", "k", kind).predicates(9) == ["1 = 1"]
        assert "MIN(place)" in asked[0]
