import pytest
from pyspark.sql import functions as F

from tidemark.operators import batches


def brute_pages(keys, size):
    pages = {}
    for place, key in enumerate(sorted(keys)):
        pages.setdefault(place // size + 1, []).append(key)
    return {number: (len(p), p[0], p[-1]) for number, p in pages.items()}


def ledger(rows, key, size, tie=()):
    got = batches.batch_ledger(rows, key, size, tie).collect()
    return {r.batch_number: (r.records_in_batch, r.first_key, r.last_key) for r in got}


@pytest.mark.parametrize("size", [1, 7, 100, 1000])
def test_unique_keys(spark, size):
    rows = spark.range(0, 250, 1, 5).select(((F.col("id") * 7919) % 1000).alias("k"))
    keys = [r.k for r in rows.collect()]
    assert ledger(rows, "k", size) == brute_pages(keys, size)


def test_hot_key_is_spread_over_ranges(spark, tmp_path):
    rows = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 11).alias("k"),
        F.col("id"),
    )
    keys = [r.k for r in rows.collect()]
    assert ledger(rows, "k", 100) == brute_pages(keys, 100)
    numbered = batches.number_rows(rows, "k", 100)
    again = batches.number_rows(rows.repartition(3), "k", 100)
    assert sorted(numbered.collect()) == sorted(again.collect())

    folder = str(tmp_path / "numbered")
    batches.number_rows(rows, "k", 100, partitions=6, folder=folder)
    hot = spark.read.parquet(folder).where("k = 5").groupBy("_range").count()
    assert hot.count() > 1
    assert hot.agg(F.max("count")).first()[0] < 2500


def test_nulls_come_last(spark):
    rows = spark.createDataFrame([(None,), (2,), (1,)], "k int")
    got = {r.k: r.batch_number for r in batches.number_rows(rows, "k", 1).collect()}
    assert got == {1: 1, 2: 2, None: 3}


def test_empty(spark):
    rows = spark.createDataFrame([], "k int")
    assert batches.batch_ledger(rows, "k", 10).count() == 0


def test_batch_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        batches.number_rows(spark.range(3), "id", 0)


def test_batches_from_counts(spark):
    rows = spark.createDataFrame(
        [("a", 0, 10), ("b", 25, 10), ("c", 20, 10), ("d", 1500, 0), ("e", 25_001, 1)],
        "execution_id string, total_records bigint, batch_size int",
    )
    got = batches.batches_of(rows)
    counted = {
        r.execution_id: (r.n, r.rows, r.last)
        for r in got.groupBy("execution_id")
        .agg(
            F.count("*").alias("n"),
            F.sum("records_in_batch").alias("rows"),
            F.max("batch_number").alias("last"),
        )
        .collect()
    }
    assert counted == {
        "b": (3, 25, 3), "c": (2, 20, 2), "d": (2, 1500, 2), "e": (25_001, 25_001, 25_001)
    }


def test_maps_take_part(spark, tmp_path):
    rows = spark.range(7).selectExpr("id % 2 AS k", "map('a', id) AS m")
    got = batches.number_rows(rows, "k", 3, folder=str(tmp_path / "numbered")).collect()
    assert sorted(r.batch_number for r in got) == [1, 1, 1, 2, 2, 2, 3]
    found = batches.batch_ledger(rows, "k", 3, folder=str(tmp_path / "ledger"))
    assert found.count() == 3 and (tmp_path / "ledger").exists()
