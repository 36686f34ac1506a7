"""Poisson replication against SQL and against its target weights."""

import math

import duckdb
from pyspark.sql import functions as F

from tidemark.llm import mixing

from .samples import values


def test_inverse_matches_distribution(spark):
    for mean in (0.0, 0.3, 1.0, 7.5, 15.9):
        us = [k / 997 for k in range(997)] + [1 - 2**-52]
        frame = spark.createDataFrame([(u, mean) for u in us], "u double, mean double")
        got = [r[0] for r in frame.select(mixing.poisson(F.col("mean"), F.col("u"))).collect()]
        for u, k in list(zip(us, got, strict=True))[:-1]:
            below = sum(math.exp(-mean) * mean**i / math.factorial(i) for i in range(k))
            assert below <= u + 1e-9 and u <= below + math.exp(-mean) * mean**k / math.factorial(k) + 1e-9
        assert got[-1] < 100


def test_weights_are_reached(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, "rare")
        .when(F.col("id") % 7 == 2, "zero").when(F.col("id") % 5 == 1, F.lit(None))
        .otherwise("other").alias("source"),
    )
    weights = {"hot": 1, "rare": 2, "zero": 0, None: 1, "absent": 5}
    mixed = mixing.mix(docs, weights, total=30_000)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert set(counts) == {"hot", "rare", None}
    for source, share in (("hot", 0.25), ("rare", 0.5), (None, 0.25)):
        assert abs(counts[source] - 30_000 * share) < 6 * math.sqrt(30_000 * share)
    again = mixing.mix(docs.repartition(3), weights, total=30_000, partitions=2)
    assert values(again, *mixed.columns) == values(mixed, *mixed.columns)


def test_by_size_and_columns(spark):
    rows = [(1, "a", "x" * 30, "old"), (2, "b", "y", "old"), (2, "b", "y", "old"), (None, "b", None, "old")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, copy string")
    mixed = mixing.mix(docs, {"a": 1, "b": 1}, total=400, size=F.coalesce(F.length("text"), F.lit(1)))
    assert mixed.columns == ["doc_id", "source", "text", "copy", "mix_key"]
    got = mixed.collect()
    twice = [r for r in got if r.doc_id == 2]
    assert len(twice) % 2 == 0 and len(twice) > 50
    assert 1 <= sum(r.doc_id == 1 for r in got) <= 20


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, source string")
    assert mixing.mix(docs).collect() == [] == mixing.mix(docs, {"a": 1}).collect()


def test_matches_sql(spark):
    rows = [(k, None if k % 11 == 0 else f"s{k % 3 * (k % 2)}", None if k == 5 else f"t{k}") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed = mixing.mix(docs).withColumn("text_md5", F.md5("text"))
    duck = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841
    duck.register("documents", documents)
    found = duck.sql(mixing.mix_sql("documents"))
    order = ["doc_id", "source", "copy", "mix_key", "text_md5"]
    want = sorted((tuple(r[found.columns.index(c)] for c in order) for r in found.fetchall()), key=repr)
    assert values(mixed, *order) == want


def test_large_rates_keep_the_variance(spark):
    """A source repeated 50 times on average has counts that vary like a Poisson number of mean 50."""
    docs = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 4000, "small").otherwise("rest").alias("source")
    )
    mixed = mixing.mix(docs, {"small": 1, "rest": 1}, total=400_000)
    counts = mixed.where("source = 'small'").groupBy("doc_id").count()
    row = counts.agg(F.avg("count"), F.var_samp("count"), F.count("*")).first()
    assert row[2] == 4000
    assert abs(row[0] - 50) < 6 * math.sqrt(50 / 4000)
    assert abs(row[1] - 50) < 6 * 50 * math.sqrt(2 / 4000)


def test_large_rates_match_sql(spark):
    rows = [(k, "rare" if k < 3 else "common", f"t{k}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed = mixing.mix(docs).withColumn("text_md5", F.md5("text"))
    assert mixed.where("source = 'rare'").count() > 90
    duck = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841
    duck.register("documents", documents)
    found = duck.sql(mixing.mix_sql("documents"))
    order = ["doc_id", "source", "copy", "mix_key", "text_md5"]
    want = sorted((tuple(r[found.columns.index(c)] for c in order) for r in found.fetchall()), key=repr)
    assert values(mixed, *order) == want
