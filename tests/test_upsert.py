import random

from pyspark.sql import functions as F

from tidemark.operators import ledger
from tidemark.operators.upsert import delete, latest, upsert, upsert_newer


def sample(seed, n=400):
    chance = random.Random(seed)
    return [
        (chance.choice(["hot", "hot", *"abcdefgh"]), chance.randrange(20), chance.randrange(5))
        for _ in range(n)
    ]


def brute(rows):
    best = {}
    for key, at, value in rows:
        best[key] = max(best.get(key, (-1, -1)), (at, value))
    return sorted((key, *rest) for key, rest in best.items())


def test_latest_against_brute_force(spark):
    for seed in range(3):
        rows = sample(seed)
        frame = spark.createDataFrame(rows, "k string, at int, v int")
        for shaped in (frame, frame.repartition(7), frame.orderBy(F.desc("v"))):
            assert sorted(map(tuple, latest(shaped, ["k"], ["at"]).collect())) == brute(rows)


def test_aggregate_is_combined_before_the_shuffle(spark):
    frame = spark.createDataFrame(sample(1), "k string, at int, v int")
    plan = latest(frame, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert plan.count("Exchange") == 1


def test_keep_first(spark):
    frame = spark.createDataFrame(
        [("a", 1, "created", "x"), ("a", 2, "later", "y")], "k string, at int, born string, v string"
    )
    assert latest(frame, ["k"], ["at"], ["born"]).collect() == [("a", 2, "created", "y")]


def test_upsert_forms_agree(spark):
    old = sample(5)
    new = [(key, at + 100, value) for key, at, value in sample(6, 50)]
    schema = "k string, at int, v int"
    current = latest(spark.createDataFrame(old, schema), ["k"], ["at"])
    incoming = spark.createDataFrame(new, schema)
    general = upsert(current, incoming, ["k"], ["at"])
    quick = upsert_newer(current, incoming, ["k"], ["at"])
    assert sorted(general.collect()) == sorted(quick.collect())
    assert sorted(map(tuple, general.collect())) == brute(old + new)


def test_newer_rows_do_not_shuffle_the_large_side(spark, tmp_path):
    path = str(tmp_path / "base")
    spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("at")).write.parquet(path)
    incoming = spark.range(5).select(F.col("id").alias("k"), F.lit(2).alias("at"))
    quick = upsert_newer(spark.read.parquet(path), incoming, ["k"], ["at"])
    quick.collect()
    plan = quick._jdf.queryExecution().executedPlan().toString()
    final = plan.split("+- == Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "LeftAnti" in final


def test_delete(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    gone = spark.createDataFrame([("a", "x"), ("c", "y")], "k string, other string")
    assert delete(rows, gone, ["k"]).collect() == [("b", 2)]


def test_untouched_since_full(spark):
    records = spark.createDataFrame(
        [
            ("t", "s", "d", "old", "f1", 1), ("t", "s", "d", "seen", "f2", 2),
            ("t", "s", "d", "later", "i3", 3), ("t", "s", "other", "x", "f1", 1),
        ],
        "tenant_id string, source_id string, dataset_id string, record_key string, "
        "execution_id string, started_at int",
    )
    runs = spark.createDataFrame(
        [("t", "s", "d", "f1", 1), ("t", "s", "d", "f2", 2)],
        "tenant_id string, source_id string, dataset_id string, execution_id string, "
        "started_at int",
    )
    got = ledger.untouched_since_full(records, runs).select("record_key").collect()
    assert [r.record_key for r in got] == ["old"]
