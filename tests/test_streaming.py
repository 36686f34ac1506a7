import pytest
from pyspark.sql import functions as F

from tidemark import Dataset, Execution, run_sync, schemas
from tidemark.streaming import topics
from tidemark.streaming.ingest import stream_rows
from tidemark.streaming.upserts import changes, current_records, stream_upserts


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


@pytest.mark.parametrize(
    "text, good",
    [
        ('{"tenant_id":"t","source_id":"s","dataset_id":"d","timestamp":"2024-01-02T03:04:05Z"}',
         True),
        ('{"tenant_id":"t","unknown":1}', True), ("{}", True), ("{bad", False), ("", False),
        ("[1]", False), ('{"tenant_id":"t","timestamp":"yesterday"}', False),
    ],
)
def test_parse(spark, text, good):
    rows = spark.createDataFrame([(text,)], "value string")
    got = topics.parse(rows, schemas.SYNC_REQUEST).first()
    assert (got.error is None) == good and got.body == text


def test_restarted_ingest_takes_up_where_it_stopped(spark, store, tmp_path):
    arrivals, offsets = str(tmp_path / "in"), str(tmp_path / "offsets")
    dataset = Dataset("t", "s", "d", "incremental", "id", "key", "id", batch_size=10)

    def run():
        rows = spark.readStream.schema("id bigint, v string").parquet(arrivals)
        finish(stream_rows(store, rows, dataset, "arrivals", offsets))

    spark.range(0, 50).select("id", F.lit("a").alias("v")).write.parquet(arrivals)
    run()
    spark.range(40, 60).select("id", F.lit("b").alias("v")).write.mode("append").parquet(arrivals)
    run()
    run()
    rows = store.normalized(dataset.identity)
    assert rows.count() == 60
    assert rows.where("payload LIKE '%\"b\"%'").count() == 20
    ledger = {r.execution_id: r.total_records for r in store.executions.current().collect()}
    assert ledger == {"arrivals-000000000000": 50, "arrivals-000000000001": 20}


def test_repeated_micro_batch_writes_nothing_twice(spark, store, tmp_path):
    arrivals = str(tmp_path / "in")
    spark.range(0, 50).write.parquet(arrivals)
    dataset = Dataset("t", "s", "d", technical_key="id")
    for attempt in ("one", "two"):
        rows = spark.readStream.schema("id bigint").parquet(arrivals)
        finish(stream_rows(store, rows, dataset, "arrivals", str(tmp_path / attempt)))
    assert store.log().count() == 50
    assert store.executions.current().count() == 1


def test_batches_of_a_snapshot_are_not_written_again(spark, store, tmp_path):
    arrivals = str(tmp_path / "in")
    dataset = Dataset("t", "s", "d", "incremental", "id", "key", "id")

    def run(offsets):
        rows = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(arrivals)
        finish(stream_rows(store, rows, dataset, "arrivals", str(tmp_path / offsets)))

    spark.range(0, 50, 1, 1).write.parquet(arrivals)
    run("one")
    spark.range(50, 80, 1, 1).write.mode("append").parquet(arrivals)
    run("one")
    store.drop(store.compact(dataset.identity))
    before = store.last_value(dataset.identity)
    run("two")
    assert store.log().count() == 0 and store.normalized(dataset.identity).count() == 80
    assert store.last_value(dataset.identity) == before == "79"
    spark.range(80, 90, 1, 1).write.mode("append").parquet(arrivals)
    run("two")
    assert store.normalized(dataset.identity).count() == 90


def test_ingest_keeps_cursor_and_tells(spark, store, tmp_path):
    arrivals = str(tmp_path / "in")
    dataset = Dataset("t", "s", "d", "incremental", "id", "key", "id")
    spark.range(0, 50).write.parquet(arrivals)

    def run():
        rows = spark.readStream.schema("id bigint").parquet(arrivals)
        finish(stream_rows(store, rows, dataset, "arrivals", str(tmp_path / "offsets")))

    run()
    assert store.last_value(dataset.identity) == "49"
    spark.range(10, 20).write.mode("append").parquet(arrivals)
    run()
    assert store.last_value(dataset.identity) == "49"
    topics_told = {r.topic for r in store.messages().collect()}
    assert any("started" in t for t in topics_told) and any("completed" in t for t in topics_told)
    result = run_sync(store, dataset, lambda: spark.range(0, 60), Execution("later"))
    assert (result.total_records, result.last_value) == (10, "59")


def test_failed_and_empty_batches(spark, store, tmp_path):
    arrivals = str(tmp_path / "in")
    spark.range(0, 5).write.parquet(arrivals)
    dataset = Dataset("t", "s", "d", technical_key="id")
    rows = spark.readStream.schema("id bigint").parquet(arrivals)
    broken = rows.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    query = stream_rows(store, broken, dataset, "broken", str(tmp_path / "one"))
    with pytest.raises(Exception, match="no"):
        query.awaitTermination()
    assert store.log().count() == 0
    none = rows.where("id > 100")
    finish(stream_rows(store, none, dataset, "none", str(tmp_path / "two")))
    assert {r.status for r in store.executions.current().collect()} <= {"failed"}
    assert store.attempts.changes().count() == 0


def test_repeated_batch_keeps_rejects_once(spark, store, tmp_path):
    folder, offsets = str(tmp_path / "in"), tmp_path / "offsets"
    lines = ["{bad", '{"tenant_id":"t"}', '{"tenant_id":"t","source_id":"s","dataset_id":"d"}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(folder)
    for _ in range(2):
        stream = topics.read_messages(spark, "text", {}, folder)
        finish(topics.reset_requests(store, stream, str(offsets)))
        assert store.rejected().count() == 2
        for commit in (offsets / "commits").iterdir():  # as if the driver had died before it
            commit.unlink()


def test_sync_requests_of_several_files(spark, store, tmp_path, testdata):
    from tidemark.sources.tables import parquet_folder

    store.sources.upsert(
        store.sources.one_row(tenant_id="t", source_id="s", connector_type="postgres")
    )
    store.datasets.upsert(
        store.datasets.one_row(
            tenant_id="t", source_id="s", dataset_id="part", table_name="part",
            sync_mode="incremental", incremental_column="p_partkey", incremental_type="key",
            technical_key="p_partkey", batch_size=1000, enabled=True,
        )
    )
    folder, offsets = str(tmp_path / "in"), str(tmp_path / "offsets")

    def send(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").write.mode("append").text(
            folder
        )

    def run():
        stream = topics.read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, folder)
        finish(topics.sync_requests(store, stream, parquet_folder(spark, testdata), offsets))

    def request(execution_id):
        return f'{{"tenant_id":"t","source_id":"s","dataset_id":"part","execution_id":"{execution_id}"}}'

    send(request("e1"), "{bad")
    run()
    send(request("e2"))
    run()
    ledger = {r.execution_id: r.total_records for r in store.executions.current().collect()}
    assert ledger == {"e1": spark.read.parquet(f"{testdata}/part.parquet").count(), "e2": 0}
    assert [tuple(r) for r in store.rejected().collect()] == [("sync", "{bad", "malformed message")]


def test_upserts_by_state_write_only_changes(spark, tmp_path):
    arrivals, offsets, out = (str(tmp_path / name) for name in ("in", "offsets", "out"))
    kind = "key string, at int, first_seen string, last double"  # names that are used inside, too
    batches = [
        [("a", 1, "x", 1.0), ("a", 3, "y", None), ("b", 2, "z", 1.0), (None, 1, "n", 0.0)],
        [("a", 2, "late", 1.0), ("b", 2, "z", 1.0), ("c", None, "", 1.0), (None, 2, "m", 0.0)],
        [],
        [("a", 3, "y", 5.0), ("c", None, "", 1.0), ("b", None, "zz", 9.0), ("d", 1, "q" * 99_999, 1.0)],
    ]
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    schema = spark.createDataFrame([], kind).schema
    for rows in batches:
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(schema).parquet(arrivals)
        finish(stream_upserts(stream, ["key"], ["at"], out, offsets))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider
    found = changes(spark, out, schema)
    per_batch = {}
    for row in found.collect():
        per_batch.setdefault(row.batch, set()).add((row.key, row.at, row.first_seen[:5], row.last))
    numbers = sorted(per_batch)
    assert [per_batch[n] for n in numbers] == [
        {("a", 3, "y", None), ("b", 2, "z", 1.0), (None, 1, "n", 0.0)},
        {("c", None, "", 1.0), (None, 2, "m", 0.0)},
        {("a", 3, "y", 5.0), ("d", 1, "qqqqq", 1.0)},
    ]
    now = {r.key: (r.at, r.last) for r in current_records(spark, out, schema, ["key"], ["at"]).collect()}
    assert now == {"a": (3, 5.0), "b": (2, 1.0), "c": (None, 1.0), "d": (1, 1.0), None: (2, 0.0)}
    stream = spark.readStream.schema(schema).parquet(arrivals)  # anew, without the state
    finish(stream_upserts(stream, ["key"], ["at"], out, str(tmp_path / "other")))
    again = current_records(spark, out, schema, ["key"], ["at"]).collect()
    assert {r.key: (r.at, r.last) for r in again} == now
    assert current_records(spark, str(tmp_path / "none"), schema, ["key"], ["at"]).count() == 0
