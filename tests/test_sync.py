"""Properties of whole syncs: idempotence, resumption, failure, recovery."""

import pytest
from pyspark.sql import functions as F

from tidemark import Dataset, Execution, run_sync
from tidemark.functions import cursors
from tidemark.plans import sync as sync_module
from tidemark.operators.batches import batch_ledger

ORDERS = Dataset("t", "s", "orders", "incremental", "o_orderkey", "key", "o_orderkey")
BY_DATE = Dataset("t", "s", "orders", "incremental", "o_orderdate", "date", "o_orderkey")


def go(store, dataset, rows, execution_id, **options):
    return run_sync(store, dataset, lambda: rows, Execution(execution_id), **options)


def content(store, dataset):
    """Both layers without run ids and times."""
    return {
        layer: sorted(
            map(tuple, store.layer(layer, dataset.identity).select("record_key", "payload").collect())
        )
        for layer in ("raw", "normalized")
    }


@pytest.fixture(scope="module")
def orders(spark, testdata):
    return spark.read.parquet(f"{testdata}/orders.parquet")


def test_sync_twice_is_sync_once(store, orders):
    first = go(store, ORDERS, orders, "e1")
    once = content(store, ORDERS)
    second = go(store, ORDERS, orders, "e2")
    assert (first.total_records, second.total_records) == (orders.count(), 0)
    assert first.total_batches == -(-orders.count() // 1000)
    assert content(store, ORDERS) == once
    assert store.last_value(ORDERS.identity) == first.last_value


@pytest.mark.parametrize("dataset, column", [(ORDERS, "o_orderkey"), (BY_DATE, "o_orderdate")])
def test_split_at_a_cursor_equals_one_sync(spark, tmp_path, orders, dataset, column):
    from tidemark import Store

    whole, split = Store(spark, str(tmp_path / "a")), Store(spark, str(tmp_path / "b"))
    go(whole, dataset, orders, "e1")
    middle = orders.select(F.percentile(F.col(column).cast("double"), 0.5)).first()[0] \
        if column == "o_orderkey" else orders.agg(F.median(F.unix_seconds(
            F.col(column).cast("timestamp"))).alias("m")).first().m
    key = F.col(column) if column == "o_orderkey" else F.unix_seconds(
        F.col(column).cast("timestamp"))
    go(split, dataset, orders.where(key <= middle), "e1")
    go(split, dataset, orders, "e2")
    assert content(split, dataset) == content(whole, dataset)
    assert split.last_value(dataset.identity) == whole.last_value(dataset.identity)


def test_ties_on_the_cursor_lose_no_rows(store, orders):
    small = Dataset(**{**BY_DATE.__dict__, "batch_size": 7})
    result = go(store, small, orders, "e1")
    assert result.total_records == orders.count()
    assert len(content(store, small)["raw"]) == orders.count()


def test_reset_then_sync_equals_first_sync(store, orders):
    go(store, ORDERS, orders, "e1")
    once = content(store, ORDERS)
    store.checkpoints.delete(
        store.checkpoints.one_row(tenant_id="t", source_id="s", dataset_id="orders")
    )
    assert store.last_value(ORDERS.identity) is None
    again = go(store, ORDERS, orders, "e2")
    assert again.total_records == orders.count()
    assert content(store, ORDERS) == once


def test_full_sync_clears_the_cursor_and_keeps_vanished_rows(store, orders):
    go(store, ORDERS, orders, "e1")
    full = Dataset("t", "s", "orders", "full", technical_key="o_orderkey")
    go(store, full, orders.where("o_orderkey % 2 = 0"), "e2")
    assert store.last_value(ORDERS.identity) is None
    runs = {
        r.execution_id: r.n
        for r in store.raw(ORDERS.identity)
        .groupBy("execution_id")
        .agg(F.count("*").alias("n"))
        .collect()
    }
    assert sum(runs.values()) == orders.count() and set(runs) == {"e1", "e2"}


def test_same_execution_again_adds_what_is_new(store, orders):
    """A repeated id must not replace what its first run wrote."""
    go(store, ORDERS, orders.where("o_orderkey < 500"), "e1")
    go(store, ORDERS, orders, "e1")
    assert len(content(store, ORDERS)["raw"]) == orders.count()
    assert store.executions.current().count() == 1


def test_bad_checkpoint_fails_and_stays(store, orders):
    store.checkpoints.upsert(
        store.checkpoints.one_row(
            tenant_id="t", source_id="s", dataset_id="orders", last_value="<nil>"
        )
    )
    result = go(store, ORDERS, orders, "e1")
    assert result.status == "failed" and "CAST_INVALID_INPUT" in result.error
    assert store.last_value(ORDERS.identity) == "<nil>"
    assert store.log().count() == 0
    row = store.executions.current().first()
    assert (row.status, row.total_records, row.total_batches) == ("failed", 0, 0)
    topics = {r.topic for r in store.messages().collect()}
    assert topics == {"data.connect.sync.started", "data.connect.sync.failed"}


@pytest.mark.parametrize(
    "change, error",
    [
        ({"sync_mode": "mirror"}, "unsupported sync mode: mirror"),
        ({"incremental_column": None}, "incremental_column not configured for dataset orders"),
        ({"incremental_type": "serial"}, "unsupported incremental type: serial"),
        ({"incremental_column": "nope"}, "column 'nope' not found"),
        ({"sync_mode": "full", "technical_key": "nope"}, "column 'nope' not found"),
    ],
)
def test_configuration_errors(store, orders, change, error):
    result = go(store, Dataset(**{**ORDERS.__dict__, **change}), orders, "e1")
    assert result.status == "failed" and error in result.error


def test_crash_between_layers_and_checkpoint_is_repaired(store, orders, monkeypatch):
    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(sync_module, "move_checkpoint", lost)
        with pytest.raises(KeyboardInterrupt):
            go(store, ORDERS, orders, "e1")
    assert store.last_value(ORDERS.identity) is None
    go(store, ORDERS, orders, "e1")
    assert len(content(store, ORDERS)["normalized"]) == orders.count()
    assert store.last_value(ORDERS.identity) == str(orders.agg(F.max("o_orderkey")).first()[0])


def test_crash_before_the_ledger_is_repaired(store, orders, monkeypatch):
    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(sync_module, "record_outcome", lost)
        with pytest.raises(KeyboardInterrupt):
            go(store, ORDERS, orders, "e1")
    result = go(store, ORDERS, orders, "e1")
    assert result.total_records == orders.count()
    assert len(content(store, ORDERS)["raw"]) == orders.count()


def test_failing_write_leaves_nothing(spark, store):
    rows = spark.range(0, 1000, 1, 8).select(
        "id", F.when(F.col("id") == 777, F.raise_error(F.lit("disk on fire"))).alias("v")
    )
    full = Dataset("t", "s", "d")
    result = go(store, full, rows, "e1")
    assert result.status == "failed" and "disk on fire" in result.error
    assert store.log().count() == 0
    assert go(store, full, rows.select("id"), "e1").status == "completed"
    assert store.raw(full.identity).count() == 1000


def test_empty_dataset(store, orders):
    result = go(store, ORDERS, orders.where("false"), "e1")
    assert (result.status, result.total_records, result.total_batches) == ("completed", 0, 0)
    assert store.last_value(ORDERS.identity) is None
    assert store.messages().where("topic LIKE '%batch%'").count() == 0
    assert not any("/log/" in f for f in store.log().inputFiles())


def test_null_cursors_are_read_once(spark, store):
    rows = spark.createDataFrame([(1, None), (2, 5), (3, 7)], "id int, v bigint")
    dataset = Dataset("t", "s", "d", "incremental", "V", "key", "ID")
    assert go(store, dataset, rows, "e1").total_records == 3
    assert store.last_value(dataset.identity) == "7"
    assert go(store, dataset, rows, "e2").total_records == 0
    only_null = Dataset("t", "s", "n", "incremental", "v", "key", "id")
    go(store, only_null, rows.where("v IS NULL"), "e3")
    assert store.last_value(only_null.identity) is None


def test_late_rows_are_skipped_unless_looked_back_for(spark, store):
    dataset = Dataset("t", "s", "d", "incremental", "v", "key", "id")
    rows = spark.createDataFrame([(1, 10), (2, 20)], "id int, v bigint")
    go(store, dataset, rows, "e1")
    late = spark.createDataFrame([(1, 10), (2, 20), (3, 15), (4, 20), (5, 21)], rows.schema)
    assert go(store, dataset, late, "e2").total_records == 1
    assert go(store, dataset, late, "e3", lookback=7).total_records == 4
    assert len(content(store, dataset)["raw"]) == 5


def test_technical_key_twice_keeps_the_later_cursor(spark, store):
    dataset = Dataset("t", "s", "d", "incremental", "v", "key", "id")
    rows = spark.createDataFrame([(1, 9, "z"), (1, 10, "a"), (2, 1, "b")], "id int, v int, t string")
    go(store, dataset, rows, "e1")
    assert content(store, dataset)["raw"] == [
        ("1", '{"id":1,"t":"a","v":10}'), ("2", '{"id":2,"t":"b","v":1}')
    ]


def test_equal_rows_without_key_collapse(spark, store):
    rows = spark.createDataFrame([(1, " x"), (1, " x"), (1, "x")], "n int, t string")
    dataset = Dataset("t", "s", "d")
    assert go(store, dataset, rows, "e1").total_records == 3
    got = content(store, dataset)
    assert (len(got["raw"]), len(got["normalized"])) == (2, 1)


def test_message_trouble_does_not_fail_a_sync(spark, tmp_path, orders):
    from tidemark import Store

    def broken(_):
        raise OSError("no broker")

    store = Store(spark, str(tmp_path / "store"), publish=broken)
    assert go(store, ORDERS, orders, "e1").status == "completed"


def test_messages_follow_the_run(store, orders):
    go(store, Dataset(**{**ORDERS.__dict__, "batch_size": 400}), orders, "e1")
    got = store.messages().collect()
    assert [r.key for r in got] == ["e1"] * len(got)
    topics = [r.topic.rsplit(".", 2)[-2:] for r in got]
    assert topics.count(["sync", "started"]) == topics.count(["sync", "completed"]) == 1
    assert topics.count(["batch", "processed"]) == -(-orders.count() // 400)
    body = next(r.value for r in got if "batch" in r.topic)
    assert '"trigger_type":"manual"' in body and '"records_in_batch":400' in body


def test_message_batches_agree_with_numbered_rows(store, orders):
    result = go(store, Dataset(**{**ORDERS.__dict__, "batch_size": 400}), orders, "e1")
    rows = batch_ledger(orders, "o_orderkey", 400).collect()
    assert len(rows) == result.total_batches
    last = max(rows, key=lambda r: r.batch_number)
    assert last.records_in_batch == result.total_records - 400 * (result.total_batches - 1)


def test_wide_keys(store, orders):
    go(store, Dataset("t", "s", "d"), orders, "e1", key_bits=256)
    assert {len(r.record_key) for r in store.raw().select("record_key").collect()} == {64}


def test_lookback_never_moves_the_cursor_back(spark, store):
    dataset = Dataset("t", "s", "d", "incremental", "id", "key", "id")
    go(store, dataset, spark.sql("SELECT 9L AS id"), "e1")
    result = go(store, dataset, spark.sql("SELECT 5L AS id"), "e2", lookback=6)
    assert result.total_records == 1 and store.last_value(dataset.identity) == "9"
    go(store, dataset, spark.sql("SELECT 12L AS id"), "e3", lookback=6)
    assert store.last_value(dataset.identity) == "12"


def test_rows_are_counted_by_the_write(spark, store, orders):
    """The count is that of the files and of the commit row; the log is not read for it."""
    first = go(store, ORDERS, orders, "e1")
    again = go(store, ORDERS, orders, "e2")
    assert first.total_persisted == first.total_records == store.log(ORDERS.identity).count()
    assert (again.total_persisted, again.last_value) == (0, None)
    assert [r.records for r in store.attempts.current().collect()] == [first.total_records]
    ledger = {r.execution_id: r.total_persisted for r in store.executions.current().collect()}
    assert ledger == {"e1": first.total_records, "e2": 0}
    kind = orders.schema["o_orderkey"].dataType
    top = store.log(ORDERS.identity).agg(
        cursors.checkpoint_text(F.max("cursor"), kind)
    ).first()[0]
    assert first.last_value == top
