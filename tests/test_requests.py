import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidemark import (
    check_sources,
    process_requests,
    register_datasets,
    register_sources,
    reset_checkpoints,
    schemas,
)
from tidemark.operators.requests import check_required
from tidemark.plans.requests import _Turns
from tidemark.sources.tables import parquet_folder


def rows_of(spark, schema, *rows):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


def source(**changes):
    base = dict(
        tenant_id="t", source_id="s", connector_type="postgres", host="h", port=5432,
        database="db", username="u", password_ref="ref",
    )
    return {**base, **changes}


def dataset(name, **changes):
    base = dict(tenant_id="t", source_id="s", dataset_id=name, table_name=name, sync_mode="full")
    return {**base, **changes}


def request(name, execution_id, at="2024-01-01 00:00:00", **changes):
    import datetime

    moment = datetime.datetime.fromisoformat(at).replace(tzinfo=datetime.timezone.utc)
    return {
        **dict(
            tenant_id="t", source_id="s", dataset_id=name, execution_id=execution_id,
            connector_type="postgres", trigger_type="manual", correlation_id="c",
            timestamp=moment,
        ),
        **changes,
    }


@pytest.fixture()
def registered(spark, store):
    register_sources(
        store,
        rows_of(
            spark, schemas.SOURCE_REQUEST, source(schema=""), source(host=""),
            source(source_id="odd", connector_type="oracle", schema="hr", ssl_mode="require"),
        ),
    )
    register_datasets(
        store,
        rows_of(
            spark, schemas.DATASET_REQUEST,
            dataset("orders", sync_mode="incremental", incremental_column="o_orderkey",
                    incremental_type="key", technical_key="o_orderkey", batch_size=100),
            dataset("customer", enabled=False),
            dataset("part", technical_key="p_partkey"),
            dataset("region", sync_mode="mirror"),
            dataset("ora", source_id="odd"),
            dataset("homeless", source_id="none"),
            dataset("blank", table_name=""),
        ),
    )
    return store


def test_registration(registered):
    stored = {r.source_id: r for r in registered.sources.current().collect()}
    assert set(stored) == {"s", "odd"}
    assert (stored["s"].schema_name, stored["s"].ssl_mode) == (None, "disable")
    assert (stored["odd"].schema_name, stored["odd"].ssl_mode) == ("hr", "require")
    sets = {r.dataset_id: r for r in registered.datasets.current().collect()}
    assert set(sets) == {"orders", "customer", "part", "region", "ora"}
    assert (sets["part"].batch_size, sets["part"].object_type, sets["part"].enabled) == (
        1000, "table", True
    )
    assert sets["customer"].enabled is False
    refused = {(r.kind, r.error.split(",")[0]) for r in registered.rejected().collect()}
    assert refused == {
        ("source", "tenant_id"), ("dataset", "source is not registered"),
        ("dataset", "tenant_id"),
    }


def test_registering_again_keeps_the_creation_time(spark, registered):
    before = registered.sources.current().where("source_id = 's'").first()
    register_sources(registered, rows_of(spark, schemas.SOURCE_REQUEST, source(host="h2")))
    after = registered.sources.current().where("source_id = 's'").first()
    assert after.host == "h2" and after.created_at == before.created_at
    assert after.updated_at > before.updated_at


def test_process_requests(spark, registered, testdata):
    requests = rows_of(
        spark, schemas.SYNC_REQUEST,
        request("orders", "e1"), request("customer", "e2"), request("part", "e3"),
        request("region", "e4"), request("unknown", "e5"),
        request("orders", "e6", source_id="nowhere"), request("ora", "e7", source_id="odd"),
    )
    process_requests(registered, requests, parquet_folder(spark, testdata))
    ledger = {r.execution_id: r for r in registered.executions.current().collect()}
    assert {k: r.status for k, r in ledger.items()} == {
        "e1": "completed", "e3": "completed", "e4": "failed", "e7": "failed"
    }
    assert ledger["e4"].error_message == "unsupported sync mode: mirror"
    assert ledger["e7"].error_message == "create connector: unsupported connector type: oracle"
    assert ledger["e1"].total_batches == -(-ledger["e1"].total_records // 100)
    refused = {r.error for r in registered.rejected().where("kind = 'sync'").collect()}
    assert refused == {
        "dataset not registered: t/s/unknown", "source not registered: t/nowhere"
    }
    told = {(r.key, r.topic.rsplit(".", 1)[1]) for r in registered.messages().collect()}
    assert ("e4", "failed") in told and ("e1", "completed") in told
    assert not any(key in ("e2", "e5", "e6") for key, _ in told)


def test_one_dataset_runs_in_timestamp_order(spark, registered, testdata):
    requests = rows_of(
        spark, schemas.SYNC_REQUEST,
        *(request("part", f"e{n}", f"2024-01-01 00:00:{59 - n:02d}") for n in range(6)),
        *(request("orders", f"o{n}", f"2024-01-01 00:00:{n:02d}") for n in range(3)),
    )
    running, order, clash = [], [], []
    lock = threading.Lock()
    opened = parquet_folder(spark, testdata)

    def open_dataset(row):
        with lock:
            if row.dataset_id in running:
                clash.append(row.execution_id)
            running.append(row.dataset_id)
        return opened(row)

    def finished(result):
        with lock:
            name = "orders" if result.execution_id.startswith("o") else "part"
            running.remove(name)
            order.append(result.execution_id)

    process_requests(registered, requests, open_dataset, workers=3, on_result=finished)
    assert [e for e in order if e.startswith("e")] == ["e5", "e4", "e3", "e2", "e1", "e0"]
    assert [e for e in order if e.startswith("o")] == ["o0", "o1", "o2"]
    assert clash == []
    # The last to run owns the records.
    assert {r.execution_id for r in registered.raw(("t", "s", "part")).collect()} == {"e0"}


def test_resets(spark, registered, testdata):
    orders = rows_of(spark, schemas.SYNC_REQUEST, request("orders", "e1"))
    process_requests(registered, orders, parquet_folder(spark, testdata))
    assert registered.last_value(("t", "s", "orders")) is not None
    reset_checkpoints(
        registered,
        rows_of(
            spark, schemas.RESET_REQUEST,
            dict(tenant_id="t", source_id="s", dataset_id="orders", request_id="r"),
            dict(tenant_id="t", source_id="s", request_id="r"),
        ),
    )
    assert registered.last_value(("t", "s", "orders")) is None
    assert registered.rejected().where("kind = 'reset'").count() == 1


def test_check_sources(spark, registered):
    requests = rows_of(
        spark, schemas.TEST_REQUEST,
        dict(tenant_id="t", source_id="s", request_id="r1"),
        dict(tenant_id="t", source_id="odd", request_id="r2"),
        dict(tenant_id="t", source_id="none", request_id="r3"),
    )
    seen = spark.createDataFrame(
        [("t", "odd", "sales"), ("t", "odd", "sales")],
        "tenant_id string, source_id string, schema_name string",
    )
    check_sources(registered, requests, seen)
    result = F.from_json("value", "success boolean, error string, message string").alias("v")
    got = {r.key: r.v for r in registered.messages().select("key", result).collect()}
    assert set(got) == {"r1", "r2"}
    assert got["r1"].success and got["r1"].error is None
    assert got["r2"].message == 'connection ok but schema "hr" is not accessible'
    assert registered.rejected().where("kind = 'test'").count() == 1


@pytest.mark.parametrize("kind", ["connection", "discovery", "source"])
def test_every_required_connection_field(spark, kind):
    full = {**source(), "request_id": "r"}
    fields = "tenant_id string, source_id string, connector_type string, host string, port int, " \
        "database string, username string, password_ref string, request_id string"
    names = [part.split()[0] for part in fields.split(", ")]
    optional = {"connection": {"source_id"}, "discovery": {"source_id"}, "source": {"request_id"}}
    for name in names:
        for gap in (None, "" if name != "port" else 0):
            row = {**full, name: gap}
            rows = spark.createDataFrame([tuple(row[n] for n in names)], fields)
            error = check_required(rows, kind).first().error
            assert (error is None) == (name in optional[kind]), (kind, name)


def test_a_store_that_cannot_be_written_is_reported(spark, registered, testdata, monkeypatch):
    def broken(rows):
        raise OSError("read-only store")

    monkeypatch.setattr(registered.executions, "upsert", broken)
    requests = rows_of(
        spark, schemas.SYNC_REQUEST,
        *(request("part", f"e{n}", f"2024-01-01 00:00:{n:02d}") for n in range(4)),
    )
    with pytest.raises(OSError, match="read-only store"):
        process_requests(registered, requests, parquet_folder(spark, testdata), workers=2)


def test_a_stuck_sync_fails_and_others_finish(spark, registered, testdata):
    """Spark jobs that take too long are ended; nothing of them is seen, and the next one runs."""
    requests = rows_of(
        spark, schemas.SYNC_REQUEST,
        request("part", "e1", "2024-01-01 00:00:01"),
        request("part", "e2", "2024-01-01 00:00:02"),
        request("orders", "o1", "2024-01-01 00:00:03"),
    )
    opened = parquet_folder(spark, testdata)
    pools = set()

    def open_dataset(row):
        pools.add(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        rows = opened(row)
        if row.execution_id == "e1":  # each row takes ten minutes
            slow = F.udf(lambda n: time.sleep(600) or n, "long")
            rows = rows.withColumn("p_partkey", slow("p_partkey"))
        return rows

    begin = time.monotonic()
    process_requests(registered, requests, open_dataset, workers=2, limit=20)
    assert time.monotonic() - begin < 120
    ledger = {r.execution_id: r for r in registered.executions.current().collect()}
    assert {k: r.status for k, r in ledger.items()} == {
        "e1": "failed", "e2": "completed", "o1": "completed"
    }
    assert ledger["e1"].error_message == "not finished within 20 seconds"
    assert {r.execution_id for r in registered.raw(("t", "s", "part")).collect()} == {"e2"}
    assert pools == {"t"}


def test_waiting_requests_of_one_dataset_hold_no_worker():
    """Two workers, many rows of one dataset first: the other datasets do not wait for them."""
    done, lock = [], threading.Lock()

    def run(row):
        time.sleep(0.02)
        with lock:
            done.append(row)

    with ThreadPoolExecutor(2) as pool:
        turns = _Turns(pool, run, 1_000)
        for n in range(50):
            assert turns.add(("t", "s", "hot"), ("hot", n))
        for n in range(5):
            assert turns.add(("t", "s", f"d{n}"), (f"d{n}", 0))
        turns.finish()
    assert [n for name, n in done if name == "hot"] == list(range(50))
    assert max(place for place, (name, _) in enumerate(done) if name != "hot") < 30


def test_rows_ahead_are_bounded_and_trouble_ends_all():
    held, most = [0], [0]
    lock = threading.Lock()

    def run(row):
        with lock:
            held[0] -= 1
        if row == 30:
            raise OSError("read-only store")

    with ThreadPoolExecutor(2) as pool:
        turns = _Turns(pool, run, 4)
        for n in range(100):
            if not turns.add(("t", "s", f"d{n % 3}"), n):
                break
            with lock:
                held[0] += 1
                most[0] = max(most[0], held[0])
        with pytest.raises(OSError, match="read-only store"):
            turns.finish()
    assert most[0] <= 6 and n < 100
