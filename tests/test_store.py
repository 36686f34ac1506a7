import datetime
from concurrent.futures import ThreadPoolExecutor

import pytest

from tidemark import Dataset, Execution, run_sync
from tidemark.operators.envelope import log_rows
from tidemark.session import scratch_dir, scratch_root
from tidemark.sinks.store import Attempt


JANUARY = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
FEBRUARY = datetime.datetime(2024, 2, 2, tzinfo=datetime.timezone.utc)


def go(store, dataset, rows, execution_id):
    result = run_sync(store, dataset, lambda: rows, Execution(execution_id))
    assert result.status == "completed", result.error


def content(store, layer, dataset=None):
    rows = store.layer(layer, dataset).select("dataset_id", "execution_id", "record_key", "payload")
    return sorted(map(tuple, rows.collect()))


def test_ids_with_special_characters(spark, store):
    names = ["a b", "x=y/z", "50%", "[d]*?", "été", "q'\"#{}^"]
    rows = log_rows(spark.range(3), "id")
    for name in names:
        attempt = Attempt(name, "s", name, name, 1)
        store.write(rows, attempt, JANUARY, JANUARY)
        store.commit(attempt, JANUARY, 3)
    ids = store.raw().select("tenant_id", "dataset_id", "execution_id").distinct().collect()
    assert sorted(map(tuple, ids)) == sorted((name,) * 3 for name in names)
    assert store.raw().count() == 3 * len(names)
    assert store.raw((names[3], "s", names[3])).count() == 3


def test_empty_ids_are_refused(store):
    with pytest.raises(ValueError, match="empty"):
        Attempt("", "s", "d", "e", 1).folder()


def test_datasets_do_not_mix(spark, store):
    for tenant in ("a", "b"):
        go(store, Dataset(tenant, "s", "d", technical_key="id"), spark.range(4), f"e-{tenant}")
    assert store.raw(("a", "s", "d")).count() == 4
    assert store.raw().count() == 8
    assert store.raw(("c", "s", "d")).count() == 0


def test_concurrent_changes_are_all_kept(store):
    def change(n):
        store.checkpoints.upsert(
            store.checkpoints.one_row(
                tenant_id="t", source_id="s", dataset_id=f"d{n % 10}", last_value=f"{n:03d}"
            )
        )

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(change, range(40)))
    assert store.checkpoints.changes().count() == 40
    assert store.checkpoints.current().count() == 10


def test_upsert_delete_and_first_values(store):
    def one(**values):
        return store.sources.one_row(tenant_id="t", source_id="s", **values)

    store.sources.upsert(one(host="old", created_at=JANUARY, updated_at=JANUARY))
    store.sources.upsert(one(host="new", created_at=FEBRUARY, updated_at=FEBRUARY))
    row = store.sources.current().first()
    assert (row.host, str(row.created_at.date()), str(row.updated_at.date())) == (
        "new", "2024-01-01", "2024-02-02"
    )
    store.sources.delete(one())
    assert store.sources.current().count() == 0


def test_last_value_follows_changes(store):
    dataset = ("t", "s", "d")
    names = dict(zip(("tenant_id", "source_id", "dataset_id"), dataset))
    assert store.last_value(dataset) is None
    for value in ("5", "10", "9"):
        store.checkpoints.upsert(store.checkpoints.one_row(**names, last_value=value))
    assert store.last_value(dataset) == "9"
    store.checkpoints.delete(store.checkpoints.one_row(**names))
    assert store.last_value(dataset) is None


def test_compaction_changes_nothing_that_is_read(spark, store):
    dataset = Dataset("t", "s", "d", "full", technical_key="id")
    other = Dataset("t", "s", "other", "full", technical_key="id")
    first = spark.range(0, 100).selectExpr("id", "'one' AS v")
    second = spark.range(50, 150).selectExpr("id", "'two ' AS v")
    third = spark.range(0, 30).selectExpr("id", "'three' AS v")
    go(store, dataset, first, "e1")
    go(store, other, first, "o1")
    go(store, dataset, second, "e2")
    before = {layer: content(store, layer) for layer in ("raw", "normalized")}

    covered = store.compact(dataset.identity)
    assert len(covered) == 2
    for layer in before:
        assert content(store, layer) == before[layer]
        assert content(store, layer, dataset.identity) == [
            row for row in before[layer] if row[0] == "d"
        ]
    store.drop(covered)
    for layer in before:
        assert content(store, layer) == before[layer]

    go(store, dataset, third, "e3")
    after = {layer: content(store, layer, dataset.identity) for layer in before}
    expected = {
        key: value
        for rows, name, text in ((first, "e1", "one"), (second, "e2", "two"), (third, "e3", "three"))
        for key, value in ((str(r.id), (name, text)) for r in rows.collect())
    }
    assert {(row[2], row[1]) for row in after["normalized"]} == {
        (key, name) for key, (name, _) in expected.items()
    }
    covered = store.compact(dataset.identity)
    assert len(covered) == 3  # one run and the earlier snapshot of both layers
    store.drop(covered)
    assert {layer: content(store, layer, dataset.identity) for layer in before} == after


def parents_of_bucketed_scans(plan):
    """Operators between each bucketed scan and the join above it."""
    lines = plan.splitlines()
    for at, line in enumerate(lines):
        if "FileScan" in line and "Bucketed: true" in line:
            depth, above = len(line) - len(line.lstrip(" :+-*()0123456789")), []
            for parent in reversed(lines[:at]):
                indent = len(parent) - len(parent.lstrip(" :+-*()0123456789"))
                if indent < depth:
                    depth = indent
                    above.append(parent.strip())
                    if "Join" in parent:
                        break
            yield above


def test_buckets_hold_the_same_records_and_are_joined_in_place(spark, store):
    dataset = Dataset("t", "s", "d'%", "full", technical_key="id")
    plain = Dataset("t", "s", "plain", "full", technical_key="id")
    texts = ("'one'", "'two'", "'three'")
    for number, (begin, end) in enumerate([(0, 300), (250, 420), (0, 90)]):
        rows = spark.range(begin, end).selectExpr("id", f"{texts[number]} AS v")
        for each in (dataset, plain):
            go(store, each, rows, f"{each.dataset_id}-{number}")
        if number < 2:
            store.drop(store.compact(dataset.identity, buckets=8))
            store.drop(store.compact(plain.identity))

    def found(of):
        rows = store.layer("normalized", of.identity).select("record_key", "payload").collect()
        return sorted(map(tuple, rows))

    assert found(dataset) == found(plain) and len(found(plain)) == 420
    everything = content(store, "normalized")
    assert sorted((r[2], r[3]) for r in everything if r[0] == dataset.dataset_id) == found(plain)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = store.normalized(dataset.identity)
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    scans = list(parents_of_bucketed_scans(plan))
    assert scans, plan
    assert all("Join" in above[-1] and "Exchange" not in " ".join(above) for above in scans), plan
    before = found(plain)
    store.drop(store.compact(dataset.identity, buckets=3))  # another number: written anew
    assert found(dataset) == before
    for table in spark.catalog.listTables():  # as in a new session
        if table.name.startswith("tidemark_"):
            spark.sql(f"DROP TABLE {table.name}")
    assert found(dataset) == before


def test_a_merge_rewrites_only_buckets_with_new_keys(spark, store, tmp_path):
    dataset = Dataset("t", "s", "d", "full", technical_key="id")
    go(store, dataset, spark.range(200), "e1")
    store.compact(dataset.identity, buckets=16)
    first = store._compaction("raw", dataset.identity).versions
    assert len(set(first)) == 1
    go(store, dataset, spark.range(2).selectExpr("id * 7 AS id"), "e2")
    covered = store.compact(dataset.identity)
    second = store._compaction("raw", dataset.identity).versions
    changed = [n for n in range(16) if first[n] != second[n]]
    assert 1 <= len(changed) <= 2
    assert len(covered) == 1 + 2 * len(changed)  # the run, and old versions of both layers
    store.drop(covered)
    got = {r[2]: r[1] for r in content(store, "raw", dataset.identity)}
    assert got == {str(n): "e2" if n in (0, 7) else "e1" for n in range(200)}
    assert store.compact(dataset.identity) == []
    assert store._compaction("raw", dataset.identity).versions == second
    assert store._compaction("raw", dataset.identity).last_started is not None


def test_late_run_and_empty_dataset_with_buckets(spark, store):
    empty = ("t", "s", "nothing")
    assert store.compact(empty, buckets=4) == []
    assert store.raw(empty).count() == 0
    dataset = Dataset("t", "s", "d", "full", technical_key="id")
    go(store, dataset, spark.range(3).selectExpr("id", "'new' AS v"), "e2")
    store.drop(store.compact(dataset.identity, buckets=4))
    early = datetime.datetime(2020, 1, 1, tzinfo=datetime.timezone.utc)
    attempt = Attempt("t", "s", "d", "e1", 1)
    store.write(log_rows(spark.range(5).selectExpr("id", "'old' AS v"), "id"), attempt, early, early)
    store.commit(attempt, early, 5)
    want = {"0": "e2", "1": "e2", "2": "e2", "3": "e1", "4": "e1"}
    assert {r[2]: r[1] for r in content(store, "raw", dataset.identity)} == want
    store.drop(store.compact(dataset.identity))
    assert {r[2]: r[1] for r in content(store, "raw", dataset.identity)} == want
    assert {r[2]: r[1] for r in content(store, "raw") if r[0] == "d"} == want
    with pytest.raises(ValueError, match="at least one bucket"):
        store.compact(dataset.identity, buckets=-1)


def test_run_that_began_before_a_compaction_does_not_win(spark, store):
    """Such a run takes the general path, where start times decide."""
    dataset = Dataset("t", "s", "d", "full", technical_key="id")
    go(store, dataset, spark.range(3).selectExpr("id", "'new' AS v"), "e2")
    store.drop(store.compact(dataset.identity))
    early = datetime.datetime(2020, 1, 1, tzinfo=datetime.timezone.utc)
    rows = log_rows(spark.range(5).selectExpr("id", "'old' AS v"), "id")
    attempt = Attempt("t", "s", "d", "e1", 1)
    store.write(rows, attempt, early, early)
    store.commit(attempt, early, 5)
    got = {r[2]: r[1] for r in content(store, "raw", dataset.identity)}
    assert got == {"0": "e2", "1": "e2", "2": "e2", "3": "e1", "4": "e1"}


def test_late_run_of_one_dataset_leaves_others_on_the_short_path(spark, store):
    for name in ("a", "b"):
        dataset = Dataset("t", "s", name, "full", technical_key="id")
        go(store, dataset, spark.range(3).selectExpr("id", "'new' AS v"), f"{name}2")
        store.drop(store.compact(dataset.identity))
    early = datetime.datetime(2020, 1, 1, tzinfo=datetime.timezone.utc)
    attempt = Attempt("t", "s", "a", "a1", 1)
    store.write(log_rows(spark.range(4).selectExpr("id", "'old' AS v"), "id"), attempt, early, early)
    store.commit(attempt, early, 4)
    go(store, Dataset("t", "s", "b", "full", technical_key="id"), spark.range(1), "b3")
    got = {(r[0], r[2]): r[1] for r in content(store, "raw")}
    assert got == {
        ("a", "0"): "a2", ("a", "1"): "a2", ("a", "2"): "a2", ("a", "3"): "a1",
        ("b", "0"): "b3", ("b", "1"): "b2", ("b", "2"): "b2",
    }


def test_unfinished_attempt_is_neither_read_nor_compacted_away(spark, store):
    dataset = Dataset("t", "s", "d", "full", technical_key="id")
    go(store, dataset, spark.range(3), "e1")
    going_on = Attempt("t", "s", "d", "e2", 7)
    store.write(log_rows(spark.range(10), "id"), going_on, FEBRUARY, FEBRUARY)
    assert store.log().count() == 3 and store.raw().count() == 3
    covered = store.compact(dataset.identity)
    assert len(covered) == 1
    store.drop(covered)
    assert store.raw().count() == 3
    store.commit(going_on, datetime.datetime.now(datetime.timezone.utc), 10)
    assert store.log().count() == 10 and store.raw(dataset.identity).count() == 10
    assert len(store.compact(dataset.identity)) == 3


def test_job_that_dies_during_its_commit_leaves_nothing_to_read(spark, store, monkeypatch):
    dataset = Dataset("t", "s", "d", "full", technical_key="id")

    def dies(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(store, "commit", dies)
        assert run_sync(store, dataset, lambda: spark.range(5), Execution("e1")).status == "failed"
    assert store.log().count() == 0 and store.last_value(dataset.identity) is None
    go(store, dataset, spark.range(5), "e1")
    assert store.raw().count() == 5


def test_drop_refuses_folders_outside(store):
    with pytest.raises(ValueError, match="not part of this store"):
        store.drop(["/tmp/elsewhere"])


def test_one_dataset_reads_only_its_folders(spark, store):
    for name in ("a", "b"):
        go(store, Dataset("t", "s", name, technical_key="id"), spark.range(4), f"e-{name}")
    files = [f for f in store.log(("t", "s", "a")).inputFiles() if "/log/" in f]
    assert files and all("dataset_id=a/" in f for f in files)


def test_layer_reads_only_its_columns(spark, store):
    go(store, Dataset("t", "s", "d", technical_key="id"), spark.range(4), "e1")
    plan = store.raw(("t", "s", "d"))._jdf.queryExecution().executedPlan().toString()
    assert "raw_payload" in plan and "normalized_payload" not in plan


def test_scratch_is_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    assert scratch_dir(spark, "x").startswith(f"{root}/x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_control_tables_are_compacted_without_change(store):
    def checkpoint(name, **values):
        return store.checkpoints.one_row(
            tenant_id="t", source_id="s", dataset_id=name, **values
        )

    def source(host, at):
        return store.sources.one_row(
            tenant_id="t", source_id="s", host=host, created_at=at, updated_at=at
        )

    def state():
        return [sorted(map(tuple, t.current().collect())) for t in (store.checkpoints, store.sources)]

    for value in ("1", "2"):
        store.checkpoints.upsert(checkpoint("kept", last_value=value))
        store.checkpoints.upsert(checkpoint("gone", last_value=value))
    store.checkpoints.delete(checkpoint("gone"))
    store.sources.upsert(source("old", JANUARY))
    store.sources.upsert(source("new", FEBRUARY))
    before = state()
    covered = store.compact_control()
    assert len(covered) == 7
    # A change made before the old folders are gone is kept.
    store.checkpoints.upsert(checkpoint("late", last_value="9"))
    store.drop(covered)
    assert store.checkpoints.changes().count() == 3
    assert store.last_value(("t", "s", "late")) == "9"
    assert store.last_value(("t", "s", "kept")) == "2"
    assert store.last_value(("t", "s", "gone")) is None
    store.checkpoints.delete(checkpoint("late"))
    assert state() == before
    assert before[1][0][-2:] != before[1][0][-1:] * 2  # created in January, updated later
    store.sources.upsert(source("newer", FEBRUARY))
    assert store.sources.current().first().created_at < store.sources.current().first().updated_at


def rows_scanned(df, table):
    """Rows that scans of some folder hand on once the frame is computed."""
    df.collect()
    total, plans = 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        elif kind == "FileSourceScanExec" and f"/{table}/" in plan.metadata().apply("Location"):
            total += plan.metrics().apply("numOutputRows").value()
        children = plan.children().iterator()
        while children.hasNext():
            plans.append(children.next())
    return total


@pytest.fixture()
def scattered(spark, store):
    """Eight files, each with keys from the whole range: bounds of keys exclude none of them."""
    dataset = Dataset("t", "s", "d", "full", technical_key="id")
    rows = spark.range(16_000).selectExpr("id", "'one' AS v").repartition(8)
    go(store, dataset, rows, "e1")
    return dataset


def test_records_of_keys_read_only_files_that_may_hold_them(spark, store, scattered):
    def found(keys, **where):
        return sorted(r.record_key for r in store.records_of("raw", keys, **where).collect())

    identity = scattered.identity
    assert rows_scanned(store.raw(identity), "log") == 16_000
    assert rows_scanned(store.records_of("raw", ["17"], identity), "log") <= 4_000
    assert rows_scanned(store.records_of("raw", ["none", None], identity), "log") <= 4_000
    assert found(["17", "17", None, "none", "9"], dataset=identity) == ["17", "9"]
    many = [str(n) for n in range(0, 16_000, 500)]  # more than one part of a list
    assert found(many) == sorted(many)
    assert found([], dataset=identity) == []
    assert found(["17"], dataset=("t", "s", "other")) == []
    wanted = spark.createDataFrame([(5,), (5,), (None,), (99_999,)], "`a.key` int")
    assert found(wanted, dataset=identity) == ["5"]


@pytest.mark.parametrize("buckets", [None, 4])
def test_records_of_keys_in_snapshots(spark, store, scattered, buckets):
    identity = scattered.identity
    store.drop(store.compact(identity, buckets=buckets))
    go(store, scattered, spark.range(10, 20).selectExpr("id", "'two' AS v"), "e2")
    wanted = spark.createDataFrame([("5",), ("17",), ("none",)], "k string")
    for keys in (["5", "17", "none"], wanted):
        rows = store.records_of("normalized", keys, identity).collect()
        assert sorted((r.record_key, r.execution_id) for r in rows) == [("17", "e2"), ("5", "e1")]
    none = store.records_of("raw", ["none"], identity)
    assert rows_scanned(none, "buckets" if buckets else "snapshots") <= 4_500


def test_keys_narrow_rows_before_they_are_combined(spark, store, scattered):
    wanted = spark.range(3).selectExpr("cast(id AS string) AS k")
    plan = store.records_of("raw", wanted, scattered.identity)._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert text.index("Aggregate") < text.index("Join LeftSemi")


def checkpoint_table(spark, tmp_path, **options):
    from tidemark import schemas
    from tidemark.sinks.control import ControlTable

    path = str(tmp_path / "table")
    return ControlTable(spark, path, schemas.SYNC_CHECKPOINTS, schemas.IDENTITY, **options)


def put(table, name, value):
    table.upsert(table.one_row(tenant_id="t", source_id="s", dataset_id=name, last_value=value))


def values(table):
    return {r.dataset_id: r.last_value for r in table.current().collect()}


def folders(table, tmp_path):
    return [p for p in (tmp_path / "table").iterdir() if p.name.startswith("write_ticket=")]


def test_folders_of_a_control_table_stay_few(spark, tmp_path):
    table = checkpoint_table(spark, tmp_path, fold_after=5, keep_seconds=0)
    for n in range(30):
        put(table, f"d{n % 3}", str(n))
        assert len(folders(table, tmp_path)) <= 2 * (5 + 1) + 1
    assert values(table) == {"d0": "27", "d1": "28", "d2": "29"}
    assert table.changes().count() <= 5 + 3


def test_folded_folders_stay_for_readers_that_began_before(spark, tmp_path):
    table = checkpoint_table(spark, tmp_path, fold_after=2)
    put(table, "a", "1")
    reader = table.current()
    for n in range(6):
        put(table, "a", str(n))
    assert [r.last_value for r in reader.collect()] == ["1"]
    assert len(folders(table, tmp_path)) >= 7
    assert len(table.changes().inputFiles()) <= 3


def test_changes_beside_a_fold_are_kept(spark, tmp_path):
    """A change that appears while a fold is made, and a fold that dies before its list is there."""
    table = checkpoint_table(spark, tmp_path, fold_after=1_000)
    put(table, "a", "1")
    seen = table._open
    put(table, "b", "1")
    first = seen()
    table._open = lambda: (first[0][:1], first[1])  # the second folder is not there yet
    table.fold()
    table._open = seen
    assert values(table) == {"a": "1", "b": "1"}
    put(table, "a", "2")
    (tmp_path / "table" / "_folded" / "99.unfinished").write_text("write_ticket=1")
    assert values(table) == {"a": "2", "b": "1"}
    table.delete(table.one_row(tenant_id="t", source_id="s", dataset_id="b"))
    assert len(table.fold()) == 4
    assert table.fold() and values(table) == {"a": "2"}


def test_folding_that_fails_leaves_the_change(spark, tmp_path, monkeypatch):
    table = checkpoint_table(spark, tmp_path, fold_after=0)

    def broken():
        raise OSError("no room")

    monkeypatch.setattr(table, "fold", broken)
    put(table, "a", "1")
    assert values(table) == {"a": "1"}
