"""The store: one folder with the sync log, the layers over it, and the control tables."""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators.upsert import latest, upsert_newer
from tidemark.sinks.buckets import Buckets, newer_of
from tidemark.sinks.control import (
    TICKET,
    WRITE,
    ControlTable,
    append_folder,
    next_ticket,
    read_parquet,
)

Identity = tuple[str, str, str]
Narrowing = Callable[[DataFrame], DataFrame]

LAYERS = {"raw": "ingested_at", "normalized": "normalized_at"}
_FOLDERS = [*schemas.IDENTITY, "execution_id", "attempt"]
RECORD_KEY = [*schemas.IDENTITY, "record_key"]
# Arrival order of records: runs by start, then the source's own order within a run. The
# remaining columns break ties, so the outcome never depends on task order.
ARRIVAL = ["started_at", "execution_id", "cursor"]

#: How executions of streams are named: by stream and batch.
_BATCH = re.compile(r"(.*)-([0-9]{12,})", re.DOTALL)

#: Values of a list that Spark compares with Bloom filters: its
#: ``spark.sql.parquet.pushdown.inFilterThreshold``, unless that is changed.
_LISTED = 10

# Characters that Spark escapes in partition folder names.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f")


def _folder_value(value: str) -> str:
    if not value:
        raise ValueError("tenant, source, dataset and execution ids must not be empty")
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 else c for c in value)


def _dataset_folder(dataset: Identity) -> str:
    return "/".join(f"{n}={_folder_value(v)}" for n, v in zip(schemas.IDENTITY, dataset))


def _key_filters(*columns: str) -> dict[str, str]:
    """Parquet options that add Bloom filters of some columns to each row group."""
    wanted = {f"parquet.bloom.filter.enabled#{column}": "true" for column in columns}
    return wanted | {"parquet.bloom.filter.adaptive.enabled": "true"}


@dataclass(frozen=True)
class Attempt:
    """One write of one execution into the log."""

    tenant_id: str
    source_id: str
    dataset_id: str
    execution_id: str
    attempt: int

    def folder(self) -> str:
        dataset = _dataset_folder((self.tenant_id, self.source_id, self.dataset_id))
        execution = _folder_value(self.execution_id)
        return f"{dataset}/execution_id={execution}/attempt={self.attempt}"


@dataclass(frozen=True)
class Written:
    """What the rows of an attempt were, seen as they were written."""

    records: int
    last_value: str | None


class Store:
    """Layers, registry, checkpoints, executions, messages and refused requests.

    ``publish`` receives ``(topic, key, value)`` rows; without it they are appended to the
    store's own message table.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        publish: Callable[[DataFrame], None] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        control = f"{self.root}/control"
        self.sources = ControlTable(
            spark, f"{control}/data_sources", schemas.DATA_SOURCES,
            ["tenant_id", "source_id"], ["created_at"],
        )
        self.datasets = ControlTable(
            spark, f"{control}/data_datasets", schemas.DATA_DATASETS,
            schemas.IDENTITY, ["created_at"],
        )
        self.checkpoints = ControlTable(
            spark, f"{control}/sync_checkpoints", schemas.SYNC_CHECKPOINTS, schemas.IDENTITY
        )
        # A repeated execution keeps what its first ledger row said about its identity.
        self.executions = ControlTable(
            spark, f"{control}/sync_executions", schemas.SYNC_EXECUTIONS, ["execution_id"],
            [*schemas.IDENTITY, "connector_type", "trigger_type", "started_at"],
        )
        self.attempts = ControlTable(
            spark, f"{control}/sync_attempts", schemas.SYNC_ATTEMPTS, _FOLDERS
        )
        self.compactions = ControlTable(
            spark, f"{control}/compactions", schemas.COMPACTIONS, ["layer", *schemas.IDENTITY]
        )
        self.stream_batches = ControlTable(
            spark, f"{control}/stream_batches", schemas.STREAM_BATCHES,
            [*schemas.IDENTITY, "stream"],
        )
        self._publish = publish

    # --- messages and refusals --------------------------------------------------------

    def publish(self, messages: DataFrame, batch: str | None = None) -> None:
        """Hands on messages; those of a micro-batch that is repeated replace what it left."""
        if self._publish is not None:
            self._publish(messages)
        elif batch is None:
            append_folder(messages, f"{self.root}/messages")
        else:
            folder = f"{self.root}/messages/{WRITE}={_folder_value(batch)}"
            messages.write.mode("overwrite").parquet(folder)

    def messages(self) -> DataFrame:
        return self._appended("messages", schemas.MESSAGE)

    def reject(self, refused: DataFrame, batch: str | None = None) -> None:
        """Keeps refused requests as ``(kind, body, error)``.

        A micro-batch that is repeated under its name ``batch`` replaces what it left before.
        """
        rows = refused.select(*schemas.REJECTED.fieldNames())
        folder = f"{self.root}/rejected"
        if batch is None:
            append_folder(rows, folder)
        else:
            rows.write.mode("overwrite").parquet(f"{folder}/{WRITE}={_folder_value(batch)}")

    def rejected(self) -> DataFrame:
        return self._appended("rejected", schemas.REJECTED)

    def _appended(self, table: str, schema: T.StructType) -> DataFrame:
        rows = read_parquet(self.spark, f"{self.root}/{table}", schema)
        return rows.select(*schema.fieldNames())

    # --- the log ----------------------------------------------------------------------

    @property
    def log_path(self) -> str:
        return f"{self.root}/log"

    def write(
        self,
        rows: DataFrame,
        attempt: Attempt,
        started_at: datetime.datetime,
        written_at: datetime.datetime,
        last_value: Column | None = None,
    ) -> Written:
        """Writes both layers' rows of one attempt in a single pass (K1, K2, A1).

        The folder belongs to this attempt alone, so a task or job retry replaces nothing
        else. Nothing of it is read or compacted before ``commit``. The rows are counted, and
        ``last_value`` aggregated over them, by the job that writes them. Keys get Bloom filters,
        sized by the number of keys in each file, by which ``records_of`` passes over files.
        """
        seen = Observation()
        top = F.lit(None).cast("string") if last_value is None else last_value
        (
            rows.observe(seen, F.count(F.lit(1)).alias("records"), top.alias("last_value"))
            .withColumn("started_at", F.lit(started_at).cast("timestamp"))
            .withColumn("written_at", F.lit(written_at).cast("timestamp"))
            .write.mode("overwrite")
            .options(**_key_filters("raw_key", "normalized_key"))
            .parquet(f"{self.log_path}/{attempt.folder()}")
        )
        return Written(**seen.get)

    def commit(
        self,
        attempt: Attempt,
        started_at: datetime.datetime,
        records: int,
        last_value: str | None = None,
    ) -> None:
        """Makes a completely written attempt visible, in both layers at once."""
        row = self.attempts.one_row(
            **attempt.__dict__, started_at=started_at, records=records, last_value=last_value
        )
        self.attempts.upsert(row)

    def committed(self, attempt: Attempt) -> Row | None:
        """The commit row of an attempt, if there is one."""
        found = self.attempts.current()
        for name, value in attempt.__dict__.items():
            found = found.where(F.col(name) == value)
        return found.first()

    def discard(self, attempt: Attempt) -> None:
        """Removes an attempt without rows, so that idle runs do not pile up empty folders."""
        self.drop([f"{self.log_path}/{attempt.folder()}"])

    def log(self, dataset: Identity | None = None) -> DataFrame:
        """Every row of every committed attempt; of one dataset, only its folders are listed."""
        rows = self._partitioned("log", schemas.SYNC_LOG, dataset)
        valid = _of_dataset(self.attempts.current(), dataset).select(*_FOLDERS)
        return rows.join(valid, _FOLDERS, "left_semi").select(*schemas.SYNC_LOG.fieldNames())

    def _partitioned(
        self, table: str, schema: T.StructType, dataset: Identity | None, prefix: str = ""
    ) -> DataFrame:
        base = f"{self.root}/{table}"
        folder = f"{base}/{prefix}{_dataset_folder(dataset)}" if dataset else f"{base}/{prefix}"
        return read_parquet(self.spark, folder.rstrip("/"), schema, base)

    # --- the layers -------------------------------------------------------------------

    def _log_records(self, layer: str, log: DataFrame) -> DataFrame:
        return log.select(
            *schemas.IDENTITY,
            F.col(f"{layer}_key").alias("record_key"),
            "execution_id",
            F.col(f"{layer}_payload").alias("payload"),
            "cursor",
            "started_at",
            "written_at",
        )

    def _compaction(self, layer: str, dataset: Identity) -> Row | None:
        newest = self.compactions.current().where(F.col("layer") == layer)
        return _of_dataset(newest, dataset).first()

    def _snapshot(self, layer: str, dataset: Identity | None) -> DataFrame | None:
        """Records of the newest compaction of each dataset; None where nothing is compacted."""
        if dataset:
            row = self._compaction(layer, dataset)
            if row is None:
                return None
            if row.versions:
                rows = self._buckets(layer, dataset, len(row.versions)).rows(row.versions)
                return _with_identity(rows, dataset)
        prefix = f"layer={layer}/"
        stored = self._partitioned("snapshots", schemas.LAYER_SNAPSHOT, dataset, prefix)
        if dataset:
            return stored.where(F.col("compaction") == row.compaction)
        newest = self.compactions.current().where(F.col("layer") == layer)
        if newest.isEmpty():
            return None
        whole = stored.join(
            newest.where("versions IS NULL"), [*schemas.IDENTITY, "compaction"], "left_semi"
        )
        bucketed = newest.where("versions IS NOT NULL").select(
            *schemas.IDENTITY,
            F.size("versions").alias("buckets"),
            F.posexplode("versions").alias("bucket", "version"),
        )
        if bucketed.isEmpty():
            return whole
        parts = read_parquet(
            self.spark,
            f"{self.root}/buckets/layer={layer}",
            T.StructType([*schemas.BUCKET_ROWS.fields, *schemas.BUCKET_FOLDERS.fields]),
            f"{self.root}/buckets",
        ).join(bucketed, bucketed.columns, "left_semi")
        columns = [*schemas.IDENTITY, *schemas.BUCKET_ROWS.fieldNames()]
        return whole.select(*columns).unionByName(parts.select(*columns))

    def _buckets(self, layer: str, dataset: Identity, count: int) -> Buckets:
        folder = f"{self.root}/buckets/layer={layer}/{_dataset_folder(dataset)}/buckets={count}"
        return Buckets(self.spark, folder, schemas.BUCKET_ROWS, count)

    def _onto_buckets(
        self, layer: str, dataset: Identity, compaction: Row, among: Narrowing
    ) -> DataFrame:
        """Current records of a dataset in buckets: only rows newer than the snapshot move."""
        buckets = self._buckets(layer, dataset, len(compaction.versions))
        base = among(buckets.rows(compaction.versions))
        log = among(self._log_records(layer, self.log(dataset)))
        fresh = buckets.spread(_one_per_key(log))
        if self._late(layer, dataset).isEmpty():
            kept = base.join(fresh.select("record_key"), "record_key", "left_anti")
            merged = kept.select(*base.columns).unionByName(fresh)
        else:
            merged = newer_of(base, fresh, ARRIVAL)
        return _with_identity(merged, dataset)

    def records(
        self, layer: str, dataset: Identity | None = None, among: Narrowing = lambda rows: rows
    ) -> DataFrame:
        """Current records with their arrival columns; all datasets or a single one.

        ``among`` narrows rows to some record keys before they are combined per key.
        """
        if dataset:
            compaction = self._compaction(layer, dataset)
            if compaction and compaction.versions:
                return self._onto_buckets(layer, dataset, compaction, among)
        fresh = among(self._log_records(layer, self.log(dataset)))
        snapshot = self._snapshot(layer, dataset)
        if snapshot is None:
            return latest(fresh, RECORD_KEY, ARRIVAL)
        base = among(snapshot).select(*fresh.columns)
        late = self._late(layer, dataset)
        if late.isEmpty():
            return upsert_newer(base, fresh, RECORD_KEY, ARRIVAL)

        def part(rows: DataFrame, how: str) -> DataFrame:
            return rows.join(late, schemas.IDENTITY, how)

        in_turn = upsert_newer(part(base, "left_anti"), part(fresh, "left_anti"), RECORD_KEY, ARRIVAL)
        mixed = part(base, "left_semi").unionByName(part(fresh, "left_semi"))
        return in_turn.unionByName(latest(mixed, RECORD_KEY, ARRIVAL).select(*in_turn.columns))

    def _late(self, layer: str, dataset: Identity | None) -> DataFrame:
        """Datasets with a run that began no later than the last compacted one.

        Start times come from the commit rows; no row of the log is read.
        """
        attempts = _of_dataset(self.attempts.current(), dataset)
        first = attempts.groupBy(*schemas.IDENTITY).agg(F.min("started_at").alias("first"))
        compacted = self.compactions.current().where(F.col("layer") == layer)
        return (
            first.join(compacted, schemas.IDENTITY)
            .where(F.col("first") <= F.col("last_started"))
            .select(*schemas.IDENTITY)
        )

    def layer(
        self, layer: str, dataset: Identity | None = None, among: Narrowing = lambda rows: rows
    ) -> DataFrame:
        """The layer as its table: one current row per record key."""
        return self.records(layer, dataset, among).select(
            *schemas.IDENTITY,
            "execution_id",
            "record_key",
            "payload",
            F.col("written_at").alias(LAYERS[layer]),
        )

    def records_of(
        self, layer: str, keys: DataFrame | Sequence[str], dataset: Identity | None = None
    ) -> DataFrame:
        """The layer's rows of some record keys (O5); keys without a record give nothing.

        A list is for a few hundred keys at most: as a condition on the scans it passes over row
        groups whose Bloom filters hold none of them, over pages of snapshots by their order, and
        over other buckets. A DataFrame has any number of keys in its first column, null and
        repeated ones included, and is joined before rows are combined per key.
        """
        if isinstance(keys, DataFrame):
            column = F.col(f"`{keys.columns[0]}`").cast("string")
            wanted = keys.select(column.alias("record_key"))
            return self.layer(
                layer,
                dataset,
                lambda rows: rows.join(wanted, "record_key", "left_semi").select(*rows.columns),
            )
        listed = sorted({key for key in keys if key is not None})
        # Spark hands a longer list to the files as its bounds alone.
        parts = [listed[n : n + _LISTED] for n in range(0, len(listed), _LISTED)]
        hit = reduce(or_, (F.col("record_key").isin(part) for part in parts), F.lit(False))
        return self.layer(layer, dataset, lambda rows: rows.where(hit))

    def raw(self, dataset: Identity | None = None) -> DataFrame:
        return self.layer("raw", dataset)

    def normalized(self, dataset: Identity | None = None) -> DataFrame:
        return self.layer("normalized", dataset)

    # --- compaction -------------------------------------------------------------------

    def compact(self, dataset: Identity, buckets: int | None = None) -> list[str]:
        """Makes a dataset's current records the snapshot of both layers.

        Covers the attempts that are committed when it begins, one row per run since the last
        compaction; afterwards their rows count by the snapshot alone. An attempt that is still
        being written, or was given up, is left alone. Returns the covered folders for ``drop``.

        With ``buckets`` the snapshot is kept in so many key buckets: this and later compactions
        rewrite only buckets that hold a newly written key, and reads join without moving the
        snapshot. The number stays until another one is given, which rewrites the snapshot once.
        """
        committed = _of_dataset(self.attempts.current(), dataset).collect()
        attempts = [Attempt(**{name: row[name] for name in _FOLDERS}) for row in committed]
        covered = [f"{self.log_path}/{attempt.folder()}" for attempt in attempts]
        pinned = self.spark.createDataFrame(
            [tuple(a.__dict__[name] for name in _FOLDERS) for a in attempts],
            T.StructType([schemas.SYNC_ATTEMPTS[name] for name in _FOLDERS]),
        )
        log = self._partitioned("log", schemas.SYNC_LOG, dataset).join(pinned, _FOLDERS, "left_semi")
        number = next_ticket()
        for layer in LAYERS:
            rows = self._log_records(layer, log)
            previous = self._compaction(layer, dataset)
            count = buckets or len(previous and previous.versions or ())
            if count:
                versions, replaced = self._merge(layer, dataset, rows, previous, count, number)
                starts = [row.started_at for row in committed]
                if previous and previous.last_started:
                    starts.append(previous.last_started)
                last = max(starts, default=None)
            else:
                versions = None
                last, replaced = self._rewrite(layer, dataset, rows, previous, number)
            covered += replaced
            self.compactions.upsert(
                self.compactions.one_row(
                    **dict(zip(schemas.IDENTITY, dataset)),
                    layer=layer,
                    compaction=number,
                    last_started=last,
                    versions=versions,
                )
            )
        if attempts:
            self._remember_batches(dataset, committed)
            self.attempts.delete(pinned)
        return covered

    def _rewrite(
        self, layer: str, dataset: Identity, rows: DataFrame, previous: Row | None, number: int
    ) -> tuple[datetime.datetime | None, list[str]]:
        """Writes a whole snapshot; returns the last start in it and the folders it replaces."""
        replaced = []
        if previous:
            rows = self._snapshot(layer, dataset).select(*rows.columns).unionByName(rows)
            replaced = [self._snapshot_folder(layer, dataset, previous.compaction)]
        folder = self._snapshot_folder(layer, dataset, number)
        kept = latest(rows, RECORD_KEY, ARRIVAL)
        # Keys in order let a reader of few keys pass over row groups and pages.
        (
            kept.drop(*schemas.IDENTITY)
            .sortWithinPartitions("record_key")
            .write.mode("errorifexists")
            .options(**_key_filters("record_key"))
            .parquet(folder)
        )
        written = self.spark.read.schema("started_at timestamp").parquet(folder)
        return written.agg(F.max("started_at")).first()[0], replaced

    def _merge(
        self,
        layer: str,
        dataset: Identity,
        rows: DataFrame,
        previous: Row | None,
        count: int,
        number: int,
    ) -> tuple[list[int], list[str]]:
        """Writes a new version of each bucket with new rows; returns versions and folders replaced.

        Only the numbers of such buckets reach the driver, at most ``count``.
        """
        buckets = self._buckets(layer, dataset, count)
        versions = list(previous.versions or ()) if previous else []
        if len(versions) != count:  # a first compaction, or one with another number of buckets
            replaced = []
            if previous and versions:
                other = self._buckets(layer, dataset, len(versions))
                replaced = [other.path(b, v) for b, v in enumerate(versions) if v]
            elif previous:
                replaced = [self._snapshot_folder(layer, dataset, previous.compaction)]
            if previous:
                rows = self._snapshot(layer, dataset).select(*rows.columns).unionByName(rows)
            buckets.write(buckets.spread(_one_per_key(rows)), number)
            return [number] * count, replaced
        touched = sorted(
            row[0] for row in rows.select(buckets.bucket_of()).distinct().toLocalIterator()
        )
        if not touched:
            return versions, []
        fresh = buckets.spread(_one_per_key(rows))
        buckets.write(newer_of(buckets.rows(versions, touched), fresh, ARRIVAL), number)
        replaced = [buckets.path(b, versions[b]) for b in touched]
        for bucket in touched:
            versions[bucket] = number
        return versions, replaced

    def _remember_batches(self, dataset: Identity, committed: list[Row]) -> None:
        """Keeps the last batch of each stream: its commit row is about to go."""
        last: dict[str, Row] = {}
        for row in committed:
            found = _BATCH.fullmatch(row.execution_id)
            if found and int(found[2]) == row.attempt:
                known = last.get(found[1])
                if known is None or known.attempt < row.attempt:
                    last[found[1]] = row
        for stream, row in last.items():
            self.stream_batches.upsert(
                self.stream_batches.one_row(
                    **dict(zip(schemas.IDENTITY, dataset)), stream=stream, batch_id=row.attempt,
                    records=row.records, last_value=row.last_value,
                )
            )

    def compacted_batch(self, dataset: Identity, stream: str) -> Row | None:
        """The last batch of a stream that compaction has covered."""
        return (
            _of_dataset(self.stream_batches.current(), dataset)
            .where(F.col("stream") == stream)
            .first()
        )

    def compact_control(self) -> list[str]:
        """Rewrites the control tables in few files; returns the covered folders for ``drop``."""
        tables = (
            self.sources, self.datasets, self.checkpoints, self.executions, self.attempts,
            self.compactions, self.stream_batches,
        )
        return [folder for table in tables for folder in table.compact()]

    def _snapshot_folder(self, layer: str, dataset: Identity, compaction: int) -> str:
        path = _dataset_folder(dataset)
        return f"{self.root}/snapshots/layer={layer}/{path}/compaction={compaction}"

    def drop(self, folders: list[str]) -> None:
        """Deletes covered folders, once no reader that began earlier is still running."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for folder in folders:
            if not folder.startswith(f"{self.root}/"):
                raise ValueError(f"{folder} is not part of this store")
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)

    # --- checkpoints ------------------------------------------------------------------

    def last_value(self, dataset: Identity) -> str | None:
        """The stored cursor of a dataset."""
        row: Row | None = _of_dataset(self.checkpoints.changes(), dataset).select(
            F.max_by(
                F.struct("last_value", "deleted"), F.struct(TICKET, "last_value")
            ).alias("change")
        ).first()
        if row is None or row.change is None or row.change.deleted:
            return None
        return row.change.last_value


def _of_dataset(df: DataFrame, dataset: Identity | None) -> DataFrame:
    for name, value in zip(schemas.IDENTITY, dataset or ()):
        df = df.where(F.col(name) == value)
    return df


def _one_per_key(rows: DataFrame) -> DataFrame:
    """The last record of each key of one dataset, without the dataset's own columns."""
    return latest(rows.select(*schemas.BUCKET_ROWS.fieldNames()), ["record_key"], ARRIVAL)


def _with_identity(rows: DataFrame, dataset: Identity) -> DataFrame:
    return rows.withColumns({n: F.lit(v) for n, v in zip(schemas.IDENTITY, dataset)})
