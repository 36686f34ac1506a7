"""Small control tables kept as append-only change logs in Parquet.

Nothing is ever rewritten in place, so concurrent writers and a lost driver cannot damage a
table; the current rows are the last change of each key. From time to time a table is folded: the
last changes are written as one more folder, and a list names the folders that it stands for. A
reader opens the newest fold and the folders that its list does not name.
"""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.operators.upsert import latest

# Place of a change in the order of changes, and partition column of append-only tables.
TICKET = "change_ticket"
WRITE = "write_ticket"

#: A table is folded once more than this many folders have come since its last fold.
FOLD_AFTER = 64
#: Seconds for which folders stay after they were folded, for readers that began before.
KEEP_SECONDS = 86_400.0
#: Where the lists of folded folders are; Spark does not read names that begin so.
_LISTS = "_folded"

log = logging.getLogger(__name__)
_fold_lock = threading.Lock()
_ticket_lock = threading.Lock()
_last_ticket = 0


def next_ticket() -> int:
    """A number greater than any handed out before: the clock, in nanoseconds."""
    global _last_ticket
    with _ticket_lock:
        _last_ticket = max(time.time_ns(), _last_ticket + 1)
        return _last_ticket


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType, base: str | None = None
) -> DataFrame:
    """A Parquet folder under a fixed schema; a folder not yet written is an empty table.

    ``base`` is the folder of the whole table, where ``path`` is some of its partitions.
    """
    reader = spark.read.schema(schema)
    try:
        return (reader.option("basePath", base) if base else reader).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_folder(rows: DataFrame, path: str, ticket: int | None = None) -> None:
    """Appends rows as a folder of their own.

    Two jobs that append to one folder share its temporary files, and the first to finish
    removes those of the other; separate folders keep concurrent writers apart.
    """
    rows.write.mode("errorifexists").parquet(f"{path}/{WRITE}={ticket or next_ticket()}")


class _Folder:
    """Names, small texts and deletions in one folder of Spark's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.path = path
        root = self._hadoop.Path(path)
        self._files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, below: str = "") -> dict[str, int]:
        """What lies in the folder, with the time of its last change in milliseconds."""
        if not self._files.exists(self._at(below)):
            return {}
        found = self._files.listStatus(self._at(below))
        return {status.getPath().getName(): status.getModificationTime() for status in found}

    def text(self, name: str) -> str:
        stream = self._files.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Writes a text that is seen as a whole or not at all."""
        hidden = self._at(f"{name}.unfinished")
        stream = self._files.create(hidden, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self._files.rename(hidden, self._at(name)):
            raise OSError(f"{self.path}/{name} could not be written")

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)


class ControlTable:
    """Keyed rows with upsert and delete."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        keep_first: Sequence[str] = (),
        fold_after: int = FOLD_AFTER,
        keep_seconds: float = KEEP_SECONDS,
    ):
        self.spark = spark
        self.path = path
        self.fold_after = fold_after
        self.keep_seconds = keep_seconds
        self.schema = schema
        self.keys = list(keys)
        self.keep_first = list(keep_first)
        self.change_schema = T.StructType(
            [
                *schema.fields,
                T.StructField(TICKET, T.LongType()),
                T.StructField("deleted", T.BooleanType()),
                T.StructField(WRITE, T.LongType()),
            ]
        )

    def _append(self, rows: DataFrame, deleted: bool) -> None:
        if rows.schema != self.schema:
            present = set(rows.columns)
            rows = rows.select(
                *(
                    (F.col(f.name) if f.name in present else F.lit(None))
                    .cast(f.dataType)
                    .alias(f.name)
                    for f in self.schema.fields
                )
            )
        marks = {TICKET: F.lit(next_ticket()), "deleted": F.lit(deleted)}
        append_folder(rows.withColumns(marks), self.path)
        if len(self._open()[0]) > self.fold_after:
            try:
                self.fold()
            except Exception:  # noqa: BLE001 - the change is written; a later one folds
                log.warning("%s could not be folded", self.path, exc_info=True)

    def upsert(self, rows: DataFrame) -> None:
        """Inserts rows or replaces those of the same key (K3, K5, K6, K7)."""
        self._append(rows, deleted=False)

    def delete(self, keys: DataFrame) -> None:
        """Removes the rows of the given keys (K4)."""
        self._append(keys.select(*self.keys), deleted=True)

    def _open(self) -> tuple[list[str], set[str]]:
        """Folders that count, and those that the newest fold stands for."""
        folder = _Folder(self.spark, self.path)
        lists = [int(name) for name in folder.names(_LISTS) if name.isdigit()]
        folded = set(folder.text(f"{_LISTS}/{max(lists)}").splitlines()) if lists else set()
        present = [name for name in folder.names() if name.startswith(f"{WRITE}=")]
        return sorted(set(present) - folded), folded & set(present)

    def _changes_in(self, names: Sequence[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.change_schema)
        reader = self.spark.read.schema(self.change_schema).option("basePath", self.path)
        return reader.parquet(*(f"{self.path}/{name}" for name in names))

    def changes(self) -> DataFrame:
        return self._changes_in(self._open()[0])

    def _last_changes(self, changes: DataFrame) -> DataFrame:
        return latest(changes.drop(WRITE), self.keys, [TICKET], self.keep_first)

    def fold(self) -> list[str]:
        """Writes the last change of every key, deletions included, as one more folder.

        These rows keep their place in the order, so a change made meanwhile still wins, as does
        one whose folder appears only now: what a fold stands for is listed by name. Two folds at
        a time do no harm, since each lists only what it has read. Folders are deleted
        ``keep_seconds`` after the fold that lists them. Returns the folders listed.
        """
        with _fold_lock:
            names, hidden = self._open()
            if not names:
                return []
            ticket = next_ticket()
            append_folder(self._last_changes(self._changes_in(names)), self.path, ticket)
            folder = _Folder(self.spark, self.path)
            folder.put(f"{_LISTS}/{ticket}", "\n".join(sorted({*names, *hidden})))
            self._expire(folder, ticket)
            return [f"{self.path}/{name}" for name in names]

    def _expire(self, folder: _Folder, newest: int) -> None:
        """Deletes what lists older than ``keep_seconds`` name, and those lists."""
        lists = {int(name): at for name, at in folder.names(_LISTS).items() if name.isdigit()}
        moment = lists[newest]
        for ticket, at in lists.items():
            if ticket != newest and moment - at >= self.keep_seconds * 1000:
                for name in folder.text(f"{_LISTS}/{ticket}").splitlines():
                    folder.delete(name)
                folder.delete(f"{_LISTS}/{ticket}")

    def compact(self) -> list[str]:
        """As ``fold``, for a caller who deletes the folders with ``Store.drop``."""
        return self.fold()

    def current(self) -> DataFrame:
        last = self._last_changes(self.changes())
        return last.where(~F.col("deleted")).select(*self.schema.fieldNames())

    def one_row(self, **values: object) -> DataFrame:
        """A single row of this table's schema."""
        return self.spark.createDataFrame(
            pa.Table.from_pylist([values], to_arrow_schema(self.schema)), self.schema
        )
