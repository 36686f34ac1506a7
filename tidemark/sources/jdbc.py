"""Datasets in PostgreSQL, MySQL and SQL Server, read in parallel through JDBC."""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.defaults import DEFAULT_SSL_MODE
from tidemark.functions.values import column_of, is_moment, require_column
from tidemark.sources.ranges import KeyRanges

# Seconds to wait for a connection, connections open at one time, and seconds
# that a query of a sync may take.
CONNECT_SECONDS = 10
MAX_CONNECTIONS = 10
QUERY_SECONDS = 600
# Shares of a table, each read by a query of its own; a connection takes one after another.
PARTITIONS = 200

_DRIVERS = {
    "postgres": "org.postgresql.Driver",
    "mysql": "com.mysql.cj.jdbc.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
}
_QUOTES = {"postgres": ('"', '"'), "mysql": ("`", "`"), "sqlserver": ("[", "]")}
# How each server maps text to an integer, for splitting a text key into even shares.
_TEXT_HASH = {
    "postgres": "abs(cast(hashtext(cast({0} as text)) as bigint))",
    "mysql": "crc32({0})",
    "sqlserver": "abs(cast(checksum({0}) as bigint))",
}


def _known(connector: str) -> str:
    if connector not in _DRIVERS:
        raise ValueError(f"unsupported connector type: {connector}")
    return connector


def connection_options(
    connector: str,
    host: str,
    port: int,
    database: str,
    username: str,
    password: str,
    ssl_mode: str | None = None,
) -> dict[str, str]:
    """Reader options of a source."""
    mode = ssl_mode or DEFAULT_SSL_MODE
    connector = _known(connector)
    if connector == "postgres":
        url = (
            f"jdbc:postgresql://{host}:{port}/{database}"
            f"?sslmode={mode}&connectTimeout={CONNECT_SECONDS}"
        )
    elif connector == "mysql":
        tls = "VERIFY_IDENTITY" if mode == "require" else "DISABLED"
        url = (
            f"jdbc:mysql://{host}:{port}/{database}"
            f"?sslMode={tls}&connectTimeout={CONNECT_SECONDS * 1000}"
        )
    else:
        name = "{" + database.replace("}", "}}") + "}"
        url = f"jdbc:sqlserver://{host}:{port};databaseName={name};loginTimeout={CONNECT_SECONDS}"
    return {"url": url, "driver": _DRIVERS[connector], "user": username, "password": password}


def quoted(connector: str, identifier: str) -> str:
    """An identifier in the dialect's quotes."""
    opening, closing = _QUOTES[_known(connector)]
    return opening + identifier.replace(closing, closing * 2) + closing


def qualified_table(connector: str, schema: str | None, table: str) -> str:
    """A table name with its schema, if there is one."""
    parts = [schema, table] if schema else [table]
    return ".".join(quoted(connector, part) for part in parts)


def text_key_shares(connector: str, column: str, shares: int) -> list[str]:
    """Predicates that put every row, nulls included, in exactly one share (S3)."""
    name = quoted(connector, column)
    bucket = f"{_TEXT_HASH[_known(connector)].format(name)} % {shares}"
    first = f"({bucket} = 0 OR {name} IS NULL)"
    return [first, *(f"{bucket} = {share}" for share in range(1, shares))]


def number_shares(
    connector: str, column: str, low: decimal.Decimal, high: decimal.Decimal, shares: int
) -> list[str]:
    """Predicates over even ranges of any number; every row, nulls included, is in one (S3)."""
    name = quoted(connector, column)
    edges = [f"{low + (high - low) * k / shares:f}" for k in range(1, shares)]
    edges = list(dict.fromkeys(edges))
    if not edges:
        return ["1 = 1"]
    inner = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(edges, edges[1:])]
    return [f"({name} < {edges[0]} OR {name} IS NULL)", *inner, f"{name} >= {edges[-1]}"]


@dataclass(frozen=True)
class ReadPlan:
    """How a table is split over connections."""

    column: str | None
    kind: str  # "range", "number", "hash" or "single"


def plan_partitions(
    schema: T.StructType, technical_key: str | None, incremental_column: str | None
) -> ReadPlan:
    """The column to split a read by (S3).

    A number or a date is split into ranges and text by its hash; Spark lays out ranges of whole
    numbers and moments, other numbers get predicates. The technical key comes first: it is
    unique, so its shares are even where many rows have one cursor value.
    """
    by_name = {field.name.lower(): field for field in schema.fields}
    found = [
        by_name[name.lower()]
        for name in (technical_key, incremental_column)
        if name and name.lower() in by_name
    ]
    for field in found:
        if is_moment(field.dataType) or isinstance(field.dataType, T.IntegralType):
            return ReadPlan(field.name, "range")
        if isinstance(field.dataType, T.NumericType):
            return ReadPlan(field.name, "number")
    for field in found:
        if isinstance(field.dataType, T.StringType):
            return ReadPlan(field.name, "hash")
    return ReadPlan(None, "single")


def range_literal(kind: T.DataType, text: str) -> str | None:
    """A stored cursor as a SQL literal for laying out ranges; None if it has no plain form.

    Moments are cut to milliseconds, which every server reads; ranges need no more.
    """
    try:
        if is_moment(kind):
            moment = datetime.datetime.fromisoformat(text).replace(tzinfo=None)
            return f"'{moment.isoformat(' ', 'milliseconds')}'"
        if isinstance(kind, T.NumericType):
            number = decimal.Decimal(text)
            return f"{number:f}" if number.is_finite() else None
    except (ValueError, decimal.InvalidOperation):
        pass
    return None


def read_table(
    spark: SparkSession,
    connector: str,
    options: Mapping[str, str],
    table: str,
    technical_key: str | None = None,
    incremental_column: str | None = None,
    batch_size: int = 1000,
    connections: int | None = MAX_CONNECTIONS,
    query_seconds: int = QUERY_SECONDS,
    last_value: str | None = None,
    partitions: int = PARTITIONS,
    counted: bool = False,
) -> DataFrame:
    """A table read over several connections (S2, S3); ``table`` is already qualified.

    The table is read in ``partitions`` queries, at most ``connections`` at a time (None: as many
    as there are task slots, where each query is a task that is repeated alone).

    Connections see different moments of a table that is being written, so the read is bounded
    by the greatest cursor found first; rows beyond it belong to the next run. With the stored
    cursor as ``last_value`` the ranges are laid over the new rows only, which otherwise would all
    fall to one connection; it filters nothing.

    ``counted`` lays the ranges by counts of the key (``ranges``), so a skewed key gives even
    shares and a text key is read by ranges instead of as many scans. It costs a few aggregate
    queries over the key column; otherwise ranges are of equal width.
    """
    settings = {**options, "fetchsize": str(batch_size), "queryTimeout": str(query_seconds)}
    reader = spark.read.format("jdbc").options(**settings)
    whole = reader.option("dbtable", table).load()
    plan = plan_partitions(whole.schema, technical_key, incremental_column)

    newer = ""
    if incremental_column and last_value:
        cursor = require_column(whole, incremental_column)
        literal = range_literal(cursor.dataType, last_value)
        if literal:
            newer = f" WHERE {quoted(connector, cursor.name)} > {literal}"

    def bounds(column: str) -> Row:
        name = quoted(connector, column)
        query = f"SELECT MIN({name}) AS low, MAX({name}) AS high FROM {table}{newer}"
        return reader.option("query", query).load().toDF("low", "high").first()

    def by_predicates(shares: list[str]) -> DataFrame:
        properties = {k: v for k, v in settings.items() if k != "url"}
        return spark.read.jdbc(options["url"], table, predicates=shares, properties=properties)

    rows = whole
    if counted and plan.column:
        kind = require_column(whole, plan.column).dataType
        shares = KeyRanges(
            lambda query: reader.option("query", query).load().collect(),
            connector, table, quoted(connector, plan.column), kind, newer,
        ).predicates(partitions)
        if len(shares) > 1:
            rows = by_predicates(shares)
    elif plan.kind == "range":
        limits = bounds(plan.column)
        if limits.low is not None and limits.low < limits.high:
            rows = (
                spark.read.format("jdbc")
                .options(**settings)
                .option("dbtable", table)
                .option("partitionColumn", quoted(connector, plan.column))
                .option("lowerBound", str(limits.low))
                .option("upperBound", str(limits.high))
                .option("numPartitions", str(partitions))
                .load()
            )
    elif plan.kind == "number":
        limits = bounds(plan.column)
        ends = [_finite(limits.low), _finite(limits.high)]
        if None not in ends and ends[0] < ends[1]:
            rows = by_predicates(number_shares(connector, plan.column, *ends, partitions))
    elif plan.kind == "hash":
        rows = by_predicates(text_key_shares(connector, plan.column, connections or MAX_CONNECTIONS))
    split = counted or plan.kind in ("range", "number")
    if connections and plan.column and split and connections < partitions:
        rows = rows.coalesce(connections)
    if incremental_column:
        cursor = require_column(whole, incremental_column)
        high = bounds(cursor.name).high
        if high is not None:
            name = column_of(cursor.name)
            rows = rows.where((name <= F.lit(high).cast(cursor.dataType)) | name.isNull())
    return rows


def _finite(value: object) -> decimal.Decimal | None:
    number = None if value is None else decimal.Decimal(str(value))
    return number if number is not None and number.is_finite() else None


def open_with(
    spark: SparkSession,
    password_of: Callable[[str], str],
    connections: int | None = MAX_CONNECTIONS,
    partitions: int = PARTITIONS,
    query_seconds: int = QUERY_SECONDS,
    counted: bool = True,
) -> Callable[[Row], DataFrame]:
    """Opens a resolved dataset over JDBC; ``password_of`` looks a secret up by reference."""

    def open_dataset(dataset: Row) -> DataFrame:
        connector = dataset.source_connector
        options = connection_options(
            connector,
            dataset.host,
            dataset.port,
            dataset.database_name,
            dataset.username,
            password_of(dataset.password_ref),
            dataset.ssl_mode,
        )
        return read_table(
            spark,
            connector,
            options,
            qualified_table(connector, dataset.dataset_schema, dataset.table_name),
            dataset.technical_key,
            dataset.incremental_column if dataset.sync_mode == "incremental" else None,
            dataset.batch_size,
            connections,
            query_seconds,
            dataset.last_value,
            partitions,
            counted,
        )

    return open_dataset
