"""WARC archives of pages: deterministic shards, rolled files, commit by manifest."""

from __future__ import annotations

import base64
import contextlib
import datetime
import gzip
import hashlib
import io
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote, unquote_to_bytes

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.graph import Scratch
from tidemark.sinks.control import read_parquet

#: Bytes of payload in a shard, the rows that one task sorts and writes.
SHARD_BYTES = 64 << 20
#: From this many shards on they become larger instead of more; files keep their size.
MOST_SHARDS = 4096
#: Compressed bytes after which a shard goes on in a further file.
ROLL_BYTES = 1 << 30
#: What a record takes besides its payload, about.
RECORD_BYTES = 512
#: Payloads of fewer bytes are written whole each time.
LEAST_REVISIT = 1000
#: Rows, per shard, from which the bounds of the shards are taken.
BOUNDS_SAMPLE = 64

_READ_BYTES = 1 << 20
_MANIFEST = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("temporary", T.StringType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("records", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("sha256", T.StringType()),
    ]
)
# Names and forms of the WARC 1.1 format.
_VERSION = b"WARC/1.1\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RESPONSE_TYPE = "application/http;msgtype=response"


# --- places ---------------------------------------------------------------------------


def _filesystem(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a Hadoop-style path as tasks open it, and the path in it."""
    if folder.startswith(("file:", "/")):
        return pyarrow.fs.LocalFileSystem(), re.sub("^file:/*", "/", folder)
    return pyarrow.fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", folder))


# --- records --------------------------------------------------------------------------


def _header_text(value: str) -> str:
    """A value as one line of printable ASCII."""
    return quote(value, safe="!\"#$&'()*+,-./:;<=>?@[\\]^_`{|}~")


def _record_id(page: str | None, key: bytes, ordinal: int) -> str:
    seed = hashlib.sha256(f"{ordinal}:{page is None}:{page or ''}:".encode() + key).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=seed[:16], version=5)}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own, the same bytes each time."""
    lines = [*headers, ("Content-Length", str(len(block)))]
    head = _VERSION + "".join(f"{n}: {v}\r\n" for n, v in lines).encode("ascii") + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head) + packer.compress(block + b"\r\n\r\n") + packer.flush()


def _http_head(size: int) -> bytes:
    return (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode()


def _page_member(
    page: str | None, url: str | None, payload: bytes, key: bytes, ordinal: int, date: str,
    revisits: tuple | None,
) -> bytes:
    """A response, or a revisit of the page that ``revisits`` holds."""
    head = _http_head(len(payload))
    block = head if revisits else head + payload
    uri = url or f"urn:x-page:{quote(page or '', safe='')}"
    headers = [
        ("WARC-Type", "revisit" if revisits else "response"),
        ("WARC-Record-ID", _record_id(page, key, ordinal)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _header_text(uri)),
        ("WARC-Payload-Digest", _sha1(payload)),
        ("WARC-Block-Digest", _sha1(block)),
        ("Content-Type", _RESPONSE_TYPE),
    ]
    if page is not None:
        headers.append(("X-Page-Id", quote(page, safe="")))
    if revisits:
        (first,) = revisits
        headers += [
            ("WARC-Profile", _PROFILE),
            ("WARC-Refers-To", _record_id(first, key, 0)),
            ("WARC-Refers-To-Date", date),
        ]
        if first is not None:
            headers.append(("X-Refers-To-Page-Id", quote(first, safe="")))
    return _member(headers, block)


class _File:
    """A file under its temporary name, counted and hashed as it grows."""

    def __init__(self, root: str, shard: int, part: int, date: str) -> None:
        self.name = f"shard-{shard:05d}-{part:04d}.warc.gz"
        # Another attempt at the same shard writes under another name.
        self.temporary = f"_temporary/{uuid.uuid4().hex}-{self.name}"
        self.shard, self.part, self.records, self.bytes = shard, part, 0, 0
        self.digest = hashlib.sha256()
        files, path = _filesystem(root)
        files.create_dir(f"{path}/_temporary", recursive=True)
        self.stream = files.open_output_stream(f"{path}/{self.temporary}", compression=None)
        body = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
        info = [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", _record_id(self.name, b"", 0)),
            ("WARC-Date", date),
            ("WARC-Filename", self.name),
            ("Content-Type", "application/warc-fields"),
        ]
        self._write(_member(info, body))

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.digest.update(data)
        self.bytes += len(data)

    def add(self, member: bytes) -> None:
        self._write(member)
        self.records += 1

    def close(self) -> tuple:
        self.stream.close()
        return (
            self.name, self.temporary, self.shard, self.part, self.records, self.bytes,
            self.digest.hexdigest(),
        )


def _manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, _MANIFEST.fieldNames())


# --- writing --------------------------------------------------------------------------


def _facts(pages: DataFrame) -> DataFrame:
    """Pages with their payload's bytes and its SHA-256, by which payloads are told apart."""
    payload = F.coalesce(F.col("_payload").cast("binary"), F.lit(b""))
    rows = pages.withColumn("_payload", payload)
    return rows.withColumn("_key", F.unhex(F.sha2("_payload", 256)))


def _revisits(facts: DataFrame, least: int) -> DataFrame:
    """(_id, _key, _first) of pages whose payload others have too; _first is the response.

    Only ids and digests are shuffled. Counts are combined before the shuffle, so a payload that a
    third of the pages have is one row per task; the join with it is one Spark can split.
    """
    large = facts.where(F.octet_length("_payload") >= least).select("_id", "_key")
    shared = (
        large.groupBy("_key")
        .agg(F.max("_id").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    return large.join(shared, "_key").groupBy("_id", "_key").agg(F.max("_first").alias("_first"))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 64) -> Iterator[pa.RecordBatch]:
    """A few rows at a time: Python's own copies of payloads stay small beside a batch."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def _shard_of(bounds: list[tuple]):
    @F.arrow_udf("int")
    def shard(ids: pa.Array, keys: pa.Array) -> pa.Array:
        pairs = zip(ids.to_pylist(), keys.to_pylist(), strict=True)
        return pa.array([bisect_right(bounds, _sorting(*pair)) for pair in pairs], pa.int32())

    return shard


def _sorting(page, key: bytes) -> tuple:
    return (False, key) if page is None else (True, page, key)


def _bounds(facts: DataFrame, shard_bytes: int, most: int) -> list[tuple]:
    """First sort keys of all shards but the first, with equal bytes between them in a sample.

    The sample holds the rows with the least hashes, and the number of shards follows from the
    bytes, so both depend on the rows alone and not on how Spark happens to deal them.
    """
    held = F.octet_length("_payload").cast("long") + RECORD_BYTES
    size = facts.agg(F.sum(held)).first()[0] or 0
    shards = max(1, min(most, -(-size // shard_bytes)))
    if shards == 1:
        return []
    mark = F.xxhash64("_id", "_key").alias("_mark")
    sample = facts.select("_id", "_key", held.alias("_held"), mark).orderBy("_mark", "_id", "_key")
    sample = sample.limit(shards * BOUNDS_SAMPLE).collect()  # at most MOST_SHARDS times as many
    rows = sorted((_sorting(row["_id"], bytes(row["_key"])), row["_held"]) for row in sample)
    each = sum(held for _, held in rows) / shards
    bounds, before = set(), 0
    for key, held in rows:
        # The first row of a share begins a shard; a row larger than a share has one to itself.
        if before // each != (before + held) // each and before:
            bounds.add(key)
        before += held
    return sorted(bounds)


def write(
    pages: DataFrame,
    folder: str,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    date: str = "2000-01-01T00:00:00Z",
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
    least_revisit: int = LEAST_REVISIT,
) -> None:
    """Writes one record per row into WARC files in ``folder``, and last a manifest of them.

    Payloads (text, in UTF-8, or bytes) of at least ``least_revisit`` bytes are stored once: of
    the records with equal ones that with the largest id is a response, the others revisit it.
    Null payloads are empty, null urls are replaced by one made from the id, null ids are smaller
    than any other and records of them refer to nothing that could be named. Rows that repeat id
    and payload are records of their own; of those that hold the largest id the first is the
    response. Ids have to be of a type that text can be cast back to. Other columns are not read.
    An empty table gives an archive without files. ``date`` is the date of all records.

    Records are dealt into shards by id, and where ids are equal by payload, with bounds taken
    from the rows alone; each shard is sorted and goes into files of about ``roll_bytes``
    compressed. Every record is a gzip member, with its headers and digests made here, so the
    same rows always give the same files. A payload is shuffled once.

    Tasks write under temporary names of their own. When all have ended, the files of the attempts
    that counted get their names, and the manifest is written: an archive is complete if it has
    one, and nothing else in the folder belongs to it. ``folder`` has to be one that Arrow can
    open on every executor: a shared mount, or an object store or HDFS with its client library.
    """
    spark = pages.sparkSession
    if not read_parquet(spark, f"{folder}/manifest", _MANIFEST).isEmpty():
        raise FileExistsError(f"{folder} holds an archive already")
    datetime.datetime.fromisoformat(date)
    rows = pages.select(
        F.col(id_column).alias("_id"),
        F.col(url_column).cast("string").alias("_url"),
        F.col(payload_column).alias("_payload"),
    )
    facts = _facts(rows)
    scratch = Scratch(spark)
    again = scratch.keep(_revisits(facts, least_revisit), "warc-revisits")
    bounds = _bounds(facts, shard_bytes, MOST_SHARDS)
    nothing = F.lit(None)
    # What is known of a record's payload travels ahead of it, sorted right before it.
    known = again.select(
        "_id", "_key", nothing.cast("string").alias("_url"), nothing.cast("binary").alias("_payload"),
        F.lit(False).alias("_page"), F.col("_first").cast("string").alias("_first"),
        (F.col("_first").eqNullSafe(F.col("_id"))).alias("_is_first"),
    )
    records = facts.select(
        "_id", "_key", "_url", "_payload",
        F.lit(True).alias("_page"), nothing.cast("string").alias("_first"),
        F.lit(False).alias("_is_first"),
    )
    dealt = (
        known.unionByName(records)
        .withColumn("_shard", _shard_of(bounds)("_id", "_key") if bounds else F.lit(0))
        .repartitionById(len(bounds) + 1, F.col("_shard"))
        .sortWithinPartitions("_shard", "_id", "_key", "_page", "_url")
        .select(
            "_shard", F.col("_id").cast("string").alias("_id"), "_key", "_url", "_payload",
            "_page", "_first", "_is_first",
        )
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        file = group = first = None
        ordinal = 0
        with contextlib.ExitStack() as open_:
            for some in _slices(batches):
                for row in zip(*(c.to_pylist() for c in some.columns), strict=True):
                    shard, page, key, url, payload, is_page, target, is_first = row
                    if group != (shard, page, key):
                        group, first, ordinal = (shard, page, key), None, 0
                    if not is_page:
                        first = (target, is_first)
                        continue
                    if file is None or file.shard != shard or file.bytes >= roll_bytes:
                        part = 0 if file is None or file.shard != shard else file.part + 1
                        if file is not None:
                            done.append(file.close())
                        file = _File(folder, shard, part, date)
                        open_.callback(file.stream.close)
                    revisits = None
                    if first is not None and not (first[1] and ordinal == 0):
                        revisits = first[:1]
                    file.add(_page_member(page, url, payload, key, ordinal, date, revisits))
                    ordinal += 1
            if file is not None:
                done.append(file.close())
        yield _manifest_batch(done)

    # Only the rows of attempts that counted are in this table.
    written = scratch.keep(dealt.mapInArrow(pack, _MANIFEST), "warc-written")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                final, temporary = f"{path}/{row['name']}", f"{path}/{row['temporary']}"
                # A repeated commit finds the file under its name already.
                if files.get_file_info(temporary).type != pyarrow.fs.FileType.NotFound:
                    files.move(temporary, final)
                if files.get_file_info(final).size != row["bytes"]:
                    raise OSError(f"{final} does not have {row['bytes']} bytes")
            yield batch

    written.mapInArrow(commit, _MANIFEST).write.parquet(f"{folder}/manifest")
    scratch.folders.append(f"{folder}/_temporary")  # what lost attempts have left
    scratch.release()


# --- reading --------------------------------------------------------------------------


def _records(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and block of each record of an unpacked file."""
    while line := stream.readline():
        if line != _VERSION:
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("ascii").partition(":")
            headers[name.lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]) or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('warc-record-id')} is cut short")
        yield headers, block


def _page_row(headers: dict[str, str], block: bytes) -> tuple:
    """A page's record as a row; digests are computed anew from what the record holds."""
    if _sha1(block) != headers["warc-block-digest"]:
        raise ValueError(f"record {headers['warc-record-id']} is damaged")
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
    stated = headers["warc-payload-digest"]
    whole = headers["warc-type"] == "response"
    if whole and (len(payload) != size or _sha1(payload) != stated):
        raise ValueError(f"payload of record {headers['warc-record-id']} is damaged")

    def page(name: str) -> str | None:
        return unquote_to_bytes(headers[name]).decode() if name in headers else None

    return (
        page("x-page-id"), headers["warc-record-id"], headers["warc-target-uri"],
        headers["warc-type"], size, base64.b32decode(stated.removeprefix("sha1:")).hex(),
        page("x-refers-to-page-id"), headers.get("warc-refers-to"),
        payload if whole else None,
    )


_ROW = (
    "_id string, record_id string, uri string, record_type string, payload_bytes long,"
    " payload_digest string, _refers string, refers_to_record string, payload binary"
)


def read(
    spark: SparkSession,
    folder: str,
    *,
    id_column: str = "page_id",
    id_type: str = "long",
    payloads: bool = False,
) -> DataFrame:
    """The pages' records of an archive, one row each.

    Columns: the page's id, record_id, uri, record_type, payload_bytes and payload_digest (bare
    hex SHA-1) of the whole payload, refers_to and refers_to_record (page and record that a
    revisit refers to) and, if asked for, payload: null for revisits, see ``restored``.

    Files are those of the manifest, each read as a stream by one task; without a manifest there
    is no archive. Sizes, block digests and the payload digests of responses are verified.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    files = max(1, manifest.count())

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _filesystem(folder)
        for batch in batches:
            for name, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if store.get_file_info(f"{path}/{name}").size != size:
                    raise OSError(f"{name} does not have {size} bytes")
                with store.open_input_stream(f"{path}/{name}", compression=None) as packed:
                    unpacked = io.BufferedReader(gzip.GzipFile(fileobj=packed), _READ_BYTES)
                    rows, held = [], 0
                    for headers, block in _records(unpacked):
                        if headers["warc-type"] == "warcinfo":
                            continue
                        row = _page_row(headers, block)
                        rows.append(row if payloads else (*row[:-1], None))
                        held += 500 + len(row[-1] or b"") * payloads
                        if held > 4 * _READ_BYTES:
                            yield _page_batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _page_batch(rows)

    found = (
        manifest.select("name", "bytes")
        .repartition(min(files, MOST_SHARDS))
        .mapInArrow(unpack, _ROW)
    )
    kept = ("record_id", "uri", "record_type", "payload_bytes", "payload_digest")
    return found.select(
        F.col("_id").cast(id_type).alias(id_column),
        *kept,
        F.col("_refers").cast(id_type).alias("refers_to"),
        "refers_to_record",
        *(["payload"] if payloads else []),
    )


def _page_batch(rows: list[tuple]) -> pa.RecordBatch:
    text = pa.string()
    kinds = [text, text, text, text, pa.int64(), text, text, text, pa.binary()]
    names = [field.split()[0] for field in _ROW.split(", ")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


def restored(records: DataFrame) -> DataFrame:
    """``read(..., payloads=True)`` with revisits' payloads taken from the records they refer to."""
    kept = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("payload").alias("_payload")
    )
    payload: Column = F.coalesce("payload", "_payload").alias("payload")
    return records.join(kept, "refers_to_record", "left").select(
        *(c for c in records.columns if c != "payload"), payload
    )


def write_sql(pages: str, least_revisit: int = LEAST_REVISIT) -> str:
    """What ``read`` finds of each page, as SQL of DuckDB over a table with the default columns."""
    return f"""
    WITH facts AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
            sha1(coalesce(html, '')) AS payload_digest
        FROM {pages}
    ),
    placed AS (
        SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS largest FROM facts
    )
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= {least_revisit} AND page_id <> largest
            THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= {least_revisit} AND page_id <> largest THEN largest END AS refers_to
    FROM placed
    """
