"""Locality-sensitive digests of whole texts: quartiles of hashed byte-triplet counts."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 128
#: A difference of this much or more is likeness 0; unrelated digests differ by about as much.
BOUND = 208
RESULT = (
    "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
)
# Triplets of a window of five bytes: the last byte with two of the four before it.
_TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
_SALTS = (2, 3, 5, 7, 11, 13)


def _tables() -> np.ndarray:
    """Three fixed scrambles of a byte, one for each place in a triplet."""
    values = np.arange(256, dtype=np.uint64)
    tables = []
    for place in (1, 2, 3):
        mixed = (values + np.uint64(place << 8)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        tables.append((mixed >> np.uint64(57)).astype(np.uint8))
    return np.stack(tables)


_LAST, _MIDDLE, _FIRST = _tables()
_LENGTH_STEP = 1.3


def digest(data: bytes) -> str:
    """Hex digits: two for the length's logarithm, two for quartile ratios, the rest for buckets.

    Each bucket has two bits: the quartile of its count. Texts of fewer than five bytes have no
    triplets; their buckets are all alike and the digest holds their bytes' checksum in place of
    the ratios.
    """
    values = np.frombuffer(data, np.uint8)
    n = len(values)
    size = min(255, math.floor(math.log(n + 1, _LENGTH_STEP)))
    if n < 5:
        return f"{size:02x}{sum(data) % 256:02x}" + "0" * (BUCKETS // 2)
    last, middle, first = _LAST[values], _MIDDLE[values], _FIRST[values]
    hashed = np.concatenate(
        [
            last[4:] + middle[4 - near : n - near] + first[4 - far : n - far] + np.uint8(salt)
            for (near, far), salt in zip(_TRIPLETS, _SALTS, strict=True)
        ]
    )
    counts = np.bincount(hashed & (BUCKETS - 1), minlength=BUCKETS)
    ordered = np.sort(counts)
    q1, q2, q3 = (int(ordered[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    ratios = (q1 * 16 // max(q3, 1) % 16) * 16 + q2 * 16 // max(q3, 1) % 16
    packed = codes[0::4] << 6 | codes[1::4] << 4 | codes[2::4] << 2 | codes[3::4]
    return f"{size:02x}{ratios:02x}{packed.tobytes().hex()}"


def _codes(fingerprint: str) -> np.ndarray:
    packed = np.frombuffer(bytes.fromhex(fingerprint[4:]), np.uint8)
    return np.stack([packed >> 6 & 3, packed >> 4 & 3, packed >> 2 & 3, packed & 3], 1).ravel()


# Two quartiles apart counts 2, opposite ends 6.
_APART = np.array([0, 1, 2, 6])


def difference(one: str, other: str) -> int:
    """0 for equal digests, never more than ``BOUND``."""
    if one == other:
        return 0
    apart = np.abs(_codes(one).astype(np.int8) - _codes(other).astype(np.int8))
    total = int(_APART[apart].sum())
    lengths = abs(int(one[:2], 16) - int(other[:2], 16))
    total += lengths if lengths <= 1 else 6 * lengths
    for at in (2, 3):
        gap = abs(int(one[at], 16) - int(other[at], 16))
        gap = min(gap, 16 - gap)
        total += gap if gap <= 1 else 6 * (gap - 1)
    return min(BOUND, max(1, total))


def likeness(one: str, other: str) -> float:
    """1 for equal digests, down to 0 at the bound."""
    return 1 - difference(one, other) / BOUND


def lanes(docs: DataFrame, id_column: str, count: int) -> tuple[list, dict]:
    """Bounds of about equally large ranges of ids, and where each range's first id goes too.

    The second holds, for the first id of each range that has rows, the range before it (for the
    first range the last): so each range can be read to its end and one document further.
    """
    ids = docs.select(F.col(id_column).alias("_id")).where("_id IS NOT NULL")
    shares = [k / count for k in range(1, count)]
    cuts = ids.agg(F.percentile_approx("_id", F.array(*map(F.lit, shares)), 20 * count)).first()[0]
    bounds = sorted(set(cuts or []))
    first = (
        ids.withColumn("_lane", _lane_of(bounds)("_id"))
        .groupBy("_lane")
        .agg(F.min("_id").alias("_id"))
        .orderBy("_lane")
        .collect()
    )
    return bounds, {r["_id"]: first[k - 1]["_lane"] for k, r in enumerate(first)}


def _lane_of(bounds: list):
    edges = np.array(bounds, np.int64)

    @F.arrow_udf("int")
    def lane(ids: pa.Array) -> pa.Array:
        known = ids.fill_null(0).to_numpy(zero_copy_only=False)
        found = np.searchsorted(edges, known, side="left").astype(np.int32)
        return pa.array(found, mask=np.asarray(ids.is_null()))

    return lane


def fingerprints(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    lanes_per_partition: int = 4,
) -> DataFrame:
    """One row per row of ``docs``: its digest, its edited text's, and how like they and the next
    document's are.

    The edited text has its second half (the last floor(n/2) characters) replaced by as many
    characters, or all, from the start of the next document by ascending id; after the last comes
    the first. Ids are whole numbers. Rows with equal ids are ordered by text and each is the
    next of the one before; rows with null ids come first, among themselves. Null texts count as
    empty; an only document is its own next. Other columns are not read; an empty table gives an
    empty result.

    Texts are shuffled once, into ranges of ids that are read in order; the first document of
    each range is sent to the range before as well, so no range has to wait for another.
    """
    if id_column in RESULT:
        raise ValueError(f"{id_column!r} is a column of the result")
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(
        F.col(id_column).cast("long").alias("_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("_text"),
    )
    bounds, also = lanes(docs, id_column, partitions * lanes_per_partition)
    own = F.coalesce(_lane_of(bounds)("_id"), F.lit(-1))
    routes = texts.withColumn("_lane", own)
    heads = F.broadcast(
        spark.createDataFrame(list(also.items()), "_id long, _before int")  # a row per range
    )
    tails = routes.join(heads, "_id").select(
        "_id", "_text", F.col("_before").alias("_lane"), F.lit(True).alias("_tail")
    )
    placed = routes.select("_id", "_text", "_lane", F.lit(False).alias("_tail")).unionByName(tails)
    ordered = placed.repartition(partitions * lanes_per_partition, "_lane").sortWithinPartitions(
        "_lane", "_tail", "_id", "_text"
    )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane = first = held = None
        out: list[tuple] = []

        def close(row: tuple, after: tuple) -> None:
            doc, text, mark = row
            half = len(text) // 2
            edited = (text[: len(text) - half] + after[1][:half]).encode()
            edited_mark = digest(edited) if half else mark
            out.append(
                (
                    doc, len(text), hashlib.sha256(edited).hexdigest(), mark, edited_mark,
                    likeness(mark, edited_mark), likeness(mark, after[2]),
                )
            )

        for batch in batches:
            for doc, text, at, tail in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != lane:
                    if held is not None:
                        close(held, first)
                    lane, held, first = at, None, None
                row = (doc, text, digest(text.encode()))
                if held is not None:
                    close(held, row)
                    held = None
                if not tail:
                    held = row
                first = first or row
            if out:
                yield _batch(out)
                out = []
        if held is not None:
            close(held, first)
        if out:
            yield _batch(out)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (
            pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()
        )
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["_id", *RESULT])

    found = ordered.mapInArrow(
        follow,
        "_id long, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double",
    )
    return found.select(F.col("_id").cast(kind).alias(id_column), *RESULT)
