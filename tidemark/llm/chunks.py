"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends where some bits of it are zero, which
depends on the last ``WINDOW`` bytes alone, so an insertion moves no boundary beyond its own
neighbourhood. A chunk met before, by document and place, is a repeat; repeats in a row that are
long enough are cut out.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.encoding import BATCH_BYTES, bounded_batches, byte_slices, release

#: Bytes that decide about a boundary: as many as a 16-bit gear hash remembers.
WINDOW = 16
#: A chunk has 2^MEAN_BITS bytes on average, and ends after ``LONGEST`` in any case.
MEAN_BITS = 5
LONGEST = 512
#: Repeats of fewer bytes in a row stay.
LEAST_BYTES = 80
#: Chunks that a task remembers at one time, about.
HELD_CHUNKS = 250_000
CHUNK = ["d1", "d2", "id", "key", "place", "source"]
_SIZE_BITS = 16  # of a chunk's length in its place, below its begin


def _gears() -> np.ndarray:
    """A fixed random 16-bit number for each byte."""
    values = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    return (values >> np.uint64(48)).astype(np.uint16)


_GEARS = _gears()
_LOW = (1 << 64) - 1


def boundaries(data: bytes, mean_bits: int = MEAN_BITS, longest: int = LONGEST) -> np.ndarray:
    """Ends of the chunks of some bytes, ascending; the last is the length.

    The hash of a place is the sum of the gears of its last bytes, each shifted by its distance:
    h(i) = (h(i - 1) << 1) + gear(i), in 16 bits, here by doubling the number of bytes summed.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    values = np.frombuffer(data, np.uint8)
    hashed = _GEARS[values]
    for reach in (1, 2, 4, 8):
        longer = hashed.copy()
        longer[reach:] += hashed[:-reach] << np.uint16(reach)
        hashed = longer
    ends = np.flatnonzero(hashed >> np.uint16(16 - mean_bits) == 0) + 1
    ends = ends[ends < n]
    for _ in range(3):  # on to the start of a character, which does not depend on what is far
        ends = ends + (values[np.minimum(ends, n - 1)] & 0xC0 == 0x80) * (ends < n)
    ends = np.unique(np.append(ends, n))
    gaps = np.diff(ends, prepend=0)
    if (gaps > longest).any():
        forced = np.concatenate(
            [
                np.arange(end - gap + longest, end, longest)
                for end, gap in zip(ends.tolist(), gaps.tolist(), strict=True)
                if gap > longest
            ]
        )
        for _ in range(3):  # back to the start of a character
            forced = forced - (values[forced] & 0xC0 == 0x80)
        ends = np.unique(np.concatenate([ends, forced]))
    return ends


def row_key(text: Column, seed: int) -> Column:
    """A number that tells texts of one id apart; further seeds give other, longer ones."""
    return F.xxhash64(text, F.lit(seed)) if seed else F.hash(text)


def _telling_seed(docs: DataFrame) -> int:
    """The first seed whose keys tell apart all different texts of each id in (id, text).

    Texts are compared by their 128-bit digests. Only ids, keys and digests are shuffled,
    combined before.
    """
    for seed in itertools.count():
        digest = F.unhex(F.md5("text"))
        keys = docs.groupBy("id", row_key(F.col("text"), seed).alias("key")).agg(
            F.min(digest).alias("least"), F.max(digest).alias("most")
        )
        if keys.where("least != most").isEmpty():
            return seed


def _chunk_rows(docs: DataFrame, kind: str, mean_bits: int) -> DataFrame:
    """A row per chunk of (id, key, text) with its digest, of 128 bits in two halves.

    ``place`` holds begin and length. Where the task has met the chunk before, at an earlier
    place in the order, the second half is null and ``source`` the document of that place: such a
    repeat is certain and need not meet the others of its chunk, so it is dealt by task and number
    and a chunk of a third of all rows leaves each task a few times.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holders: dict[int, tuple] = {}
        task = TaskContext.get().partitionId()
        for batch in batches:
            done = 0
            for part in byte_slices(batch.column(2), BATCH_BYTES):
                if len(holders) > HELD_CHUNKS:
                    holders.clear()
                ids = batch.column(0).slice(done, len(part))
                keys = batch.column(1).slice(done, len(part))
                done += len(part)
                documents = zip(ids.to_pylist(), keys.to_pylist(), part.to_pylist(), strict=True)
                upper: list[int] = []
                lower: list[int | None] = []
                sources: list = []
                owners: list[int] = []
                ends: list[np.ndarray] = []
                for owner, (doc, key, text) in enumerate(documents):
                    if not text:
                        continue
                    data, begin = text.encode(), 0
                    found = boundaries(data, mean_bits)
                    for end in found.tolist():
                        digest = xxhash.xxh3_128_intdigest(data[begin:end])
                        own = (doc is None, 0 if doc is None else doc, key, begin)
                        holder = holders.get(digest)
                        if holder is None or own <= holder:
                            holders[digest] = own
                            upper.append((digest & _LOW) - (1 << 63))
                            lower.append((digest >> 64) - (1 << 63))
                            sources.append(None)
                        else:
                            upper.append(task << 32 | len(upper))
                            lower.append(None)
                            sources.append(None if holder[0] else holder[1])
                        begin = end
                    owners += [owner] * len(found)
                    ends.append(found)
                if not upper:
                    continue
                begins = np.concatenate([np.append([0], e[:-1]) for e in ends]).astype(np.int64)
                sizes = np.concatenate(ends) - begins
                at = pa.array(owners, pa.int64())
                columns = [
                    pa.array(upper, pa.int64()),
                    pa.array(lower, pa.int64()),
                    ids.take(at),
                    keys.take(at),
                    pa.array(begins << _SIZE_BITS | sizes, pa.int64()),
                    pa.array(sources, ids.type),
                ]
                yield pa.RecordBatch.from_arrays(columns, CHUNK)
            release()

    key = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(
        cut, f"d1 long, d2 long, id {kind}, key {key}, place long, source {kind}"
    )


def repeats(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    mean_bits: int = MEAN_BITS,
    seed: int | None = None,
) -> DataFrame:
    """(id, key, begin, end, source) of each chunk, in bytes, that is met before.

    The first of equal chunks by id (nulls last), ``key`` (``row_key`` with ``seed``, by default
    the first that tells all texts of each id apart) and place stays. ``source`` is a document
    that has the chunk earlier, perhaps the same one.
    """
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_column).alias("id"), text.alias("text"))
    key = row_key(F.col("text"), _telling_seed(texts) if seed is None else seed)
    keyed = texts.select("id", key.alias("key"), "text")
    chunks = _chunk_rows(keyed, docs.schema[id_column].dataType.simpleString(), mean_bits)
    order = [F.col("id").asc_nulls_last(), "key", "place"]
    chunk = Window.partitionBy("d1", "d2").orderBy(*order)
    first = F.first(F.struct("id", "key", "place")).over(chunk)
    ranked = chunks.withColumn("_first", first)
    sure = F.col("d2").isNull()
    later = ~F.col("_first").eqNullSafe(F.struct("id", "key", "place"))
    begin = F.shiftright("place", _SIZE_BITS)
    size = F.col("place").bitwiseAND(F.lit((1 << _SIZE_BITS) - 1))
    return ranked.where(sure | later).select(
        "id",
        "key",
        begin.cast("int").alias("begin"),
        (begin + size).cast("int").alias("end"),
        F.when(sure, F.col("source")).otherwise(F.col("_first.id")).alias("source"),
    )


def _cut(text: str, found: list[dict], least: int) -> tuple[str, list[dict]]:
    """The text without its runs of at least so many repeated bytes, and those runs."""
    runs: list[dict] = []
    for one in sorted(found, key=lambda r: (r["begin"], r["end"])):
        if runs and one["begin"] <= runs[-1]["end"]:
            runs[-1]["end"] = max(runs[-1]["end"], one["end"])
            runs[-1]["sources"] += [one["source"]]
        else:
            runs.append({"begin": one["begin"], "end": one["end"], "sources": [one["source"]]})
    data, at, left = text.encode(), 0, []
    gone = [run for run in runs if run["end"] - run["begin"] >= least]
    for run in gone:
        left.append(data[at : run["begin"]])
        at = run["end"]
        run["sources"] = sorted({s for s in run["sources"] if s is not None})
    left.append(data[at:])
    return b"".join(left).decode(), gone


def deduplicate(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    mean_bits: int = MEAN_BITS,
    least_bytes: int = LEAST_BYTES,
) -> DataFrame:
    """``docs`` with repeated passages cut out of the text, and ``spans`` of what was cut.

    Runs of chunks met before of at least ``least_bytes`` bytes go; ``spans`` lists them as
    (begin, end, sources): bytes of the old text, and documents that have parts of them earlier.
    Every row stays, in the end perhaps with an empty text; null texts stay null. Rows that repeat
    an id and a text are one document and get one result; rows with null ids come last in the
    order. All other columns are kept, one named ``spans`` is replaced. An empty table gives an
    empty result.
    """
    text = F.col(text_column).cast("string")
    whole = F.coalesce(text, F.lit(""))
    seed = _telling_seed(docs.select(F.col(id_column).alias("id"), whole.alias("text")))
    found = repeats(
        docs, id_column=id_column, text_column=text_column, mean_bits=mean_bits, seed=seed
    )
    by_document = found.groupBy("id", "key").agg(  # as many as a text has chunks
        F.collect_list(F.struct("begin", "end", "source")).alias("_found")
    )
    columns = [c for c in docs.columns if c != "spans"]
    keyed = docs.select(
        F.struct(*[c for c in columns if c != text_column]).alias("_row"),
        F.col(id_column).alias("_id"),
        text.alias("_text"),
        row_key(whole, seed).alias("_key"),
    )
    joined = keyed.join(
        by_document, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("key")), "left"
    )
    kind = docs.schema[id_column].dataType.simpleString()
    span = f"struct<begin: int, end: int, sources: array<{kind}>>"

    @F.arrow_udf(f"struct<text: string, spans: array<{span}>>")
    def cut(texts: pa.Array, founds: pa.Array) -> pa.Array:
        target = pa.struct(
            [
                ("text", pa.string()),
                ("spans", pa.list_(pa.struct([
                    ("begin", pa.int32()), ("end", pa.int32()),
                    ("sources", pa.list_(founds.type.value_type.field("source").type)),
                ]))),
            ]
        )
        rows = []
        for old, some in zip(texts, founds, strict=True):
            if some.is_valid and old.is_valid:
                new, gone = _cut(old.as_py(), some.as_py(), least_bytes)
                rows.append({"text": new, "spans": gone})
            else:
                rows.append({"text": old.as_py(), "spans": []})
        result = pa.array(rows, target)
        del rows
        release()
        return result

    once = cut.asNondeterministic()  # else a filter on the result would cut all texts again
    done = joined.select("_row", once("_text", "_found").alias("_done"))
    return done.select(
        *[
            (F.col("_done.text") if c == text_column else F.col(f"_row.`{c}`")).alias(c)
            for c in columns
        ],
        F.col("_done.spans").alias("spans"),
    )
