"""Exact similarity join of documents by word n-grams, over a token-group matrix.

1. Documents with equal sets are one class. Tokens (hashed shingles) have one order: those that
   a count sketch of fixed size finds frequent come last, others by their hash.
2. Classes that share minima of the hash are compared with the most usual of them, which makes
   groups of similar documents in linear time.
3. The matrix holds, for each group, the union of its members' tokens that matter: of a set of n
   tokens the first n - ceil(8n/9) + 1, since a pair with similarity 0.8 shares one of these and
   one of the first n - ceil(4n/5) + 1 of the larger set. If a query has none of its first tokens
   in the union, it overlaps the union in fewer than 0.8 n tokens, and the group stays closed. It
   does also where the first common token stands so late that too few can follow it, in the
   query or in all members.
4. Only in qualifying other groups are the members compared with the query: first by a sketch of
   parities, which bounds their difference from below, then by whole sets.

A pair inside one group is linked already, so large groups of copies are never compared with
themselves, and no link between groups is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.encoding import BATCH_BYTES, byte_slices, release
from tidemark.llm.graph import Scratch, components, kept

#: The sketch has 2^SKETCH_BITS counters, whatever the corpus.
SKETCH_BITS = 20
_BLOCKS = 64
_LANES = 64
#: Classes are grouped by minima of scrambled hashes: in some groupings by two minima over rare
#: tokens, which keeps shared passages out, in others by one over all tokens, which finds large
#: families, whose common tokens are frequent.
RARE_GROUPINGS = 2
WHOLE_GROUPINGS = 3
#: Tables of up to so many rows of a few numbers are broadcast; larger ones are joined.
BROADCAST_ROWS = 300_000
#: Partners that one set meets in a lane.
LANE_ROWS = 250
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
     0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3],
    np.uint64,
)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(31)) * _MULTIPLIERS[6]
    return values ^ values >> np.uint64(29)


def tokens(text: str | None, words_each: int = 5) -> np.ndarray:
    """Distinct hashed shingles of a text, ascending.

    A-Z is lower-cased, words end at ASCII white space; a shorter text is one shingle of all its
    words, and a text without words has none.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    each = min(words_each, len(words))
    hashed = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    n = len(words) - each + 1
    total = np.full(n, each, np.uint64)
    for k in range(each):
        total = _mixed(total + hashed[k : k + n] * _MULTIPLIERS[k % 6])
    return np.unique(total)


def _each(
    columns: int, function: Callable, schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow function that makes rows of (other columns..., text) and yields them as batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = 0
            for part in byte_slices(batch.column(columns - 1), BATCH_BYTES):
                others = [c.slice(place, len(part)).to_pylist() for c in batch.columns[:-1]]
                place += len(part)
                rows = [function(*row) for row in zip(*others, part.to_pylist(), strict=True)]
                arrays = [
                    pa.array(values, field.type)
                    for values, field in zip(zip(*rows, strict=True), schema, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def frequent_cells(texts: DataFrame, words_each: int = 5, bits: int = SKETCH_BITS) -> np.ndarray:
    """Which cells of the count sketch stand out: over the mean by eight deviations.

    Every task adds up one sketch of fixed size; sketches are summed by block in two steps, and
    one bit per cell reaches the driver.
    """
    cells = 1 << bits
    width = cells // _BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(cells, np.int64)
        for batch in batches:
            for part in byte_slices(batch.column(0), BATCH_BYTES):
                found = [tokens(text, words_each) for text in part.to_pylist()]
                flat = np.concatenate([np.empty(0, np.uint64), *found]) >> np.uint64(64 - bits)
                held += np.bincount(flat.astype(np.int64), minlength=cells)
        lane = TaskContext.get().partitionId() % _LANES
        blocks = [b.tobytes() for b in held.reshape(_BLOCKS, width)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(_BLOCKS), pa.int32()),
                pa.array([lane] * _BLOCKS, pa.int32()),
                pa.array([zlib.compress(b, 1) for b in blocks], pa.binary()),
            ],
            ["block", "lane", "counts"],
        )
        release()

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), np.int64) for c in group["counts"])
        first = group.iloc[0]
        packed = zlib.compress(total.tobytes(), 1)
        return pd.DataFrame({"block": [first.block], "lane": [first.lane], "counts": [packed]})

    shape = "block int, lane int, counts binary"
    parts = texts.mapInArrow(count, shape).groupBy("block", "lane").applyInPandas(add, shape)
    whole = kept(parts.groupBy("block").applyInPandas(add, shape), "sketch")

    def read(counts: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(counts), np.int64)

    @F.pandas_udf("long")
    def total_of(counts: pd.Series) -> pd.Series:
        return counts.map(lambda c: int(read(c).sum()))

    total = whole.agg(F.sum(total_of("counts"))).first()[0] or 0
    mean = total / cells
    bound = mean + 8 * (mean**0.5 + 1)

    @F.pandas_udf("binary")
    def outstanding(counts: pd.Series) -> pd.Series:
        return counts.map(lambda c: np.packbits(read(c) > bound).tobytes())

    found = np.zeros(cells, bool)
    for row in whole.select("block", outstanding("counts").alias("bits")).collect():
        bits_of = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)
        found[row["block"] * width : (row["block"] + 1) * width] = bits_of
    return found


def _late(found: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Which tokens are in a cell that stands out, and so come last in the common order."""
    bits = len(frequent).bit_length() - 1
    return frequent[(found >> np.uint64(64 - bits)).astype(np.int64)]


def parities(found: np.ndarray) -> bytes:
    """A bit per cell of tokens: whether their number is odd. There are about as many cells."""
    cells = 1 << max(3, (len(found) - 1).bit_length())
    counts = np.bincount((found & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits(counts & 1 == 1).tobytes()


def differences(one: bytes, other: bytes) -> int:
    """At most the number of tokens that are in one of two sets only, from their parities."""
    a, b = (np.frombuffer(p, np.uint8) for p in sorted((one, other), key=len))
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def signatures(
    docs: DataFrame, id_column: str, text_column: str, frequent: np.ndarray, words_each: int
) -> DataFrame:
    """A row per document: id, n, the share of frequent tokens, digest and parities of its set,
    group keys, and first tokens."""
    schema = pa.schema(
        [("n", pa.int64()), ("usual", pa.float64()), ("digest", pa.binary()),
         ("parity", pa.binary()), ("keys", pa.list_(pa.int64())), ("firsts", pa.list_(pa.int64()))]
    )

    def sign(text: str | None) -> tuple:
        found = tokens(text, words_each)
        if not len(found):
            return 0, 0.0, b"", b"", [], []
        late = _late(found, frequent)
        rare = found if late.all() else found[~late]
        keys = []
        for k in range(RARE_GROUPINGS + WHOLE_GROUPINGS):
            used, each = (rare, 2) if k < RARE_GROUPINGS else (found, 1)
            minima = [
                int(_mixed(used * _MULTIPLIERS[j % 8] + np.uint64(97 * j)).min())
                for j in range(2 * k, 2 * k + each)
            ]
            keys.append(xxhash.xxh3_64_intdigest(repr((k, minima))) - (1 << 63))
        ordered = np.concatenate([found[~late], found[late]])
        firsts = ordered[: len(found) - (4 * len(found) + 4) // 5 + 1].view(np.int64)
        digest = xxhash.xxh3_128_digest(found.tobytes())
        return len(found), float(late.mean()), digest, parities(found), keys, firsts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0), batch.select([1])
            place = 0
            for made in _each(1, sign, schema)(iter([rows])):
                columns = [ids.slice(place, made.num_rows), *made.columns]
                place += made.num_rows
                yield pa.RecordBatch.from_arrays(columns, ["id", *schema.names])
            release()

    kind = docs.schema[id_column].dataType.simpleString()
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string"))
    return chosen.mapInArrow(
        run,
        f"id {kind}, n long, usual double, digest binary, parity binary, keys array<long>,"
        " firsts array<long>",
    ).withColumn("row", F.monotonically_increasing_id())


def _few(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it has few rows and joined otherwise."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _promising(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose parities leave it open whether their sets are similar enough."""

    @F.arrow_udf("boolean")
    def open_still(n: pa.Array, m: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
        rows = zip(n.to_pylist(), m.to_pylist(), one.to_pylist(), other.to_pylist(), strict=True)
        return pa.array(
            [(100 + percent) * differences(a, b) <= (100 - percent) * (x + y) for x, y, a, b in rows],
            pa.bool_(),
        )

    left = classes.select(F.col("class").alias("one"), F.col("n").alias("_n"), F.col("parity").alias("_p"))
    right = classes.select(F.col("class").alias("other"), F.col("n").alias("_m"), F.col("parity").alias("_q"))
    both = pairs.join(left, "one").join(right, "other")
    return both.where(open_still("_n", "_m", "_p", "_q")).select("one", "other")


def _verified(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    classes: DataFrame,
    pairs: DataFrame,
    words_each: int,
    percent: int,
    scratch: Scratch,
) -> DataFrame:
    """The pairs (one, other) of classes whose whole sets overlap in ``percent`` of their union.

    Sets are made from the texts again, only for classes in a pair. They meet by ``other``, whose
    set comes first; one with many partners is met in several lanes.
    """
    pairs = scratch.keep(_promising(pairs, classes, percent), "promising")
    lanes = pairs.groupBy("other").agg(F.ceil(F.count("*") / LANE_ROWS).cast("int").alias("_lanes"))
    lanes = scratch.keep(lanes, "lanes")
    meeting = F.struct("lead", "lane", "side").alias("meeting")
    members = pairs.join(lanes, "other").select(
        F.col("one").alias("class"),
        F.col("other").alias("lead"),
        F.pmod(F.xxhash64("one"), "_lanes").cast("int").alias("lane"),
        F.lit(1).alias("side"),
    )
    leads = lanes.select(
        F.col("other").alias("class"),
        F.col("other").alias("lead"),
        F.explode(F.sequence(F.lit(0), F.col("_lanes") - 1)).alias("lane"),
        F.lit(0).alias("side"),
    )
    wanted = members.unionByName(leads).select("class", meeting).groupBy("class").agg(
        F.collect_list("meeting").alias("meetings")  # as many as the class has pairs
    )
    named = classes.select("class", F.col("id").alias("_id"), "digest")
    wanted = scratch.keep(wanted.join(named, "class"), "wanted")
    texts = docs.select(F.col(id_column).alias("_own"), F.col(text_column).cast("string").alias("_t"))
    found = texts.join(_few(wanted), F.col("_own").eqNullSafe(F.col("_id")))
    names = ["lead", "lane", "side", "class", "set"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = 0
            for part in byte_slices(batch.column(3), BATCH_BYTES // 4):
                others = [c.slice(place, len(part)).to_pylist() for c in batch.columns[:3]]
                place += len(part)
                out: list[tuple] = []
                held = 0
                for number, digest, meetings, text in zip(*others, part.to_pylist(), strict=True):
                    made = tokens(text, words_each).tobytes()
                    if xxhash.xxh3_128_digest(made) != digest:  # another row of that id
                        continue
                    for m in meetings:
                        out.append((m["lead"], m["lane"], m["side"], number, made))
                        held += len(made)
                        if held > BATCH_BYTES:
                            yield as_batch(out)
                            out, held = [], 0
                if out:
                    yield as_batch(out)
            release()

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    met = (
        found.select("class", "digest", "meetings", "_t")
        .mapInArrow(make, "lead long, lane int, side int, class long, set binary")
        .repartition("lead", "lane")
        .sortWithinPartitions("lead", "lane", "side")
    )

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, first = None, np.empty(0, np.uint64)
        for batch in batches:
            one: list[int] = []
            other: list[int] = []
            columns = [c.to_pylist() for c in batch.columns]
            for now, _, side, number, made in zip(*columns, strict=True):
                own = np.frombuffer(made, np.uint64)
                if not side:
                    lead, first = now, own
                    continue
                both = np.sort(np.concatenate([first, own]))
                common = int((both[1:] == both[:-1]).sum())
                if now == lead and 100 * common >= percent * (len(both) - common):
                    one.append(number)
                    other.append(now)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one, pa.int64()), pa.array(other, pa.int64())], ["one", "other"]
            )

    return met.mapInArrow(test, "one long, other long").distinct()


def similar(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    words_each: int = 5,
    percent: int = 80,
    sketch_bits: int = SKETCH_BITS,
) -> tuple[DataFrame, DataFrame]:
    """(documents, links): all documents with their component, and the links that hold it together.

    The first has one row per row of ``docs``: id, ``n_shingles``, ``class`` (equal for equal sets)
    and ``component_id``, the smallest id that can be reached by links. The second has verified
    links between classes (``one``, ``other``) that connect the components; further links inside a
    component are not listed. Two documents link when their intersection is at least ``percent``
    (80 or more) of their union.

    Null and empty texts have no shingles and link with nothing. Rows with equal ids count each by
    its text; rows with null ids take part and have no id to give, so a component of them alone is
    null. Other columns are not read. An empty table gives empty results.
    """
    if percent < 80:
        raise ValueError("the order of tokens is laid out for 80 percent or more")
    if id_column in ("n_shingles", "class", "component_id"):
        raise ValueError(f"{id_column!r} is a column of the result")
    spark = docs.sparkSession
    lasting, scratch = Scratch(spark), Scratch(spark)
    texts = docs.select(F.col(text_column).cast("string"))
    frequent = frequent_cells(texts, words_each, sketch_bits)
    rows = scratch.keep(signatures(docs, id_column, text_column, frequent, words_each), "signatures")
    classes = rows.where("n > 0").groupBy("digest").agg(
        F.min("row").alias("class"),
        F.min("id").alias("id"),
        F.first("n").alias("n"),
        F.first("usual").alias("usual"),
        F.first("keys").alias("keys"),
        F.first("parity").alias("parity"),
    )
    classes = scratch.keep(classes, "classes")
    exact = docs, id_column, text_column, classes

    # Groups: everyone with the most usual of those that share a key. In a family of edited copies
    # the most usual one is the least edited, which most others are near.
    keyed = classes.select("class", "usual", F.explode("keys").alias("key"))
    firsts = keyed.groupBy("key").agg(
        F.max_by("class", F.struct("usual", "class")).alias("other"), F.count("*").alias("of")
    )
    pairs = keyed.join(firsts.where("of > 1"), "key").where(F.col("class") != F.col("other"))
    pairs = scratch.keep(pairs.select(F.col("class").alias("one"), "other").distinct(), "pairs")
    found = _verified(*exact, pairs, words_each, percent, scratch)
    links = scratch.keep(found, "links")
    grouped = components(links, "one", "other").select(F.col("id").alias("class"), "component")
    grouped = scratch.keep(
        classes.select("class", "n")
        .join(grouped, "class", "left")
        .select(
            "class", "n", F.coalesce("component", "class").alias("group"),
            F.col("component").isNotNull().alias("many"),
        ),
        "groups",
    )

    # The matrix of tokens and groups; only groups of several have tokens in common to add up.
    members = rows.select(F.col("row").alias("class"), "firsts").join(_few(grouped), "class")
    query = members.select("class", "n", "group", F.posexplode("firsts").alias("at", "token"))
    tell = (F.col("n") - F.floor((8 * F.col("n") + 8) / 9) + 1).cast("int")
    own = members.select(
        "class", "n", "group", "many",
        F.posexplode(F.slice("firsts", F.lit(1), tell)).alias("at", "token"),
    )
    # Overlap o and sizes n, m: o / (n + m - o) >= p / 100 means (100 + p) o >= p (n + m). From the
    # first common token on, at place ``at``, at most n - at tokens are common.
    room = (100 + percent) * (F.col("n") - F.col("at")) - percent * F.col("n")
    query = query.withColumn("query_room", room).drop("at")
    alone = own.where("NOT many").select(
        "token", F.col("group").alias("in_group"), F.col("n").alias("least"),
        F.col("n").alias("most"), room.alias("room"), F.col("class").alias("member"),
    )
    union = own.where("many").groupBy("token", F.col("group").alias("in_group")).agg(
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.max(room).alias("room"),
        F.when(F.count("*") == 1, F.min("class")).alias("member"),
    )
    opened = query.join(alone.unionByName(union), "token").where(
        (F.col("group") != F.col("in_group"))
        & (F.col("least") <= F.col("n"))
        & (5 * F.col("most") >= 4 * F.col("n"))
        & (F.col("room") >= percent * F.col("n"))
        & (F.col("query_room") >= percent * F.col("least"))
    )
    opened = scratch.keep(
        opened.select(
            F.col("class").alias("one"), "n", "in_group", "member",
            F.when(F.col("member").isNull(), F.col("token")).alias("token"),
            F.when(F.col("member").isNull(), F.col("query_room")).alias("query_room"),
        ).distinct(),
        "opened",
    )
    single = opened.where("member IS NOT NULL").select("one", F.col("member").alias("other"))
    # In an open group of several, the members that share the token and are of a fitting size.
    several = opened.where("member IS NULL").select("one", "n", "in_group", "token", "query_room")
    inside = own.where("many").select(
        F.col("class").alias("other"), F.col("n").alias("m"), F.col("group").alias("in_group"),
        "token", room.alias("room"),
    )
    several = (
        several.join(inside, ["in_group", "token"])
        .where((F.col("m") <= F.col("n")) & (5 * F.col("m") >= 4 * F.col("n")))
        .where((F.col("room") >= percent * F.col("n")) & (F.col("query_room") >= percent * F.col("m")))
        .select("one", "other")
    )
    more = scratch.keep(single.unionByName(several).distinct(), "pairs")
    found = _verified(*exact, more, words_each, percent, scratch)
    links = lasting.keep(links.unionByName(found), "links")

    whole = components(links, "one", "other").withColumnRenamed("id", "class")
    labelled = classes.select("digest", "class", "id").join(whole, "class", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "class"))
    smallest = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
    labelled = labelled.join(smallest, "component").select("digest", "class", "component_id")
    labelled = scratch.keep(labelled, "labels")
    found = rows.select("id", "n", "digest", "row").join(labelled, "digest", "left")
    found = found.select(
        "id",
        F.col("n").alias("n_shingles"),
        F.coalesce("class", "row").alias("class"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    found = lasting.keep(found, "found")
    scratch.release()  # signatures take half as much as the input, the result hardly anything
    return found.withColumnRenamed("id", id_column), links
