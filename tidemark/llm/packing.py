"""Best-fit packing of token sequences by linear grouping.

Pieces of equal length are alike, so a packing is a plan over the histogram of lengths: it has at
most ``capacity`` bars, whatever the corpus. Large lengths are sorted, put into groups of equal
cardinality and rounded up to the largest of their group; the few sizes left are packed by the
configuration program (columns priced by a knapsack); the real lengths then take the places of
the rounded ones, and all others go, longest first, where they fit best. Pieces find their place
in the plan by their rank among those of equal length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.encoding import BATCH_BYTES, byte_slices, encoder, release
from tidemark.session import scratch_dir

#: Lengths above this share of the capacity are grouped.
LARGE_SHARE = 1 / 16
GROUPS = 48
#: Rows of equal length are ranked in so many lanes at once, each at most one task's work.
LANES = 1024

PLAN = (
    "length long, rank_from long, n long, sequence_from long, each long, offset_from long"
)


def _price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size make the most valuable configuration within the capacity."""
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(sizes), capacity + 1), np.int32)
    for j in np.flatnonzero(values > 1e-12):
        size, before = int(sizes[j]), best
        best = before.copy()
        for times in range(1, capacity // size + 1):
            offer = before[: capacity + 1 - times * size] + times * values[j]
            better = offer > best[times * size :] + 1e-12
            best[times * size :][better] = offer[better]
            taken[j, times * size :][better] = times
    config, room = np.zeros(len(sizes)), int(np.argmax(best))
    for j in range(len(sizes) - 1, -1, -1):
        config[j] = taken[j, room]
        room -= int(config[j]) * int(sizes[j])
    return config


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple]:
    """(configuration, times): whole parts of an optimal fractional packing of a few sizes."""
    columns = np.diag(capacity // sizes).astype(float)
    level = np.linalg.solve(columns, demand)
    for _ in range(60 * len(sizes)):
        values = np.linalg.solve(columns.T, np.ones(len(sizes)))
        new = _price(values, sizes, capacity)
        if values @ new <= 1 + 1e-7:
            break
        way = np.linalg.solve(columns, new)
        steps = np.full(len(sizes), np.inf)
        steps[way > 1e-9] = np.maximum(level[way > 1e-9], 0) / way[way > 1e-9]
        leaves = int(np.argmin(steps))
        columns[:, leaves] = new
        level = np.linalg.solve(columns, demand)
    return [
        (columns[:, j].astype(int), int(times))
        for j, times in enumerate(np.floor(level + 1e-7))
        if times > 0
    ]


class _Bins:
    """Runs of sequences that are filled alike, by the room left in them."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.opened = capacity, 0
        self.by_room: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.rooms: list[int] = []
        self.rank: dict[int, int] = defaultdict(int)
        self.plan: list[tuple[int, ...]] = []

    def open(self, count: int) -> int:
        self.opened += count
        return self.opened - count

    def leave(self, first: int, count: int, room: int) -> None:
        if count and room:
            if not self.by_room[room]:
                bisect.insort(self.rooms, room)
            self.by_room[room].append((first, count))

    def put(self, length: int, first: int, count: int, each: int, offset: int) -> None:
        """``each`` pieces of a length into each of ``count`` sequences."""
        if count and each:
            self.plan.append((length, self.rank[length], count * each, first, each, offset))
            self.rank[length] += count * each

    def fit(self, length: int, count: int) -> None:
        """The pieces of one length, each where it leaves the least room."""
        while count:
            at = bisect.bisect_left(self.rooms, length)
            if at < len(self.rooms):
                room = self.rooms[at]
                first, bins = self.by_room[room].pop()
                if not self.by_room[room]:
                    del self.rooms[at]
            else:
                room, bins = self.capacity, -(-count // (self.capacity // length))
                first = self.open(bins)
            each = room // length
            full = min(bins, count // each)
            self.put(length, first, full, each, self.capacity - room)
            self.leave(first, full, room - full and room - each * length)
            count -= full * each
            if full < bins:
                few = min(count, each - 1) if count < each else 0
                if few:
                    self.put(length, first + full, 1, few, self.capacity - room)
                    self.leave(first + full, 1, room - few * length)
                    count -= few
                    full += 1
                self.leave(first + full, bins - full, room)


def plan(
    histogram: dict[int, int],
    capacity: int,
    groups: int = GROUPS,
    large_share: float = LARGE_SHARE,
) -> tuple[list[tuple[int, ...]], int]:
    """(rows of ``PLAN``, number of sequences) for so many pieces of each length.

    A row says: ``n`` pieces of ``length``, from rank ``rank_from`` on, fill consecutive sequences
    from ``sequence_from``, ``each`` of them in one, the first at ``offset_from``. An empty
    histogram gives no row.
    """
    bins = _Bins(capacity)
    left = {length: n for length, n in histogram.items() if n}
    large = [x for x in sorted(left, reverse=True) if large_share * capacity < x < capacity]
    total = sum(left[x] for x in large)
    queues: list[deque] = []
    sizes: list[int] = []
    if total:
        share = -(-total // groups)
        room = 0
        for length in large:
            n = left[length]
            while n:
                if not room:
                    queues.append(deque())
                    sizes.append(length)
                    room = share
                part = min(n, room)
                queues[-1].append([length, part])
                n, room = n - part, room - part
        merged: dict[int, deque] = {}
        for size, queue in zip(sizes, queues, strict=True):
            merged.setdefault(size, deque()).extend(queue)  # a size common to groups counts once
        order = np.array(list(merged))
        demand = np.array([sum(n for _, n in merged[s]) for s in merged], float)
        for config, times in configurations(order, demand, capacity):
            slots = [merged[int(s)] for s, a in zip(order, config, strict=True) for _ in range(a)]
            first = bins.open(times)
            # Each slot takes real lengths from its group; sequences alike in all slots are a run.
            done = 0
            while done < times:
                takes: list[tuple[deque, int]] = []
                run = times - done
                need: dict[int, int] = defaultdict(int)
                for queue in slots:
                    need[id(queue)] += 1
                for queue in {id(q): q for q in slots}.values():
                    if queue:
                        takes.append((queue, need[id(queue)]))
                for queue, k in takes:
                    available = queue[0][1]
                    run = min(run, available // k if available >= k else 1)
                offset = 0
                for queue, k in takes:
                    wanted = k * run
                    while wanted and queue:
                        length, n = queue[0]
                        # One run puts the same number of one length into each sequence.
                        part = min(n, wanted) if run == 1 else wanted
                        bins.put(length, first + done, run, part // run, offset)
                        offset += (part // run) * length
                        left[length] -= part
                        wanted -= part
                        queue[0][1] -= part
                        if not queue[0][1]:
                            queue.popleft()
                bins.leave(first + done, run, capacity - offset)
                done += run
    for length in sorted(left, reverse=True):
        bins.fit(length, left[length])
    return bins.plan, bins.opened


def plan_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of ``PLAN``, handed over by Arrow: a list would start Python workers of its own kind,
    which stay on beside the others, only to be copied."""
    names = [column.split()[0] for column in PLAN.split(", ")]
    columns = [pa.array([row[k] for row in rows], pa.int64()) for k in range(len(names))]
    return spark.createDataFrame(pa.table(columns, names))


def encode_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int,
    end_id: int,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
    batch_bytes: int = BATCH_BYTES,
    let_go: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each text followed by ``end_id``."""
    kind = docs.schema[id_column].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer)
        end, step = end_id.to_bytes(4, "little"), 4 * capacity
        lane = TaskContext.get().partitionId() * 37
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            place = 0
            for part in byte_slices(texts, batch_bytes):
                rows: list[int] = []
                cut: list[tuple[int, int, bytes]] = []
                for ids in ids_of(part.to_pylist()):
                    ids += end
                    for begin in range(0, len(ids), step):
                        rows.append(place)
                        cut.append((begin // step, begin // 4, ids[begin : begin + step]))
                    place += 1
                columns = [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array([c[0] for c in cut], pa.int32()),
                    pa.array([c[1] for c in cut], pa.int64()),
                    pa.array([len(c[2]) // 4 for c in cut], pa.int64()),
                    pa.array([zlib.crc32(c[2]) for c in cut], pa.int64()),
                    pa.array([(lane + i) % LANES for i in range(len(cut))], pa.int32()),
                ]
                lane += len(cut)
                names = [id_column, "piece", "start", "length", "ids_crc32", "lane"]
                if with_ids:
                    columns.append(
                        pa.array(
                            [np.frombuffer(c[2], "<u4").astype(np.int32) for c in cut],
                            pa.list_(pa.int32()),
                        )
                    )
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
        release(tokenizers=let_go)

    schema = f"`{id_column}` {kind}, piece int, start long, length long, ids_crc32 long, lane int"
    return docs.select(F.col(id_column), F.col(text_column).cast("string")).mapInArrow(
        encode, schema + (", ids array<int>" if with_ids else "")
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = 4096,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
    groups: int = GROUPS,
    large_share: float = LARGE_SHARE,
    let_go: bool = False,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset``, and ``ids`` on request.

    Each row of ``docs`` is its own document; a null text counts as empty, and an empty document
    still has its ``end_id``. Only documents longer than ``capacity`` are cut. Rows with equal or
    null ids stay apart, other columns are not read, an empty table gives an empty result. The
    pieces are written once to the shared folder of ``spark.checkpoint.dir``, so ranks stay the
    same when a task is repeated; only the histogram of lengths, at most ``capacity`` rows,
    reaches the driver, and the plan that is broadcast has a few rows per length and
    configuration. With ``let_go`` workers load the tokenizer anew for each task, and hold no
    memory for it in between.
    """
    if id_column in ("piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"):
        raise ValueError(f"{id_column!r} is a column of the result")
    spark = docs.sparkSession
    folder = scratch_dir(spark, "packing")
    encode_pieces(
        docs, tokenizer, capacity, end_id,
        id_column=id_column, text_column=text_column, with_ids=with_ids, let_go=let_go,
    ).write.parquet(folder)
    pieces = spark.read.parquet(folder)
    bars = pieces.groupBy("lane", "length").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in bars.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, _ = plan(histogram, capacity, groups, large_share)
    places = plan_table(spark, rows)

    before = bars.select(
        "lane",
        "length",
        (
            F.sum("n").over(
                Window.partitionBy("length").orderBy("lane").rowsBetween(
                    Window.unboundedPreceding, Window.currentRow
                )
            )
            - F.col("n")
        ).alias("_before"),
    )
    lane = Window.partitionBy("lane", "length").orderBy(id_column, "piece", "ids_crc32")
    ranked = (
        pieces.withColumn("_nth", F.row_number().over(lane) - 1)
        .join(before, ["lane", "length"])
        .withColumn("_rank", F.col("_before") + F.col("_nth"))
    )
    at = F.col("_rank") - F.col("rank_from")
    placed = ranked.join(
        F.broadcast(places.withColumnRenamed("length", "_length")),
        (F.col("length") == F.col("_length"))
        & (F.col("_rank") >= F.col("rank_from"))
        & (F.col("_rank") < F.col("rank_from") + F.col("n")),
    )
    return placed.select(
        id_column,
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence_from") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("offset_from") + at % F.col("each") * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and the ``ids`` of its pieces in order."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(ordered["ids"]).alias("ids"))
