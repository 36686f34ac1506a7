"""Near-duplicate embeddings by collision counting over one-dimensional projections.

Unit vectors with cosine c are sqrt(2 - 2c) apart, and so are at most their projections on all of an
orthonormal basis together. With windows of a K-th of that distance squared, such a pair misses
fewer than K windows. All pairs of a label are counted block by block, in windows of whole grid
cells; pairs with few enough misses are verified by their cosine. No pair at the threshold is lost.

The count cannot be cut short by sorting: at a cosine of 0.93 the window that keeps all near pairs
on one projection is three deviations of an evenly spread label wide, and keeps nearly all others.

``exhaustive=False`` counts only pairs that share a cell. Two unit vectors with cosine c differ along
a Gaussian direction by a normal number of deviation sqrt(2 - 2c). Vectors are dealt into cells by a
few such directions at a time, in several trees; cell width and trees follow from the recall asked
for at the threshold. Cells are told apart by 128 bits of label, length, tree and grid.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components, kept

#: Most projections of which collisions are counted, and the share of them that near pairs may miss.
COUNTED, MISSED = 64, 1 / 4
#: Cell width in deviations at the threshold, and the number of vectors a cell is meant to hold.
CELL_WIDTH = 4.0
CELL_SIZE = 24
#: Recall at the threshold of the trees.
TREE_RECALL = 0.985
#: Rows of a block; more vectors of a label, or of a cell, are compared block by block.
BLOCK = 16_384
#: Added to the distance squared: far more than rounding of projections, cells and cosines.
SLACK = 1e-9
SEED = 20
BROADCAST_LABELS = 50_000
MOST_TASKS = 20_000


def _same_cell(deviation: float, width: float) -> float:
    """Chance that two values with a normal difference fall into one cell of a random grid."""
    gaps = (np.arange(4000) + 0.5) / 4000 * width
    density = np.exp(-((gaps / deviation) ** 2) / 2) * 2 / (deviation * math.sqrt(2 * math.pi))
    return float((density * (1 - gaps / width)).sum() * width / 4000)


def least_collisions(counted: int = COUNTED) -> int:
    """Collisions that any pair at the threshold has on so many orthonormal projections."""
    return counted - max(1, int(counted * MISSED)) + 1


@lru_cache(maxsize=64)
def shape(rows: int, threshold: float) -> tuple[int, int]:
    """(projections per cell, trees) for so many vectors of one label."""
    deviation = math.sqrt(2 - 2 * threshold)
    width = CELL_WIDTH * deviation
    near, far = _same_cell(deviation, width), _same_cell(math.sqrt(2), width)
    depth = max(0, math.ceil(math.log(max(rows / CELL_SIZE, 1)) / -math.log(far)))
    if not depth:
        return 0, 1
    return depth, math.ceil(math.log(1 - TREE_RECALL) / math.log(1 - near**depth))


@lru_cache(maxsize=16)
def _basis(dimensions: int) -> np.ndarray:
    """Orthonormal directions, up to ``COUNTED`` of them."""
    random = np.random.default_rng((SEED, dimensions))
    return np.linalg.qr(random.standard_normal((dimensions, min(dimensions, COUNTED))))[0]


@lru_cache(maxsize=16)
def _directions(dimensions: int, tree: int, count: int) -> np.ndarray:
    return np.random.default_rng((SEED, dimensions, tree)).standard_normal((dimensions, count))


def _unit(vector: list | None) -> np.ndarray | None:
    """The vector in double precision at length 1; None if it cannot be compared."""
    if not vector or any(x is None for x in vector):
        return None
    values = np.array(vector, np.float64)
    if not np.isfinite(values).all():
        return None
    largest = np.abs(values).max()
    if not largest:
        return None
    values = values / largest  # squares of very small or large components stay finite
    return values / np.linalg.norm(values)


def _vectors(df: DataFrame, id_column: str, label_column: str, vector_column: str) -> DataFrame:
    kinds = [df.schema[c].dataType.simpleString() for c in (id_column, label_column)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [_unit(v) for v in batch.column(2).to_pylist()]
            known = batch.column(1).is_valid().to_pylist()
            units = [u if ok else None for u, ok in zip(units, known, strict=True)]
            packed = [None if u is None else u.tobytes() for u in units]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([0 if u is None else len(u) for u in units], pa.int32()),
                    pa.array([b and xxhash.xxh3_128_digest(b) for b in packed], pa.binary()),
                    pa.array(packed, pa.binary()),
                ],
                ["id", "label", "dimensions", "digest", "vector"],
            )

    chosen = df.select(id_column, label_column, F.col(vector_column).cast("array<double>"))
    return chosen.mapInArrow(
        read, f"id {kinds[0]}, label {kinds[1]}, dimensions int, digest binary, vector binary"
    ).withColumn("row", F.monotonically_increasing_id())


def _cells(classes: DataFrame, threshold: float, exhaustive: bool) -> DataFrame:
    """A row per class and tree: its cell, and its cells in all trees to tell repeated pairs.

    Exhaustive: one cell for each label and length.
    """
    width = CELL_WIDTH * math.sqrt(2 - 2 * threshold)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                out: list[tuple] = []
                for number, label, of, copies, packed in zip(
                    *(c.to_pylist() for c in part.columns), strict=True
                ):
                    vector = np.frombuffer(packed)
                    depth, trees = (0, 1) if exhaustive else shape(of, threshold)
                    keys = []
                    for tree in range(trees):
                        ways = _directions(len(vector), tree, depth + 1)
                        grid = np.floor((vector @ ways)[:depth] / width + ways[0, :depth])
                        text = repr((label, len(vector), tree, grid.astype(int).tolist()))
                        keys.append(xxhash.xxh3_128_digest(text))
                    cells = b"".join(key[:8] for key in keys)
                    out += [
                        (key, tree, number, of, copies, packed, cells)
                        for tree, key in enumerate(keys)
                    ]
                kinds = (
                    pa.binary(), pa.int32(), *[pa.int64()] * 3, pa.binary(), pa.binary()
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    ["cell", "tree", "class", "of", "copies", "vector", "cells"],
                )

    return classes.select("class", "label", "of", "copies", "vector").mapInArrow(
        deal, "cell binary, tree int, class long, of long, copies long, vector binary, cells binary"
    )


def _join(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Joins the sets of every x and its y; ``root`` holds the place of the first of each set."""
    while len(x):
        one, other = root[x], root[y]
        apart = one != other
        x, y, one, other = x[apart], y[apart], one[apart], other[apart]
        np.minimum.at(root, np.maximum(one, other), np.minimum(one, other))
        while (root != (above := root[root])).any():
            root[:] = above


def _compare(rows: list[tuple], threshold: float, two: bool) -> list[tuple]:
    """(class, links, one class for all it reaches) of a tile's rows (side, tree, class, copies, ...).

    Two: only pairs of one row of either side are compared.
    """
    rows = sorted(rows, key=lambda r: (r[0], r[2]))
    side = np.array([r[0] for r in rows])
    number = np.array([r[2] for r in rows], np.int64)
    copies = np.array([r[3] for r in rows], np.int64)
    vectors = np.stack([np.frombuffer(r[4]) for r in rows])
    cells = np.stack([np.frombuffer(r[5], np.int64) for r in rows])
    tree, n = rows[0][1], len(rows)
    ways = _basis(vectors.shape[1])
    counted = ways.shape[1]
    most = counted - least_collisions(counted)  # missed windows
    width = math.sqrt((2 - 2 * threshold + SLACK) / (most + 1))
    # Cells of the grid from one to the next cover the window; modulo 256 they do so all the more.
    grid = np.floor((vectors @ ways).T / width).astype(np.int64).astype(np.uint8)
    after = grid + np.uint8(1)
    links, root = np.zeros(n, np.int64), np.arange(n)
    middle = int(np.searchsorted(side, side[0], "right")) if two else n
    for begin, start in product(range(0, middle, 128), range(middle if two else 0, n, 2048)):
        some, others = slice(begin, min(begin + 128, middle)), slice(start, start + 2048)
        if not two and others.stop <= begin:
            continue  # counted the other way round
        missed = np.zeros((some.stop - begin, len(number[others])), np.uint8)
        apart, far = np.empty_like(missed), np.empty(missed.shape, bool)
        for j in range(counted):
            np.subtract(after[j, some, None], grid[j, None, others], out=apart)
            np.greater(apart, 2, out=far)
            missed += far.view(np.uint8)
        wanted = missed <= most
        if not two:
            wanted &= number[some, None] < number[None, others]
        if np.count_nonzero(wanted) > wanted.size // 16:  # too many to look at one by one
            wanted &= vectors[some] @ vectors[others].T >= threshold - SLACK
        a, b = np.nonzero(wanted)
        a, b = a + begin, b + start
        new = ~(cells[a, :tree] == cells[b, :tree]).any(axis=1)  # else an earlier tree has it
        a, b = a[new], b[new]
        for at in range(0, len(a), 20_000):
            x, y = a[at : at + 20_000], b[at : at + 20_000]
            near = np.einsum("ij,ij->i", vectors[x], vectors[y]) >= threshold
            x, y = x[near], y[near]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            _join(root, x, y)
    found = np.flatnonzero(links)
    return list(zip(number[found].tolist(), links[found].tolist(), number[root[found]].tolist()))


def near_duplicates(
    embeddings: DataFrame,
    *,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
    threshold: float = 0.93,
    exhaustive: bool = True,
) -> DataFrame:
    """One row per row: id, ``n_links``, ``component_id``, ``kept``.

    All vectors of one label (and length) with a cosine of at least ``threshold`` are linked, none
    below it. ``n_links`` counts other rows, ``component_id`` is the smallest id reachable by links.
    Rows with equal vectors are one class with a weight, and only classes are compared; more than
    ``BLOCK`` of them are compared block by block, so that work and shuffle grow with the square of
    a label's classes and memory does not. Where labels are too large for that, ``exhaustive=False``
    compares vectors that share a cell only: the expected recall at the threshold is then
    ``TREE_RECALL`` and rises quickly above it. Null, zero or empty vectors, vectors with null or non-finite
    components and rows without a label have no links and their own id. Rows that repeat an id
    link as rows; null ids give no component id and are not kept. Other columns are not read, an
    empty table gives an empty result.
    """
    if id_column in ("n_links", "component_id", "kept"):
        raise ValueError(f"{id_column!r} is a column of the result")
    rows = kept(_vectors(embeddings, id_column, label_column, vector_column), "vectors")
    classes = (
        rows.where("digest IS NOT NULL")
        .groupBy("label", "dimensions", "digest")
        .agg(F.min("row").alias("class"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    )
    classes = kept(classes, "classes")
    sizes = classes.groupBy("label", "dimensions").agg(F.count("*").alias("of"))
    if sizes.count() <= BROADCAST_LABELS:
        sizes = F.broadcast(sizes)
    cells = _cells(classes.join(sizes, ["label", "dimensions"]), threshold, exhaustive)
    if exhaustive:
        blocks = F.ceil(F.col("of") / BLOCK).cast("int")
        counts = sizes.select(blocks.alias("b")).agg(F.sum(F.expr("b * (b + 1L) div 2"))).first()
        # As many tasks as tiles: what a tile costs is not its bytes.
        least = classes.sparkSession.sparkContext.defaultParallelism
        tasks = [min(max(counts[0] or 0, least), MOST_TASKS)]
    else:
        full = (
            cells.groupBy("cell").agg(F.count("*").alias("_in")).where(F.col("_in") > BLOCK)
            .select("cell", F.ceil(F.col("_in") / BLOCK).cast("int").alias("_blocks"))
        )
        cells, blocks, tasks = cells.join(full, "cell", "left"), F.coalesce("_blocks", F.lit(1)), []
    side = F.pmod(F.xxhash64("class"), blocks).cast("int")
    tiles = (
        cells.withColumn("side", side)
        .withColumn("_with", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("low", F.least("side", "_with"))
        .withColumn("high", F.greatest("side", "_with"))
        .select("cell", "low", "high", "side", "tree", "class", "copies", "vector", "cells")
    )
    tiles = tiles.repartition(*tasks, "cell", "low", "high").sortWithinPartitions("cell", "low", "high")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []
        for batch in batches:
            out: list[tuple] = []
            for cell, low, high, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (cell, low, high) != tile:
                    if len(held) > 1:
                        out += _compare(held, threshold, tile[1] != tile[2])
                    tile, held = (cell, low, high), []
                held.append(row)
            yield _links(out)
        yield _links(_compare(held, threshold, tile[1] != tile[2]) if len(held) > 1 else [])

    def _links(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["class", "links", "reached"]
        )

    shape_of = "class long, links long, reached long"
    linked = kept(tiles.mapInArrow(count, shape_of), "links")
    counted = linked.groupBy("class").agg(F.sum("links").alias("links"))
    joined = components(linked, "class", "reached").withColumnRenamed("id", "class")
    labelled = (
        classes.select("class", "label", "dimensions", "digest", "copies")
        .join(counted, "class", "left")
        .join(joined, "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
        .withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
        .select("label", "dimensions", "digest", "component", "n_links")
    )
    member = rows.select("id", "label", "dimensions", "digest").join(
        labelled, ["label", "dimensions", "digest"], "left"
    )
    smallest = member.groupBy("component").agg(F.min("id").alias("_least"))
    named = member.join(smallest.where("component IS NOT NULL"), "component", "left")
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("_least"))
    return named.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
