"""Ranked lexical search: the best documents of each item, found by masks of matched terms."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.encoding import byte_slices
from tidemark.llm.graph import Scratch, kept
from tidemark.session import scratch_dir
from tidemark.sinks.control import read_parquet

#: Different terms, counted per item, of the items that are searched for in one pass.
BLOCK_TERMS = 50_000
#: Bytes of text that become rows of the index together.
SLICE_BYTES = 4 << 20
#: Documents that are scored at first, in the order of their masks' bounds; twice as many next.
FIRST_SCORED = 64

# Terms are runs of ASCII letters and digits and of anything beyond ASCII; A-Z are folded. In
# UTF-8 every byte of a character beyond ASCII is 0x80 or more, so bytes can be told apart singly.
_FOLD = bytes(
    ord(chr(b).lower()) if b < 0x80 and chr(b).isalnum() else b if b >= 0x80 else 0x20
    for b in range(256)
)
_POSTING = "n long, terms binary, counts binary"
_TOKENS = -1  # stands for a number of tokens, where terms are counted
_DOCUMENTS = -2


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats."""
    return text.translate(_FOLD).split()


def weight(documents: int, holding: int) -> int:
    """What a term counts that ``holding`` of all ``documents`` have."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document: id, number of terms, and numbers and counts of those in the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            done = 0
            for slice_ in byte_slices(batch.column(1), SLICE_BYTES):
                sizes, held, often = [], [], []
                for text in slice_.cast(pa.binary()).to_pylist():
                    words = terms(text)
                    found = Counter(map(number, words))
                    found.pop(None, None)
                    sizes.append(len(words))
                    held.append(np.fromiter(found.keys(), np.int32, len(found)).tobytes())
                    often.append(np.fromiter(found.values(), np.int32, len(found)).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, len(sizes)),
                        pa.array(sizes, pa.int64()),
                        pa.array(held, pa.binary()),
                        pa.array(often, pa.binary()),
                    ],
                    ["_id", "n", "terms", "counts"],
                )
                done += len(sizes)

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(post, f"_id {kind}, {_POSTING}")


def _statistics(index: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and the documents that hold each of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding = np.zeros(size, np.int64)
        documents = tokens = 0
        for batch in batches:
            numbers = b"".join(batch.column(1).to_pylist())
            holding += np.bincount(np.frombuffer(numbers, np.int32), minlength=size)
            sizes = batch.column(0).to_numpy()
            documents += int(np.count_nonzero(sizes))
            tokens += int(sizes.sum())
        seen = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([_DOCUMENTS, _TOKENS, *seen.tolist()], pa.int32()),
                pa.array([documents, tokens, *holding[seen].tolist()], pa.int64()),
            ],
            ["term", "count"],
        )

    counted = index.select("n", "terms").mapInArrow(count, "term int, count long")
    total = counted.groupBy("term").agg(F.sum("count").alias("count")).collect()  # the vocabulary
    known = {row["term"]: row["count"] for row in total}
    holding = np.array([known.get(t, 0) for t in range(size)], np.int64)
    return known.get(_DOCUMENTS, 0), known.get(_TOKENS, 0), holding


class _Block:
    """Some documents: bitmaps of the terms, and what each term in them adds to a score."""

    def __init__(self, batch: pa.RecordBatch, documents: int, tokens: int) -> None:
        self.ids = batch.column(0).to_pylist()
        self.size = len(self.ids)
        sizes = batch.column(1).to_numpy()
        held = batch.column(2).to_pylist()
        self.terms = np.frombuffer(b"".join(held), np.int32)
        often = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.int32).astype(np.int64)
        each = np.fromiter((len(h) // 4 for h in held), np.int64, self.size)
        self.starts = np.concatenate([[0], np.cumsum(each)])
        self.docs = np.repeat(np.arange(self.size), each)
        length = 75 + 25 * sizes * documents // tokens
        self.parts = 1_000_000_000 * often // (1000 * often + 12 * length[self.docs])
        order = np.argsort(self.terms, kind="stable")
        self.by_term = self.docs[order]
        present, begins = np.unique(self.terms[order], return_index=True)
        ends = np.append(begins[1:], len(order))
        peaks = np.maximum.reduceat(self.parts[order], begins) if len(begins) else begins
        self.spans = dict(zip(present.tolist(), zip(begins.tolist(), ends.tolist(), strict=True)))
        self.peaks = dict(zip(present.tolist(), peaks.tolist(), strict=True))
        self.bitmaps: dict[int, np.ndarray] = {}

    def bitmap(self, term: int) -> np.ndarray:
        """One bit per document: whether it holds the term."""
        if term not in self.bitmaps:
            begin, end = self.spans[term]
            holds = np.zeros(self.size, bool)
            holds[self.by_term[begin:end]] = True
            self.bitmaps[term] = np.packbits(holds)
        return self.bitmaps[term]

    def masks(self, wanted: list[int]) -> np.ndarray:
        """Bytes per document: bit j tells whether it holds the j-th wanted term."""
        rows = []
        for begin in range(0, len(wanted), 8):  # the bitmaps, turned by eight rows at a time
            bits = np.stack([self.bitmap(t) for t in wanted[begin : begin + 8]])
            bits = np.unpackbits(bits, axis=1, count=self.size)
            rows.append(np.packbits(bits, axis=0, bitorder="little")[0])
        rows += [np.zeros(self.size, np.uint8)] * (-len(rows) % 8)
        return np.stack(rows, axis=1)

    def scores(self, docs: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Exact scores; ``values`` holds each term's weight times its repeats in the item."""
        begins, ends = self.starts[docs], self.starts[docs + 1]
        sizes = ends - begins  # never 0: each holds a wanted term
        firsts = np.cumsum(sizes) - sizes
        places = np.arange(int(sizes.sum())) + np.repeat(begins - firsts, sizes)
        return np.add.reduceat(values[self.terms[places]] * self.parts[places], firsts)


_BITS = np.arange(256)[:, None] >> np.arange(8) & 1


def _groups(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One document of each distinct mask, and the number of each document's mask among them."""
    words = np.ascontiguousarray(masks).view(np.uint64)
    _, first, number = np.unique(words[:, 0], return_index=True, return_inverse=True)
    for k in range(1, words.shape[1]):
        distinct, own = np.unique(words[:, k], return_inverse=True)
        _, first, number = np.unique(
            number * len(distinct) + own, return_index=True, return_inverse=True
        )
    return first, number


def _improve(best: list[tuple], block: _Block, item: dict[int, int], values: np.ndarray, k: int):
    """The ``k`` best of ``best`` and the block's documents, as sorted (-score, id is null, id).

    Documents are grouped by the mask of the item's terms that they hold. A mask's bound adds
    the most that each of its terms gives in this block. Masks are taken by descending bound until
    none can reach the k-th score any more; equal scores are still looked at, for their ids.
    """
    present = [t for t in item if t in block.spans and values[t] > 0]
    if not present:
        return best
    masks = block.masks(present)
    first, number = _groups(masks)
    peaks = np.zeros(masks.shape[1] * 8, np.int64)
    peaks[: len(present)] = [int(values[t]) * block.peaks[t] for t in present]
    table = _BITS @ peaks.reshape(-1, 8).T
    bounds = table[masks[first], np.arange(masks.shape[1])].sum(axis=1)
    least = -best[-1][0] if len(best) == k else 1
    open_ = np.flatnonzero(bounds >= least)
    if not len(open_):
        return best
    place = np.full(len(bounds), -1)
    open_ = open_[np.argsort(-bounds[open_], kind="stable")]
    place[open_] = np.arange(len(open_))
    docs = np.flatnonzero(place[number] >= 0)
    docs = docs[np.argsort(place[number[docs]], kind="stable")]  # mask after mask
    limits = bounds[number[docs]]
    begin, count = 0, FIRST_SCORED
    while begin < len(docs) and limits[begin] >= least:
        some = docs[begin : begin + count]
        some = some[limits[begin : begin + count] >= least]
        scores = block.scores(some, values)
        good = np.flatnonzero(scores >= least)
        found = zip((-scores[good]).tolist(), some[good].tolist(), strict=True)
        ids = block.ids
        best = heapq.nsmallest(
            k, best + [(score, ids[d] is None, ids[d]) for score, d in found], key=_order
        )
        least = -best[-1][0] if len(best) == k else 1
        begin, count = begin + count, 2 * count
    return best


def _order(entry: tuple) -> tuple:
    score, unknown, doc = entry
    return (score, True) if unknown else (score, False, doc)


def _blocks(items: DataFrame, block_terms: int) -> Iterator[list[tuple]]:
    """Items with their terms' counts; as many at a time as have ``block_terms`` terms, or one."""
    block, held = [], 0
    for row in items.toLocalIterator():
        wanted = Counter(terms((row["_text"] or "").encode()))
        if block and held + len(wanted) > block_terms:
            yield block
            block, held = [], 0
        if wanted:
            block.append((row["_item"], wanted))
            held += len(wanted)
    if block:
        yield block


def _search_block(docs: DataFrame, block: list[tuple], kind, k: int, folder: str) -> None:
    """Writes (_item, rank, _id, score) for the items of a block."""
    vocabulary: dict[bytes, int] = {}
    for _, wanted in block:
        for term in wanted:
            vocabulary.setdefault(term, len(vocabulary))
    scratch = Scratch(docs.sparkSession)
    index = scratch.keep(_index(docs, vocabulary), "search-index")
    documents, tokens, holding = _statistics(index, len(vocabulary))
    weights = np.array([weight(documents, int(h)) for h in holding], np.int64)
    asked = [{vocabulary[t]: often for t, often in wanted.items()} for _, wanted in block]
    names = [name for name, _ in block]
    shared = docs.sparkSession.sparkContext.broadcast((weights, asked, names))
    item_kind = to_arrow_type(kind)
    doc_kind = to_arrow_type(docs.schema["_id"].dataType)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, asked, names = shared.value
        best: list[list[tuple]] = [[] for _ in asked]
        values = np.zeros(len(weights), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            held = _Block(batch, documents, tokens)
            for place, item in enumerate(asked):
                own = list(item)
                values[own] = weights[own] * np.fromiter(item.values(), np.int64, len(own))
                best[place] = _improve(best[place], held, item, values, k)
                values[own] = 0
        rows = [(place, names[place], e[2], -e[0]) for place, top in enumerate(best) for e in top]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.int32(), item_kind, doc_kind, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            ["_place", "_item", "_id", "score"],
        )

    result = (
        f"_place int, _item {kind.simpleString()},"
        f" _id {docs.schema['_id'].dataType.simpleString()}, score long"
    )
    # Without terms in any document there is nothing to rank, nor to divide by.
    found = index.where("n > 0").mapInArrow(rank, result)
    by_score = Window.partitionBy("_place").orderBy(F.desc("score"), F.asc_nulls_last("_id"))
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    ranked.select("_item", "rank", "_id", "score").write.parquet(folder)
    scratch.release()


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item, rank, document, score): the ``k`` best documents with a score above 0 of each item.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, with A-Z in lower
    case. With N documents that have terms, L terms in all, n in a document, df documents that
    hold a term and tf of its occurrences in one, a term's weight is
    floor(1000 ln((2 N + 2) / (2 df + 1))), a document's length m is 75 + 25 n N div L, and its
    score sums weight * (10^9 tf div (1000 tf + 12 m)) over the item's terms, with repeats.
    Equal scores are ranked by id, null ids last.

    Null texts have no terms. Rows of documents that share an id are documents of their own. Rows
    of items that repeat id and text are one item; different texts of one id are ranked apart.
    Items without a term, or whose terms no document has, give no row, so an empty table on either
    side gives an empty result. Other columns are not read.

    Documents are cut into terms once per block of items, into an index of the block's terms in
    the shared folder; whole-corpus counts are added up from it. Tasks then go through the index
    in blocks of documents, with one bitmap per term, and keep the ``k`` best of each item, so
    ``k`` rows per item and task are shuffled. Neither side is ever held whole.
    """
    if len({id_column, item_column, "rank", "score"}) < 4:
        raise ValueError(f"{id_column!r} or {item_column!r} is another column of the result")
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_column).alias("_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("_text"),
    )
    asked = items.select(F.col(item_column).alias("_item"), F.col(item_text_column).alias("_text"))
    kind = asked.schema["_item"].dataType
    # The distinct rows are written first: they are read partition by partition.
    listed = kept(asked.distinct().orderBy("_item", "_text"), "search-items")
    folder = scratch_dir(spark, "search-blocks")
    for number, block in enumerate(_blocks(listed, block_terms)):
        _search_block(texts, block, kind, k, f"{folder}/block={number}")
    ranks = T.StructType(
        [
            T.StructField("_item", kind),
            T.StructField("rank", T.IntegerType()),
            texts.schema["_id"],
            T.StructField("score", T.LongType()),
        ]
    )
    return read_parquet(spark, folder, ranks).select(
        F.col("_item").alias(item_column), "rank", F.col("_id").alias(id_column), "score"
    )


def search_sql(docs: str, items: str, k: int = 20) -> str:
    """The same as SQL of DuckDB, over tables with the default column names."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

    def cut(table: str, column: str) -> str:
        return (
            f"SELECT {column}, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'),"
            f" '{pattern}')) AS term FROM {table}"
        )

    return f"""
    WITH doc_terms AS ({cut(docs, "doc_id")}),
    item_terms AS (SELECT item_id, term, count(*) AS often FROM ({cut(items, "item_id")}) GROUP BY ALL),
    lengths AS (SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id),
    totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS tokens FROM lengths),
    postings AS (
        SELECT doc_id, term, count(*) AS tf FROM doc_terms
        WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL
    ),
    weights AS (
        SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
        FROM postings, totals GROUP BY term, docs
    ),
    parts AS (
        SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // tokens)))
            AS part
        FROM postings JOIN weights USING (term) JOIN lengths USING (doc_id), totals
    ),
    scores AS (
        SELECT item_id, doc_id, sum(often * part)::BIGINT AS score
        FROM item_terms JOIN parts USING (term) GROUP BY ALL
    ),
    ranked AS (
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER
            AS rank, doc_id, score
        FROM scores WHERE score > 0
    )
    SELECT * FROM ranked WHERE rank <= {k}
    """
