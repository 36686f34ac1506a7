"""Ranked search against a plain reading of its formula, and against SQL."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries, search

from .samples import awkward, empty, prose, values

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=20):
    """All scores of all documents; one item per different (id, text)."""
    counted = [(doc, Counter(plain_terms(text))) for doc, text in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, tokens = sum(s > 0 for s in sizes), sum(sizes)
    rows = []
    for item, text in set(items):
        wanted = Counter(plain_terms(text))
        found = []
        for (doc, c), n in zip(counted, sizes):
            score = 0
            for term, often in wanted.items():
                if tf := c[term]:
                    df = sum(term in other for _, other in counted)
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    m = 100 - 25 + (25 * n * n_docs) // tokens
                    score += often * w * ((1000000000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        found.sort(key=lambda f: f[:3])
        rows += [(item, rank, f[3], -f[0]) for rank, f in enumerate(found[:k], 1)]
    return sorted(rows, key=repr)


def got(frame):
    return values(frame, "item_id", "rank", "doc_id", "score")


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_terms(text):
    try:
        data = text.encode()
    except UnicodeEncodeError:
        return
    assert [t.decode() for t in search.terms(data)] == plain_terms(text)


def many(spark, k):
    """Documents with ties, copies and a word that all share; more than one block of them."""
    rows = [(n, f"common {prose(n % 40, 12)} w{n % 7} w{n % 3}") for n in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = [(n, f"{prose(n, 6)} w{n % 7} common common") for n in range(12)]
    items.append((50, prose(3, 400)))  # far more than 64 terms
    items.append((51, "none of these !"))
    frame = spark.createDataFrame(items, "item_id long, text string")
    return rows, items, docs, frame


@pytest.mark.parametrize("block_terms", [10, 50_000])
def test_matches_plain(spark, block_terms):
    rows, items, docs, frame = many(spark, 20)
    found = search.search(docs, frame, block_terms=block_terms)
    assert got(found) == plain(rows, items)


def test_blocks_of_documents_share_their_best(spark):
    rows, items, docs, frame = many(spark, 3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        assert got(search.search(docs, frame, k=3)) == plain(rows, items, 3)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_masks_are_grouped():
    """More than 64 terms: several words per mask."""
    import pyarrow as pa

    def pack(numbers):
        return np.array(numbers, np.int32).tobytes()

    rows = [(n, [n % 5, 5 + n % 7, 20 + n % 70]) for n in range(300)]
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array([n for n, _ in rows]),
            pa.array([3 + n % 11 for n, _ in rows], pa.int64()),
            pa.array([pack(t) for _, t in rows]),
            pa.array([pack([1 + n % 3, 1, 2]) for n, _ in rows]),
        ],
        ["_id", "n", "terms", "counts"],
    )
    block = search._Block(batch, 300, 2000)
    wanted = list(range(90))
    masks = block.masks([t for t in wanted if t in block.spans])
    first, number = search._groups(masks)
    assert {tuple(masks[f]) for f in first} == {tuple(m) for m in masks}
    for doc in range(300):
        assert (masks[first[number[doc]]] == masks[doc]).all()


def test_awkward(spark):
    docs = awkward(spark, ["rank", "score", "n", "terms", "_place"])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [
        (1, prose(2, 30)), (1, prose(2, 30)), (1, prose(1, 5)), (None, "word Word x"),
        (3, None), (4, ""), (5, "  ! "), (6, "ünïcödé Ünïcödé endoftext ΣΣ"),
    ]
    frame = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string")
    assert got(search.search(docs, frame)) == plain(rows, items)


def test_ties_with_null_ids(spark):
    rows = [(3, "a b"), (None, "a b"), (1, "b a"), (1, "a b"), (2, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(1, "a")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert got(search.search(docs, frame, k=3)) == [(1, 1, 1, s := plain(rows, items)[0][3]), (1, 2, 1, s), (1, 3, 3, s)]
    assert got(search.search(docs, frame)) == plain(rows, items)


def test_text_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("x", "some words"), ("y", "words")], "name string, body string")
    items = spark.createDataFrame([("q", "words")], "query string, asked string")
    names = {"id_column": "name", "text_column": "body", "item_column": "query", "item_text_column": "asked"}
    found = search.search(docs, items, **names)
    assert [tuple(r)[:3] for r in found.orderBy("rank").collect()] == [("q", 1, "y"), ("q", 2, "x")]
    assert found.columns == ["query", "rank", "name", "score"]
    assert search.search(docs.limit(0), items, **names).collect() == []
    assert search.search(docs, items.limit(0), **names).collect() == []
    wordless = spark.createDataFrame([("x", "!"), ("y", None)], docs.schema)
    assert search.search(wordless, items, **names).collect() == []
    nothing = search.search(empty(spark), empty(spark, "item_id long, text string"))
    assert nothing.collect() == [] and nothing.columns == ["item_id", "rank", "doc_id", "score"]
    with pytest.raises(ValueError):
        search.search(docs, items, **(names | {"id_column": "query"}))


def test_query_matches_sql(spark, testdata):
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS FROM '{testdata}/{name}.parquet'")
    query, text = queries.QUERIES["op13_search"]
    frame = query(spark, testdata)
    result = duck.execute(text)
    names = [c[0] for c in result.description]
    assert got(frame) == sorted((tuple(dict(zip(names, r))[c] for c in ("item_id", "rank", "doc_id", "score")) for r in result.fetchall()), key=repr)
