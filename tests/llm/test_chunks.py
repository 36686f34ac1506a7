"""Content-defined chunks against a rolling hash, and deduplication against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chunks

from .samples import awkward, empty, prose


def rolled(data, mean_bits, longest):
    ends, h, begin, due = [], 0, 0, False
    for i, byte in enumerate(data):
        h = (h << 1) + int(chunks._GEARS[byte]) & 0xFFFF
        end = i + 1
        due = due or h >> 16 - mean_bits == 0
        if end == len(data) or due and data[end] & 0xC0 != 0x80:  # at the end of a character
            due = False
            for forced in range(begin + longest, end, longest):
                while data[forced] & 0xC0 == 0x80:
                    forced -= 1
                ends.append(forced)
            ends.append(end)
            begin = end
    return ends


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=300), st.sampled_from([2, 3, 5]), st.sampled_from([9, 64, 512]))
def test_boundaries_match_rolling_hash(text, mean_bits, longest):
    data = text.encode()
    assert chunks.boundaries(data, mean_bits, longest).tolist() == rolled(data, mean_bits, longest)


def test_insertions_shift_no_distant_boundary():
    data = prose(1, 2000).encode()
    old = chunks.boundaries(data)
    new = chunks.boundaries(data[:500] + b"inserted" + data[500:])
    far = {int(e) + 8 for e in old if e > 500 + chunks.WINDOW}
    assert far <= set(new.tolist())
    assert set(old[old <= 500].tolist()) <= set(new.tolist())
    assert 16 < len(data) / len(old) < 64


def brute(rows, least):
    """Text of each distinct (id, text) after one pass in order that remembers all chunks."""
    seen, result = set(), {}
    order = sorted({(d, t) for d, t in rows if t}, key=lambda r: (r[0] is None, r[0] or 0))
    for doc, text in order:
        data, begin, runs = text.encode(), 0, []
        for end in rolled(data, chunks.MEAN_BITS, chunks.LONGEST):
            if data[begin:end] in seen:
                if runs and runs[-1][1] == begin:
                    runs[-1][1] = end
                else:
                    runs.append([begin, end])
            seen.add(data[begin:end])
            begin = end
        left, at = b"", 0
        for b, e in runs:
            if e - b >= least:
                left, at = left + data[at:b], e
        result[doc, text] = (left + data[at:]).decode()
    return result


@pytest.mark.parametrize("parts", [1, 7])
def test_matches_brute_force(spark, parts):
    rng = random.Random(5)
    passages = [prose(1000 + k, 60) for k in range(12)]
    rows = []
    for k in range(80):
        words = prose(k, rng.randint(20, 200)).split()
        if k % 2:
            words.insert(rng.randrange(len(words)), rng.choice(passages))
        rows.append((100 + k, " ".join(words)))
    rows += [(3, ""), (4, None), (90, "é" * 3000), (91, "é" * 3000), (8, "word " * 5000), (None, rows[0][1]), rows[1], rows[1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = chunks.deduplicate(docs).collect()
    assert len(got) == len(rows)
    want = brute(rows, chunks.LEAST_BYTES)
    texts = defaultdict(set)
    for row in got:
        texts[row.doc_id].add(row.text)
    for (doc, text), left in want.items():
        assert texts[doc] == {left}
    assert texts[3] == {""} and texts[4] == {None}
    whole = sum(sum(p in (r.text or "") for r in got if r.doc_id) > 1 for p in passages)
    assert whole <= 1  # too few boundaries inside
    for row in got:
        for span in row.spans:
            assert span.end - span.begin >= chunks.LEAST_BYTES


def test_awkward_table_and_columns(spark):
    docs = awkward(spark, ["spans", "key", "id", "begin"])
    got = chunks.deduplicate(docs)
    assert set(got.columns) == set(docs.columns)
    rows = got.collect()
    assert len(rows) == docs.count() and {r.key for r in rows} == {"clash"}
    both = [r for r in rows if r.doc_id == 2 and (r.text or "").startswith(prose(2, 3))]
    assert len(both) == 2 and both[0].text == both[1].text == prose(2, 300)
    (copy,) = [r for r in rows if r.doc_id == 10]
    assert copy.text == "" and copy.spans[0].sources == [2]
    assert chunks.deduplicate(empty(spark)).collect() == []


def test_gears_are_spread():
    assert len(np.unique(chunks._GEARS)) > 250


def test_texts_that_share_id_and_hash(spark, monkeypatch):
    """The first keys do not tell the texts of an id apart: further ones are taken."""
    real = chunks.row_key
    monkeypatch.setattr(
        chunks, "row_key", lambda text, seed: F.length(text) % 1 if seed < 2 else real(text, seed)
    )
    copy = prose(1, 120)
    rows = [(5, copy), (5, prose(2, 100)), (None, copy), (None, prose(3, 90)), (7, prose(2, 100))]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(2)
        texts = docs.select(F.col("doc_id").alias("id"), "text")
        assert chunks._telling_seed(texts) == 2
        got = sorted((r.doc_id or 99, r.text) for r in chunks.deduplicate(docs).collect())
        assert got == sorted([(5, copy), (5, prose(2, 100)), (99, ""), (99, prose(3, 90)), (7, "")])


@pytest.mark.parametrize("letters", ["абвгдежзик", "가나다라마바사", "的一是不了人我在有他这"])
def test_chunks_in_other_scripts(letters):
    """Chunks are about as long, in bytes, whatever a character takes."""
    rng = random.Random(1)
    data = "".join(rng.choice(letters) for _ in range(20_000)).encode()
    assert 24 < len(data) / len(chunks.boundaries(data)) < 48


def test_order_of_arrival_does_not_matter(spark):
    passage = prose(9, 80)
    rows = [(k, f"{prose(k, 30)} {passage} {prose(k + 500, 30)}") for k in range(60)]
    texts = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        texts.append({r.doc_id: r.text for r in chunks.deduplicate(docs).collect()})
    assert texts[0] == texts[1] and passage in texts[0][0]
    assert sum(passage in t for t in texts[0].values()) == 1
