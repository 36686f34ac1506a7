"""Digests, their difference, and the edited texts against a plain implementation."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import digests

from .samples import awkward, empty, prose


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=200), st.binary(max_size=200))
def test_difference_is_a_bounded_score(a, b):
    one, other = digests.digest(a), digests.digest(b)
    assert digests.difference(one, one) == 0
    assert digests.difference(one, other) == digests.difference(other, one) <= digests.BOUND
    assert (digests.difference(one, other) == 0) == (one == other)
    assert len(one) == 4 + digests.BUCKETS // 2


def test_near_texts_are_nearer():
    text = prose(1, 800)
    edited = text.replace("ka", "KA", 5)
    own = digests.digest(text.encode())
    near = digests.likeness(own, digests.digest(edited.encode()))
    far = digests.likeness(own, digests.digest(bytes(range(256)) * 10))
    assert near > 0.8 > 0.3 > far


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    groups = [[r for r in rows if r[0] is None], [r for r in rows if r[0] is not None]]
    for own in groups:
        for k, (doc, text) in enumerate(own):
            after = own[(k + 1) % len(own)][1]
            half = len(text) // 2
            edited = text[: len(text) - half] + after[:half]
            marks = [digests.digest(t.encode()) for t in (text, edited, after)]
            yield (
                doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), marks[0], marks[1],
                digests.likeness(marks[0], marks[1]), digests.likeness(marks[0], marks[2]),
            )


@pytest.mark.parametrize("lanes", [1, 4])
def test_matches_plain_order(spark, lanes):
    extra = [(100 + 7 * k, prose(k, 5 + k)) for k in range(60)]
    docs = awkward(spark, ["fingerprint", "n_chars"], extra)
    got = sorted(map(tuple, digests.fingerprints(docs, lanes_per_partition=lanes).collect()), key=repr)
    want = sorted(plain([(r.doc_id, r.text or "") for r in docs.collect()]), key=repr)
    assert got == want


def test_small_tables(spark):
    assert digests.fingerprints(empty(spark)).collect() == []
    only = spark.createDataFrame([(7, "abcd")], "doc_id long, text string")
    (row,) = digests.fingerprints(only).collect()
    assert row.near_next == 1.0
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
