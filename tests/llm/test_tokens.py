"""Token counts and packing against the tokenizers library itself."""

import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import encoding, packing, tokens

from .samples import awkward, empty, values

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def library(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def packed_ids(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def test_counts_match_library(spark):
    docs = awkward(spark, ["n_tokens", "over_limit"])
    got = values(tokens.count_tokens(docs, BYTES), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = []
    for doc, text, *_ in docs.collect():
        n = len(library(BYTES, text or ""))
        want.append((doc, len((text or "").encode()), n, n > 512))
    assert got == sorted(want, key=repr)


def test_counts_with_sentencepiece(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = awkward(spark, [])
    got = values(tokens.count_tokens(docs, PIECES, batch_bytes=64), "doc_id", "n_tokens")
    want = sorted(((d, len(model.encode(t or ""))) for d, t in docs.collect()), key=repr)
    assert got == want


def test_empty_table(spark):
    assert tokens.count_tokens(empty(spark), BYTES).collect() == []
    assert packing.pack(empty(spark), WORDS).collect() == []


def test_clashing_id_is_refused(spark):
    docs = empty(spark, "n_tokens long, text string")
    with pytest.raises(ValueError):
        tokens.count_tokens(docs, BYTES, id_column="n_tokens")


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("abZé '’.,!12\n\t  \x1cßs<|>ΣI"), max_size=40))
def test_any_text_is_encoded_as_by_the_library(text):
    assert encoding.counter(BYTES)([text]) == [len(library(BYTES, text))]
    assert encoding.encoder(WORDS)([text]) == [packed_ids(library(WORDS, text))]


def test_memo_starts_anew_when_full(monkeypatch):
    monkeypatch.setattr(encoding, "MEMO_SIZE", 3)
    own = encoding.Encoder(BYTES, len, sum)
    for text in ("one two three", "four five six seven", "one two"):
        assert own([text]) == [len(library(BYTES, text))]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_repeated_fragments_cost_one_lookup_a_batch(path):
    class Memo(dict):
        looked_up = 0

        def get(self, *key):
            self.looked_up += 1
            return super().get(*key)

        def __contains__(self, key):
            self.looked_up += 1
            return super().__contains__(key)

        def __getitem__(self, key):
            self.looked_up += 1
            return super().__getitem__(key)

    own = encoding.Encoder(path, packed_ids, b"".join)
    own.memo = Memo()
    texts = ["Ça va, ça va! " * 50 + "x\x07y " * 50, "", "va ça", "“ça va”" * 3, "1 <|endoftext|>"] * 9
    for _ in range(2):
        own.memo.looked_up = 0
        assert own(texts) == [packed_ids(library(path, text)) for text in texts]
        assert 0 < own.memo.looked_up <= 30


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_each_settled_character_is_encoded_as_by_the_library(path):
    whole = Tokenizer.from_file(path)
    texts = [f"a{chr(c)}b {chr(c)}, {chr(c)}9 don't{chr(c)}" for c in range(0x180)]
    want = [packed_ids(whole.encode(text, add_special_tokens=False).ids) for text in texts]
    assert encoding.encoder(path)(texts) == want
    assert encoding.counter(path)(texts) == [len(ids) // 4 for ids in want]


def test_byte_slices_keep_order():
    texts = pa.array(["a" * 5, None, "b" * 50, "", "c"])
    parts = list(encoding.byte_slices(texts, 10))
    assert [x for p in parts for x in p.to_pylist()] == texts.to_pylist()
    assert max(len(p) for p in parts) > 1


def check_places(rows, capacity):
    held = defaultdict(list)
    for row in rows:
        held[row.sequence_id].append((row.offset, row.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_packing_round_trip(spark, capacity):
    docs = awkward(spark, ["piece", "offset", "sequence_id", "length"])
    packed = packing.pack(docs, WORDS, capacity=capacity, with_ids=True)
    rows = packed.collect()
    check_places(rows, capacity)
    want = Counter()
    for doc, text, *_ in docs.collect():
        ids = [*library(WORDS, text or ""), 1]
        for piece, begin in enumerate(range(0, len(ids), capacity)):
            part = ids[begin : begin + capacity]
            want[doc, piece, begin, len(part), zlib.crc32(packed_ids(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for row in rows:
        assert whole[row.sequence_id][row.offset : row.offset + row.length] == row.ids


@settings(max_examples=150, deadline=None)
@given(
    st.integers(4, 60).flatmap(
        lambda c: st.tuples(
            st.just(c), st.lists(st.integers(1, c), max_size=120), st.integers(1, 9)
        )
    )
)
def test_plan_places_every_piece_once(case):
    capacity, lengths, groups = case
    rows, opened = packing.plan(Counter(lengths), capacity, groups)
    ranks, places = defaultdict(list), defaultdict(list)
    for length, rank, n, first, each, offset in rows:
        ranks[length] += range(rank, rank + n)
        for i in range(n):
            places[first + i // each].append((offset + i % each * length, length))
    assert {x: sorted(r) for x, r in ranks.items()} == {
        x: list(range(n)) for x, n in Counter(lengths).items()
    }
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(places) <= opened


def test_plan_is_near_the_least_number():
    lengths = Counter({k: 37 for k in range(100, 4000, 13)})
    _, opened = packing.plan(lengths, 4096)
    lengths[40] = 3000  # small ones fill what is left
    rows, with_small = packing.plan(lengths, 4096)
    total = sum(k * n for k, n in lengths.items())
    assert with_small <= 1.06 * -(-total // 4096)
    assert with_small <= opened + 60
