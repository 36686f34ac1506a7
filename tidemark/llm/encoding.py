"""Token ids of whole texts by public tokenizers, inside Arrow functions.

Both byte-level vocabularies cut a text into fragments before any merge, and no merge crosses a
cut. A text is therefore split at white space, a cut in either, and Arrow finds the distinct
fragments of a batch. Each is looked up among those the worker remembers, or else encoded by the
library's model. Texts with characters for which the cuts could be read differently here and in
the library are left to the library as a whole.
"""

from __future__ import annotations

import ctypes
import json
import os
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Fragments that a worker remembers at most, the first it meets; others are encoded each time.
MEMO_SIZE = 250_000
#: Bytes of a batch of rows on its way to a Python worker, or those of one row.
ARROW_BYTES = 4 << 20
#: Bytes of text that are encoded together.
BATCH_BYTES = 2 << 20

_LATIN = 0x250  # code points below have settled classes and no combining marks


def _class_of(category: str) -> str:
    """Regular-expression ranges of the Latin characters of one Unicode category."""
    members = [c for c in range(_LATIN) if unicodedata.category(chr(c)).startswith(category)]
    return "".join(f"\\u{c:04x}" for c in members)


_LETTER, _NUMBER = _class_of("L"), _class_of("N")
_SPACE = r"\t\n\v\f\r \x85\xa0"
_CONTROLS = "\x1c\x1d\x1e\x1f"
_UNSETTLED = re.compile(rf"[\x1c-\x1f{chr(_LATIN)}-{chr(0x10FFFF)}]|<\|")
# The two patterns that vocabularies of these kinds cut texts by, for Latin text,
# the first also as such files state it.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD = re.compile(
    rf"[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+"
)
_SPACED_WORD = re.compile(
    rf" ?[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_FOLDING = ["NFC", "Replace", "Lowercase"]
_MARK_SWITCHES = ("normalized", "lstrip", "rstrip", "single_word")


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session hands Python workers ``ARROW_BYTES`` at a time, unless it is less.

    A batch is held by the executor and its worker at once, with whatever is made of it.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name).rstrip("bB")
    if not held.isdigit() or int(held) > ARROW_BYTES:
        spark.conf.set(name, str(ARROW_BYTES))


def byte_slices(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Consecutive slices of about ``size`` bytes each; a longer text is a slice of its own."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin = held = 0
    for place, length in enumerate(lengths.tolist()):
        if held and held + length > size:
            yield texts.slice(begin, place - begin)
            begin, held = place, 0
        held += length
    if begin < len(texts):
        yield texts.slice(begin)


def release(tokenizers: bool = False) -> None:
    """Hands freed memory back: Python workers live on between stages beside their executor,
    several for each of its cores. With ``tokenizers``, theirs too; the next task loads them anew."""
    if tokenizers:
        counter.cache_clear()
        encoder.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class _ByteLetters(dict):
    """The letters that stand for the bytes of a character in byte-level vocabularies, by its
    code point, as the library gives them."""

    def __missing__(self, point: int) -> str:
        from tokenizers import pre_tokenizers

        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self[point] = "".join(letters for letters, _ in level.pre_tokenize_str(chr(point)))
        return self[point]


class Encoder:
    """Encodes texts with one vocabulary; ``value`` turns the ids of a fragment into what is kept
    for it, and ``total`` the kept values of a text's fragments into its result."""

    def __init__(self, path: str, value: Callable, total: Callable) -> None:
        self.value, self.total = value, total
        self.memo: dict[str, object] = {}
        self.pattern = None
        self.folds = False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode_whole = lambda texts: model.encode(texts, num_threads=1)
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        vocabulary = Tokenizer.from_file(path)
        self.encode_whole = lambda texts: [
            e.ids for e in vocabulary.encode_batch_fast(texts, add_special_tokens=False)
        ]
        # A fragment is normal and cut already: the model alone is left to apply.
        tokenize, letters = vocabulary.model.tokenize, _ByteLetters()
        self.encode_fragment = lambda text: [t.id for t in tokenize(text.translate(letters))]
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        cut, norm = described["pre_tokenizer"] or {}, described["normalizer"]
        parts = cut.get("pretokenizers", [])
        marks = all(
            t["content"].startswith("<|") and not any(t[k] for k in _MARK_SWITCHES)
            for t in described["added_tokens"]
        )
        if not marks or described["post_processor"]:
            return
        if cut.get("type") == "ByteLevel":
            if cut["use_regex"] and not cut["add_prefix_space"] and norm is None:
                self.pattern = _SPACED_WORD
        elif (
            [p["type"] for p in parts] == ["Split", "ByteLevel"]
            and parts[0]["pattern"].get("Regex") == _WORD_PATTERN
            and [n["type"] for n in (norm or {}).get("normalizers", [])] == _FOLDING
        ):
            self.pattern, self.folds = _WORD, True

    def _fragments(self, text: str) -> list[str] | None:
        """The text at safe places; None if it has to go to the library as a whole."""
        if self.pattern is None:
            return None
        try:
            text.encode("latin-1")  # a copy, and much less work than the search
        except UnicodeEncodeError:
            if _UNSETTLED.search(text):
                return None
        else:
            if "<|" in text or any(c in text for c in _CONTROLS):
                return None
        return self.pattern.findall(text.lower() if self.folds else text)

    def __call__(self, texts: Sequence[str]) -> list:
        """The result of each whole text, in order."""
        cut = [self._fragments(text) for text in texts]
        flat = pa.array(list(chain.from_iterable(filter(None, cut))), pa.large_string())
        flat = flat.dictionary_encode()
        seen, memo = flat.dictionary.to_numpy(zero_copy_only=False).tolist(), self.memo
        values = list(map(memo.get, seen))
        for place, value in enumerate(values):
            if value is None:
                values[place] = self.value(self.encode_fragment(seen[place]))
                if len(memo) < MEMO_SIZE:
                    memo[seen[place]] = values[place]
        kept = np.array(values, object)[flat.indices.to_numpy()].tolist()
        bounds = accumulate((len(fragments or ()) for fragments in cut), initial=0)
        results = [self.total(kept[begin:end]) for begin, end in pairwise(bounds)]
        for place, fragments in enumerate(cut):
            if fragments is None:
                results[place] = self.value(self.encode_whole([texts[place]])[0])
        return results


def _bytes_of(ids: Sequence[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def counter(path: str) -> Encoder:
    """Lengths only; one per worker and vocabulary."""
    return Encoder(path, len, sum)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """Ids as little-endian unsigned 32-bit integers; one per worker and vocabulary."""
    return Encoder(path, _bytes_of, b"".join)
