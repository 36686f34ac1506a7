"""Token counts of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.encoding import BATCH_BYTES, byte_slices, counter

RESULT = ("n_bytes", "n_tokens", "over_limit")


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 512,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    ``tokenizer`` is the path of a vocabulary for the tokenizers (.json) or sentencepiece
    (.model) library. One narrow pass: Arrow batches are cut into slices of about ``batch_bytes``
    bytes, long texts are split where the vocabulary always cuts, and only lengths come back.
    Texts are counted whole. A null text counts as empty and an empty text has no tokens; rows
    with equal or null ids are counted each by itself; other columns are not read, so their names
    cannot clash; an empty table gives an empty result.
    """
    if id_column in RESULT:
        raise ValueError(f"{id_column!r} is a column of the result")
    kind = docs.schema[id_column].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = counter(tokenizer)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            counts = [n for part in byte_slices(texts, batch_bytes) for n in measure(part.to_pylist())]
            tokens = pa.array(counts, pa.int64())
            sizes = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, tokens, pc.greater(tokens, limit)], [id_column, *RESULT]
            )

    return docs.select(F.col(id_column), F.col(text_column).cast("string")).mapInArrow(
        count, f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
