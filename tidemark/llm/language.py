"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.encoding import byte_slices, release

#: n-grams of one to three characters in a profile.
PROFILE_SIZE = 400
#: Bytes of text whose n-grams are held at one time.
BATCH_BYTES = 256 << 10
UNDETERMINED = "und"
_POINT_BITS = 21
_BLANK = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the lower-cased words of a text, ascending, and how often each occurs.

    An n-gram is an integer of its code points; a blank stands for everything between words.
    """
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    points = np.where(_letters()[points], points, _BLANK).astype(np.uint64)
    blank = points == _BLANK
    kept = ~(blank[1:] & blank[:-1])
    points, blank = points[:-1][kept], blank[:-1][kept]
    points = np.append(points, np.uint64(_BLANK))
    blank = np.append(blank, True)
    if blank.all():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    pairs = points[:-1] << np.uint64(_POINT_BITS) | points[1:]
    pairs = pairs[~(blank[:-1] & blank[1:])]
    triples = (
        points[:-2] << np.uint64(2 * _POINT_BITS)
        | points[1:-1] << np.uint64(_POINT_BITS)
        | points[2:]
    )[~blank[1:-1]]
    return np.unique(np.concatenate([points[~blank], pairs, triples]), return_counts=True)


def learn_profiles(
    docs: DataFrame,
    *,
    text_column: str = "text",
    lang_column: str = "lang",
    size: int = PROFILE_SIZE,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """The ``size`` most frequent n-grams of each language: lang, gram, rank from 0.

    Counts cover every whole text with a language. Each task adds up its own counts first, so the
    shuffle holds a row per task, language and distinct n-gram, and a language of most documents
    is no heavier than another. Ties go to the smaller n-gram. Rows without text, letters or
    language teach nothing; no such row gives no profile.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = defaultdict(list)

        def merge(lang: str) -> None:
            found, n = zip(*held[lang], strict=True)
            distinct, places = np.unique(np.concatenate(found), return_inverse=True)
            sums = np.bincount(places, np.concatenate(n)).astype(np.int64)
            held[lang] = [(distinct, sums)]

        for batch in batches:
            langs = batch.column(0).to_pylist()
            place = 0
            for part in byte_slices(batch.column(1), batch_bytes):
                for text in part.to_pylist():
                    held[langs[place]].append(grams(text))
                    place += 1
                for lang in held:
                    merge(lang)
        for lang in held:
            found, n = held[lang][0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(found), pa.string()),
                    pa.array(found.astype(np.int64)),
                    pa.array(n),
                ],
                ["lang", "gram", "n"],
            )
        release()

    taught = docs.select(
        F.col(lang_column).cast("string").alias("lang"),
        F.col(text_column).cast("string").alias("text"),
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    totals = (
        taught.mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (
        totals.withColumn("rank", F.row_number().over(order) - 1)
        .where(F.col("rank") < size)
        .select("lang", "gram", "rank")
    )


class Profiles:
    """Profiles as arrays: the known n-grams and their rank in each language."""

    def __init__(self, rows: list, size: int) -> None:
        self.size = size
        self.langs = sorted({r.lang for r in rows})
        self.grams = np.array(sorted({r.gram for r in rows}), np.uint64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        if rows:
            at = np.searchsorted(self.grams, np.array([r.gram for r in rows], np.uint64))
            column = {lang: j for j, lang in enumerate(self.langs)}
            self.ranks[at, [column[r.lang] for r in rows]] = [r.rank for r in rows]

    def nearest(self, text: str | None) -> tuple[str, float]:
        """(language, score): 1 minus the mean out-of-place distance as a share of the largest."""
        found, n = grams(text) if text else ((), ())
        if not len(found) or not self.langs:
            return UNDETERMINED, 0.0
        top = np.lexsort((found, -n))[: self.size]
        at = np.minimum(np.searchsorted(self.grams, found[top]), len(self.grams) - 1)
        at = np.where(self.grams[at] == found[top], at, len(self.grams))
        ranks = self.ranks[at]
        out = np.abs(ranks - np.arange(len(top))[:, None])
        distance = np.where(ranks < 0, self.size, out).sum(axis=0)
        best = int(np.argmin(distance))
        return self.langs[best], float(1 - distance[best] / (self.size * len(top)))


def identify(
    docs: DataFrame,
    profiles: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = PROFILE_SIZE,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``lang_pred`` and ``score``.

    The ``size`` most frequent n-grams of the whole text are compared with each profile by
    out-of-place distance; a missing n-gram counts ``size``. Equal distances go to the language
    that sorts first. Null texts, texts without a letter and all texts when nothing was learned
    are ``und`` with score 0. Profiles have at most ``size`` rows per language and travel with
    the function. Rows are judged each by itself, other columns are not read, and an empty table
    gives an empty result.
    """
    if id_column in ("lang_pred", "score"):
        raise ValueError(f"{id_column!r} is a column of the result")
    judged = docs.select(id_column, judge(profiles, size, batch_bytes)(text_column).alias("_judged"))
    return judged.select(id_column, "_judged.lang_pred", "_judged.score")


def judge(profiles: DataFrame, size: int = PROFILE_SIZE, batch_bytes: int = BATCH_BYTES):
    """An Arrow function of a text column: struct (lang_pred, score), as ``identify`` says.

    A filter on its result does not call it again: Spark would copy a deterministic function into
    the filter, and each task would judge all texts twice, in two workers.
    """
    known = Profiles(profiles.collect(), size)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def nearest(texts: pa.Array) -> pa.Array:
        judged = [
            known.nearest(text)
            for part in byte_slices(texts, batch_bytes)
            for text in part.to_pylist()
        ]
        release()
        return pa.StructArray.from_arrays(
            [
                pa.array([j[0] for j in judged], pa.string()),
                pa.array([j[1] for j in judged], pa.float64()),
            ],
            ["lang_pred", "score"],
        )

    once = nearest.asNondeterministic()
    return lambda text: once(F.col(text).cast("string"))
