"""Documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chunks, jaccard, language, mixing, packing
from tidemark.llm.encoding import bounded_batches
from tidemark.llm.graph import kept

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text that fits the nearest profile less well than this is in no known language.
LEAST_SCORE = 0.3
#: Target weight of each source; None: all sources weigh alike.
TARGET_WEIGHTS: dict[str, float] | None = None
CAPACITY = 4096
#: Ids are marked in so many bits, 8 MB in all; the bits of one bitmap.
MARK_BITS = 1 << 26
_BITMAP_BITS = 1 << 15


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose text has letters and is like one of the languages in ``lang``.

    Profiles are learned from all documents of the stage that have a language. Rejected are null
    texts, texts without a letter, and those scoring below ``LEAST_SCORE``; a stated language
    stays as it is, a missing one is filled in. Without any stated language everything goes.
    """
    bounded_batches(spark)  # for this and all later stages of the session
    nearest = language.judge(language.learn_profiles(docs))
    judged = docs.select(*DOCUMENT, nearest("text").alias("_judged"))
    fits = (F.col("_judged.lang_pred") != language.UNDETERMINED) & (
        F.col("_judged.score") >= LEAST_SCORE
    )
    lang = F.coalesce("lang", F.col("_judged.lang_pred")).alias("lang")
    return judged.where(fits).select("doc_id", "text", lang, "source", "n_chars")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of similar documents: the one with the smallest id.

    Documents without words have no partners and stay. Rows that repeat an id and a text are one
    document. Rows with null ids cannot be told apart: they stay if any of them has to.

    Most ids have one row, which stays: these texts are not shuffled. The other ids are marked in
    bitmaps of a fixed size, and only rows whose id shares a bit with one of them are looked up.
    """
    found, _ = jaccard.similar(docs.select("doc_id", "text"))
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = found.groupBy("doc_id").agg(F.max(stays).alias("_stays"), F.count("*").alias("_rows"))
    marked = with_marks(docs.select(*DOCUMENT), ids.where("NOT _stays OR _rows > 1"))
    stay = ids.where("_stays").select(F.col("doc_id").alias("_id"))
    chosen = marked.where("_marked").join(stay, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    chosen = chosen.select(*DOCUMENT).dropDuplicates(["doc_id", "text"])
    return marked.where("NOT _marked").select(*DOCUMENT).unionByName(chosen)


def with_marks(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` with ``_marked``: true for each ``doc_id`` in ``ids``, and for few others.

    An id sets the bit that its hash names. The bitmaps are broadcast, ``MARK_BITS`` bits at most:
    more ids make more others share a bit, not larger bitmaps.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(MARK_BITS))
    bitmap, bit = F.floor(place / _BITMAP_BITS), F.pmod(place, F.lit(_BITMAP_BITS)).cast("int")
    marks = ids.groupBy(bitmap.alias("_bitmap")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    byte = F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(bit, F.lit(8))) == 1
    return (
        docs.withColumn("_bitmap", bitmap)
        .join(F.broadcast(marks), "_bitmap", "left")
        .withColumn("_marked", F.coalesce(is_set, F.lit(False)))
        .drop("_bitmap", "_bits")
    )


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages met before; a document of which nothing is left goes."""
    done = chunks.deduplicate(docs.select(*DOCUMENT))
    left = done.where((F.length("text") > 0) | (F.size("spans") == 0) | F.col("text").isNull())
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents by chance, so that sources reach their target weights, in shuffled order."""
    return mixing.mix(docs.select(*DOCUMENT), TARGET_WEIGHTS).select(*DOCUMENT)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(
        docs.select("doc_id", "text"), vocabulary, capacity=CAPACITY, end_id=1, let_go=True
    )


STAGES = [
    ("language", in_known_language),
    ("near_copies", without_near_copies),
    ("passages", without_repeated_passages),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL can express neither the profiles nor the chunks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
