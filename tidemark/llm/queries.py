"""The operators over whole given tables, with production parameters, and SQL where it can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chunks,
    digests,
    jaccard,
    language,
    mixing,
    packing,
    projections,
    search,
    tokens,
    toxicity,
    trie,
    urls,
    warc,
)
from tidemark.session import scratch_dir

CAPACITY = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(folds: int, fold: int) -> Column:
    """Whether the id's checksum leaves this remainder; a null id is always held out."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(checksum % folds == fold, F.lit(True))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(5, 0))
    texts, toxic = toxicity.sample(docs, labels)
    model = toxicity.calibrated(toxicity.fit(texts, toxic), docs, labels)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted", "spans")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, vocabulary, capacity=CAPACITY, end_id=1)


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = chunks.deduplicate(docs)
    cut = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda held, s: held + (s["end"] - s["begin"])
    )
    return done.select("doc_id", "text", "spans", cut.alias("cut_bytes"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.fingerprints(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language.learn_profiles(docs.where(~held_out(3, 1)))
    judged = language.identify(docs, profiles)
    return judged.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", "copy", "mix_key", F.md5("text").alias("text_md5"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = jaccard.similar(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page shows the document whose number its path ends in; that one's labels are the URL's."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(urls.path(F.col("url")), r"([0-9]{1,18})[^/]*/?$", 1)
    unwanted = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    labels = table(spark, sf_dir, "labels").select("doc_id", unwanted.alias("label"))
    labelled = pages.withColumn("doc_id", number.try_cast("long")).join(
        labels, "doc_id"
    )
    return urls.judge(pages, RULES, urls.fit(labelled))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.spliced_paths(table(spark, sf_dir, "conversations")))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The rules (verdict, host, path) that the URLs are judged by.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

QUERIES = {
    "op1_toxicity": (op1_toxicity, None),
    "op2_packing": (op2_packing, None),
    "op3_substrings": (op3_substrings, None),
    "op4_embeddings": (op4_embeddings, None),
    "op5_token_counts": (op5_token_counts, None),
    "op6_fingerprints": (op6_fingerprints, None),
    "op7_language": (op7_language, None),
    "op8_mixing": (op8_mixing, mixing.mix_sql("documents")),
    "op9_jaccard": (op9_jaccard, None),
    "op10_urls": (op10_urls, None),
    "op11_warc": (op11_warc, warc.write_sql("pages")),
    "op12_trie": (op12_trie, trie.trie_sql("conversations")),
    "op13_search": (op13_search, search.search_sql("documents", "benchmark")),
}
