"""URL filters: rules by host and path, and boosted trees on lexical features for all others."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import kept

#: Labelled URLs of each class that the trees are fitted to, at most.
SAMPLE_URLS = 20_000
#: Weight of the overall share in a suffix's share of label 1.
SMOOTHING = 20.0
#: Shares of suffixes of up to so many bytes are broadcast; more are joined.
BROADCAST_BYTES = 8 << 20
#: Where they are joined, rows of suffixes that hold more than one in so many are dealt over as many parts.
PARTS = 64
ALLOW, BLOCK = "allow", "block"
FEATURES = (
    "length", "host_length", "path_length", "depth", "labels", "digits", "letters", "hyphens",
    "parameters", "query_length", "escapes", "host_entropy", "path_entropy", "secure", "share",
)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(found, upper, lower), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without a host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule (verdict, host, path) that fits, as struct (verdict, rule), or null.

    A rule fits its host and all subdomains, where the path starts with the rule's.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1:]))
    fits = [
        F.when(
            ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(begin)),
            F.struct(F.lit(verdict).alias("verdict"), F.lit(name + begin).alias("rule")),
        )
        for verdict, name, begin in ordered
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<verdict:string,rule:string>"))


def entropy(text: Column) -> Column:
    """Bits per character, from the counts of its distinct characters."""
    n = F.length(text)
    characters = F.array_distinct(F.split(text, ""))
    shares = F.transform(characters, lambda c: (n - F.length(F.replace(text, c))) / n)
    bits = F.aggregate(shares, F.lit(0.0), lambda held, p: held - p * F.log2(p))
    return F.when(n > 0, bits).otherwise(0.0)


def lexical(urls: DataFrame, url_column: str) -> DataFrame:
    """``urls`` with the lexical features and the suffix (last two labels of the host)."""
    url = F.coalesce(F.col(url_column), F.lit(""))
    where, what = host(url), path(url)
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    size = F.greatest(F.length(url), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(url, F.lit(pattern)) / size

    named = {
        "length": F.length(url),
        "host_length": F.length(where),
        "path_length": F.length(what),
        "depth": F.regexp_count(what, F.lit("/[^/]")),
        "labels": F.size(F.split(where, r"\.")),
        "digits": share("[0-9]"),
        "letters": share("[A-Za-z]"),
        "hyphens": F.regexp_count(where, F.lit("-")),
        "parameters": F.when(F.length(query) > 0, F.regexp_count(query, F.lit("&")) + 1).otherwise(0),
        "query_length": F.length(query),
        "escapes": F.regexp_count(url, F.lit("%")),
        "host_entropy": entropy(where),
        "path_entropy": entropy(what),
        "secure": F.startswith(url, F.lit("https://")).cast("int"),
    }
    features = [value.cast("double").alias(f"_{name}") for name, value in named.items()]
    suffix = F.regexp_extract(where, r"([^.]*\.?[^.]*)$", 1).alias("_suffix")
    return urls.select("*", *features, suffix)


def fit(
    labelled: DataFrame,
    *,
    url_column: str = "url",
    label_column: str = "label",
    sample: int = SAMPLE_URLS,
    rounds: int = 20,
    depth: int = 4,
    seed: int = 7,
) -> tuple[PipelineModel | None, DataFrame, float]:
    """(trees, suffix shares, overall share of label 1) of labelled URLs.

    Shares cover all labelled rows and all their suffixes, in the shared folder; the trees see at most ``sample`` URLs of each class, those
    with the smallest hash, each weighing as many URLs of its class as it stands for, so the
    classes keep their true shares. Rows without a URL or a label of 0 or 1 teach nothing, and
    without both classes there are no trees.
    """
    known = labelled.select(
        F.col(url_column).alias("url"), F.col(label_column).cast("int").alias("label")
    ).where("url IS NOT NULL AND label IN (0, 1)")
    described = lexical(known, "url")
    by_suffix = described.groupBy("_suffix").agg(
        F.sum("label").alias("ones"), F.count("*").alias("of")
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    overall = counts.get(1, 0) / max(sum(counts.values()), 1)
    share = (F.col("ones") + SMOOTHING * overall) / (F.col("of") + SMOOTHING)
    shares = kept(by_suffix.select("_suffix", share.alias("_share")), "suffix-shares")
    if len(counts) < 2:
        return None, shares, overall
    drawn = [
        described.where(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(sample)
        for label in (0, 1)
    ]
    taught = _with_share(reduce(DataFrame.unionByName, drawn), shares, overall)
    stands_for = {label: max(n / sample, 1.0) for label, n in counts.items()}
    weight = F.when(F.col("label") == 1, stands_for[1]).otherwise(stands_for[0])
    taught = taught.withColumn("_weight", weight)
    assembler = VectorAssembler(inputCols=[f"_{name}" for name in FEATURES], outputCol="_features")
    trees = GBTClassifier(
        featuresCol="_features", labelCol="label", weightCol="_weight", maxIter=rounds,
        maxDepth=depth, seed=seed,
    )
    model = trees.fit(assembler.transform(taught).select("_features", "label", "_weight"))
    return PipelineModel([assembler, model]), shares, overall


def _with_share(
    described: DataFrame, shares: DataFrame, overall: float, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``described`` with ``_share``: its suffix's, or ``overall`` for one that was never labelled."""
    share = F.coalesce("_share", F.lit(overall))
    size = shares.agg(F.sum(F.octet_length("_suffix") + F.lit(16))).first()[0] or 0
    if size <= broadcast_bytes:
        return described.join(F.broadcast(shares), "_suffix", "left").withColumn("_share", share)
    # Fewer than PARTS suffixes can hold more than one in PARTS of the rows.
    often = described.groupBy("_suffix").count().where(F.col("count") > described.count() / PARTS)
    often = F.broadcast(often.select("_suffix", F.lit(True).alias("_often")))
    part = F.when(F.col("_often"), F.pmod(F.xxhash64(*described.columns), F.lit(PARTS))).otherwise(0)
    parts = F.when(F.col("_often"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = described.join(often, "_suffix", "left").withColumn("_part", part.cast("int"))
    spread = shares.join(often, "_suffix", "left").withColumn("_part", F.explode(parts)).drop("_often")
    joined = dealt.join(spread, ["_suffix", "_part"], "left").withColumn("_share", share)
    return joined.select(*described.columns, "_share")


def judge(
    urls: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    model: tuple[PipelineModel | None, DataFrame, float],
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """One row per row of ``urls``: id, host, path, rule, verdict and ``score``.

    The verdict is the longest fitting rule's; else ``block`` where the trees give label 1 a
    probability of at least ``threshold``. Without trees the score is the overall share of
    label 1. A null URL, or one without ``://``, has an empty host and path, and is judged by its
    other features. Rows are judged each by itself, other columns are not read, an empty table
    gives an empty result.
    """
    if id_column in ("host", "path", "rule", "verdict", "score"):
        raise ValueError(f"{id_column!r} is a column of the result")
    trees, shares, overall = model
    chosen = urls.select(F.col(id_column).alias("_id"), F.col(url_column).alias("_url"))
    if trees is None:
        scored = chosen.withColumn("score", F.lit(float(overall)))
    else:
        described = _with_share(lexical(chosen, "_url"), shares, overall)
        scored = trees.transform(described).withColumn("score", vector_to_array("probability")[1])
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    return (
        scored.select("_id", "score", host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path"))
        .withColumn("_fit", rule)
        .select(
            F.col("_id").alias(id_column),
            "host",
            "path",
            F.col("_fit.rule").alias("rule"),
            F.coalesce(
                F.col("_fit.verdict"),
                F.when(F.col("score") >= threshold, BLOCK).otherwise(ALLOW),
            ).alias("verdict"),
            "score",
        )
    )
