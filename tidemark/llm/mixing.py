"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A larger mean is drawn in equal parts of at most this, independent of each other, and summed:
#: sums of Poisson numbers are Poisson again, while exp(-mean) of a large mean would vanish.
LARGEST_MEAN = 16
#: Rates of up to so many sources are broadcast; those of more are joined.
BROADCAST_SOURCES = 100_000
_DIGITS = 13  # hexadecimal digits of a digest that a number of 52 bits is read from


def hashed(seed: int, *parts: Column) -> Column:
    """A whole number below 2^52 from the seed and the parts, the same on every run."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("long")


def poisson(mean: Column, uniform: Column) -> Column:
    """The smallest k with P(Poisson(mean) <= k) > uniform, for means up to ``LARGEST_MEAN``.

    The sum of the probabilities ends when a further one would not change it.
    """
    zero = F.struct(F.lit(0).alias("k"), F.exp(-mean).alias("p"), F.exp(-mean).alias("sum"))
    steps = F.sequence(F.lit(1), F.lit(6 * LARGEST_MEAN + 20))

    def grow(held: Column, k: Column) -> Column:
        p = held["p"] * mean / k
        new = F.struct(k.alias("k"), p.alias("p"), (held["sum"] + p).alias("sum"))
        ended = (held["sum"] > uniform) | (held["sum"] + p == held["sum"])
        return F.when(ended, held).otherwise(new)

    return F.aggregate(steps, zero, grow, lambda held: held["k"])


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    *,
    total: float | None = None,
    seed: int = 7,
    id_column: str = "doc_id",
    source_column: str = "source",
    size: Column | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``docs`` with each row repeated by a Poisson count whose mean is its source's target rate.

    A source with weight w has to hold w / (sum of weights) of ``total``, measured by ``size``
    (rows if not given); its rate is that target over what it holds. Without ``weights`` all
    sources weigh alike, without ``total`` the mixture is as large as the input. Sources of weight
    0 or without a weight go; weights of absent sources count for nothing. Null is a source of
    its own (weight key None). Added columns: ``copy`` (from 0) and ``mix_key``, which depend only
    on seed, id and copy, so rows that repeat an id are repeated alike. Rows come hashed by
    ``mix_key`` over all partitions and sorted by it inside: a global shuffle in which no source,
    however large, stays together. Rows with null ids are drawn as one id. Columns of docs named
    ``copy`` or ``mix_key`` are replaced; all others are kept. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    weigh = F.lit(1.0) if size is None else size.cast("double")
    source = F.coalesce(F.concat(F.lit("s"), F.col(source_column).cast("string")), F.lit("null"))
    held = (
        docs.select(source.alias("_source"), weigh.alias("_size"))
        .groupBy("_source")
        .agg(F.sum("_size").alias("_held"))
    )
    if weights is None:
        weighted = held.withColumn("_weight", F.lit(1.0))
    else:
        named = [("null" if k is None else f"s{k}", float(w)) for k, w in weights.items()]
        known = spark.createDataFrame(named, "_source string, _weight double")
        weighted = held.join(known, "_source").where("_weight > 0")
    sums = weighted.agg(F.sum("_weight"), F.count("*")).first()
    aim = total if total is not None else held.agg(F.sum("_held")).first()[0]
    rate = F.lit(float(aim or 0)) * F.col("_weight") / F.lit(float(sums[0] or 1)) / F.col("_held")
    rates = weighted.where("_held > 0").select("_source", rate.alias("_rate"))
    if sums[1] <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    uniform = hashed(seed, F.col(id_column)) / F.lit(float(1 << 4 * _DIGITS))
    parts = F.greatest(F.ceil(F.col("_rate") / LARGEST_MEAN), F.lit(1)).cast("int")
    mean = F.col("_rate") / F.col("_parts")

    def more(count: Column, part: Column) -> Column:
        own = hashed(seed, F.col(id_column), part) / F.lit(float(1 << 4 * _DIGITS))
        return count + poisson(mean, own)

    further = F.when(
        F.col("_parts") > 1,
        F.aggregate(F.sequence(F.lit(1), F.greatest(F.col("_parts") - 1, F.lit(1))), F.lit(0), more),
    ).otherwise(F.lit(0))
    kept = [c for c in docs.columns if c not in ("copy", "mix_key")]
    drawn = (
        docs.select(*kept, source.alias("_source"))
        .join(rates, "_source")
        .withColumn("_parts", parts)
        .withColumn("_count", poisson(mean, uniform) + further)
        .where("_count > 0")
        .select(*kept, F.explode(F.sequence(F.lit(0), F.col("_count") - 1)).alias("copy"))
        .withColumn("mix_key", hashed(seed + 1, F.col(id_column), F.col("copy")))
    )
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return drawn.repartition(count, "mix_key").sortWithinPartitions("mix_key")


def mix_sql(table: str, *, seed: int = 7) -> str:
    """SQL for ids, sources, copies and keys of ``mix`` without weights and total."""
    span = 16**_DIGITS

    def drawn(number: int, parts: str) -> str:
        digits = f"substr(md5('{number}|' || {parts}), 1, {_DIGITS})"
        return f"cast(('0x' || {digits}) AS bigint)"

    ident = "coalesce(cast(doc_id AS varchar), '')"
    return f"""
WITH RECURSIVE held AS (SELECT source, cast(count(*) AS double) AS held FROM {table} GROUP BY source),
rates AS (
  SELECT source, (SELECT sum(held) FROM held) * 1.0 / (SELECT count(*) FROM held) / held AS rate FROM held),
split AS (
  SELECT source, cast(greatest(ceil(rate / {LARGEST_MEAN}), 1) AS integer) AS parts,
         rate / greatest(ceil(rate / {LARGEST_MEAN}), 1) AS mean
  FROM rates),
steps AS (
  SELECT source, 0 AS k, exp(-mean) AS p, exp(-mean) AS total FROM split
  UNION ALL
  SELECT s.source, k + 1, p * mean / (k + 1), total + p * mean / (k + 1)
  FROM steps s JOIN split r ON s.source IS NOT DISTINCT FROM r.source WHERE k < {6 * LARGEST_MEAN + 20}),
levels AS (SELECT source, k, total, max(total) OVER (PARTITION BY source) AS top FROM steps),
draws AS (
  SELECT doc_id, source, text, part,
         CASE WHEN part = 0 THEN {drawn(seed, ident)} ELSE {drawn(seed, ident + " || '|' || part")} END
           / {float(span)!r} AS u
  FROM (SELECT d.doc_id, d.source, d.text, unnest(generate_series(0, s.parts - 1)) AS part
        FROM {table} d JOIN split s ON d.source IS NOT DISTINCT FROM s.source)),
drawn AS (
  SELECT doc_id, d.source, part, any_value(text) AS text,
         coalesce(min(k) FILTER (WHERE total > u), min(k) FILTER (WHERE total = top)) AS n
  FROM draws d JOIN levels s ON d.source IS NOT DISTINCT FROM s.source
  GROUP BY doc_id, d.source, part),
counted AS (
  SELECT doc_id, source, any_value(text) AS text, cast(sum(n) AS bigint) AS n FROM drawn GROUP BY doc_id, source),
copies AS (
  SELECT doc_id, source, text, cast(unnest(generate_series(0, n - 1)) AS integer) AS copy
  FROM counted WHERE n > 0)
SELECT doc_id, source, copy, {drawn(seed + 1, ident + " || '|' || copy")} AS mix_key,
       md5(text) AS text_md5 FROM copies
"""
