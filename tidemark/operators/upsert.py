"""Upserts as set operations: one current row per key, last write wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _packed(names: Sequence[str]) -> Column:
    return F.struct(*(F.col(name) for name in names))


def latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep_first: Sequence[str] = (),
) -> DataFrame:
    """The last row per key (W2), with the ``keep_first`` columns taken from the first row.

    Rows are compared by ``order`` and then by all other columns, so the result does not
    depend on arrival. The aggregate is combined before the shuffle: a key that holds a third
    of all rows leaves each map task as one row.
    """
    others = [c for c in df.columns if c not in keys and c not in order]
    last = F.max(_packed([*order, *others])).alias("last")
    if not keep_first:
        grouped = df.groupBy(*keys).agg(last)
    else:
        first = F.min(_packed([*order, *keep_first])).alias("first")
        grouped = df.groupBy(*keys).agg(last, first)

    def pick(name: str) -> Column:
        if name in keys:
            return F.col(name)
        side = "first" if name in keep_first else "last"
        return F.col(side).getField(name).alias(name)

    return grouped.select(*(pick(name) for name in df.columns))


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep_first: Sequence[str] = (),
) -> DataFrame:
    """Existing and incoming rows, one per key."""
    return latest(existing.unionByName(incoming), keys, order, keep_first)


def upsert_newer(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """As ``upsert`` where ``current`` has one row per key and every incoming row is newer.

    Only incoming rows are aggregated. Current rows are kept by an anti-join on the key, which
    Catalyst turns into a broadcast when the incoming keys are small, so the large side is
    then neither shuffled nor sorted.
    """
    replacing = latest(incoming, keys, order)
    kept = current.join(replacing.select(*keys), list(keys), "left_anti")
    return kept.select(*current.columns).unionByName(replacing)


def delete(current: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among ``gone`` (K4)."""
    return current.join(gone.select(*keys), list(keys), "left_anti").select(*current.columns)
