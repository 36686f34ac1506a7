"""Queries over the given tables, one per operator, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, tuple[Query, str | None]]:
    """Every query by name, with its SQL or None."""
    from workload import (
        catalogs,
        messages,
        projections,
        registry,
        scans,
        streams,
        syncs,
        upserts,
    )

    merged: dict[str, tuple[Query, str | None]] = {}
    for module in (scans, projections, upserts, registry, catalogs, messages, syncs, streams):
        for name, entry in module.QUERIES.items():
            if name in merged:
                raise ValueError(f"two queries named {name}")
            merged[name] = entry
    return merged
