"""Synchronisation of relational tables into a raw and a normalized layer, on Spark."""

from tidemark.plans.discovery import Discovery, discover
from tidemark.plans.registration import (
    check_sources,
    register_datasets,
    register_sources,
    reset_checkpoints,
)
from tidemark.plans.requests import process_requests
from tidemark.plans.sync import Dataset, Execution, SyncResult, run_sync
from tidemark.session import session
from tidemark.sinks.store import Store

__all__ = [
    "Dataset",
    "Discovery",
    "Execution",
    "Store",
    "SyncResult",
    "check_sources",
    "discover",
    "process_requests",
    "register_datasets",
    "register_sources",
    "reset_checkpoints",
    "run_sync",
    "session",
]
