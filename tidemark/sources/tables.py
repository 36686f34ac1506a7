"""Datasets held as Parquet folders or as tables of the session catalog."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession


def parquet(spark: SparkSession, path: str) -> DataFrame:
    """All rows and columns of a Parquet folder (S2, P17); later filters reach the scan."""
    return spark.read.parquet(path)


def table(spark: SparkSession, name: str) -> DataFrame:
    """All rows and columns of a catalog table or view."""
    return spark.table(name)


def parquet_folder(spark: SparkSession, folder: str) -> Callable[[Row], DataFrame]:
    """Opens a resolved dataset as ``<folder>/<table_name>.parquet``."""

    def open_dataset(dataset: Row) -> DataFrame:
        return parquet(spark, f"{folder}/{dataset.table_name}.parquet")

    return open_dataset

