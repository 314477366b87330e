"""The driver's parquet tables: one file per table under a scale-factor folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in DRIVER_TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
