"""A daily chain that publishes a table's new version in one step.

Each run writes a version folder of its own, checks it there, and only then adds a row to the
pointer, a small append-only table.  Readers follow the newest pointer row: they see the old
version or the new one, never a part of one and never a gap, and a run that fails in the
middle leaves no trace for them.  A run for a day that was already published gives a new version
of the same day, so running it twice leaves one copy of its rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "seq bigint, ds string, path string"


def _pointer(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(POINTER).parquet(f"{root}/pointer")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], POINTER)


def published(spark: SparkSession, root: str) -> DataFrame:
    """The current version; raises ``LookupError`` before the first one."""
    row = _pointer(spark, root).agg(F.max_by(F.struct("ds", "path"), "seq").alias("now")).first()
    if row.now is None:
        raise LookupError(f"nothing is published at {root}")
    return spark.read.parquet(row.now.path)


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(seq, ds, path) of all publications, for a clean-up of old folders."""
    return _pointer(spark, root).orderBy("seq")


def check_keys(df: DataFrame, unique_keys: Sequence[str], name: str) -> None:
    """Raise if a key is NULL or not unique, or if there are no rows."""
    if unique_keys:
        null = F.lit(False)
        for c in unique_keys:
            null = null | F.col(c).isNull()
        found = df.groupBy(*unique_keys).agg(F.count("*").alias("n")).agg(
            F.count("*").alias("rows"), F.count(F.when(F.col("n") > 1, 1)).alias("dups"), F.count(F.when(null, 1)).alias("nulls")).first()
        if found.dups or found.nulls:
            raise ValueError(f"{name}: {found.dups} duplicate and {found.nulls} NULL keys in {list(unique_keys)}")
        if not found.rows:
            raise ValueError(f"{name} is empty")
    elif df.isEmpty():
        raise ValueError(f"{name} is empty")


def run_daily(spark: SparkSession, root: str, ds: str, extract: Callable[[], DataFrame],
              transform: Callable[[DataFrame], DataFrame] = lambda df: df, unique_keys: Sequence[str] = ()) -> DataFrame:
    """Extract, stage, check, publish; returns the published table.

    One writer at a time is assumed (the schedule's own rule); readers need no care.
    """
    path = f"{root}/versions/{ds}-{uuid.uuid4().hex[:12]}"
    transform(extract()).write.mode("errorifexists").parquet(path)
    check_keys(spark.read.parquet(path), unique_keys, path)
    last = _pointer(spark, root).agg(F.max("seq")).first()[0]
    spark.createDataFrame([((last or 0) + 1, ds, path)], POINTER).coalesce(1).write.mode("append").parquet(f"{root}/pointer")
    return published(spark, root)
