"""Catalog tables: database with a location, create-if-absent, truncate, insert,
and the stage -> target publish of a full refresh."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_database(spark: SparkSession, name: str, location: str | None = None, use: bool = True) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")
    if use:
        spark.catalog.setCurrentDatabase(name)


def create_table_if_absent(spark: SparkSession, name: str, ddl: str, fmt: str = "parquet",
                           partitioned_by: Sequence[str] = (), location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS name (ddl) USING fmt [PARTITIONED BY] [LOCATION]``."""
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {fmt}{part}{loc}")


def truncate(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def insert(df: DataFrame, name: str, overwrite: bool = False) -> None:
    """Insert by column position (``INSERT INTO`` / ``INSERT OVERWRITE``)."""
    df.write.insertInto(name, overwrite=overwrite)


def insert_with(spark: SparkSession, name: str, ctes: Mapping[str, DataFrame], select: str) -> None:
    """``WITH … INSERT INTO name <select>``: the select names the given frames as common table expressions.

    The frames are temporary views of unlike names for the time of the statement, so
    callers cannot meet each other's.
    """
    views = {cte: f"{cte}_{uuid.uuid4().hex[:12]}" for cte in ctes}
    try:
        for cte, view in views.items():
            ctes[cte].createTempView(view)
        heads = ", ".join(f"{cte} AS (SELECT * FROM {view})" for cte, view in views.items())
        spark.sql(f"WITH {heads} INSERT INTO {name} {select}")
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def prepare_target(spark: SparkSession, target: str, stage: str, ddl: str) -> None:
    """Create target and stage when absent, empty the stage."""
    create_table_if_absent(spark, target, ddl)
    create_table_if_absent(spark, stage, ddl)
    truncate(spark, stage)


def publish_from_stage(spark: SparkSession, stage: str, target: str,
                       unique_keys: Sequence[str] = ()) -> DataFrame:
    """Replace the target's rows with the stage's (``INSERT OVERWRITE … SELECT``),
    after checking the key is unique in the stage (the target's primary key).
    Raises ``ValueError`` and leaves the target as it was when the check fails."""
    staged = spark.table(stage)
    if unique_keys:
        dup = staged.groupBy(*unique_keys).count().where(F.col("count") > 1).limit(1).count()
        if dup:
            raise ValueError(f"{stage} holds duplicate keys {list(unique_keys)}")
    spark.sql(f"INSERT OVERWRITE TABLE {target} SELECT * FROM {stage}")
    return spark.table(target)
