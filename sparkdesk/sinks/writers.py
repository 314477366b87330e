"""Writers.  Every writer is one distributed Spark write; nothing goes through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdesk.functions.text import day_range


def save_overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace whatever is at ``path``."""
    df.write.format(fmt).mode("overwrite").save(path)


def save_new(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write only if nothing is at ``path`` yet (Spark's default ``errorifexists``)."""
    df.write.format(fmt).mode("errorifexists").save(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add rows to ``path``; a re-run adds them again (no de-duplication)."""
    df.write.format(fmt).mode("append").save(path)


def write_partitioned(df: DataFrame, path: str, part_col: str = "dt", fmt: str = "parquet",
                      replace_touched: bool = True, rows_per_task: int = 2_000_000) -> None:
    """Write by a partition column.

    ``replace_touched=True`` uses dynamic partition overwrite: the partitions
    present in ``df`` are replaced, all others stay.

    Each partition value gets ``ceil(rows / rows_per_task)`` writer tasks: a
    first small aggregate counts the rows per value (one row per partition
    folder; the planner broadcasts it if it is small), then rows
    are shuffled by ``(part_col, salt)`` with a salt below that bucket count.
    A day holding a third of the data is written by proportionally many
    tasks, a small day by one (one file, no small-file spray).  The salt is a
    hash of the row, so a retried task gets the same rows.
    """
    counts = df.groupBy(part_col).agg(F.count(F.lit(1)).alias("__rows"))
    buckets = counts.select(F.col(part_col), F.greatest(
        F.ceil(F.col("__rows") / F.lit(float(rows_per_task))), F.lit(1)).cast("long").alias("__buckets"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col("__buckets"))
    spread = (df.join(buckets, df[part_col].eqNullSafe(buckets[part_col]), "left")
                .drop(buckets[part_col])
                .withColumn("__salt", salt)
                .repartition(F.col(part_col), F.col("__salt"))
                .drop("__buckets", "__salt"))
    writer = spread.write.option("maxRecordsPerFile", rows_per_task)
    if replace_touched:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.partitionBy(part_col).format(fmt).save(path)


def write_day_partition(df: DataFrame, path: str, day: str, ts_col: str, part_col: str = "dt",
                        fmt: str = "parquet", replace: bool = True, rows_per_task: int = 2_000_000) -> None:
    """Static-partition load of one day: rows whose ``ts_col`` falls on ``day``.

    ``replace=True`` (``INSERT OVERWRITE ... PARTITION``) is idempotent: running
    it twice leaves one copy of the day.  ``replace=False`` is the plain
    ``INSERT INTO ... PARTITION`` and duplicates the day on a re-run.
    The day test is a half-open timestamp range, so it reaches the source scan.  A large
    day is spread over writer tasks like any partition (see ``write_partitioned``).
    """
    day_rows = df.where(day_range(ts_col, day)).withColumn(part_col, F.lit(day).cast("date"))
    write_partitioned(day_rows, path, part_col, fmt, replace_touched=replace, rows_per_task=rows_per_task)


def staged_full_refresh(df: DataFrame, target: str, stage: str, unique_keys: Sequence[str] = (),
                        fmt: str = "parquet") -> DataFrame:
    """Full refresh through a stage: write stage -> validate -> replace target.

    The stage is written and read back, the key is checked to be unique (one
    grouped aggregate, no collect of rows), then the target is overwritten from
    the stage.  Plain files give no multi-statement transaction: a reader that
    lists the target during the final overwrite can see it empty; a table
    format with atomic commits removes that gap.  Raises ``ValueError`` and
    leaves the target untouched when the key check fails.
    """
    spark = df.sparkSession
    df.write.format(fmt).mode("overwrite").save(stage)
    staged = spark.read.format(fmt).load(stage)
    if unique_keys:
        dup = (staged.groupBy(*unique_keys).count().where(F.col("count") > 1).limit(1).count())
        if dup:
            raise ValueError(f"stage {stage} holds duplicate keys {list(unique_keys)}")
    staged.write.format(fmt).mode("overwrite").save(target)
    return spark.read.format(fmt).load(target)


def write_lines(df: DataFrame, path: str, cols: Sequence[str], sep: str = ",",
                mode: str = "overwrite") -> None:
    """Result lines ``a,b,c`` as plain text (NULL fields become empty).

    Rows that come in an order (``orderBy``: dealt by range) keep it from file to file and
    within each file, so the files in name order are the ordered lines.
    """
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    df.select(line.alias("value")).write.mode(mode).text(path)
