"""Readers.  Each returns a lazy DataFrame; nothing is collected to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.functions.text import day_range


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Columnar scan, schema from the footers; ``columns`` prunes the ReadSchema."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_orc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.orc(path)
    return df.select(*columns) if columns else df


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str,
                   header: bool = True, sep: str = ",") -> DataFrame:
    """Delimited text with a fixed schema (Hive external-table semantics).

    PERMISSIVE mode: a field that does not parse becomes NULL instead of failing
    the job; the first line is skipped when ``header``.
    """
    return (spark.read.option("header", header).option("sep", sep)
            .option("mode", "PERMISSIVE").option("enforceSchema", True)
            .schema(schema).csv(path))


def read_csv_prefix(spark: SparkSession, path: str, names: list[str],
                    header: bool = True, sep: str = ",") -> DataFrame:
    """Read only the leading ``len(names)`` fields of each line, all as strings.

    Mirrors a Hive DDL that lists fewer columns than the file holds: the
    trailing fields are dropped positionally.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return read_csv_typed(spark, path, schema, header=header, sep=sep)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text lines, one row per line in column ``value``; splits by file block."""
    return spark.read.text(path)


# Shape of one landed page of the paged location API: the page number it was
# requested with, ``info`` (``count`` locations, ``pages`` in total) and the locations.
LOCATION_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("dimension", T.StringType()),
    T.StructField("residents", T.ArrayType(T.StringType())),
])
PAGE_SCHEMA = T.StructType([
    T.StructField("page", T.IntegerType()),
    T.StructField("info", T.StructType([T.StructField("count", T.LongType()),
                                        T.StructField("pages", T.IntegerType())])),
    T.StructField("results", T.ArrayType(LOCATION_SCHEMA)),
])


def read_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landing folder of API pages.

    ``multi_line=False``: one page document per line (JSON lines), so a large
    landing folder splits across tasks.  ``multi_line=True``: one document per
    file, as saved straight from the API; files are read in parallel.
    """
    return spark.read.schema(PAGE_SCHEMA).option("multiLine", multi_line).json(path)


def read_day(spark: SparkSession, path: str, day: str, part_col: str = "dt") -> DataFrame:
    """Rows of one day from a date-partitioned folder (partition pruning on ``part_col``)."""
    return spark.read.parquet(path).where(F.col(part_col) == F.lit(day).cast("date"))


__all__ = ["read_parquet", "read_orc", "read_csv_typed", "read_csv_prefix", "read_lines",
           "read_pages", "read_day", "day_range", "PAGE_SCHEMA", "LOCATION_SCHEMA"]
