"""The map/reduce tip report on raw taxi CSV lines.

Map: strip, split on ',', drop the header, keep rows of one year with a
payment code, emit (month, code, tip text).  Reduce: code -> label through a
small dictionary, parse the tip, mean per (month, label).  On Spark the
"reduce" is a hash aggregate with map-side partial sums, so there is no
single-reducer bottleneck and no sorted-input requirement.

Malformed input is skipped and counted, never fatal (see :func:`line_rejects`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.functions.stats import exact_avg, usable
from sparkdesk.functions.text import strip_ws
from sparkdesk.session import write_scratch

# Taxi line layout (0-based field positions) and header marker.
VENDOR_FIELD = 0
PICKUP_FIELD = 1
PAYMENT_FIELD = 9
TIP_FIELD = 13
MIN_FIELDS = 14
HEADER_VENDOR = "VendorID"

# Payment type codes and labels of the taxi data dictionary.
PAYMENT_TYPES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]


_ROW_TYPE = T.StructType([T.StructField("month", T.StringType()),
                          T.StructField("payment_type", T.StringType()),
                          T.StructField("tip_amount", T.DoubleType())])


def payment_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PAYMENT_TYPES, "id int, name string")


def _fields(lines: DataFrame, value_col: str) -> DataFrame:
    line = strip_ws(F.col(value_col))
    parts = F.split(line, ",")
    return lines.select(parts.alias("f"), F.size(parts).alias("n"))


def parse_trip_lines(lines: DataFrame, year: str, value_col: str = "value") -> DataFrame:
    """Mapper: ``(month, payment_type, tip_amount)`` of well-formed lines of ``year``.

    ``payment_type`` stays the raw code text; ``tip_amount`` is the parsed
    double, NULL when the text is not a number (dropped by the reducer).
    Lines with fewer than 14 fields are malformed and skipped.
    """
    f = _fields(lines, value_col)
    pickup = F.get("f", PICKUP_FIELD)
    code = F.get("f", PAYMENT_FIELD)
    keep = ((F.col("n") >= MIN_FIELDS)
            & (F.get("f", VENDOR_FIELD) != F.lit(HEADER_VENDOR))
            & pickup.isNotNull() & (pickup != "")
            & (F.substring(pickup, 1, 4) == F.lit(year))
            & code.isNotNull() & (code != ""))
    row = F.struct(F.substring(pickup, 1, 7).alias("month"),
                   code.alias("payment_type"),
                   F.get("f", TIP_FIELD).try_cast("double").alias("tip_amount"))
    # A ``where(keep)`` here would be pushed below the projection of ``f``, which
    # pastes the strip + split into the predicate once per field reference
    # (about ten times per line).  Emitting 0 or 1 rows from a generator keeps
    # ``f`` computed once per line, inside the same codegen stage (~4x faster).
    none = F.array().cast(T.ArrayType(_ROW_TYPE))
    return f.select(F.inline(F.when(keep, F.array(row)).otherwise(none)))


def avg_tip_by_month_label(parsed: DataFrame, labels: DataFrame, mean_fn=F.avg) -> DataFrame:
    """Reducer: mean tip per (month, payment label), ordered by month and label.

    ``labels`` is ``(id int, name string)``; the code join is a broadcast of a
    six-row table.  Unknown or non-numeric codes and unparsable tips drop out.
    """
    coded = parsed.select("month", F.col("payment_type").try_cast("int").alias("code"),
                          "tip_amount").where(F.col("tip_amount").isNotNull())
    joined = coded.join(F.broadcast(labels.select(F.col("id").alias("code"),
                                                  F.col("name").alias("payment"))),
                        "code", "inner")
    return (joined.groupBy("month", "payment").agg(mean_fn(F.col("tip_amount")).alias("avg_tip"))
            .orderBy("month", "payment"))


#: What can become of a line, in the order in which it is tested.
OUTCOMES = ("header", "malformed", "other_year", "no_payment", "unknown_payment", "bad_tip", "tip_out_of_range", "ok")


def _outcome(header: Column, n: Column, pickup: Column, code: Column, known: Column, tip: Column, year: str) -> Column:
    """``ok`` is exactly what the mean counts: a tip that is no number, or not one that
    ``usable`` takes (NaN, infinite, too large), has an outcome of its own."""
    return (F.when(header, "header").when(n < MIN_FIELDS, "malformed")
            .when(pickup.isNull() | (pickup == "") | (F.substring(pickup, 1, 4) != F.lit(year)), "other_year")
            .when(code.isNull() | (code == ""), "no_payment").when(~known, "unknown_payment")
            .when(tip.isNull(), "bad_tip").when(usable(tip).isNull(), "tip_out_of_range").otherwise("ok"))


def tip_report(lines: DataFrame, labels: DataFrame, year: str, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """The mean tip per (month, payment label), and the count of lines per outcome, from one
    pass: good lines are grouped by month and label, all others by their outcome, and both
    results are read from that small table."""
    f = _fields(lines, value_col)
    part = F.struct((F.get("f", VENDOR_FIELD) == F.lit(HEADER_VENDOR)).alias("header"), F.col("n").alias("n"),
                    F.get("f", PICKUP_FIELD).alias("pickup"), F.get("f", PAYMENT_FIELD).alias("code"),
                    F.get("f", TIP_FIELD).try_cast("double").alias("tip"))
    # a generator keeps the split computed once per line (see parse_trip_lines)
    parts = f.select(F.inline(F.array(part)))
    known = F.broadcast(labels.select(F.col("id").alias("__code"), F.col("name").alias("payment")))
    coded = parts.join(known, F.col("code").try_cast("int") == F.col("__code"), "left")
    c = F.col
    marked = coded.withColumn("outcome", _outcome(c("header"), c("n"), c("pickup"), c("code"), c("__code").isNotNull(), c("tip"), year))
    ok = c("outcome") == "ok"
    groups = marked.groupBy("outcome", F.when(ok, F.substring("pickup", 1, 7)).alias("month"), F.when(ok, c("payment")).alias("payment"))
    both = write_scratch(groups.agg(F.count("*").alias("lines"), exact_avg("tip").alias("avg_tip")), "tip_groups")
    report = both.where(ok).select("month", "payment", "avg_tip").orderBy("month", "payment")
    return report, both.groupBy("outcome").agg(F.sum("lines").alias("lines"))


def line_rejects(lines: DataFrame, labels: DataFrame, year: str,
                 value_col: str = "value") -> DataFrame:
    """Count of lines by outcome (one of ``OUTCOMES``): one pass, one small aggregate."""
    f = _fields(lines, value_col)
    pickup = F.get("f", PICKUP_FIELD)
    code = F.get("f", PAYMENT_FIELD)
    tip = F.get("f", TIP_FIELD).try_cast("double")
    known = labels.select(F.col("id").alias("__code"))
    f = f.join(F.broadcast(known), code.try_cast("int") == F.col("__code"), "left")
    reason = _outcome(F.get("f", VENDOR_FIELD) == F.lit(HEADER_VENDOR), F.col("n"), pickup, code, F.col("__code").isNotNull(), tip, year)
    return f.groupBy(reason.alias("outcome")).agg(F.count(F.lit(1)).alias("lines"))
