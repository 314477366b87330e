"""The tip report as a Structured Streaming job over a landing folder.

New raw-line files are picked up as they land; the parse is the same
stateless map as the batch job, the code -> label join is a stream-static
broadcast of the six-row dictionary, and the state is one running
``(sum, count)`` per ``(month, label)``: small and bounded by the number of
months, so no watermark is needed.  Each micro-batch rewrites the report
(``complete`` mode through ``foreachBatch``), which is idempotent: a batch
replayed after a failure writes the same report again.  Progress and state
live in the checkpoint folder, so a restarted job resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.functions.stats import usable
from sparkdesk.operators.lines import parse_trip_lines, payment_dim


def run_incremental_tip_report(spark: SparkSession, landing: str, report: str, checkpoint: str,
                               year: str, files_per_batch: int = 10,
                               state_partitions: int = 2) -> DataFrame:
    """Process every file now in ``landing`` (``availableNow``), update the
    report at ``report`` and return it read back.

    ``state_partitions`` sizes the aggregation's state: it holds one row per
    (month, label) and map-side partial sums keep its shuffle tiny at any input
    size, so a few state stores suffice.  The value is fixed in the checkpoint
    on the first run (a restart keeps it)."""
    raw = (spark.readStream.schema(T.StructType([T.StructField("value", T.StringType())]))
           .option("maxFilesPerTrigger", files_per_batch).text(landing))
    parsed = parse_trip_lines(raw, year)
    labels = payment_dim(spark).select(F.col("id").alias("code"), F.col("name").alias("payment"))
    coded = (parsed.select("month", F.col("payment_type").try_cast("int").alias("code"), "tip_amount")
                   .where(F.col("tip_amount").isNotNull())
                   .join(F.broadcast(labels), "code", "inner"))
    running = coded.groupBy("month", "payment").agg(
        F.try_sum(usable("tip_amount").cast("decimal(26,6)")).alias("tip_sum"),
        F.count(usable("tip_amount")).alias("tip_n"))

    def publish(batch: DataFrame, _epoch: int) -> None:
        out = batch.select("month", "payment",
                           F.try_divide(F.col("tip_sum").cast("double"), F.col("tip_n").cast("double")).alias("avg_tip"))
        out.write.mode("overwrite").parquet(report)

    # the stream clones the session conf when it starts; restore ours right after
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        q = (running.writeStream.outputMode("complete").foreachBatch(publish)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    q.awaitTermination()
    return spark.read.parquet(report)
