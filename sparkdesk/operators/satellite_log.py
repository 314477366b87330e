"""Incremental satellites: an append-only log of a key's rows, in which late rows find their place.

The log holds every row ever loaded, marked as a change or as a mere confirmation of the row
before it.  So the changes are at any time those of the whole history, also when a late row
comes between stored ones and turns the next confirmation into a change, or the next change
into a confirmation.  A stored row whose mark changes is not rewritten: the same row with a
higher load number takes its place.

A load scans what it needs: of each key in the batch the stored rows from its first new row
on, and the one before that.  The same log serves links: the
driving key is the key, the partner is the payload, and a new partner closes the old one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.operators.keyed_scan import Chunks, keyed_scan
from sparkdesk.operators.vault import validity_intervals


def _newest_version(log: DataFrame, place: Sequence[str], payload: Sequence[str]) -> DataFrame:
    return (log.groupBy(*place).agg(F.max_by(F.struct(*payload, "is_change"), "load_seq").alias("__row"))
            .select(*place, *[F.col(f"__row.{c}").alias(c) for c in (*payload, "is_change")]))


def changes(log: DataFrame, hk: str, ts: str, payload: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """The satellite: (hk, ts, *tie, *payload) of the rows that differ from the row before."""
    return _newest_version(log, [hk, ts, *tie], payload).where("is_change").drop("is_change")


def increment(log: DataFrame | None, batch: DataFrame, hk: str, ts: str, payload: Sequence[str], load_seq: int,
              tie: Sequence[str] = (), chunk: Column | Chunks | None = None) -> DataFrame:
    """The rows to append for ``batch``: (hk, ts, *tie, *payload, is_change, load_seq).

    (hk, ts, *tie) names a row; rows that the log has already, and repeats within the batch
    (the least payload is taken), add nothing, so a batch may be loaded again.  Rows without a key
    or time are left out.  ``load_seq`` must grow from load to load; ``chunk`` splits a hot key
    (see ``keyed_scan``).
    """
    place, payload = [hk, ts, *tie], list(payload)
    at = F.struct(ts, *tie)
    line = batch.where(F.col(hk).isNotNull() & F.col(ts).isNotNull()).select(*place, F.struct(*payload).alias("__p"))
    line = line.withColumns({"__new": F.lit(True), "__was": F.lit(None).cast("boolean")})
    if log is not None:
        first = line.groupBy(hk).agg(F.min(at).alias("__first"))
        # the rows before a key's first new one are one group, those from there on a group each:
        # of every group the last row counts, and of its versions the newest
        row = F.struct(*place, F.struct(*payload).alias("__p"), F.col("is_change").alias("__was"))
        stored = (log.join(first, hk).groupBy(hk, F.when(at >= F.col("__first"), at).alias("__late"))
                  .agg(F.max_by(row, F.struct(ts, *tie, "load_seq")).alias("__row")).select("__row.*"))
        line = line.unionByName(stored.withColumn("__new", F.lit(False)))
    # a stored row stays where a new one names the same place
    scanned = keyed_scan(line, hk, [ts, *tie], prev={"__prev": ["__p"]}, chunk=chunk, least=["__new", "__p", "__was"])
    is_change = F.col("__prev").isNull() | ~F.col("__p").eqNullSafe(F.col("__prev.__p"))
    # the stored row before the first new one has none before it on the line: its mark stands
    is_change = F.when(~F.col("__new") & F.col("__prev").isNull(), F.col("__was")).otherwise(is_change)
    return (scanned.withColumn("is_change", is_change).where(F.col("__new") | (F.col("__was") != F.col("is_change")))
            .select(*place, "__p.*", "is_change", F.lit(load_seq).cast("bigint").alias("load_seq")))


def link_validity(log: DataFrame, driving: str, partner: str, ts: str, tie: Sequence[str] = (),
                  chunk: Column | Chunks | None = None) -> DataFrame:
    """(driving, partner, valid_from, valid_to): a partner stands until the next one appears.

    ``log`` is one that ``increment`` fills with the partner as payload; a NULL partner ends the
    link without a next one and gives no row of its own.
    """
    rows = changes(log, driving, ts, [partner], tie)
    return (validity_intervals(rows, driving, ts, "valid_from", "valid_to", tie=tie, chunk=chunk)
            .where(F.col(partner).isNotNull()).select(driving, partner, "valid_from", "valid_to"))
