"""As-of joins of facts to a history, and chains of links with validity.

A fact takes the values that were in force at its time.  Facts and history rows are put on
one timeline per key, and the last history row's values are carried forward to the facts
after it: one keyed scan, no range join, and a key that holds a third of all facts is cut
into chunks of time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from sparkdesk.operators.keyed_scan import Chunks, keyed_scan


def _all_set(cols: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & c.isNotNull()
    return out


def asof_join(facts: DataFrame, history: DataFrame, keys: Sequence[str] | str, fact_ts: str, hist_ts: str,
              values: Sequence[str], *, tie: Sequence[str] = (), history_keys: Sequence[str] | str | None = None,
              prefix: str = "", chunk_of: Callable[[Column], Column | Chunks] | None = None) -> DataFrame:
    """Every row of ``facts`` with ``values`` of the last ``history`` row of its key at or before ``fact_ts``.

    The new columns are named ``prefix`` + value, and ``prefix`` + "valid_from" has the history row's
    time; all are NULL for a fact without an earlier history row, or with a NULL key or time
    (each such fact is a key of its own, so they are dealt evenly).  History rows with a NULL key or time are never in force.  A
    NULL value in force is NULL, not the value before it.  Of history rows at one time the one
    with the greatest ``tie`` counts.  ``chunk_of`` makes the chunks from the timeline's time
    column (see ``keyed_scan``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    history_keys = keys if history_keys is None else [history_keys] if isinstance(history_keys, str) else list(history_keys)
    named = [F.col(v).alias(f"{prefix}{v}") for v in values] + [F.col(hist_ts).alias(f"{prefix}valid_from")]
    clash = {f"{prefix}{v}" for v in (*values, "valid_from")} & set(facts.columns)
    if clash:
        raise ValueError(f"column names on both sides: {sorted(clash)}")
    ks, ties = [f"__k{i}" for i in range(len(keys))], [f"__tie{i}" for i in range(len(tie))]
    in_force = history.where(_all_set([F.col(c) for c in (*history_keys, hist_ts)])).select(
        *[F.col(c).alias(k) for c, k in zip(history_keys, ks)], F.col(hist_ts).alias("__ts"), F.lit(0).alias("__side"),
        *[F.col(c).alias(t) for c, t in zip(tie, ties)], F.struct(*named).alias("__in_force"))
    placed = _all_set([F.col(c) for c in (*keys, fact_ts)])
    # key and time are on the line already; they are kept apart only if the history has another type
    kind = lambda df, c: df.schema[c].dataType
    held = {c: k for c, k in zip((*keys, fact_ts), (*ks, "__ts")) if kind(facts, c) == kind(in_force, k)}
    on_line = facts.select(
        *[F.col(c).alias(k) for c, k in zip(keys, ks)], F.col(fact_ts).alias("__ts"), F.lit(1).alias("__side"),
        F.when(~placed, F.xxhash64(*[f.name for f in facts.schema if not isinstance(f.dataType, MapType)])).alias("__apart"),
        F.struct(*[c for c in facts.columns if c not in held] or [F.lit(None).alias("__none")]).alias("__fact"))
    line = in_force.unionByName(on_line, allowMissingColumns=True)
    chunk = chunk_of(F.col("__ts")) if chunk_of else None
    if isinstance(chunk, Chunks) and chunk.counted is None:
        # keys alone are counted, so the facts' other columns are not read for it
        count = in_force.select(*ks).union(facts.where(placed).select(*keys))
        chunk = chunk.counted_on(count.withColumn("__apart", F.lit(None).cast("bigint")))
    # a history row at a fact's own time is in force; facts of one time do not depend on each other
    scanned = keyed_scan(line, [*ks, "__apart"], ["__ts", "__side", *ties], fill=["__in_force"], chunk=chunk)
    return scanned.where("__side = 1").select(
        *[F.col(held.get(c, f"__fact.`{c}`")).alias(c) for c in facts.columns], "__in_force.*")


def link_intervals(links: DataFrame, child: str, parent: str, valid_from: str, valid_to: str) -> DataFrame:
    """(child, parent, valid_from, valid_to) with a NULL parent for the time before a child's first link.

    Open ends are NULL.  Where a link has ended without a next one, a NULL parent follows.
    """
    cols = [F.col(child).alias("child"), F.col(parent).alias("parent"), F.col(valid_from).alias("valid_from"),
            F.col(valid_to).alias("valid_to")]
    known = links.select(*cols).where("child IS NOT NULL")
    edge = known.groupBy("child").agg(F.min(F.coalesce("valid_from", F.lit("0001-01-01").cast("timestamp_ntz"))).alias("first"),
                                      F.max(F.coalesce("valid_to", F.lit("9999-12-31").cast("timestamp_ntz"))).alias("last"))
    none = F.lit(None).cast(known.schema["parent"].dataType).alias("parent")
    open_ = F.lit(None).cast("timestamp_ntz")
    before = (edge.where(F.col("first") > F.lit("0001-01-01").cast("timestamp_ntz"))
              .select("child", none, open_.alias("valid_from"), F.col("first").alias("valid_to")))
    after = (edge.where(F.col("last") < F.lit("9999-12-31").cast("timestamp_ntz"))
             .select("child", none, F.col("last").alias("valid_from"), open_.alias("valid_to")))
    return known.unionByName(before).unionByName(after)


def temporal_bridge(base: DataFrame, hk: str, links: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """One row per key of ``base`` and time in which all levels above it stay the same.

    ``links`` go up level by level: (level name, (child, parent, valid_from, valid_to) rows as
    ``link_intervals`` gives them).  Each level is an equality join on the hash key that the
    level below resolved to; the intervals that overlap are cut to their common part, so the
    change points of all levels come together.  A key without a link has NULL from there on.
    Output: ``hk``, the levels, valid_from, valid_to (NULL = open).
    """
    open_ = F.lit(None).cast("timestamp_ntz")
    out = base.select(hk).distinct().withColumns({"valid_from": open_, "valid_to": open_})
    below = hk
    for level, link in links:
        step = link.select(F.col("child").alias("__child"), F.col("parent").alias(level), F.col("valid_from").alias("__from"),
                           F.col("valid_to").alias("__to"))
        meets = ((F.col("__from").isNull() | F.col("valid_to").isNull() | (F.col("__from") < F.col("valid_to")))
                 & (F.col("__to").isNull() | F.col("valid_from").isNull() | (F.col("valid_from") < F.col("__to"))))
        out = (out.join(step, (F.col(below) == F.col("__child")) & meets, "left")
               .withColumn("valid_from", F.greatest("valid_from", "__from")).withColumn("valid_to", F.least("valid_to", "__to"))
               .drop("__child", "__from", "__to"))
        below = level
    return out.select(hk, *[level for level, _ in links], "valid_from", "valid_to")
