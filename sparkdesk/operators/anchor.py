"""Anchor modelling: one narrow history table per attribute, the latest view
and the as-of view rebuilt from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.operators.keyed_scan import Chunks, with_neighbour


def split_attributes(history: DataFrame, sk: str, ts: str, attrs: Sequence[str],
                     tie: Sequence[str] = (), chunk: Column | Chunks | None = None) -> dict[str, DataFrame]:
    """``{attr: (sk, load_dttm, *tie, attr)}`` with change-only rows per attribute.

    All attributes are compared with the previous row in one keyed pass.
    """
    scanned = with_neighbour(history.select(sk, ts, *tie, *attrs), sk, [ts, *tie], list(attrs), "__prev", chunk, "prev")
    out = {}
    for a in attrs:
        new = F.col("__prev").isNull() | ~F.col(a).eqNullSafe(F.col(f"__prev.{a}"))
        out[a] = scanned.where(new).select(F.col(sk), F.col(ts).alias("load_dttm"), *tie, F.col(a))
    return out


def _at_latest(value: str, ts: str, tie: Sequence[str], as_of: str | None) -> Column:
    """The value at the greatest (ts, *tie), no later than ``as_of``: a partial aggregate,
    so a key with a long history costs one row per task."""
    order = F.struct(ts, *tie)
    if as_of is not None:
        order = F.when(F.col(ts) <= F.lit(as_of).cast("timestamp_ntz"), order)
    return F.max_by(F.col(value), order).alias(value)


def latest_of(history: DataFrame, sk: str, ts: str, attrs: Sequence[str], tie: Sequence[str] = (),
              as_of: str | None = None) -> DataFrame:
    """One wide row per key straight from the history: one scan and one shuffle, no change
    detection.  A key without a row by ``as_of`` stays, with NULLs."""
    return history.groupBy(sk).agg(*[_at_latest(a, ts, tie, as_of) for a in attrs])


def latest_view(anchor: DataFrame, sk: str, tables: dict[str, DataFrame], tie: Sequence[str] = (),
                as_of: str | None = None) -> DataFrame:
    """One wide row per anchor key from attribute tables: each attribute's value at its
    latest (load time, *tie), at or before ``as_of`` when given."""
    out = anchor.select(sk).distinct()
    for i, (a, t) in enumerate(tables.items()):
        last = t.groupBy(F.col(sk).alias(f"__k{i}")).agg(_at_latest(a, "load_dttm", tie, as_of))
        out = out.join(last, out[sk].eqNullSafe(last[f"__k{i}"]), "left").drop(f"__k{i}")
    return out


def tie_view(tie_history: DataFrame, left: DataFrame, right: DataFrame, left_sk: str, right_sk: str, ts: str,
             tie: Sequence[str] = (), as_of: str | None = None) -> DataFrame:
    """Two anchors side by side through a historised tie, as of a time.

    Each left key's partner is that of its last tie row at or before ``as_of``; a NULL partner
    has ended the tie.  ``left`` and ``right`` are the anchors' views as of the same time, one row
    a key.  Left keys without a tie stay, with NULLs.
    """
    partner = (tie_history.groupBy(left_sk).agg(_at_latest(right_sk, ts, tie, as_of))
               .select(F.col(left_sk).alias("__left"), F.col(right_sk)))
    out = left.join(partner, left[left_sk] == F.col("__left"), "left").drop("__left")
    other = right.withColumnRenamed(right_sk, "__right")
    return out.join(other, out[right_sk] == other["__right"], "left").drop("__right")
