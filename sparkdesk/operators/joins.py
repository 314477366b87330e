"""Join helpers for keys that may be NULL.

A row whose join key is NULL can never match, but a shuffled (sort-merge)
outer join still hashes it like any other key: every NULL-key row lands in
the same shuffle partition.  When a third of a fact's rows carry no key
(subscription payments without content, hierarchy roots without a parent),
that one task holds a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def left_join_nulls_apart(left: DataFrame, right: DataFrame, left_keys, right_keys) -> DataFrame:
    """``left LEFT JOIN right ON left_keys = right_keys`` where rows with a
    NULL in any left key skip the join.

    Keyed rows are joined as usual; rows with a NULL key are appended with
    NULL right-hand columns, which is what the plain left join gives them.
    The NULL-key rows never enter the shuffle, so they cannot pile up in one
    task.  Output columns: ``left``'s, then ``right``'s (names must not clash).

    ``left`` is read twice with complementary filters, so apply this right
    above the scan (the NULL test then reaches it as a filter), not above
    another join, which would run twice.
    """
    lk, rk = _list(left_keys), _list(right_keys)
    if len(lk) != len(rk):
        raise ValueError("left_keys and right_keys differ in length")
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"column names on both sides: {sorted(clash)}")
    keyed = None
    for c in lk:
        cond = F.col(c).isNotNull()
        keyed = cond if keyed is None else keyed & cond
    on = None
    for a, b in zip(lk, rk):
        cond = F.col(a) == F.col(b)
        on = cond if on is None else on & cond
    cols = [*left.columns, *right.columns]
    matched = left.where(keyed).join(right, on, "left").select(*cols)
    no_key = left.where(~keyed).select(
        *left.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields])
    return matched.unionByName(no_key)
