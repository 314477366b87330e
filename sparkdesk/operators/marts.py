"""Content hierarchy and denormalised marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.operators.joins import left_join_nulls_apart
from sparkdesk.session import write_scratch


def resolve_hierarchy(content: DataFrame, id_col: str, parent_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """``(id, parent_id, grandparent_id, root_id, level, *carry)`` (episode -> season -> series,
    trailer -> film), for any depth.

    Every row points to a row above it; each round it jumps to where that one points, so the
    jumps double and depth d takes about log2 d joins.  ``level`` 0 is a root.  A parent id that
    is not in the table is kept as given and is the root; a row without an id stays its own.
    Rows that are still on their way after more steps than there are rows are on or below a
    cycle: where they point to are exactly the ids on cycles, which the error names.
    """
    kind = content.schema[id_col].dataType
    rows = content.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent_id"), *carry)
    up = rows.where("id IS NOT NULL").select(F.col("id").alias("__up"), F.col("parent_id").alias("__next"))
    first = left_join_nulls_apart(rows, up, "parent_id", "__up")
    # (at, level): where the row points to, so many steps up; open while that has a parent
    state = first.select(
        "id", "parent_id", *carry, F.col("__next").alias("grandparent_id"),
        F.coalesce("__next", "parent_id", "id").cast(kind).alias("at"),
        (F.col("parent_id").isNotNull().cast("long") + F.col("__next").isNotNull().cast("long")).alias("level"),
        F.col("__next").isNotNull().alias("open"))
    steps = 2
    while True:
        state = write_scratch(state, "hierarchy")
        seen = state.agg(F.count(F.when(F.col("open"), 1)).alias("open"), F.count("*").alias("rows")).first()
        if not seen["open"]:
            return state.select("id", "parent_id", "grandparent_id", F.col("at").alias("root_id"), F.col("level").cast("int"), *carry)
        if steps > 2 * seen["rows"]:
            named = [r[0] for r in state.where("open").select("at").distinct().orderBy("at").limit(20).collect()]
            raise ValueError(f"parents form a cycle through {named}")
        above = state.where("id IS NOT NULL").select(F.col("id").alias("__id"), F.col("at").alias("__at"), F.col("level").alias("__level"),
                                                     F.col("open").alias("__open"))
        jumped = state.where("open").join(above, F.col("at") == F.col("__id"), "left").select(
            "id", "parent_id", *carry, "grandparent_id", F.coalesce("__at", "at").alias("at"),
            (F.col("level") + F.coalesce("__level", F.lit(0))).alias("level"), F.coalesce("__open", F.lit(False)).alias("open"))
        state = state.where("not open").unionByName(jumped)
        steps *= 2


def presence_flags(cols: dict[str, str]) -> list[Column]:
    """``is_<name>`` = 1 when the column is filled, else 0."""
    return [F.col(c).isNotNull().cast("int").alias(f"is_{name}") for name, c in cols.items()]
