"""One-pass data-quality profile: size, completeness, uniqueness, compliance.

Output is the long metrics table ``(entity, instance, name, value)`` with one
row per metric that could be computed (a metric that is undefined, e.g. on an
empty table, is left out).  Size, completeness and compliance come from one
aggregate; each uniqueness metric needs one grouped aggregate over its
columns (map-side partial counts, so a hot value costs one row per task).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRIC_COLS = ["entity", "instance", "name", "value"]


def _metric(entity: str, instance: str, name: str, value) -> "F.Column":
    return F.struct(F.lit(entity).alias("entity"), F.lit(instance).alias("instance"),
                    F.lit(name).alias("name"), value.cast("double").alias("value"))


def _explode_metrics(row_df: DataFrame) -> DataFrame:
    return (row_df.select(F.explode(F.array(*[F.col(c) for c in row_df.columns])).alias("m"))
                  .select("m.*").where(F.col("value").isNotNull()))


def profile(df: DataFrame, completeness: Sequence[str] = (), unique: Sequence[Sequence[str]] = (),
            compliance: Mapping[str, str] | None = None, size: bool = True) -> DataFrame:
    """Run all metrics together and return the long metrics table.

    * Size: row count.
    * Completeness(c): non-NULL share of ``c``.
    * Uniqueness(cols): share of rows whose key occurs exactly once; rows whose
      key columns are all NULL are not counted as values, the denominator is
      all rows.
    * Compliance(name, predicate): share of rows where the SQL predicate is
      true; NULL counts as not satisfied.
    """
    compliance = dict(compliance or {})
    total = F.count(F.lit(1))
    parts = []
    if size:
        parts.append(_metric("Dataset", "*", "Size", total).alias("m0"))
    for i, c in enumerate(completeness):
        parts.append(_metric("Column", c, "Completeness",
                             F.try_divide(F.count(F.col(c)).cast("double"), total.cast("double")))
                     .alias(f"c{i}"))
    for i, (name, pred) in enumerate(compliance.items()):
        hits = F.count_if(F.coalesce(F.expr(pred), F.lit(False)))
        parts.append(_metric("Column", name, "Compliance",
                             F.try_divide(hits.cast("double"), total.cast("double")))
                     .alias(f"p{i}"))
    out = _explode_metrics(df.agg(*parts)) if parts else None
    for cols in unique:
        u = uniqueness(df, cols)
        out = u if out is None else out.unionByName(u)
    return out


def uniqueness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Uniqueness metric of a column list as a one-row metrics table."""
    cols = list(cols)
    all_null = None
    for c in cols:
        cond = F.col(c).isNull()
        all_null = cond if all_null is None else all_null & cond
    per_key = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
                 .select(F.when(all_null, F.lit(None)).otherwise(F.col("__n")).alias("__n"),
                         F.col("__n").alias("__rows")))
    agg = per_key.agg(F.try_divide(F.count_if(F.col("__n") == 1).cast("double"),
                                   F.sum("__rows").cast("double")).alias("__v"))
    entity = "Column" if len(cols) == 1 else "Multicolumn"
    m = _metric(entity, ",".join(cols), "Uniqueness", F.col("__v"))
    return agg.select(m.alias("m")).select("m.*").where(F.col("value").isNotNull())
