"""Grouped reports: top-k, per-key statistics with HAVING, role-playing star
joins and conditional counts.

All of them are one hash aggregate (partial on the map side, final after one
shuffle on the grouping keys), so a hot key costs one combined row per map
task, not a third of the table in one reducer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.functions.stats import safe_corr, usable


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def top_k_by_count(df: DataFrame, keys, k: int = 10, counted: str | None = None,
                   alias: str = "count", drop_null_keys: bool = True) -> DataFrame:
    """The ``k`` key groups with most non-null ``counted`` values (default: the key).

    Ties are broken by the keys ascending so the answer is deterministic.
    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own top ``k`` and only ``k * tasks`` rows reach the final merge.
    """
    keys = _cols(keys)
    counted = counted or keys[0]
    if drop_null_keys:
        cond = None
        for key in keys:
            c = F.col(key).isNotNull()
            cond = c if cond is None else cond & c
        df = df.where(cond)
    out = df.groupBy(*keys).agg(F.count(F.col(counted)).alias(alias))
    return out.orderBy(F.col(alias).desc(), *[F.col(c).asc() for c in keys]).limit(k)


def group_report(df: DataFrame, keys, aggs: Mapping[str, Column],
                 having: Column | None = None, order_by: Sequence[Column] | None = None,
                 k: int | None = None) -> DataFrame:
    """``GROUP BY keys`` with named aggregates, optional HAVING, order and limit.

    NULL keys form their own group (SQL semantics).
    """
    keys = _cols(keys)
    out = df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggs.items()])
    if having is not None:
        out = out.where(having)
    out = out.select(*keys, *aggs.keys())
    if order_by is not None:
        out = out.orderBy(*order_by)
    if k is not None:
        out = out.limit(k)
    return out


def route_stats(df: DataFrame, keys, counted: str, measure: str, k: int = 10,
                count_alias: str = "tail_count", mean_alias: str = "avg_measure",
                mean_fn=F.avg) -> DataFrame:
    """Top ``k`` key pairs by count of ``counted``, with the mean of ``measure``."""
    keys = _cols(keys)
    return group_report(
        df, keys,
        {count_alias: F.count(F.col(counted)), mean_alias: mean_fn(F.col(measure))},
        order_by=[F.col(count_alias).desc(), *[F.col(c).asc() for c in keys]], k=k)


def having_stats(df: DataFrame, key: str, value: str, other: str, threshold: float,
                 prefix: str = "value", mean_fn=F.avg) -> DataFrame:
    """avg/min/max of ``value`` and its correlation with ``other`` per ``key``,
    keeping groups whose maximum reaches ``threshold``.

    The correlation is NULL for a group where either side has no variance.
    """
    v = F.col(value)
    return group_report(
        df, key,
        {f"avg_{prefix}": mean_fn(v), f"min_{prefix}": F.min(v), f"max_{prefix}": F.max(v),
         f"corr_{prefix}_{other}": safe_corr(value, other)},
        having=F.col(f"max_{prefix}") >= F.lit(threshold))


def role_join(fact: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str],
              dim_cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join one dimension several times, once per role.

    ``roles`` maps a prefix to the fact column holding that role's key, e.g.
    ``{"origin": "ORIGIN_AIRPORT", "destination": "DESTINATION_AIRPORT"}``; the
    dimension's columns come out as ``<prefix>_<col>`` so the roles stay apart.
    A small dimension is broadcast by the planner's size check (AQE re-checks at
    run time); a large one falls back to a sort-merge join.
    """
    out = fact
    for prefix, fact_col in roles.items():
        renamed = dim.select(F.col(dim_key).alias(f"{prefix}_{dim_key}"),
                             *[F.col(c).alias(f"{prefix}_{c}") for c in dim_cols])
        out = out.join(renamed, out[fact_col] == renamed[f"{prefix}_{dim_key}"], how)
    return out


def conditional_counts(df: DataFrame, keys, flags: Mapping[str, Column],
                       means: Mapping[str, str] | None = None) -> DataFrame:
    """Per group: how many rows satisfy each predicate, plus means of columns.

    A NULL predicate counts as not satisfied; use ``eqNullSafe`` in the
    predicates to make that explicit.
    """
    aggs = {name: F.count_if(F.coalesce(pred, F.lit(False))) for name, pred in flags.items()}
    for name, col in (means or {}).items():
        aggs[name] = F.avg(F.col(col))
    return group_report(df, keys, aggs)


def conditional_counts_via_dim(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str,
                               dim_label: str, flags: Mapping[str, Column],
                               means: Mapping[str, str] | None = None,
                               label_alias: str | None = None,
                               mean_scale: int | None = None) -> DataFrame:
    """``fact JOIN dim GROUP BY dim_label`` with conditional counts and means,
    aggregated on the fact key *before* the join.

    The fact side shrinks to one row per key (partial + final aggregate) and
    only that crosses the join; sums and counts are re-added per label, so a
    duplicated dimension key fans out exactly as the plain join would.
    ``mean_scale`` sums the mean columns through ``decimal(26, scale)`` (exact; see ``usable``).
    """
    def as_num(c: Column) -> Column:
        return c.cast("double") if mean_scale is None else usable(c, mean_scale).cast(f"decimal(26,{mean_scale})")

    means = dict(means or {})
    parts = [F.count_if(F.coalesce(pred, F.lit(False))).alias(name) for name, pred in flags.items()]
    for name, col in means.items():
        parts += [F.sum(as_num(F.col(col))).alias(f"__s_{name}"),
                  F.count(as_num(F.col(col))).alias(f"__n_{name}")]
    pre = fact.groupBy(F.col(fact_key).alias("__k")).agg(*parts)
    joined = pre.join(dim.select(F.col(dim_key).alias("__k"), F.col(dim_label)), "__k", "inner")
    finals = [F.sum(F.col(name)).alias(name) for name in flags]
    finals += [F.try_divide(F.sum(f"__s_{name}").cast("double"),
                           F.sum(f"__n_{name}").cast("double")).alias(name) for name in means]
    out = joined.groupBy(F.col(dim_label)).agg(*finals)
    if label_alias:
        out = out.withColumnRenamed(dim_label, label_alias)
    return out
