"""Declared tables: columns, types, primary and foreign keys, and one job that checks them.

The result is the long metrics table (entity, instance, name, value) of the data-quality
profile.  Keys of all tables are counted in one union and one aggregate, and so are all
references: a referenced key and the rows that name it meet under the same value, so an
orphan is a value without its key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdesk.functions.keys import key_text


@dataclass(frozen=True)
class TableSpec:
    """``columns``: name -> Spark type; ``references``: foreign key columns -> referenced table, by its primary key."""

    columns: Mapping[str, str]
    primary_key: Sequence[str] = ()
    references: Mapping[tuple[str, ...], str] = field(default_factory=dict)


def column_issues(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> list[tuple[str, str, str, float]]:
    """MissingColumn and WrongType rows, from the schemas alone."""
    out = []
    for name, spec in sorted(specs.items()):
        there = {f.name: f.dataType.simpleString() for f in tables[name].schema.fields}
        for column, kind in spec.columns.items():
            out.append(("Column", f"{name}.{column}", "MissingColumn", float(column not in there)))
            if column in there:
                out.append(("Column", f"{name}.{column}", "WrongType", float(there[column] != kind)))
    return out


def check_tables(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """(entity, instance, name, value): MissingColumn and WrongType of each declared column;
    Size, NullKey (rows) and DuplicateKey (rows beyond the first of their key) of each
    primary key; Orphan (rows whose complete reference names no key) and NullReference of each
    foreign key.  Metrics that need an absent column are left out.
    """
    spark = next(iter(tables.values())).sparkSession
    keys, checks, metrics = None, [], []
    has = lambda t, cols: set(cols) <= set(tables[t].columns)

    def add(table: str, instance: str, cols: Sequence[str], target: str, owner: bool) -> None:
        nonlocal keys
        whole = F.lit(True)
        for c in cols:
            whole = whole & F.col(c).isNotNull()
        rows = tables[table].groupBy(F.when(whole, key_text(*cols)).alias("key")).agg(F.count("*").alias("n"))
        rows = rows.select(F.lit(target).alias("target"), F.lit(instance).alias("instance"), F.lit(owner).alias("owner"), "key", "n")
        keys = rows if keys is None else keys.unionByName(rows)
        checks.append((instance, owner))

    for name, spec in sorted(specs.items()):
        if spec.primary_key and has(name, spec.primary_key):
            add(name, f"{name}({','.join(spec.primary_key)})", spec.primary_key, name, True)
        for cols, target in spec.references.items():
            if has(name, cols) and has(target, specs[target].primary_key):
                add(name, f"{name}({','.join(cols)})->{target}", cols, target, False)
    frame = spark.createDataFrame(column_issues(tables, specs), "entity string, instance string, name string, value double")
    if keys is None:
        return frame
    # one row per key value of a target: how often it is a key, and how often each reference names it
    instances = [i for i, _ in checks]
    per = [F.sum(F.when(F.col("instance") == i, F.col("n"))).alias(f"n{k}") for k, i in enumerate(instances)]
    by_key = keys.groupBy("target", "key").agg(F.max("owner").alias("known"), *per)
    null, n = F.col("key").isNull(), lambda k: F.coalesce(F.col(f"n{k}"), F.lit(0))
    for k, (instance, owner) in enumerate(checks):
        if owner:
            values = {"Size": n(k), "NullKey": F.when(null, n(k)), "DuplicateKey": F.when(~null & (n(k) > 1), n(k) - 1)}
        else:
            values = {"NullReference": F.when(null, n(k)), "Orphan": F.when(~null & ~F.col("known"), n(k))}
        metrics += [(instance, owner, m, F.coalesce(F.sum(v), F.lit(0)).cast("double")) for m, v in values.items()]
    sums = by_key.agg(*[v.alias(f"m{j}") for j, (*_, v) in enumerate(metrics)])
    rows = [F.struct(F.lit("Key" if owner else "Reference").alias("entity"), F.lit(instance).alias("instance"), F.lit(m).alias("name"),
                     F.col(f"m{j}").alias("value")) for j, (instance, owner, m, _) in enumerate(metrics)]
    return frame.unionByName(sums.select(F.inline(F.array(*rows))))
