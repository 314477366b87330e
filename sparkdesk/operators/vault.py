"""Data Vault loading: hubs, links, satellites, validity intervals, PIT and
bridge tables.

Every loader returns the rows to *append*; the vault tables are append-only
and keyed by a hash key plus ``load_dttm``.  ``load_dttm`` and ``source_id``
are arguments (never the wall clock) so a re-run is repeatable.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.functions.keys import hash_key
from sparkdesk.operators.keyed_scan import Chunks, keyed_scan, with_neighbour


def _meta(df: DataFrame, load_dttm: str, source_id: str) -> DataFrame:
    return df.withColumn("load_dttm", F.lit(load_dttm).cast("timestamp_ntz")) \
             .withColumn("source_id", F.lit(source_id))


def hub_rows(staged: DataFrame, bk_cols: Sequence[str], hk: str, existing: DataFrame | None,
             load_dttm: str, source_id: str) -> DataFrame:
    """New hub rows: one for each hash key not yet in ``existing`` (left anti join on the
    hash key).  Spellings that share a hash key (case, outer blanks) are one key; the
    smallest spelling is stored.  Loading the same batch twice adds nothing the second time."""
    keys = (staged.groupBy(hash_key(*bk_cols).alias(hk)).agg(F.min(F.struct(*bk_cols)).alias("__bk"))
            .select(hk, "__bk.*"))
    if existing is not None:
        keys = keys.join(existing.select(hk), hk, "left_anti")
    return _meta(keys.select(hk, *bk_cols), load_dttm, source_id)


def link_rows(staged: DataFrame, parts: Mapping[str, Sequence[str]], hk: str,
              existing: DataFrame | None, load_dttm: str, source_id: str) -> DataFrame:
    """New link rows.  ``parts`` maps each hub hash-key column to its business
    key columns in ``staged``; the link key hashes all of them together."""
    all_bk = [c for cols in parts.values() for c in cols]
    pairs = staged.select(hash_key(*all_bk).alias(hk),
                          *[hash_key(*cols).alias(name) for name, cols in parts.items()]).dropDuplicates([hk])
    if existing is not None:
        pairs = pairs.join(existing.select(hk), hk, "left_anti")
    return _meta(pairs, load_dttm, source_id)


def satellite_changes(history: DataFrame, hk: str, ts: str, payload: Sequence[str],
                      tie: Sequence[str] = (), chunk: Column | Chunks | None = None) -> DataFrame:
    """Keep a row only when its payload differs from the previous row of the
    same key (NULL-safe: NULL -> NULL is no change); the first row of a key is kept.

    ``tie`` extra order columns break equal timestamps; ``chunk`` (e.g. the
    day of ``ts``) splits a hot key across tasks (see ``keyed_scan``).
    """
    payload = list(payload)
    d = with_neighbour(history, hk, [ts, *tie], payload, "__prev", chunk, "prev")
    same = None
    for c in payload:
        eq = F.col(c).eqNullSafe(F.col(f"__prev.{c}"))
        same = eq if same is None else same & eq
    return d.where(F.col("__prev").isNull() | ~same).drop("__prev")


def validity_intervals(sat: DataFrame, hk: str, ts: str, valid_from: str = "valid_from_dttm",
                       valid_to: str = "valid_to_dttm", tie: Sequence[str] = (),
                       chunk: Column | Chunks | None = None) -> DataFrame:
    """``valid_from`` = own load time, ``valid_to`` = next load time of the same
    key (NULL while current)."""
    d = with_neighbour(sat, hk, [ts, *tie], [ts], "__next", chunk, "next")
    return d.withColumn(valid_from, F.col(ts)) \
            .withColumn(valid_to, F.col(f"__next.{ts}")).drop("__next")


def pit_table(hk: str, satellites: Mapping[str, DataFrame], ts: str = "load_dttm",
              pit_ts: str = "pit_dttm", chunk_of=None) -> DataFrame:
    """Point-in-time table.

    Change points are the union of all satellites' load times per key; for each
    point and satellite the latest load time at or before it (carry-forward of
    the satellite's own load time), plus ``valid_to`` = next point.  No range
    join: one union, one aggregate, one keyed scan.
    """
    names = list(satellites)
    points = None
    for name in names:
        s = satellites[name].select(F.col(hk), F.col(ts).alias(pit_ts),
                                    *[(F.col(ts) if n == name else F.lit(None).cast("timestamp_ntz"))
                                      .alias(f"{n}_{ts}") for n in names])
        points = s if points is None else points.unionByName(s)
    cols = [f"{n}_{ts}" for n in names]
    # one row per (key, point): the max per satellite of the rows at that point
    points = points.groupBy(hk, pit_ts).agg(*[F.max(c).alias(c) for c in cols])
    chunk = chunk_of(F.col(pit_ts)) if chunk_of else None
    # carry-forward of every satellite and the next point: one keyed scan
    scanned = keyed_scan(points, hk, pit_ts, next={"__next": [pit_ts]}, fill=cols, chunk=chunk)
    return scanned.withColumn("valid_to_dttm", F.col(f"__next.{pit_ts}")).drop("__next")


def bridge(base: DataFrame, steps: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Flatten a hierarchy by a chain of joins.

    ``steps`` is a list of ``(level_df, base_fk, level_key)``: each level is
    joined on ``base_fk = level_key`` (left join: a missing level leaves
    NULLs).  Levels are small dimensions: the planner broadcasts them after a
    size check, else sort-merge joins.
    """
    out = base
    for level, fk, key in steps:
        out = out.join(level, out[fk] == level[key], "left")
    return out
