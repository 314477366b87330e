"""Previous / next row and carry-forward within a key, split by time chunks.

A plain ``Window.partitionBy(key).orderBy(t)`` puts every row of a key into
one task; a key holding a third of the table then serialises the job.  Here a
chunk column (e.g. the day of ``t``) is added: the window runs per
``(key, chunk)``, in parallel, and the values that cross a chunk border come
from a small per-chunk aggregate (one row per key and chunk) scanned per key.
With ``chunk=None`` it is the single window.  :class:`Chunks` cuts hot keys
finer than the rest, so a key holding a third of the table spreads over
minutes instead of days.

:func:`keyed_scan` answers every request of one ordered pass at once:
neighbours before and after, and carry-forward columns share one window, one
per-chunk aggregate, one window over the chunks and one join back.

Ties in ``order`` must be broken by the caller (append a unique column).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkdesk.session import write_scratch

#: Keys are counted in so many hash buckets: the counts stay a small table, however many keys there are.
BUCKETS = 1 << 16
#: The keys of a bucket with no more rows than this are scanned whole.
WHOLE_ROWS = 100_000


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _ord(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _payload(values: Sequence[str]) -> Column:
    return F.struct(*[F.col(v) for v in values])


class Chunks:
    """Chunking of large keys only, with a finer cut for hot ones.

    Rows are counted by hash bucket of the key (``BUCKETS``), which is one aggregate with a
    bounded result, run when the scan is planned.  A key whose bucket holds no more than
    ``whole_rows`` rows is one chunk; the keys of larger buckets are chunked by ``coarse``
    (e.g. the day of ``t``), and by ``fine`` (e.g. the minute) if the bucket holds more than
    ``hot_rows``.  A small key that shares a large one's bucket is cut with it, which
    changes no result.  Both must be non-decreasing in the scan order and of the same type.
    """

    def __init__(self, coarse: Column, fine: Column, hot_rows: int = 1_000_000,
                 counted: DataFrame | None = None, whole_rows: int = WHOLE_ROWS):
        self.coarse, self.fine, self.hot_rows, self.counted = coarse, fine, hot_rows, counted
        self.whole_rows = min(hot_rows, whole_rows)
        self._found: DataFrame | None = None

    def counted_on(self, history: DataFrame) -> "Chunks":
        """Take the large keys from ``history`` (e.g. the raw rows) instead of
        from each scanned frame: a frame derived from it (change rows, one
        attribute) has no more rows per key, so the set is safe for it too, and
        the count is a scan that all scans with these chunks share."""
        return Chunks(self.coarse, self.fine, self.hot_rows, history, self.whole_rows)

    def large(self, df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
        """(__bucket, __hot) of the buckets with more than ``whole_rows`` rows; None if there is none."""
        if self._found is None or self.counted is None:
            n = (self.counted if self.counted is not None else df).groupBy(_bucket(keys)).agg(F.count(F.lit(1)).alias("__n"))
            self._found = write_scratch(n.where(F.col("__n") > self.whole_rows).select(
                "__bucket", (F.col("__n") > self.hot_rows).alias("__hot")), "large_buckets")
        return None if self._found.isEmpty() else self._found

    def assign(self, df: DataFrame, keys: Sequence[str], found: DataFrame | None = None) -> DataFrame:
        """``df`` with ``__chunk``, and ``__large``: whether the key is cut at all (``found``: from ``large``)."""
        found = self.large(df, keys) if found is None else found
        if found is None:
            return df.withColumns({"__chunk": self.coarse, "__large": F.lit(False)})
        hot = F.col("__hot")
        d = df.withColumn("__bucket", _bucket(keys)).join(F.broadcast(found), "__bucket", "left")
        return d.withColumns({"__chunk": F.when(hot, self.fine).otherwise(self.coarse),
                              "__large": hot.isNotNull()}).drop("__bucket", "__hot")


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("__bucket")


def keyed_scan(df: DataFrame, keys, order, prev: Mapping[str, Sequence[str]] | None = None,
               next: Mapping[str, Sequence[str]] | None = None, fill: Sequence[str] = (),
               chunk: Column | Chunks | None = None, least: Sequence[str] = ()) -> DataFrame:
    """One ordered pass per key.

    * ``prev`` / ``next``: ``{out: value columns}``; ``out`` is a struct of the
      values of the previous / next row of the same key, NULL when there is
      none (a NULL field inside the struct means the neighbour's value is NULL).
    * ``fill``: columns replaced by their last non-NULL value up to and
      including the current row (``last(col, ignorenulls)``).
    * ``least``: all columns besides keys and order; of rows that are equal in these only the
      one that is least in ``least`` is scanned, without a further shuffle.
    """
    keys, order = _list(keys), _list(order)
    prev, next, fill, columns = dict(prev or {}), dict(next or {}), list(fill), df.columns
    d = None
    if isinstance(chunk, Chunks):
        found = chunk.large(df, keys)
        d = chunk.assign(df, keys, found) if found is not None else None
    elif chunk is not None:
        d = df.withColumns({"__chunk": chunk, "__large": F.lit(True)})
    cut = d is not None
    read = {*order, *fill, *[v for vals in (*prev.values(), *next.values()) for v in _list(vals)]}
    if cut:
        # one column for key and chunk: a struct is not NULL, so it is joined by plain equality below
        # and the rows stay where this shuffle puts them
        d = d.withColumn("__part", F.struct(*keys, F.when(F.col("__large"), F.col("__chunk")).alias("__chunk"))).drop(
            "__chunk", "__large", *[k for k in keys if k not in read]).repartition("__part")
    else:
        d = df.repartition(*keys) if least else df
    part = ["__part"] if cut else keys
    if least:
        same = list(dict.fromkeys([*part, *order]))
        d = d.groupBy(*same).agg(F.min(F.struct(*least)).alias("__least")).select(*same, "__least.*")
    w = Window.partitionBy(*part).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = {}
    for out, vals in prev.items():
        inner[out] = F.lag(_payload(_list(vals)), 1).over(w)
    for out, vals in next.items():
        inner[out] = F.lead(_payload(_list(vals)), 1).over(w)
    for c in fill:
        inner[c] = F.last(F.col(c), True).over(run)
    added = [o for o in inner if o not in columns]
    scanned = d.select(*[inner.get(c, F.col(c)).alias(c) for c in d.columns],
                       *[inner[o].alias(o) for o in added])
    if not cut:
        return scanned.select(*columns, *added)

    # per (key, chunk): last row (for the next chunk's first ``prev``), first row
    # (for the previous chunk's last ``next``), last non-NULL of each fill column
    edge = []
    for out, vals in prev.items():
        edge.append(F.max_by(_payload(_list(vals)), _ord(order)).alias(f"__last_{out}"))
    for out, vals in next.items():
        edge.append(F.min_by(_payload(_list(vals)), _ord(order)).alias(f"__first_{out}"))
    for c in fill:
        edge.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), _ord(order))).alias(f"__l_{c}"))
    # a row's other columns are asked for too: with equal columns, this and ``scanned`` read one shuffle of the rows
    rest = F.any_value(F.struct("__part", *[c for c in d.columns if c not in read and c != "__part"]))
    per_chunk = d.groupBy("__part").agg(*edge, rest.alias("__rest")).where("__rest IS NOT NULL")
    per_chunk = per_chunk.select("__part.*", *[c for c in per_chunk.columns if c not in ("__part", "__rest")])
    wc = Window.partitionBy(*keys).orderBy("__chunk")
    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(
        F.struct(*keys, "__chunk").alias("__edge"),
        *[F.lag(f"__last_{o}", 1).over(wc).alias(f"__c_{o}") for o in prev],
        *[F.lead(f"__first_{o}", 1).over(wc).alias(f"__c_{o}") for o in next],
        *[F.last(f"__l_{c}", True).over(before).alias(f"__c_{c}") for c in fill])
    # a chunk that nothing is carried to needs no row
    carry = carry.where(" OR ".join(f"`__c_{o}` IS NOT NULL" for o in [*prev, *next, *fill]))
    j = scanned.join(carry, F.col("__part") == F.col("__edge"), "left")
    # a neighbour payload struct is never NULL, so a NULL one marks the chunk's edge row
    fixed = {o: F.coalesce(F.col(o), F.col(f"__c_{o}")) for o in [*prev, *next, *fill]}
    back = {k: F.col("__part")[k] for k in keys if k not in scanned.columns}
    return j.select(*[fixed.get(c, back.get(c, F.col(c))).alias(c) for c in [*columns, *added]])


def with_neighbour(df: DataFrame, keys, order, values, out: str, chunk: Column | Chunks | None = None,
                   direction: str = "prev") -> DataFrame:
    """Add ``out``: a struct of ``values`` from the previous (``prev``) or next
    (``next``) row of the same key in ``order``."""
    req = {out: _list(values)}
    if direction == "prev":
        return keyed_scan(df, keys, order, prev=req, chunk=chunk)
    return keyed_scan(df, keys, order, next=req, chunk=chunk)


def carry_forward(df: DataFrame, keys, order, cols, chunk: Column | Chunks | None = None) -> DataFrame:
    """Replace each of ``cols`` by its last non-NULL value up to and including
    the current row of the same key (``last(col, ignorenulls)``)."""
    return keyed_scan(df, keys, order, fill=_list(cols), chunk=chunk)
