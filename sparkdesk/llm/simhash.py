"""SimHash near-duplicates by covering locality-sensitive hashing.

Each bit position gets a non-zero vector of radius + 1 bits.  For every non-zero vector v, a
table's mask keeps the positions whose vector has an odd product with v.  The vectors of up
to ``radius`` differing positions leave some v that has an even product with all of them,
so that table's mask hides every difference: any pair within the radius collides there.

A bucket with too many fingerprints is split by the same construction over the bits that its
mask hides, so pairs within the radius stay together and buckets shrink until they are
small (distinct fingerprints that agree on most bits are few).  Inside a small bucket all
distances are checked, and only a spanning star of each linked group is emitted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.llm.common import documents, same_row, text_key
from sparkdesk.session import write_scratch

BITS = 64
#: A bucket of up to so many distinct fingerprints is compared in one place; larger ones are split.
SMALL_BUCKET = 256
#: Bits are counted for so many shingles at a time.
CHUNK = 1 << 16


def fingerprint(text: str, shingle: int, seed: int) -> int:
    """The majority of each bit over the shingles' hashes (0 without words)."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    pairs = zip(starts, ends[shingle - 1:].tolist()) if len(words) >= shingle else [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in pairs], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), CHUNK):
        part = hashes[i:i + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, shingle: int = 3, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp) for each row, the fingerprint as a signed 64-bit number."""
    d = documents(docs, id_col, text_col)
    d = d.withColumn("text_key", text_key(F.col("text")))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps.view(np.int64))],
                                             ["doc_id", "text_key", "fp"])

    return d.mapInArrow(work, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, text_key bigint, fp bigint")


def covering_masks(kept: int, radius: int) -> list[int]:
    """Masks over the bits that ``kept`` lacks, each together with ``kept``: any ``radius``
    or fewer of those bits are outside one of them."""
    free = [b for b in range(BITS) if not kept >> b & 1]
    vectors = (1 << radius + 1) - 1
    masks = {kept | sum(1 << b for i, b in enumerate(free) if (i % vectors + 1 & v).bit_count() & 1)
             for v in range(1, vectors + 1)}
    return sorted(masks)


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> BITS - 1 else x


def _tables(spark: SparkSession, parents: list[int], radius: int) -> DataFrame:
    """(parent, mask), a fixed number of rows at each level."""
    rows = [(_signed(p), _signed(m)) for p in parents for m in covering_masks(p, radius)]
    return spark.createDataFrame(rows, "parent bigint, mask bigint")


def _bucket_links(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A star (member, smallest member) for each group linked within the radius."""
    bits = members.view(np.uint64)  # bitwise_count would take the absolute value of a signed number
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= radius
    label = np.arange(len(members))
    while True:
        least = np.where(near, label[None, :], len(members)).min(axis=1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    return [(int(members[i]), int(members[j])) for i, j in enumerate(label) if i != j]


def _links_within(buckets: DataFrame, radius: int) -> DataFrame:
    """(a, b) from buckets given as small arrays of distinct fingerprints."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = [link for members in batch.column(0)
                     for link in _bucket_links(np.sort(np.array(members.values, dtype=np.int64)), radius)]
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return buckets.mapInArrow(work, "a bigint, b bigint")


def links(fps: DataFrame, *, radius: int = 3, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """(a, b) with a > b: links that join exactly the fingerprints within the radius, directly
    or through others.  ``fps`` has distinct values in ``fp``."""
    spark = fps.sparkSession
    rows = fps.select(F.lit(0).cast("bigint").alias("parent"), "fp")
    found, parents = None, [0]
    while True:
        tables = _tables(spark, parents, radius)
        keyed = (rows.join(F.broadcast(tables), "parent")
                 .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp").distinct())
        # written first: the join below does not reuse its partitions and can split a large bucket
        sizes = write_scratch(keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1"), "simhash_sizes")
        level = write_scratch(keyed.join(sizes, ["mask", "key"]), "simhash_buckets")
        buckets = (level.filter(F.col("n") <= small_bucket).groupBy("mask", "key")
                   .agg(F.collect_list("fp").alias("members")).select("members"))
        here = write_scratch(_links_within(buckets, radius).distinct(), "simhash_links")
        found = here if found is None else found.unionAll(here)
        large = level.filter(F.col("n") > small_bucket)
        # the masks of large buckets: at most as many as there are tables at this level
        parents = [m % (1 << BITS) for (m,) in large.select("mask").distinct().collect()]
        if not parents:
            return found.distinct()
        rows = large.select(F.col("mask").alias("parent"), "fp")


def components(links: DataFrame) -> DataFrame:
    """(node, root): each linked node's smallest reachable node, by alternating large and small
    stars.  Each round is written to the shared folder, so lineage stays short."""
    edges = write_scratch(links.select("a", "b").distinct(), "components")
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(least.select("a", F.col("m").alias("b")))).distinct()
        edges = write_scratch(small, "components")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        seen = state


def near_duplicates(docs: DataFrame, *, shingle: int = 3, radius: int = 3, seed: int = 42, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, text_key, and root_fp,
    which names the component where component_id is null or shared.

    Fingerprints within ``radius`` bits are linked; component_id is the smallest doc_id that
    links reach, the row's own included.  Equal fingerprints are searched once.

    Null, empty and wordless texts have fingerprint zero and are linked like any other;
    very long texts are counted in chunks; repeated rows and ties share a component; a null
    doc_id takes part but is never smallest (component_id is null only among nulls); an
    empty table gives no rows; other columns are ignored.
    """
    each = write_scratch(fingerprints(docs, shingle=shingle, seed=seed, id_col=id_col, text_col=text_col), "fingerprints")
    fps = write_scratch(each.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct_fingerprints")
    roots = write_scratch(components(links(fps, radius=radius)), "roots")
    of_fp = fps.join(roots, fps.fp == roots.node, "left").select("fp", "first_doc", F.coalesce("root", "fp").alias("root"))
    least = of_fp.groupBy(F.col("root").alias("root_fp")).agg(F.min("first_doc").alias("component_id"))
    named = of_fp.join(least, F.col("root") == F.col("root_fp")).select("fp", "component_id", "root_fp")
    return each.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
                                         "text_key", "root_fp")


def keep_first(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each group: the one of the smallest doc_id, and of the smallest
    text hash where several share it.  Rows without a doc_id are kept if their group has no other."""
    first = (groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root_fp")
             .agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
             .select(F.col("first.doc_id").alias("__id"), F.col("first.text_key").alias("__key")))
    return (docs.join(first, same_row(docs, id_col, text_col), "left_semi")
            .withColumn("__key", text_key(F.col(text_col))).dropDuplicates([id_col, "__key"]).drop("__key"))
