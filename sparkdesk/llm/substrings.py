"""Substring deduplication by level-wise doubling.

At the first level, half the window length, only the least hash of each window's parts (its
minimiser) is compared: copies of a window have the same one, so a window without a
repeated part cannot be repeated.  Only windows with a repeated part are extended to twice
the length and compared whole; if none survive, nothing is.  Exact copies of a whole document
are found first, so they add no windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdesk.llm.common import documents, text_key
from sparkdesk.session import write_scratch

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(29)


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of two neighbouring runs of words from theirs."""
    mixed = (left * _A) ^ (right + _B)
    mixed ^= mixed >> _SHIFT
    mixed *= _B
    return mixed ^ (mixed >> _SHIFT)


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` words, built by doubling shorter runs."""
    made, have, power, span = None, 0, words, 1
    while True:
        if length & span:
            made = power if made is None else _join(made[:len(power) - have], power[have:])
            have += span
        span *= 2
        if span > length:
            return made
        power = _join(power[:len(power) - span // 2], power[span // 2:])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    least, span = values, 1
    while 2 * span <= width:
        least = np.minimum(least[:len(least) - span], least[span:])
        span *= 2
    return np.minimum(least[:len(least) - (width - span)], least[width - span:]) if width > span else least


class _Hasher:
    """Word hashes, remembered for words seen before."""

    def __init__(self, limit: int = 300_000):
        self.known, self.limit = {}, limit

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.limit:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _windows(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of a text: its minimiser, its own hash; and how many there are."""
    part = (window + 1) // 2
    parts = run_hashes(hashes, part)
    return _sliding_min(parts, window - part + 1), _join(parts[:len(parts) - (window - part)], parts[window - part:])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _first_level(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, key, n_words, sha, parts) of (doc_id, text, key): a row's words as one digest, and its
    distinct minimisers."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher()
        for batch in batches:
            n_words, digests, parts = [], [], []
            for text in batch.column(1):
                words = text.as_py().encode().split()
                n_words.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                least = _windows(hasher(words), window)[0] if len(words) >= window else np.empty(0, np.uint64)
                parts.append(_signed(np.unique(least)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n_words, pa.int64()), pa.array(digests, pa.string()),
                                              pa.array(parts, pa.list_(pa.int64()))], ["doc_id", "key", "n_words", "sha", "parts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(work, f"doc_id {kind}, key bigint, n_words bigint, sha string, parts array<bigint>")


def _second_level(candidates: DataFrame, window: int) -> DataFrame:
    """(part, whole, doc_id, key, at) of (doc_id, key, text, repeated): the windows that hold a repeated
    part, at the full length."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher()
        for batch in batches:
            for doc, key, text, repeated in zip(*batch.columns):
                least, whole = _windows(hasher(text.as_py().encode().split()), window)
                at = np.flatnonzero(np.isin(_signed(least), np.asarray(repeated.values)))
                for i in range(0, len(at), 100_000):
                    here = at[i:i + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_signed(least[here])), pa.array(_signed(whole[here])),
                         pa.array([doc.as_py()] * len(here), doc.type), pa.array([key.as_py()] * len(here), key.type),
                         pa.array(here.astype(np.int32))], ["part", "whole", "doc_id", "key", "at"])

    kind = candidates.schema["doc_id"].dataType.simpleString()
    return candidates.mapInArrow(work, f"part bigint, whole bigint, doc_id {kind}, key bigint, at int")


def _without(rows: DataFrame, window: int) -> DataFrame:
    """(doc_id, key, n_removed, kept_text) of (doc_id, key, text, gone), gone being places of repeated windows."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text, gone in zip(batch.column(2), batch.column(3)):
                words = text.as_py().encode().split()
                change = np.zeros(len(words) + 1, np.int64)
                at = np.asarray(gone.values)
                np.add.at(change, at, 1)
                np.add.at(change, at + window, -1)
                covered = np.cumsum(change)[:-1] > 0
                removed.append(int(covered.sum()))
                kept.append(b" ".join(w for w, c in zip(words, covered.tolist()) if not c).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.string())], ["doc_id", "key", "n_removed", "kept_text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, key bigint, n_removed bigint, kept_text string")


def _repeats(pairs: DataFrame, *key: str) -> DataFrame:
    """(key, first) of the keys that two documents or more share; combined before the shuffle."""
    return (pairs.groupBy(*key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
            .filter("first < last").drop("last"))


def remove_repeats(docs: DataFrame, *, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, kept_text (null if nothing is removed).

    Words are runs without ASCII white space.  A word goes if a window of ``window`` words
    over it also starts in a document with a smaller doc_id, judged on the input.

    Null, empty and short texts lose nothing; a row without a doc_id neither loses words nor
    takes any from others; rows that share a doc_id are judged each by its own text, and take
    nothing from each other; very long texts are worked on whole, one at a time; repeated rows
    lose the same words; an empty table gives no rows; other columns are ignored.
    """
    d = documents(docs, id_col, text_col)
    d = d.select("doc_id", "text", text_key(F.col("text")).alias("key"))
    level = write_scratch(_first_level(d, window), "substring_parts")
    known = level.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    # written first: the join below can then split the rows of a text with many copies
    copies = write_scratch(known.groupBy("sha", "n_words").agg(F.min("doc_id").alias("first_copy")), "substring_copies")
    known = known.join(copies, ["sha", "n_words"])
    named = lambda df, *more: df.select(F.col("doc_id").alias("id"), F.col("key").alias("id_key"), *more)
    same = (F.col("doc_id") == F.col("id")) & (F.col("key") == F.col("id_key"))
    whole = named(known.filter("doc_id > first_copy"), F.lit(True).alias("is_copy")).distinct()
    parts = known.filter("doc_id = first_copy").select("doc_id", "key", F.explode("parts").alias("part")).distinct()
    parts = write_scratch(parts, "substring_first")
    # repeated keys are written first: the join above them can then split a hot key's rows
    shared = parts.join(write_scratch(_repeats(parts, "part").select("part"), "substring_repeated"), "part")
    shared = shared.groupBy(F.col("doc_id").alias("id"), F.col("key").alias("id_key")).agg(F.collect_set("part").alias("repeated"))
    candidates = write_scratch(d.join(shared, same).dropDuplicates(["doc_id", "key"])
                               .select("doc_id", "key", "text", "repeated"), "substring_candidates")
    windows = write_scratch(_second_level(candidates, window), "substring_windows")
    repeated = write_scratch(_repeats(windows, "part", "whole"), "substring_repeated")
    found = (windows.join(repeated, ["part", "whole"]).filter("doc_id > first")
             .groupBy(F.col("doc_id").alias("id"), F.col("key").alias("id_key")).agg(F.collect_set("at").alias("gone")))
    kept = _without(candidates.join(found, same).select("doc_id", "key", "text", "gone"), window)
    changed = named(kept, "n_removed", "kept_text", F.lit(False).alias("is_copy")).unionByName(whole, allowMissingColumns=True)
    result = level.join(changed, same, "left")
    is_copy = F.coalesce("is_copy", F.lit(False))
    kept_text = F.when(is_copy, F.lit("")).otherwise(F.col("kept_text"))
    return result.select(
        "doc_id", "n_words", F.when(is_copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.coalesce(F.sha2(kept_text, 256), F.col("sha")).alias("kept_sha256"), kept_text.alias("kept_text"))
