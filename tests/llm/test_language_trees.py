"""Byte context trees against a plain version, and their held-out accuracy."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import CLASHING, SCHEMA, awkward_rows, frame
from pyspark.sql import functions as F

from sparkdesk.llm.context_language import (
    ContextTree,
    gram_counts,
    gram_numbers,
    identify_languages,
    learn,
    training_sample,
)

SF = "/root/testdata/sf0.01"


class PlainTree:
    """Counts by context, and escapes with exclusion, one byte at a time."""

    def __init__(self, texts, order):
        self.order, self.after = order, defaultdict(Counter)
        for text in texts:
            for i, byte in enumerate(text):
                for size in range(min(i, order) + 1):
                    self.after[text[i - size:i]][byte] += 1

    def bits(self, context, byte):
        out, gone = 0.0, set()
        for size in range(min(len(context), self.order), -1, -1):
            seen = self.after.get(context[len(context) - size:])
            if seen is None:
                continue
            left = {b: n for b, n in seen.items() if b not in gone}
            if left:
                total = sum(left.values()) + len(left)
                if byte in left:
                    return out + math.log2(total / left[byte])
                out += math.log2(total / len(left))
            gone |= set(seen)
        return out + math.log2(256 - len(gone))

    def text_bits(self, text):
        return sum(self.bits(text[max(0, i - self.order):i], b) for i, b in enumerate(text))


def counts(spark, rows, order):
    """The gram counts of (lang, text) rows."""
    return gram_counts(spark.createDataFrame(rows, "lang string, text string"), order)


TEXTS = ["abracadabra", "a", "", "barbara and abba", "日本 abra", "cadabra\ncadabra"]
NEW = ["abba", "zebra abra", "", "日", "a", "cad", "x\ny", "abracadabra" * 3]


@pytest.mark.parametrize("order", [0, 1, 3, 4, 6])
def test_code_lengths(spark, order):
    model = learn(spark.createDataFrame([("l", t) for t in TEXTS] + [("m", "zzz zebra")], "lang string, text string"), order)
    got = model.code_lengths(pa.array(NEW))
    for k, texts in enumerate([TEXTS, ["zzz zebra"]]):
        plain = PlainTree([t.encode() for t in texts], order)
        assert np.allclose(got[:, k], [plain.text_bits(t.encode()) for t in NEW])
    # a second look finds all grams in the table
    assert np.array_equal(got, model.code_lengths(pa.array(NEW)))


def test_lengths_are_those_of_a_distribution(spark):
    got = counts(spark, [("l", t) for t in TEXTS], 3).toArrow()
    tree = ContextTree(got.column("gram").to_numpy().view(np.uint64), got.column("c").to_numpy().astype(float), 3)
    for context in (b"", b"a", b"ab", b"abr", b"zzz", b"zab", b"\xe6\x97", b"a\nc"):
        data = np.frombuffer(b"".join(context + bytes([b]) for b in range(256)), np.uint8)
        have = np.tile(np.arange(len(context) + 1, dtype=np.uint8), 256)
        grams = gram_numbers(data, have, 3, 0, len(data))[len(context)::len(context) + 1]
        assert abs(np.exp2(-tree.code_lengths(grams)).sum() - 1) < 1e-9, context


def test_slots_that_collide(spark, monkeypatch):
    from sparkdesk.llm import context_language

    monkeypatch.setattr(context_language, "SLOTS", 4)
    monkeypatch.setattr(context_language, "BLOCK", 5)
    model = learn(spark.createDataFrame([("l", t) for t in TEXTS], "lang string, text string"), 3)
    plain = PlainTree([t.encode() for t in TEXTS], 3)
    for _ in range(2):
        assert np.allclose(model.code_lengths(pa.array(NEW))[:, 0], [plain.text_bits(t.encode()) for t in NEW])


def test_sample_is_bounded_and_stable(spark):
    rows = [(f"l{i % 3}", f"text {i}", i) for i in range(3000)] + [("l0", "x" * 100, 5000), (None, "t", 1), ("l1", None, 2)]
    rows += [("rare", "one", 7)] * 4 + [("least", "two", 8)]
    df = spark.createDataFrame(rows, "lang string, text string, n bigint").select("lang", "text", F.xxhash64("n").alias("row"))
    take = lambda d: sorted(map(tuple, training_sample(d, rows_per_language=20, max_bytes=50, max_languages=4).collect()))
    got = take(df)
    assert Counter(lang for lang, _ in got) == {"l0": 20, "l1": 20, "l2": 20, "rare": 4}
    assert got == take(df.repartition(7))


@pytest.mark.parametrize("schema", [SCHEMA, CLASHING + ", row int, lettered int, score string"], ids=["plain", "clashing"])
def test_awkward_rows(spark, schema):
    rows = awkward_rows() + [(40, "12 34 !?", "en", "s"), (41, "ordinary words of one kind", "en", "s")]
    docs = frame(spark, rows, schema)
    got = identify_languages(docs).collect()
    assert sorted((str(r.doc_id) for r in got)) == sorted(str(r[0]) for r in rows)
    for r in got:
        text = next(t for i, t, *_ in rows if i == r.doc_id) or ""
        if r.doc_id in (4, 5, 6, 40):
            assert (r.lang_pred, r.score, r.bits_per_byte) == ("und", 0.0, None)
        else:
            assert r.lang_pred in ("de", "en", "xx", "und") and 0 <= r.score <= 1, text
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 23}) == 1
    assert identify_languages(frame(spark, [], schema)).collect() == []
    unlabelled = identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}


def test_held_out_accuracy_and_no_leak(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    got = {r.doc_id: tuple(r) for r in identify_languages(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.filter(held).select("doc_id", "lang").collect()}
    assert {i for i, r in got.items() if r[1]} == set(truth)
    judged = [(got[i][2], lang) for i, lang in truth.items() if lang and got[i][2] != "und"]
    assert sum(a == b for a, b in judged) >= 0.98 * len(judged) > 100
    # neither the languages of held-out rows nor their other columns matter
    other = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("?"))
    assert {r.doc_id: tuple(r) for r in identify_languages(other).collect()} == got
