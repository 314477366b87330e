"""Benchmark decontamination by a prefix-filtered set join.

An item's shingles are its words.  A document can hold a window of an item only if it
holds every word of the window, so looking for one necessary word finds all candidates:
the window's rarest word in the corpus (its prefix; for full containment the prefix has
length one).  A found word fixes the place of the window in the document, so length and
position bound the candidate, and the words around it verify it, over windows of
``window`` words (the whole item if it is shorter).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.llm.common import blocks, broadcast_if_small, documents, lower_ascii, same_row, text_key, words_between
from sparkdesk.session import write_scratch

#: After A-Z are lowered, a word is a run of digits, letters a-z and non-ASCII characters.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: So many benchmark words are looked for in one pass over the corpus; more take more passes.
WORDS_A_PASS = 50_000

#: The prefix table is broadcast up to this measured size; a larger one is joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 8 << 20


def _words(text: Column) -> Column:
    return words_between(lower_ascii(text), NO_WORD)


def _corpus_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, freq) of those words of ``vocabulary`` that occur in the corpus."""
    word = docs.select(F.explode(F.split(lower_ascii(F.col("text")), NO_WORD)).alias("word"))
    counts = [word.filter(F.col("word").isin(block)).groupBy("word").agg(F.count("*").alias("freq"))
              for block in blocks(vocabulary, "word", WORDS_A_PASS)]
    return reduce(DataFrame.unionAll, counts or [vocabulary.withColumn("freq", F.lit(0).cast("bigint"))])


def _prefixes(sequences: DataFrame, freq: DataFrame, window: int) -> DataFrame:
    """(word, seq_id, k, at, ws): the rarest word of each window, the item's words within reach of it and its place there.

    Windows with a word that the corpus lacks cannot occur and drop out here.
    """
    k = F.least(F.lit(window), F.size("ws"))
    starts = sequences.select("seq_id", "ws", k.alias("k"),
                              F.explode(F.sequence(F.lit(0), F.size("ws") - k)).alias("start"))
    parts = starts.select("seq_id", "start", "k", F.posexplode(F.slice("ws", F.col("start") + 1, F.col("k"))).alias("j", "word"))
    ranked = (parts.join(freq, "word").groupBy("seq_id", "start", "k")
              .agg(F.count("*").alias("found"), F.min(F.struct("freq", "word", "j")).alias("rarest")))
    places = (ranked.filter("found = k")
              .select(F.col("rarest.word").alias("word"), "seq_id", (F.col("start") + F.col("rarest.j")).alias("at"), "k"))
    low = F.greatest(F.col("at") - (window - 1), F.lit(0))
    return (places.distinct().join(sequences, "seq_id")
            .select("word", "seq_id", "k", (F.col("at") - low).alias("at"), F.slice("ws", low + 1, 2 * window - 1).alias("ws")))


def _scan(docs: DataFrame, block: list[str], window: int) -> DataFrame:
    """(doc_id, text_key, n_words, found): the places of the block's words, each with the words within reach."""
    words = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), _words(F.col("text")).alias("words"))
    low = lambda i: F.greatest(i - (window - 1), F.lit(0))
    places = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1))
    at = F.filter(places, lambda i: F.col("words")[i].isin(block)) if block else F.array().cast("array<int>")
    around = F.transform(at, lambda i: F.struct(
        i.alias("pos"), F.col("words")[i].alias("word"),
        F.transform(F.sequence(low(i), F.least(i + (window - 1), F.size("words") - 1)), lambda j: F.col("words")[j]).alias("around"),
        (i - low(i)).alias("off")))
    return words.select("doc_id", "text_key", F.size("words").cast("bigint").alias("n_words"), around.alias("found"))


def _verified() -> Column:
    """The windows through the found word that occur: array of (start, k) in the document."""
    k, at, off = F.col("k"), F.col("at"), F.col("off")
    low = F.greatest(F.lit(0), at - k + 1, at - off)
    high = F.least(at, F.size("ws") - k, at - off + F.size("around") - k)
    starts = F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    same = F.filter(starts, lambda s: F.slice("around", off + s - at + 1, k) == F.slice("ws", s + 1, k))
    return F.transform(same, lambda s: F.struct((F.col("pos") + s - at).alias("start"), k.alias("k")))


def _covered(hits: Column) -> Column:
    """How many words the (sorted) windows cover together."""
    first = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).alias("upto"))

    def step(a, h):
        end = h.start + h.k
        new = F.greatest(F.lit(0), end - F.greatest(h.start, a.upto))
        return F.struct((a.total + new).alias("total"), F.greatest(a.upto, end).alias("upto"))

    return F.aggregate(hits, first, step, lambda a: a.total)


def benchmark_overlap(docs: DataFrame, items: DataFrame, *, window: int = 13, hit_percent: int = 5,
                      id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                      item_text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit, spans, item_ids, contaminated, text_key.

    ``spans`` are the occurring windows as (start, k) in words, ``item_ids`` the items
    with one, as sorted strings; ``contaminated`` is n_hit > 0 and
    100 * n_hit >= hit_percent * n_words.

    Null or wordless texts have no words and no hits; items without words match nothing;
    an empty table of documents gives no rows, one of items no hits.  Repeated items count
    once for each item_id; an item without an id is not counted, but its words are hit.
    Rows of equal doc_id and text share their hits; others that share a doc_id (null too) do
    not.  Other columns are ignored.
    """
    docs = documents(docs, id_col, text_col)
    sequences = write_scratch(documents(items, item_id_col, item_text_col)
                              .select(F.col("doc_id").alias("item_id"), _words(F.col("text")).alias("ws"))
                              .filter(F.size("ws") > 0), "items")
    # equal items are searched once
    seqs = write_scratch(sequences.select("ws").distinct().withColumn("seq_id", F.monotonically_increasing_id()),
                         "item_texts")
    freq = write_scratch(_corpus_counts(docs, seqs.select(F.explode("ws").alias("word"))), "item_word_counts")
    prefixes = write_scratch(_prefixes(seqs, freq, window), "item_prefixes")
    scans = [write_scratch(_scan(docs, block, window), "item_places")
             for block in blocks(prefixes, "word", WORDS_A_PASS)] or [write_scratch(_scan(docs, [], window), "item_places")]
    small = broadcast_if_small(prefixes, max_rows=BROADCAST_ROWS, max_bytes=BROADCAST_BYTES, size_col="word")
    found = reduce(DataFrame.unionAll, [one.select("doc_id", "text_key", F.inline("found")) for one in scans])
    hits = (found.join(small, "word")
            .select("doc_id", "text_key", "seq_id", F.explode(_verified()).alias("hit")))
    hits = write_scratch(hits, "item_hits")
    covered = (hits.groupBy(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).agg(F.array_sort(F.collect_set("hit")).alias("spans"))
               .withColumn("n_hit", _covered(F.col("spans"))))
    names = sequences.join(seqs, "ws").select("seq_id", F.col("item_id").cast("string").alias("item"))
    named = (hits.select("doc_id", "text_key", "seq_id").distinct().join(names, "seq_id")
             .groupBy(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key")).agg(F.array_sort(F.collect_set("item")).alias("item_ids")))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return (scans[0].select("doc_id", "text_key", "n_words")
            .join(covered, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), "left")
            .join(named, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key")), "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"),
                    F.coalesce("spans", F.array().cast("array<struct<start:int,k:int>>")).alias("spans"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                    ((n_hit > 0) & (100 * n_hit >= hit_percent * F.col("n_words"))).alias("contaminated"), "text_key"))


def drop_contaminated(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, by doc_id and text; the columns stay as they are."""
    bad = verdicts.filter("contaminated").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    return docs.join(bad, same_row(docs, id_col, text_col), "left_anti")
