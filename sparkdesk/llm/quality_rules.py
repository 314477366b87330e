"""Quality rules: simple counts, and how far a document's histograms are from its language.

Two histograms are taken of each document: character classes (upper case, lower case and
other letters, digits, white space, punctuation, other) and common words (the ordinary
function words of a few languages, in lower case, and all other words together).  The
references are the same histograms summed over all documents of a language.  A document
is judged by the Jensen-Shannon distance to its own language's reference, or to the
nearest one if its language has none, and only if it is long enough for its histogram to
mean something.  How far a text without any common word lies from a reference depends on
the language alone, so word distances are judged as shares of that.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.llm.common import SPACE_RUN, documents, same_row, text_key, words_between
from sparkdesk.session import write_scratch

#: Ordinary function words by language (a parameter of the operator).
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "ist", "nicht"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "with"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "por"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
}

#: Character classes in order, each a Java character class; what is left is "other".
CLASSES = {"lower": r"\p{Ll}", "space": r"\x20\x09-\x0D", "upper": r"\p{Lu}", "letter": r"\p{L}\p{M}",
           "digit": r"\p{N}", "punct": r"\p{P}"}


#: Characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]+"


def _with_classes(d: DataFrame) -> DataFrame:
    """Adds ``class_hist``, word_chars and n_symbols: one class after another is taken out of
    the text, and the lengths of what is left give the counts."""
    left = ["text"]
    for name, cls in CLASSES.items():
        d = d.withColumn(f"no_{name}", F.regexp_replace(left[-1], f"[{cls}]+", ""))
        left.append(f"no_{name}")
    d = d.withColumn("no_symbol", F.regexp_replace("no_digit", SYMBOLS, ""))
    counts = dict(zip(CLASSES, (F.length(a) - F.length(b) for a, b in zip(left, left[1:]))))
    d = d.withColumn("word_chars", (F.length("text") - counts["space"]).cast("bigint"))
    d = d.withColumn("n_symbols", (F.length("no_digit") - F.length("no_symbol")).cast("bigint"))
    return d.withColumn("class_hist", F.array(*[c.cast("bigint") for c in (*counts.values(), F.length(left[-1]))]))


#: Bits of a packed number that hold a window's place; a longer text skips the packing.
PLACE_BITS = 24
PLACE_MASK = (1 << PLACE_BITS) - 1


def _packed(words: Column) -> Column:
    """A hash of each three-word window and its place, packed into one number and sorted:
    equal hashes come together without a window leaving its row."""
    places = F.when(F.size(words).between(4, 1 << PLACE_BITS), F.sequence(F.lit(0), F.size(words) - 3))
    return F.sort_array(F.transform(places, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])
                                    .bitwiseAND(F.lit(~PLACE_MASK)).bitwiseOR(i.cast("bigint"))))


def _keyed(words: Column, places: Column) -> Column:
    """The three words at each place, followed by the place, sorted."""
    return F.sort_array(F.transform(places, lambda i: F.concat_ws(
        " ", words[i], words[i + 1], words[i + 2], F.lpad(F.hex(i), 8, "0"))))


def _with_repeats(d: DataFrame) -> DataFrame:
    """Adds ``repeats``: the sorted places of windows that occur at another place too.

    Places whose hash equals a neighbour's are suspects; the words of suspects are compared.
    """
    d = d.withColumn("packed", _packed(F.col("words")))
    packed = F.col("packed")
    later = F.when(F.size("packed") > 1, F.sequence(F.lit(1), F.size("packed") - 1))
    d = d.withColumn("second", F.filter(later, lambda i: packed[i].bitwiseXOR(packed[i - 1]).between(0, PLACE_MASK)))
    place = lambda i: packed[i].bitwiseAND(F.lit(PLACE_MASK)).cast("int")
    suspects = F.array_distinct(F.concat(F.transform("second", place), F.transform("second", lambda i: place(i - 1))))
    all_places = F.sequence(F.lit(0), F.size("words") - 3)
    d = d.withColumn("suspects", F.when(F.size("words") > 1 << PLACE_BITS, all_places)
                     .when(F.size("second") > 0, suspects))
    d = d.withColumn("keyed", _keyed(F.col("words"), F.col("suspects")))
    text = lambda x: F.substring_index(x, " ", 3)
    same = lambda x, i: F.coalesce(text(x) == text(F.get(F.col("keyed"), i)), F.lit(False))
    twins = F.filter("keyed", lambda x, i: same(x, i - 1) | same(x, i + 1))
    return d.withColumn("repeats", F.sort_array(F.transform(
        twins, lambda x: F.conv(F.substring_index(x, " ", -1), 16, 10).cast("int"))))


def _covered(places: Column) -> Column:
    """Words covered by three-word windows at the given sorted places."""
    first = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).alias("upto"))
    step = lambda a, p: F.struct((a.total + p + 3 - F.greatest(p, a.upto)).alias("total"), (p + 3).alias("upto"))
    return F.coalesce(F.aggregate(places, first, step, lambda a: a.total), F.lit(0).cast("bigint"))


def histograms(docs: DataFrame, *, common_words: dict[str, list[str]] = COMMON_WORDS, id_col: str = "doc_id",
               text_col: str = "text", lang_col: str = "lang", keep_row: bool = False) -> DataFrame:
    """One row per row of ``docs``: counts for the base rules and both histograms; with
    ``keep_row`` the row itself too, as ``row``."""
    listed = sorted({w for ws in common_words.values() for w in ws})
    row = ["row"] if keep_row else []
    d = documents(docs, id_col, text_col, docs[lang_col].alias("lang"), *[F.struct("*").alias(c) for c in row])
    d = _with_classes(d).select(
        *row, "doc_id", "lang", "text", text_key(F.col("text")).alias("text_key"), words_between(F.col("text"), SPACE_RUN).alias("words"),
        F.length("text").cast("bigint").alias("n_chars"), "word_chars", "n_symbols", "class_hist")
    d = d.select(
        *row, "doc_id", "lang", "text_key", F.size("words").alias("n"), "n_chars", "word_chars", "n_symbols", "class_hist",
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        "words", F.filter(F.transform("words", F.lower), lambda w: w.isin(listed)).alias("common"))
    d = _with_repeats(d)
    times = [F.size("common") - F.size(F.array_remove("common", w)) for w in listed]
    return d.select(
        *row, "doc_id", "lang", "text_key", F.col("n").cast("bigint").alias("n_words"), "n_chars", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _covered(F.col("repeats")).alias("n_repeat_words"), "class_hist",
        F.array(*[c.cast("bigint") for c in (*times, F.col("n") - F.size("common"))]).alias("word_hist"))


def _references(hists: DataFrame, langs: list[str]) -> dict[str, dict[str, list[int]]]:
    """Both histograms summed per language: one row for each listed language, so a few rows."""
    sums = {}
    for name in ("class_hist", "word_hist"):
        one = hists.filter(F.col("lang").isin(langs)).select("lang", F.posexplode(name).alias("i", "n"))
        for lang, i, n in one.groupBy("lang", "i").agg(F.sum("n").alias("n")).collect():
            sums.setdefault(lang, {}).setdefault(name, {})[i] = n
    return {lang: {name: [h[i] for i in range(len(h))] for name, h in by.items()} for lang, by in sums.items()}


def _entropy(shares: Column) -> Column:
    """In bits; a share of zero adds nothing (log2 of zero is null)."""
    return F.aggregate(shares, F.lit(0.0), lambda a, x: a - F.coalesce(x * F.log2(x), F.lit(0.0)))


def _far(shares: str, entropy: str, ref: list[int]) -> Column:
    """Jensen-Shannon distance (root of the divergence in bits, 0 to 1) to a reference: the
    entropy of the mean histogram less the mean of both entropies."""
    q = [n / max(1, sum(ref)) for n in ref]
    mean = F.zip_with(shares, F.lit(q), lambda a, b: (a + b) / 2)
    divergence = _entropy(mean) - (F.col(entropy) - sum(x * math.log2(x) for x in q if x)) / 2
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def wordless_distance(ref: list[int]) -> float:
    """The distance from a word reference to a text without any common word."""
    q = [n / max(1, sum(ref)) for n in ref]
    m = (q[-1] + 1) / 2
    return math.sqrt(max(0.0, ((q[-1] * math.log2(q[-1] / m) if q[-1] else 0.0) + math.log2(1 / m) + sum(q[:-1])) / 2))


def _own_or_nearest(by_lang: dict[str, Column]) -> Column:
    """The value of the row's language, or the least of all if it has none."""
    if not by_lang:
        return F.lit(None).cast("double")
    out = F.least(*by_lang.values(), F.lit(math.inf))
    for lang, value in by_lang.items():
        out = F.when(F.col("lang") == lang, value).otherwise(out)
    return F.nullif(out, F.lit(math.inf))


def _distances(hists: DataFrame, refs: dict[str, dict[str, list[int]]], judged_words: int) -> DataFrame:
    """Adds class_distance, word_distance and word_share; null below ``judged_words`` words."""
    for name, total in (("class", "n_chars"), ("word", "n_words")):
        share = F.transform(f"{name}_hist", lambda n: n / F.col(total))  # noqa: B023
        hists = hists.withColumn("p", F.when(F.col("n_words") >= judged_words, share)).withColumn("h", _entropy(F.col("p")))
        far = {lang: _far("p", "h", r[f"{name}_hist"]) for lang, r in refs.items()}
        judged = lambda x: F.when(F.col("p").isNotNull(), x)  # noqa: E731, B023
        hists = hists.withColumn(f"{name}_distance", judged(_own_or_nearest(far)))
        if name == "word":
            # a reference without any common word tells nothing
            most = {lang: wordless_distance(r["word_hist"]) for lang, r in refs.items()}
            share = {lang: far[lang] / most[lang] for lang in refs if most[lang] > 0}
            hists = hists.withColumn("word_share", judged(_own_or_nearest(share)))
    return hists.drop("p", "h")


def _judged(hists: DataFrame, *, common_words: dict[str, list[str]], min_words: int, max_repeat_percent: int,
            judged_words: int, max_class_distance: float, max_word_share: float) -> DataFrame:
    """Adds the distances, base_failed and kept to written histograms."""
    refs = _references(hists, sorted(common_words))
    failed = ((F.col("n_words") < min_words)
              | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    far = (F.coalesce(F.col("class_distance") > max_class_distance, F.lit(False))
           | F.coalesce(F.col("word_share") > max_word_share, F.lit(False)))
    return _distances(hists, refs, judged_words).withColumn("base_failed", failed).withColumn("kept", ~failed & ~far)


#: Limits of the operator and of the stage: both apply the same.
LIMITS = {"common_words": COMMON_WORDS, "min_words": 50, "max_repeat_percent": 50, "judged_words": 100,
          "max_class_distance": 0.25, "max_word_share": 0.8}


def quality_rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  **limits) -> DataFrame:
    """Per row of ``docs``: the counts, class_distance, word_distance, word_share, base_failed, kept and text_key.

    ``limits`` are those of ``LIMITS``.  The distances are to the reference of the row's
    language, or to the nearest if that is null or not in ``common_words``; null for a document
    of fewer than ``judged_words`` words.  ``word_share`` is the word distance as a share of that of a
    text without any common word.  References are summed over all documents whose ``lang_col``
    is a listed language.  ``base_failed``: fewer than ``min_words`` words, or more than
    ``max_repeat_percent`` per cent of words in repeated three-word windows.  ``kept`` is false if
    ``base_failed``; a document of ``judged_words`` words or more must also be within
    ``max_class_distance`` and ``max_word_share``.

    Null and empty texts have no words and fail; a null or unknown language adds to no
    reference; very long texts are counted whole, in one row of numbers; repeated rows and ties
    are judged alike; an empty table gives no rows; other columns are ignored.
    """
    limits = {**LIMITS, **limits}
    hists = write_scratch(histograms(docs, common_words=limits["common_words"], id_col=id_col, text_col=text_col,
                                     lang_col=lang_col), "histograms")
    return (_judged(hists, **limits)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance",
                    "word_distance", "word_share", "base_failed", "kept", "text_key"))


def keep_good(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              **limits) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, columns as they are.

    Each row is written beside its histograms and filtered when it is read again, so texts
    are neither joined nor shuffled; every row is judged by its own text.
    """
    limits = {**LIMITS, **limits}
    hists = write_scratch(histograms(docs, common_words=limits["common_words"], id_col=id_col, text_col=text_col,
                                     lang_col=lang_col, keep_row=True), "histograms")
    return _judged(hists, **limits).filter("kept").select("row.*")
