"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ``order`` bytes with the counts of the
bytes that followed them.  A byte that a context never saw costs an escape to the next
shorter context, where the bytes of the longer one are excluded; at the end every byte
is still possible.  So the code lengths of all bytes in a context are those of a true
distribution, and a text's code length is its log probability under frozen counts.

With frozen counts the length depends on a byte and the ``order`` bytes before it alone.
Such a gram is a number; a batch's grams are looked up in a table of grams met before, and
only new ones go through the trees, side by side.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkdesk.llm.common import documents

#: Texts without any of these are of no language.
LETTER = r"\p{L}"
UNDETERMINED = "und"
#: A gram's number holds its bytes, and its count of context bytes from this bit on.
LENGTH_BIT = 56
MOST_CONTEXT = 6
#: So many bytes are worked on side by side.
BLOCK = 1 << 20
#: Slots of the table of grams met before; a gram that finds its slot taken replaces the other.
SLOTS = 1 << 20


def gram_numbers(data: np.ndarray, context: np.ndarray, order: int, begin: int, end: int) -> np.ndarray:
    """The grams that end at the places ``begin`` to ``end`` of ``data``; ``context`` says how many
    bytes before each place belong to its text, ``order`` at most."""
    out = data[begin:end].astype(np.uint64)
    have = context[begin:end]
    for back in range(1, order + 1):
        far = np.zeros(end - begin, np.uint64)
        lost = max(0, back - begin)
        far[lost:] = data[begin - back + lost:end - back]
        out |= np.where(have >= back, far << np.uint64(8 * back), np.uint64(0))
    return out | (have.astype(np.uint64) << np.uint64(LENGTH_BIT))


def _texts(column: Iterable, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of some texts, each byte's count of context bytes, and the texts' ends."""
    parts = [np.frombuffer(t.as_buffer(), np.uint8) if t.is_valid else np.empty(0, np.uint8) for t in column]
    ends = np.cumsum([len(p) for p in parts]).astype(np.int64)
    context = np.full(int(ends[-1]) if parts else 0, order, np.uint8)
    for end, part in zip(ends, parts):
        first = min(order, len(part))
        context[end - len(part):end - len(part) + first] = np.arange(first)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint8)), context, ends


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key, or -1."""
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


@dataclass
class Level:
    """The contexts of one length.

    ``total`` and ``distinct`` count the bytes after a context and the different ones; the
    ``left_`` pair is what stays at its next shorter context once its own bytes are excluded.
    """

    contexts: np.ndarray
    total: np.ndarray
    distinct: np.ndarray
    left_total: np.ndarray
    left_distinct: np.ndarray
    grams: np.ndarray
    times: np.ndarray


class ContextTree:
    """The frozen counts of one language."""

    def __init__(self, grams: np.ndarray, times: np.ndarray, order: int):
        """From the counts of all grams of full length, and of the shorter ones that begin texts."""
        length = grams >> np.uint64(LENGTH_BIT)
        self.levels: list[Level] = []
        for size in range(order + 1):
            mask = np.uint64((1 << (8 * (size + 1))) - 1)
            here = length >= size
            keys, at = np.unique(grams[here] & mask, return_inverse=True)
            n = np.bincount(at, times[here], len(keys))
            contexts, first = np.unique(keys >> np.uint64(8), return_index=True)
            distinct = np.diff(np.append(first, len(keys)))
            total = np.add.reduceat(n, first) if len(first) else np.empty(0)
            if not len(keys):
                break
            if size:
                up = self.levels[size - 1]
                shorter = _find(up.grams, keys & (mask >> np.uint64(8)))
                parent = _find(up.contexts, contexts & (mask >> np.uint64(16)))
                left_total = up.total[parent] - np.add.reduceat(up.times[shorter], first)
                left_distinct = up.distinct[parent] - distinct
            else:
                left_total, left_distinct = np.zeros(1), 256 - distinct
            self.levels.append(Level(contexts, total, distinct, left_total, left_distinct, keys, n))

    def code_lengths(self, grams: np.ndarray) -> np.ndarray:
        """Bits of each gram's last byte after the others, by the longest contexts first."""
        length = (grams >> np.uint64(LENGTH_BIT)).astype(np.int64)
        bits = np.zeros(len(grams))
        open_ = np.arange(len(grams))
        longer = np.full(len(grams), -1)  # the context that was escaped from, one byte longer
        for size in range(len(self.levels) - 1, -1, -1):
            level = self.levels[size]
            mask = np.uint64((1 << (8 * (size + 1))) - 1)
            now = open_[length[open_] >= size]
            keys = grams[now] & mask
            context = _find(level.contexts, keys >> np.uint64(8))
            known = context >= 0
            now, keys, context = now[known], keys[known], context[known]
            total, distinct = level.total[context], level.distinct[context]
            came = longer[now]
            if size + 1 < len(self.levels):
                above = self.levels[size + 1]
                total = np.where(came >= 0, above.left_total[came], total)
                distinct = np.where(came >= 0, above.left_distinct[came], distinct)
            place = _find(level.grams, keys)
            seen = place >= 0
            bits[now[seen]] += np.log2(total[seen] + distinct[seen]) - np.log2(level.times[place[seen]])
            escaped = ~seen & (distinct > 0)  # with no byte left the escape is certain
            bits[now[escaped]] += np.log2(total[escaped] + distinct[escaped]) - np.log2(distinct[escaped])
            longer[now] = context
            open_ = np.setdiff1d(open_, now[seen], assume_unique=True)
        # UTF-8 never uses all 256 bytes, so some are left to share what remains
        bits[open_] += np.log2(self.levels[0].left_distinct[0])
        return bits


class Languages:
    """The trees of all languages, and the grams that this worker has met."""

    def __init__(self, trees: dict[str, ContextTree], order: int):
        self.names, self.order = sorted(trees), order
        self.trees = [trees[n] for n in self.names]
        self.keys = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
        self.bits = np.zeros((SLOTS, len(self.names)))

    def __getstate__(self) -> dict:
        return {"names": self.names, "order": self.order, "trees": self.trees}

    def __setstate__(self, state: dict) -> None:
        self.__init__(dict(zip(state["names"], state["trees"])), state["order"])

    def _bits(self, grams: np.ndarray) -> np.ndarray:
        slot = ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64) % SLOTS
        new = np.flatnonzero(self.keys[slot] != grams)
        out = self.bits[slot]
        if len(new):
            fresh, first, at = np.unique(grams[new], return_index=True, return_inverse=True)
            found = np.column_stack([t.code_lengths(fresh) for t in self.trees])
            out[new] = found[at]
            self.keys[slot[new[first]]] = fresh
            # two new grams of one slot: the last written key must meet its own lengths
            self.bits[slot[new[first]]] = found
        return out

    def code_lengths(self, column: Iterable) -> np.ndarray:
        """Bits of each text in each language: (texts, languages)."""
        data, context, ends = _texts(column, self.order)
        out = np.zeros((len(ends), len(self.names)))
        for begin in range(0, len(data), BLOCK):
            end = min(len(data), begin + BLOCK)
            bits = self._bits(gram_numbers(data, context, self.order, begin, end))
            text = np.searchsorted(ends, np.arange(begin, end), side="right")
            first = text[0]
            for k in range(len(self.names)):
                sums = np.bincount(text - first, bits[:, k])
                out[first:first + len(sums), k] += sums
        return out


def training_sample(docs: DataFrame, *, rows_per_language: int, max_bytes: int, max_languages: int) -> DataFrame:
    """(lang, text): the rows of (lang, text, row) to learn from.

    Of each of the ``max_languages`` most frequent languages the ``rows_per_language`` rows
    with the least hashes, of texts up to ``max_bytes`` bytes.  Rows of one hash are repeats.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()
                         & (F.octet_length("text") <= max_bytes))
    counts = (usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages))
    # a hash below this share of all: about twice the rows that are needed, at any size
    span = F.lit(2.0 ** 64) * F.least(F.lit(1.0), F.lit(2.0 * rows_per_language + 100) / F.col("n"))
    below = F.broadcast(counts.select("lang", (F.lit(-2.0 ** 63) + span).alias("most")))
    near = usable.join(below, "lang").filter(F.col("row").cast("double") <= F.col("most")).select("lang", "text", "row")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("row"))
    chosen = near.select("lang", "row").distinct().select("lang", "row", place.alias("place"))
    chosen = chosen.filter(F.col("place") <= rows_per_language).select("lang", "row")
    return near.join(F.broadcast(chosen), ["lang", "row"]).select("lang", "text")


def gram_counts(sample: DataFrame, order: int) -> DataFrame:
    """(lang, gram, c) of (lang, text); combined within each batch first."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                data, context, _ = _texts(batch.column(1).filter(pa.array(langs == lang)), order)
                for begin in range(0, len(data), BLOCK):
                    end = min(len(data), begin + BLOCK)
                    grams, times = np.unique(gram_numbers(data, context, order, begin, end), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)),
                         pa.array(times, pa.int64())], ["lang", "gram", "c"])

    return sample.mapInArrow(work, "lang string, gram bigint, c bigint").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def learn(sample: DataFrame, order: int) -> Languages:
    """The trees of a sample of (lang, text); the bound of the sample bounds what the driver gets."""
    if not 0 <= order <= MOST_CONTEXT:
        raise ValueError(f"order must be 0 to {MOST_CONTEXT}")
    got = gram_counts(sample, order).toArrow()
    langs = got.column("lang").to_numpy(zero_copy_only=False)
    grams, times = got.column("gram").to_numpy().view(np.uint64), got.column("c").to_numpy().astype(float)
    return Languages({name: ContextTree(grams[langs == name], times[langs == name], order) for name in sorted(set(langs))}, order)


def identify_languages(docs: DataFrame, *, order: int = 4, rows_per_language: int = 400, max_bytes: int = 1 << 16,
                       max_languages: int = 200, folds: int = 4, held_fold: int = 2, id_col: str = "doc_id",
                       text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score, bits_per_byte.

    Documents whose crc32(doc_id as text) mod ``folds`` is ``held_fold`` are held out.  The trees
    are fitted on a bounded sample of the other rows that have a language: at most
    ``rows_per_language`` texts of at most ``max_bytes`` bytes for each of ``max_languages``
    languages.  Every text is then scored whole, by its bytes alone: ``lang_pred`` has the
    shortest code, ``score`` is its posterior probability if all languages are equally
    likely before, ``bits_per_byte`` its code length over the text's bytes.

    Null, empty and letterless texts are ``und`` with score 0 and no bits; so is every text if there is
    nothing to learn from; very long texts are scored whole in blocks; of languages with
    equal codes the first by name is taken; repeated rows get equal results and are learned
    from as often as they are there; a null doc_id is not held out; an empty table gives no
    rows; other columns are ignored.
    """
    fold = F.coalesce(F.pmod(F.crc32(docs[id_col].cast("string")), F.lit(folds)), F.lit(held_fold + 1))
    d = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].cast("string").alias("lang"),
                    (fold == held_fold).alias("held_out"))
    train = d.filter(~F.col("held_out")).select("lang", "text", F.xxhash64("doc_id", "text").alias("row"))
    model = learn(training_sample(train, rows_per_language=rows_per_language, max_bytes=max_bytes,
                                  max_languages=max_languages), order)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            n, lettered = batch.num_rows, np.array(batch.column(3).to_pylist(), bool)
            langs, scores, rates = [UNDETERMINED] * n, [0.0] * n, [None] * n
            rows = np.flatnonzero(lettered) if model.names else np.empty(0, np.int64)
            if len(rows):
                texts = batch.column(1).take(pa.array(rows))
                bits = model.code_lengths(texts)
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(rows)), best]
                share = 1 / np.exp2(least[:, None] - bits).sum(axis=1)
                for i, k, p, b, t in zip(rows, best, share, least, texts):
                    langs[i], scores[i], rates[i] = model.names[k], float(p), float(b / t.as_buffer().size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(rates, pa.float64())], names)

    kind = d.schema["doc_id"].dataType.simpleString()
    text = documents(d, "doc_id", "text", F.col("held_out"), F.coalesce(F.col("text"), F.lit("")).rlike(LETTER).alias("lettered"))
    return text.mapInArrow(work, f"doc_id {kind}, held_out boolean, lang_pred string, score double, bits_per_byte double")
