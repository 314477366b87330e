"""A hidden Markov language model, trained by Baum-Welch over partitions.

A word's probability is that of its class in the hidden state times its own share of the
class.  Classes are hash buckets, so the tables that the tasks need are of fixed size.
Baum-Welch learns start, transition and class probabilities: each task sums expected counts
over its documents, Spark adds them up by class.  A word's share of its class comes from
the corpus's word counts, which stay a distributed table.  The end of a text is a class of
its own.  The scaled forward recursion gives a text's exact probability.

Texts are split once.  The words of a bounded group of texts are numbered together, and texts
are written as numbers; all rounds read those, and a word meets its count once for a group.

A text is cut into short segments; each segment's transfer matrix is computed for all
segments side by side, and the matrices are chained per text, so long texts take no longer
loops than short ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkdesk.llm.common import documents
from sparkdesk.session import write_scratch

#: The end of a text as a word; words are never empty.
END = b""
SEGMENT = 64
#: Products of so many steps are formed before they are scaled back.
RESCALE = 8
#: So many words are worked on side by side; a longer text makes a batch of its own.
BATCH_WORDS = 400_000
#: Texts are numbered together up to so many words, or so many different ones; a longer text makes a group of its own.
GROUP_WORDS, GROUP_DISTINCT = 2_000_000, 400_000
#: Columns of the numbered texts: a row for each text, and one for each group's words.
NUMBERED = ["group_id", "doc_id", "held_out", "n_tokens", "classes", "ranks", "words", "kinds", "times"]


@dataclass
class Model:
    """Start (K), transition (K, K) and class (classes + 1, K) probabilities; the last class is the end."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def first(cls, states: int, class_counts: np.ndarray, seed: int) -> Model:
        """Sticky states whose class probabilities differ at random around the corpus's own."""
        noise = np.exp(np.random.default_rng(seed).normal(size=(len(class_counts), states)))
        emit = (class_counts[:, None] + 0.1) * noise
        move = np.full((states, states), 0.1 / max(1, states - 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=0))

    @classmethod
    def from_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Model:
        share = lambda x, smooth, axis: (x + smooth) / (x + smooth).sum(axis=axis, keepdims=True)
        return cls(share(start, 0.1, 0), share(move, 0.1, 1), share(emit, 0.1, 0))


class _Segments:
    """The class numbers of some texts, cut into segments of equal length.

    The last axis of all tables is the segment, so that each step works on long rows.
    """

    def __init__(self, texts: list[np.ndarray], model: Model):
        counts = np.array([-(-len(t) // SEGMENT) for t in texts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        classes = np.full((self.first[-1], SEGMENT), -1, np.int64)
        for t, at in zip(texts, self.first):
            classes[at:at + -(-len(t) // SEGMENT)].flat[:len(t)] = t
        self.classes = np.ascontiguousarray(classes.T)
        self.there = self.classes >= 0
        self.starts = self.first[:-1]
        self.counts, self.model = counts, model
        self.emit = np.empty((SEGMENT, len(model.start), self.first[-1]))
        for k in range(len(model.start)):
            self.emit[:, k] = np.ascontiguousarray(model.emit[:, k])[self.classes]
        self.absent = [np.flatnonzero(~self.there[t]) for t in range(SEGMENT)]
        self.transfer, self.scale = self._transfers()

    def _transfers(self) -> tuple[np.ndarray, np.ndarray]:
        """Each segment's product of (move, emit) and the log of what was divided out of it."""
        n, k = self.classes.shape[1], len(self.model.start)
        product, scale = np.repeat(np.eye(k)[:, :, None], n, axis=2), np.zeros(n)
        for t in range(SEGMENT):
            moved = np.matmul(self.model.move.T, product)
            if t == 0:
                moved[:, :, self.starts] = product[:, :, self.starts]
            moved *= self.emit[t]
            moved[:, :, self.absent[t]] = product[:, :, self.absent[t]]
            product = moved
            if t % RESCALE == RESCALE - 1:
                total = product.sum(axis=(0, 1))
                product /= total
                scale += np.log(total)
        return product, scale

    def forward(self) -> tuple[np.ndarray, np.ndarray]:
        """The state probabilities before each segment, and each text's log probability."""
        before = np.empty((len(self.model.start), self.classes.shape[1]))
        logs = np.zeros(len(self.counts))
        alive, now = np.arange(len(self.counts)), np.repeat(self.model.start[:, None], len(self.counts), axis=1)
        for j in range(self.counts.max(initial=0)):
            keep = self.counts[alive] > j
            alive, now = alive[keep], now[:, keep]
            at = self.first[alive] + j
            before[:, at] = now
            now = np.einsum("ks,kls->ls", now, self.transfer[:, :, at])
            total = now.sum(axis=0)
            now /= total
            logs[alive] += np.log(total) + self.scale[at]
        return before, logs

    def _backward(self) -> np.ndarray:
        """What follows each segment, up to a factor."""
        after = np.ones((len(self.model.start), self.classes.shape[1]))
        for j in range(self.counts.max(initial=0) - 2, -1, -1):
            at = self.first[:-1][self.counts > j + 1] + j
            follows = np.einsum("kls,ls->ks", self.transfer[:, :, at + 1], after[:, at + 1])
            # the next segment's product already holds the move into it
            after[:, at] = follows / follows.sum(axis=0)
        return after

    def expected(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts: start, moves, and (class, states) for each word."""
        k, move = len(self.model.start), self.model.move
        before, _ = self.forward()
        alphas = np.empty((SEGMENT, k, self.classes.shape[1]))
        now, divided = before, {}
        for t in range(SEGMENT):
            moved = np.matmul(move.T, now, out=alphas[t])
            if t == 0:
                moved[:, self.starts] = now[:, self.starts]
            moved *= self.emit[t]
            moved[:, self.absent[t]] = now[:, self.absent[t]]
            if t % RESCALE == RESCALE - 1:
                divided[t] = moved.sum(axis=0)
                moved /= divided[t]
            now = moved
        beta, moves = self._backward(), np.zeros((k, k))
        gammas = np.empty((SEGMENT, k, self.classes.shape[1]))
        for t in range(SEGMENT - 1, -1, -1):
            gamma = np.multiply(alphas[t], beta, out=gammas[t])
            total = gamma.sum(axis=0)
            gamma /= total
            ahead = self.emit[t] * beta
            # the sum over moves into this word is the same total, but for what was divided out
            weight = 1 / (total * divided[t] if t in divided else total)
            weight[self.absent[t]] = 0.0
            if t == 0:
                weight[self.starts] = 0.0
            moves += move * ((alphas[t - 1] if t else before) @ (ahead * weight).T)
            back = move @ ahead
            back[:, self.absent[t]] = beta[:, self.absent[t]]
            if t % RESCALE == 0:
                back /= back.sum(axis=0)
            beta = back
        start = gammas[0][:, self.starts].sum(axis=1)
        return start, moves, self.classes[self.there], np.array([gammas[:, i][self.there] for i in range(k)]).T


class _Numbers(dict):
    """Words numbered in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def words_of(text: str) -> list[bytes]:
    """A-Z in lower case, cut at ASCII white space."""
    return text.encode().lower().split()


def class_of(word: bytes, classes: int) -> int:
    """A word's class; the end is a class of its own, after all others."""
    return xxhash.xxh3_64_intdigest(word) % classes if word else classes


def _number_kind(largest: int) -> type:
    """The narrowest of two number types that holds ``largest``."""
    return np.uint16 if largest < 1 << 16 else np.uint32


class _Group:
    """Some texts whose words are numbered together, so that each word is looked up once for all of them."""

    def __init__(self):
        self.number, self.size = _Numbers(), 0
        self.ids, self.held, self.texts = [], [], []

    def add(self, doc_id, held: bool, text: str) -> None:
        words = words_of(text)
        words.append(END)
        self.texts.append(np.fromiter(map(self.number.__getitem__, words), np.uint32, len(words)))
        self.ids.append(doc_id)
        self.held.append(held)
        self.size += len(words)

    def full(self) -> bool:
        return self.size >= GROUP_WORDS or len(self.number) >= GROUP_DISTINCT

    def batches(self, group_id: int, classes: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """The texts, a row each, and one row of the group's words by class.

        A token is its word's class and the word's rank among the group's words of that class; the end
        that each text has is left out.
        """
        count, words = len(self.texts), list(self.number)
        kinds = np.fromiter((class_of(w, classes) for w in words), np.int64, len(words))
        order = np.argsort(kinds, kind="stable")
        by_class = kinds[order]
        ranks = np.empty(len(words), np.int64)
        ranks[order] = np.arange(len(words)) - np.searchsorted(by_class, by_class)
        train = [t for t, held in zip(self.texts, self.held) if not held]
        times = np.bincount(np.concatenate(train), minlength=len(words)) if train else np.zeros(len(words), np.int64)
        coded = lambda table, kind: pa.array([table[t[:-1]].astype(kind).tobytes() for t in self.texts], pa.binary())
        no = lambda kind, n: pa.nulls(n, kind)
        listed = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        yield pa.RecordBatch.from_arrays(
            [pa.array([group_id] * count, pa.int64()), pa.array(self.ids, id_type), pa.array(self.held, pa.bool_()),
             pa.array([len(t) for t in self.texts], pa.int64()),
             coded(kinds, _number_kind(classes - 1)), coded(ranks, np.min_scalar_type(int(ranks.max()))),
             no(pa.list_(pa.binary()), count), no(pa.list_(pa.int32()), count), no(pa.list_(pa.int64()), count)], NUMBERED)
        yield pa.RecordBatch.from_arrays(
            [pa.array([group_id], pa.int64()), no(id_type, 1), no(pa.bool_(), 1), no(pa.int64(), 1), no(pa.binary(), 1), no(pa.binary(), 1),
             listed(pa.array([words[i] for i in order], pa.binary())), listed(pa.array(by_class, pa.int32())),
             listed(pa.array(times[order], pa.int64()))], NUMBERED)


def _numbered(docs: DataFrame, classes: int) -> DataFrame:
    """(doc_id, held_out, text) with words as numbers; the only place where texts are split.

    A group's number is that of its task and its place there, so it is unique in a written table.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group_id, group, id_type = TaskContext.get().partitionId() << 32, _Group(), None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, held, text in zip(*batch.columns):
                group.add(doc_id.as_py(), held.as_py(), text.as_py())
                if group.full():
                    yield from group.batches(group_id, classes, id_type)
                    group_id, group = group_id + 1, _Group()
        if group.texts:
            yield from group.batches(group_id, classes, id_type)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        work, f"group_id bigint, doc_id {kind}, held_out boolean, n_tokens bigint, classes binary, ranks binary, "
              "words array<binary>, kinds array<int>, times array<bigint>")


def _batched(texts: Iterable[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Some texts at a time, about BATCH_WORDS words."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= BATCH_WORDS:
            yield some
            some, size = [], 0
    if some:
        yield some


def _expected_counts(texts: DataFrame, model: Model, classes: int) -> Model:
    """One Baum-Welch step: each task's expected counts, added up by class (a fixed number of rows)."""
    states, kind = len(model.start), _number_kind(classes - 1)
    sent = texts.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        emit = np.zeros((states, classes + 1))
        start, move = np.zeros(states), np.zeros((states, states))
        values = (value for batch in batches for value in batch.column(0))
        for some in _batched(np.append(np.frombuffer(v.as_py(), kind), np.int64(classes)) for v in values):
            s, m, seen, gamma = _Segments(some, model).expected()
            start, move = start + s, move + m
            for k in range(states):
                emit[k] += np.bincount(seen, gamma[:, k], classes + 1)
        used = np.flatnonzero(emit.any(axis=0))
        sums = np.hstack([emit[:, used], start[:, None], move.T])
        index = np.concatenate([used, np.arange(classes + 1, classes + 2 + states)])
        yield pa.RecordBatch.from_arrays([pa.array(index, pa.int32()), *[pa.array(sums[k]) for k in range(states)]],
                                         ["i", *[f"s{k}" for k in range(states)]])

    cols = [f"s{k}" for k in range(states)]
    sums = (texts.select("classes").mapInArrow(work, "i int, " + ", ".join(f"{c} double" for c in cols))
            .groupBy("i").agg(*[F.sum(c).alias(c) for c in cols]))
    table = np.zeros((classes + 2 + states, states))
    got = sums.toArrow()
    table[np.asarray(got.column("i"))] = np.column_stack([np.asarray(got.column(c)) for c in cols]) if got.num_rows else 0.0
    sent.unpersist()
    return Model.from_counts(table[classes + 1], table[classes + 2:], table[:classes + 1])


def _scored(texts: DataFrame, vocabulary: DataFrame, model: Model, class_logs: np.ndarray) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, log_sum, score) of texts and their groups' counted words.

    Each group's texts meet its words in one task: a group's size is bounded, but for a text that is longer.
    ``log_sum`` adds up log10(c + 1) over all tokens.
    """
    sent, kind = texts.sparkSession.sparkContext.broadcast((model, np.append(class_logs, 0.0))), _number_kind(len(class_logs) - 1)

    def work(texts: pa.Table, words: pa.Table) -> pa.Table:
        model, logs = sent.value
        number, c = np.asarray(words["number"]), np.asarray(words["c"])
        kinds, lg = np.empty(len(number), np.int64), np.empty(len(number))
        kinds[number], lg[number] = np.asarray(words["kind"]), np.log10(c + 1)
        share = np.where(kinds < len(logs) - 1, lg - logs[kinds], 0.0)
        first = np.searchsorted(kinds, np.arange(len(logs)))
        known, log_sum, score = [], [], []

        def numbers(of_class: bytes, ranks: bytes, n_tokens: int) -> np.ndarray:
            out = np.full(n_tokens, len(number) - 1)  # the end is the last of a group's words
            if n_tokens > 1:
                out[:-1] = first[np.frombuffer(of_class, kind)] + np.frombuffer(ranks, f"u{len(ranks) // (n_tokens - 1)}")
            return out

        coded = map(numbers, *(texts[c].to_pylist() for c in ("classes", "ranks", "n_tokens")))
        for some in _batched(coded):
            tokens = np.concatenate(some)
            at = np.cumsum([0, *map(len, some[:-1])])
            known.append(np.add.reduceat((lg > 0)[tokens].astype(np.int64), at))
            log_sum.append(np.add.reduceat(lg[tokens], at))
            hidden = _Segments([kinds[t] for t in some], model).forward()[1] / np.log(10)
            score.append(hidden + np.add.reduceat(share[tokens], at))
        joined = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.empty(0), kind)
        return pa.table({"doc_id": texts["doc_id"], "held_out": texts["held_out"], "n_tokens": texts["n_tokens"],
                         "n_known": joined(known, pa.int64()), "log_sum": joined(log_sum, pa.float64()),
                         "score": joined(score, pa.float64())})

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return (texts.select("group_id", "doc_id", "held_out", "n_tokens", "classes", "ranks").groupBy("group_id")
            .cogroup(vocabulary.groupBy("of_group"))
            .applyInArrow(work, f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, log_sum double, score double"))


def score_documents(docs: DataFrame, *, states: int = 4, classes: int = 1 << 16, rounds: int = 4, seed: int = 7,
                    folds: int = 7, held_fold: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents whose crc32(doc_id as text) mod ``folds`` is ``held_fold`` are held out; all others
    train.  ``base_score`` is the log10 probability by smoothed word counts, ``score`` by the
    hidden Markov model.  A word's share of its class is (c + 1) / (C + V + 1), with C tokens
    and V distinct words of the class in training, so unseen words have one share too.

    Null and empty texts are an end alone; a null doc_id trains; a word seen nowhere counts
    as unseen; very long texts are scored whole; repeated rows and rows that share a doc_id
    (null too) are scored each by its own words, so ties do not arise; with nothing to train
    on all counts are zero; an empty table gives no rows; other columns are ignored.
    """
    fold = F.coalesce(F.pmod(F.crc32(docs[id_col].cast("string")), F.lit(folds)), F.lit(held_fold + 1))
    numbered = write_scratch(_numbered(documents(docs, id_col, text_col, (fold == held_fold).alias("held_out")), classes),
                             "numbered", compression="zstd")
    texts = numbered.filter(F.col("classes").isNotNull())
    train = texts.filter(~F.col("held_out"))
    words = (numbered.filter(F.col("words").isNotNull())
             .select("group_id", F.posexplode(F.arrays_zip("words", "kinds", "times")).alias("number", "x"))
             .select(F.col("group_id").alias("of_group"), "number", F.col("x.words").alias("word"), F.col("x.kinds").alias("kind"), F.col("x.times").alias("times")))
    alike = Window.partitionBy("word")
    vocabulary = write_scratch(
        words.select("of_group", "number", "kind", "times", F.sum("times").over(alike).alias("c"),
                     (F.row_number().over(alike.orderBy("of_group")) == 1).alias("is_first")), "vocabulary", compression="zstd")
    by_class = np.zeros((classes + 1, 2))
    for kind, n, v in vocabulary.groupBy("kind").agg(F.sum("times"), F.count_if(F.col("is_first") & (F.col("c") > 0))).collect():
        by_class[kind] = n, v
    total, distinct = by_class.sum(axis=0)
    class_logs = np.log10(by_class[:classes].sum(axis=1) + 1)
    model = Model.first(states, by_class[:, 0], seed)
    for _ in range(rounds):
        model = _expected_counts(train, model, classes)
    unit = float(np.log10(total + distinct + 1))
    return (_scored(texts, vocabulary.select("of_group", "number", "kind", "c"), model, class_logs)
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("bigint").alias("train_tokens"),
                    (F.col("log_sum") - unit * F.col("n_tokens")).alias("base_score"), "score"))
