"""Conversation prefix tries, packed as double arrays.

Conversations become paths of turn keys; equal paths are merged first, so copies cost one
path.  Paths are dealt into shards by a prefix that is long enough for a shard to be small:
one turn, and twice as many wherever a prefix is too frequent.  In a task some shards make
one trie over dense turn ids, packed into BASE and CHECK arrays: the child of node s by turn
t is at BASE[s] + t, if CHECK there names s.  Nodes below a shard's prefix are complete.
The few above it are shared between shards, and their aggregates are merged by Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.llm.common import SPACE_RUN, broadcast_if_small, whole_text, words_between
from sparkdesk.session import write_scratch

#: A prefix with more turns below it is split, and so many turns make one trie.
SHARD_TURNS = 1 << 18
#: Merged upper nodes are broadcast up to this measured size; beyond it they are joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20
#: Places tried for a node's children before they go to the end of the arrays.
TRIALS = 64

TURN = "struct<key:binary,n:bigint>"


class DoubleArrayTrie:
    """The trie of some paths of small numbers; node 0 is the root."""

    def __init__(self, paths: Sequence[Sequence[int]]):
        self.base, self.check = [0], [0]
        self._free = 1
        ordered = sorted(map(tuple, paths))
        todo = [(0, 0, len(ordered), 0)]
        while todo:
            node, low, high, depth = todo.pop()
            while low < high and len(ordered[low]) == depth:
                low += 1
            runs = []
            while low < high:
                label, begin = ordered[low][depth], low
                while low < high and ordered[low][depth] == label:
                    low += 1
                runs.append((label, begin, low))
            if runs:
                base = self.base[node] = self._place([r[0] for r in runs])
                for label, begin, end in runs:
                    self.check[base + label] = node
                    todo.append((base + label, begin, end, depth + 1))

    def _place(self, labels: list[int]) -> int:
        """A base at which all labels (ascending) find free places; makes room for them."""
        check, at, tried = self.check, self._free, 0
        while at < len(check) and check[at] >= 0:
            at += 1
        self._free = at
        while at < len(check) and tried < TRIALS:
            base = at - labels[0]
            if all(base + x >= len(check) or check[base + x] < 0 for x in labels):
                break
            tried += 1
            at += 1
            while at < len(check) and check[at] >= 0:
                at += 1
        else:
            at = len(check)
        base = at - labels[0]
        grow = base + labels[-1] + 1 - len(check)
        if grow > 0:
            check.extend([-1] * grow)
            self.base.extend([0] * grow)
        return base

    def nodes(self, path: Sequence[int]) -> list[int]:
        """The nodes of a path, the root left out; stops where the trie has no such child."""
        out, node = [], 0
        for label in path:
            nxt = self.base[node] + label
            if not 0 < nxt < len(self.check) or self.check[nxt] != node:
                break
            out.append(nxt)
            node = nxt
        return out


@dataclass
class _Shards:
    """The paths of some whole shards, and their turns as dense ids."""

    paths: list[list[int]] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    members: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    ends: list[str] = field(default_factory=list)
    ids: dict[bytes, int] = field(default_factory=dict)
    words: list[int] = field(default_factory=list)
    turns: int = 0

    def add(self, keys: list[bytes], words: list[int], depth: int, members: int, first: int, ends: str) -> None:
        path = []
        for key, n in zip(keys, words):
            turn = self.ids.setdefault(key, len(self.ids))
            if turn == len(self.words):
                self.words.append(n)
            path.append(turn)
        self.paths.append(path)
        self.depth.append(depth)
        self.members.append(members)
        self.first.append(first)
        self.ends.append(ends)
        self.turns += len(path)

    def rows(self) -> dict[str, list]:
        """All nodes: complete ones below the shards' prefixes, partial sums above them."""
        trie = DoubleArrayTrie(self.paths)
        walks = [trie.nodes(p) for p in self.paths]
        size, check = len(trie.check), np.array(trie.check)
        used = np.flatnonzero(check >= 0)
        flat = np.concatenate([np.array(w, np.int64) for w in walks])
        lengths = np.array([len(w) for w in walks])
        per_node = lambda values: np.repeat(np.array(values, np.int64), lengths)
        begin = np.cumsum(lengths) - lengths
        depth = np.zeros(size, np.int64)
        depth[flat] = np.arange(len(flat)) - np.repeat(begin, lengths) + 1
        shard_depth = np.full(size, 1 << 62)
        shard_depth[flat] = per_node(self.depth)
        local = depth >= shard_depth
        n, first = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
        np.add.at(n, flat, per_node(self.members))
        np.minimum.at(first, flat, per_node(self.first))
        n[0], first[0] = sum(self.members), min(self.first)
        words = np.zeros(size, np.int64)
        words[flat] = np.array(self.words, np.int64)[np.concatenate([np.array(p, np.int64) for p in self.paths])] if len(flat) else 0
        below = used[used > 0]
        children = np.bincount(check[below], minlength=size)
        leaves = (local & (children == 0)).astype(np.int64)
        saved = np.where(local, (n - 1) * words, 0)
        for d in range(int(depth.max()), 0, -1):
            here = below[depth[below] == d]
            np.add.at(leaves, check[here], leaves[here])
            np.add.at(saved, check[here], saved[here])
        tops = below[local[below] & ~local[check[below]]]
        upper_children = np.bincount(check[tops], minlength=size)
        ends = {w[-1] if w else 0: e for w, e in zip(walks, self.ends)}
        upper = self._upper_keys(walks, local)
        out = {"upper": [], "conv_id": first[used].tolist(), "depth": depth[used].tolist(), "parent_conv_id": [], "chain": [],
               "words": words[used].tolist(), "n_convs": n[used].tolist(), "n_children": [], "n_leaves": leaves[used].tolist(),
               "saved_tokens": saved[used].tolist(), "ends": []}
        for node in used.tolist():
            above = int(check[node])
            out["upper"].append(not local[node])
            out["ends"].append(ends.get(node))
            inside = local[node] and local[above]
            out["parent_conv_id"].append(int(first[above]) if inside else None)
            out["chain"].append(None if inside else upper[above] if local[node] else upper[node])
            out["n_children"].append(int(children[node] if local[node] else upper_children[node]))
        return out

    def _upper_keys(self, walks: list[list[int]], local: np.ndarray) -> dict[int, list[bytes]]:
        """Each upper node's key after those of the nodes above it; a key is a hash of the whole prefix."""
        turns = list(self.ids)
        chains = {0: [hashlib.sha256().digest()]}
        for walk, path in zip(walks, self.paths):
            above = 0
            for node, turn in zip(walk, path):
                if local[node]:
                    break
                if node not in chains:
                    chains[node] = [*chains[above], hashlib.sha256(chains[above][-1] + turns[turn]).digest()]
                above = node
        return chains


NODES = ("upper boolean, conv_id bigint, depth bigint, parent_conv_id bigint, chain array<binary>, words bigint, "
         "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string")
_ARROW = {"upper": pa.bool_(), "chain": pa.list_(pa.binary()), "ends": pa.string()}


def conversations(rows: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv_id, path): each conversation's turns in order, as a hash of role and text and its words."""
    role, text = whole_text(rows[role_col]), whole_text(rows[text_col])
    key = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = rows.filter(rows[id_col].isNotNull()).select(
        rows[id_col].cast("bigint").alias("conv_id"),
        F.struct(rows[turn_col].alias("turn"), key.alias("key"),
                 F.size(words_between(text, SPACE_RUN)).cast("bigint").alias("n")).alias("t"))
    in_order = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t.key.alias("key"), t.n.alias("n")))
    return turns.groupBy("conv_id").agg(in_order.alias("path"))


def rebuild(convs: DataFrame, *, group: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, path): conversation c begins with the first h turns of conversation c - c % group,
    h = crc32(c) mod heads, and goes on with its own turns after its first h.  The remainder
    of an id below zero has its sign, as in SQL."""
    base = convs.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice("path", 1, heads - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    none = F.array().cast(f"array<{TURN}>")
    return (convs.withColumn("h", h).join(base, F.col("conv_id") - F.col("conv_id") % group == F.col("base"), "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                                        F.slice("path", F.col("h") + 1, F.greatest(F.size("path"), F.lit(0)))).alias("path")))


def _prefix(turns: int | None = None) -> Column:
    """A hash of the path's first turns, or of all."""
    path = F.col("path") if turns is None else F.slice("path", 1, turns)
    return F.unhex(F.sha2(F.array_join(F.transform(path, lambda t: F.hex(t.key)), ""), 256))


def members(paths: DataFrame) -> DataFrame:
    """(seq, n, first, ends) of (seq, conv_id): how many conversations are equal, the smallest, and
    the SHA-256 of all their ids.  Ids come sorted and go by, so a group needs no memory."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, first, sha = None, 0, 0, None
        for batch in batches:
            done = []
            seqs, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            begin = 0
            while begin < len(seqs):
                end = begin
                while end < len(seqs) and seqs[end] == seqs[begin]:
                    end += 1
                if seqs[begin] != now:
                    if sha is not None:
                        done.append((now, n, first, sha.hexdigest()))
                    now, n, first, sha = seqs[begin], 0, ids[begin], hashlib.sha256()
                sha.update(("," * bool(n) + ",".join(map(str, ids[begin:end]))).encode())
                n, begin = n + end - begin, end
            yield from made(done)
        if sha is not None:
            yield from made([(now, n, first, sha.hexdigest())])

    def made(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            types = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["seq", "n", "first", "ends"])

    return (paths.select("seq", "conv_id").repartition("seq").sortWithinPartitions("seq", "conv_id")
            .mapInArrow(work, "seq binary, n bigint, first bigint, ends string"))


def shards(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Adds ``shard`` and ``top``, the depth from which a shard's nodes are its own.

    A prefix that holds more than ``shard_turns`` turns is doubled, until a shard is small or one path.
    """
    rest, top, parts = paths, 1, []
    while True:
        keyed = rest.withColumn("shard", _prefix(top)).withColumn("top", F.lit(top))
        hot = write_scratch(keyed.groupBy("shard").agg(F.sum(F.size("path")).alias("turns"), F.max(F.size("path")).alias("deepest"))
                            .filter((F.col("turns") > shard_turns) & (F.col("deepest") > top)).select("shard"), "trie_hot")
        if hot.isEmpty():
            parts.append(keyed)
            break
        small = broadcast_if_small(hot, max_rows=BROADCAST_ROWS, max_bytes=BROADCAST_BYTES, size_col="shard")
        parts.append(keyed.join(small, "shard", "left_anti"))
        rest = write_scratch(keyed.join(small, "shard", "left_semi").drop("shard", "top"), "trie_rest")
        top *= 2
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def shard_nodes(sharded: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of each shard: those below its prefix complete, those above it in part."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = _Shards(), None
        for batch in batches:
            shard, top, n, first, ends = (batch.column(c).to_pylist() for c in ("shard", "top", "n", "first", "ends"))
            for i, path in enumerate(batch.column("path")):
                if held.turns >= shard_turns and shard[i] != now:
                    yield made(held)
                    held = _Shards()
                now, turns = shard[i], path.values
                held.add(turns.field("key").to_pylist(), turns.field("n").to_pylist(), top[i], n[i], first[i], ends[i])
        if held.paths:
            yield made(held)

    def made(held: _Shards) -> pa.RecordBatch:
        rows = held.rows()
        return pa.RecordBatch.from_arrays([pa.array(v, _ARROW.get(k, pa.int64())) for k, v in rows.items()], list(rows))

    return (sharded.select("shard", "top", "path", "n", "first", "ends").repartition("shard").sortWithinPartitions("shard")
            .mapInArrow(work, NODES))


def merged_upper(nodes: DataFrame) -> DataFrame:
    """The nodes that shards share, their sums added up; ``key`` names a node by its prefix."""
    key, above = F.element_at("chain", -1), F.when(F.size("chain") > 1, F.element_at("chain", -2))
    total = lambda c: F.sum(c).alias(c)
    up = write_scratch(nodes.filter("upper").withColumn("key", key).groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("words").alias("words"), F.max("ends").alias("ends"),
        F.max("chain").alias("chain"), *map(total, ("n_convs", "n_children", "n_leaves", "saved_tokens"))).withColumn("above", above), "trie_upper")
    kids = up.groupBy(F.col("above").alias("key")).agg(F.count("*").alias("kids"))
    up = (up.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
          .withColumn("own_leaf", (F.col("n_children") == 0).cast("bigint"))
          .withColumn("own_saved", (F.col("n_convs") - 1) * F.col("words")))
    own = (up.select(F.explode("chain").alias("key"), "own_leaf", "own_saved").groupBy("key")
           .agg(F.sum("own_leaf").alias("more_leaves"), F.sum("own_saved").alias("more_saved")))
    parents = up.select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    return (up.join(own, "key").join(parents, "above", "left")
            .select("key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                    (F.col("n_leaves") + F.col("more_leaves")).alias("n_leaves"),
                    (F.col("saved_tokens") + F.col("more_saved")).alias("saved_tokens"), "ends"))


def trie_nodes(convs: DataFrame, *, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Per node of the trie of (conv_id, path): conv_id (the smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends (SHA-256 of the ids that end here).

    A conversation without turns is a member of the root alone; an empty table gives no rows,
    not even a root.  Any number of equal conversations or of conversations with one
    beginning is worked on: equal ones are merged, and a frequent beginning is split
    further.  A single path is one row (40 bytes a turn).
    """
    paths = write_scratch(convs.withColumn("seq", _prefix()), "trie_paths")
    once = members(paths).join(paths.select(F.col("conv_id").alias("first"), "path"), "first")
    once = write_scratch(once, "trie_distinct")
    nodes = write_scratch(shard_nodes(shards(once, shard_turns), shard_turns), "trie_nodes")
    up = write_scratch(merged_upper(nodes), "trie_merged")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    parents = broadcast_if_small(up.select("key", F.col("conv_id").alias("top_parent")), max_rows=BROADCAST_ROWS,
                                 max_bytes=BROADCAST_BYTES, size_col="key")
    below = nodes.filter("not upper").withColumn("key", F.element_at("chain", -1)).join(parents, "key", "left")
    below = below.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "top_parent"))
    return (below.select(*columns).unionByName(up.select(*columns))
            .withColumn("ends", F.coalesce("ends", F.sha2(F.lit(""), 256))))


def conversation_trie(rows: DataFrame, *, group: int = 20, heads: int = 4, shard_turns: int = SHARD_TURNS,
                      id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """``trie_nodes`` of the conversations in ``rows``, rebuilt by ``rebuild``.

    Turns are ordered by ``turn_col``, null first, ties by the SHA-256 of role and text; null
    roles and texts are empty; repeated rows are turns of their own; rows without a
    conversation id belong to none and are left out; very long texts are only hashed and
    their words counted; an empty table gives no rows; other columns are ignored.
    """
    convs = write_scratch(conversations(rows, id_col=id_col, turn_col=turn_col, role_col=role_col, text_col=text_col),
                          "trie_conversations")
    return trie_nodes(rebuild(convs, group=group, heads=heads), shard_turns=shard_turns)
