"""The conversation trie against a plain one."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkdesk.llm.conversation_trie import DoubleArrayTrie, conversation_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
CLASHING = SCHEMA + ", key int, path string, n string, first int, shard string, ends int, top int, depth int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, *([None] * (schema.count(",") - 3))) for r in rows], schema)


def plain_trie(rows, group=20, heads=4):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), key, (role, text)))
    own = {c: [t for *_, t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - int(math.fmod(c, group))  # the remainder has the sign of c, as in SQL
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, cs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += kids[path] == 0
            saved[path[:d]] += (len(cs) - 1) * words
    sha = lambda cs: hashlib.sha256(",".join(map(str, sorted(cs))).encode()).hexdigest()
    return sorted(((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids[p], leaves[p], saved[p], sha(ends.get(p, [])))
                   for p, cs in members.items()), key=str)


def made(df):
    return sorted(map(tuple, df.collect()), key=str)


def random_rows(seed, convs=120, texts=4, longest=9):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "bot"]), " ".join(["w"] * rng.randrange(texts))) for c in range(convs)
            for t in range(rng.randrange(1, longest))]
    rng.shuffle(rows)
    return rows


#: Nulls, ties, repeated rows, copies, a common beginning, ids below zero, a base that is absent or short.
AWKWARD = ([(1, None, "user", "hi"), (1, 0, "user", None), (1, 1, None, "a  b\tc"), (1, 2, None, None), (None, 0, "user", "lost"),
            (0, 5, "user", "base one"), (0, 7, "bot", "base two"), (7, 0, "user", "x"), (7, 0, "user", "x"), (7, 0, "bot", "x"),
            (45, 1, "user", "no base"), (-3, 0, "user", "below"), (-3, 1, "user", "zero"), (-20, 0, "u", "base"), (47, 0, "u", "gone"),
            (21, 3, "long", "word " * 50_000), (22, 3, "", "long"), (23, 3, "lo", "ng")]
           + [(c, t, "user", f"copy {t}") for c in range(200, 260) for t in range(6)]
           + [(c, t, "user", "same start" if t < 5 else f"own {c}") for c in range(300, 340) for t in range(7)])


@pytest.mark.parametrize("schema", [SCHEMA, CLASHING], ids=["plain", "clashing"])
@pytest.mark.parametrize("shard_turns", [1 << 18, 30])
def test_awkward_rows(spark, schema, shard_turns):
    assert made(conversation_trie(frame(spark, AWKWARD, schema), shard_turns=shard_turns)) == plain_trie(AWKWARD)


@pytest.mark.parametrize("shard_turns", [1, 12, 100])
def test_random_conversations_in_split_shards(spark, shard_turns):
    rows = random_rows(shard_turns)
    assert made(conversation_trie(frame(spark, rows), shard_turns=shard_turns)) == plain_trie(rows)


def test_empty_and_turnless(spark):
    assert made(conversation_trie(frame(spark, []))) == []
    # c has no more turns than are replaced, and no base: it is a member of the root alone
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]
    assert made(conversation_trie(frame(spark, rows))) == plain_trie(rows) == [
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_one_long_conversation(spark):
    rows = [(0, t, "user", f"turn {t}") for t in range(3000)] + [(1, t, "user", f"turn {t}") for t in range(3000)]
    got = made(conversation_trie(frame(spark, rows), shard_turns=500))
    assert len(got) == 3001 and all(r[3] == 2 for r in got)
    assert got == sorted(((0, d, 0 if d else None, 2, int(d < 3000), 1, 2 * (3000 - max(d - 1, 0)), got[i][-1])
                          for i, d in enumerate(r[1] for r in got)), key=str)


@settings(deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=7), min_size=1, max_size=60))
def test_double_array(paths):
    trie = DoubleArrayTrie(paths)
    prefixes = {tuple(p[:d]) for p in paths for d in range(1, len(p) + 1)}
    node_of = {}
    for p in paths:
        walk = trie.nodes(p)
        assert len(walk) == len(p)
        for d, node in enumerate(walk, 1):
            assert node_of.setdefault(node, tuple(p[:d])) == tuple(p[:d])
    assert set(node_of.values()) == prefixes and sum(c >= 0 for c in trie.check) == len(prefixes) + 1
    assert all(trie.nodes([*p, 99]) == trie.nodes(p) for p in paths)
