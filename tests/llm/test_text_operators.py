"""Each operator against a brute-force version, on awkward rows, clashing columns and empty tables."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import CLASHING, SCHEMA, awkward_rows, frame, lower_az, space_words, unique, vocabulary
from pyspark.sql import functions as F

from sparkdesk.llm import (
    byte_bpe,
    decontaminate,
    hmm,
    host_reputation,
    line_chunks,
    quality_rules,
    queries,
    secrets,
    severity,
    simhash,
    substrings,
)


def by_id(df):
    """Rows by doc_id, a list for each."""
    out = defaultdict(list)
    for r in df.collect():
        out[r.doc_id].append(r)
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    return awkward_rows()


@pytest.fixture(scope="module", params=[SCHEMA, CLASHING], ids=["plain", "clashing"])
def docs(spark, rows, request):
    return frame(spark, rows, request.param)


def test_quality_counts(docs, rows):
    got = by_id(quality_rules.quality_rules(docs))
    for i, text, *_ in unique(rows):
        text, (r,) = text or "", got[i]
        words = space_words(text)
        grams = [tuple(words[j:j + 3]) for j in range(len(words) - 2)]
        times = Counter(grams)
        repeat = len({j + k for j, g in enumerate(grams) if times[g] > 1 for k in range(3)})
        lines = [x for x in text.split("\n") if space_words(x)]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
        failed = len(words) < 50 or 100 * repeat > 50 * len(words)
        assert r.base_failed == failed and not (failed and r.kept)
    # the two rows of 23 may name different languages, whose references they are judged by
    assert len(got[23]) == 2 and tuple(got[23][0])[:6] == tuple(got[23][1])[:6] and len(got[None]) == 2


def test_quality_hash_collisions_are_compared(spark, monkeypatch):
    """With no hash bits left every place is a suspect, and the words decide."""
    rows = [(1, "a b c x a b c y " + " ".join(vocabulary()[:60]), "en", "s"), (2, " ".join(vocabulary()[:80]), "en", "s")]
    monkeypatch.setattr(quality_rules, "PLACE_BITS", 62)
    monkeypatch.setattr(quality_rules, "PLACE_MASK", (1 << 62) - 1)
    got = by_id(quality_rules.quality_rules(frame(spark, rows)))
    assert [got[i][0].n_repeat_words for i in (1, 2)] == [6, 0]


def test_quality_distance_separates_gibberish(spark):
    en = "the of and to in a is that for it as with people house water day of the and to in"
    rows = [(i, " ".join([en] * 8 + [f"w{i}", f"x{i}"]), "en", "s") for i in range(30)]
    rows = [(i, " ".join(w + str(j % 7) * (j % 3 == 5) for j, w in enumerate(t.split())), a, b) for i, t, a, b in rows]
    rows.append((99, " ".join(f"{j}%{j}#" for j in range(200)), "en", "s"))
    got = by_id(quality_rules.quality_rules(frame(spark, rows), max_repeat_percent=100))
    assert all(got[i][0].kept for i in range(30)) and not got[99][0].kept and not got[99][0].base_failed


def histogram_rows():
    """Clean English and German, symbol-decorated words, and letters without a common word."""
    rng = random.Random(5)
    made, common = vocabulary(3, 900), quality_rules.COMMON_WORDS
    prose = lambda lang, n: " ".join(rng.choice(common[lang]) if rng.random() < 0.45 else rng.choice(made) for _ in range(n))
    rows = [(i, prose("en", 150), "en", "s") for i in range(20)] + [(i, prose("de", 150), "de", "s") for i in range(20, 40)]
    sentences = " ".join(w.capitalize() if j % 6 == 0 else w for j, w in enumerate(prose("en", 200).split()))
    rows += [(40, sentences, "en", "s"), (41, prose("en", 200), None, "s"), (42, prose("en", 200), "xx", "s")]
    bad = [(50, " ".join(w + rng.choice(["$$$", "###", "&&&"]) for w in prose("en", 200).split()), "en", "s"),
           (51, " ".join(rng.choice(made) for _ in range(300)), "en", "s"), (52, " ".join(rng.choice(made) for _ in range(300)), None, "s"),
           (53, prose("en", 300), "de", "s")]
    return rows, bad


def test_quality_rejects_what_base_rules_pass(spark):
    clean, bad = histogram_rows()
    got = by_id(quality_rules.quality_rules(frame(spark, clean + bad + bad[:1])))
    assert len(got[50]) == 2 and got[50][0] == got[50][1]
    assert all(got[r[0]][0].kept for r in clean)
    assert all(not got[r[0]][0].kept and not got[r[0]][0].base_failed for r in bad)
    short = [(i, " ".join(t.split()[:80]), lang, s) for i, t, lang, s in bad]
    assert all(r.kept and r.word_share is None for r in quality_rules.quality_rules(frame(spark, short)).collect())


def test_quality_distances_by_hand(spark):
    """Both distances against their definition, by own language or the nearest."""
    clean, bad = histogram_rows()
    rows = clean + bad
    got = by_id(quality_rules.quality_rules(frame(spark, rows)))
    listed = sorted({w for ws in quality_rules.COMMON_WORDS.values() for w in ws})
    classes = {"lower": "abcdefghijklmnopqrstuvwxyzé", "space": " \n", "punct": "#&", "other": "$"}

    def hists(text):
        words = [w.lower() for w in space_words(text)]
        chars = [sum(c in cs for c in text) for cs in classes.values()] + [sum(c.isupper() for c in text)]
        return chars, [words.count(w) for w in listed] + [sum(w not in listed for w in words)]

    def distance(a, b):
        p, q = [x / sum(a) for x in a], [x / sum(b) for x in b]
        kl = lambda u, v: sum(x * math.log2(x / ((x + y) / 2)) for x, y in zip(u, v) if x)
        return math.sqrt(max(0, (kl(p, q) + kl(q, p)) / 2))

    each = {i: hists(t) for i, t, *_ in rows}
    refs = {lang: [[sum(x) for x in zip(*(each[r[0]][k] for r in rows if r[2] == lang))] for k in (0, 1)] for lang in ("de", "en")}
    for i, _, lang, _ in rows:
        langs = [lang] if lang in refs else list(refs)
        (r,) = got[i]
        assert math.isclose(r.class_distance, min(distance(each[i][0], refs[x][0]) for x in langs), abs_tol=1e-9)
        assert math.isclose(r.word_distance, min(distance(each[i][1], refs[x][1]) for x in langs), abs_tol=1e-9)
        none = [0] * len(listed) + [1]
        assert math.isclose(r.word_share, min(distance(each[i][1], refs[x][1]) / distance(none, refs[x][1]) for x in langs), abs_tol=1e-9)


def brute_windows(words, item, window=13):
    k = min(window, len(item))
    return [s for s in range(len(words) - k + 1) for o in range(len(item) - k + 1) if k and words[s:s + k] == item[o:o + k]]


def test_decontaminate(spark, docs, rows):
    by = {r[0]: r[1] for r in rows}
    items = [(1, " ".join(space_words(by[9])[28:70])), (2, "Two, words!"), (3, None), (4, "!!!"), (5, "nowhere to be found"),
             (6, " ".join(space_words(by[9])[28:70])), (None, " ".join(space_words(by[16])[:20])), (7, "same line " * 9),
             (8, "日本 語 😀")]
    table = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, n_words int")
    got = by_id(decontaminate.benchmark_overlap(docs, table))
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_az(t))
    for i, text, *_ in unique(rows):
        words, (r,) = split(text), got[i]
        hit, names = set(), set()
        for name, item in items:
            item = split(item)
            starts = brute_windows(words, item)
            hit |= {s + j for s in starts for j in range(min(13, len(item)))}
            names |= {str(name)} if starts and name is not None else set()
        assert (r.n_words, r.n_hit, r.item_ids) == (len(words), len(hit), sorted(names)), i
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(words))
    assert got[23][0] == got[23][1]


def test_decontaminate_in_blocks(spark, docs, rows, monkeypatch):
    by = {r[0]: r[1] for r in rows}
    items = spark.createDataFrame([(1, by[9]), (2, by[16])], "item_id bigint, text string")
    whole = decontaminate.benchmark_overlap(docs, items).collect()
    monkeypatch.setattr(decontaminate, "WORDS_A_PASS", 7)
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    key = lambda r: (r.doc_id or -1, r.n_words)
    assert sorted(decontaminate.benchmark_overlap(docs, items).collect(), key=key) == sorted(whole, key=key)


def brute_chunks(lines, choices=8):
    """(a, b, lo, hi) of each choice's chunks."""
    h = [int(hashlib.md5(line.encode()).hexdigest()[:8], 16) for line in lines]
    rolled = [x + 31 * y for x, y in zip(h, [0, *h])]
    out = set()
    for s in range(choices):
        ends = [i for i, r in enumerate(rolled) if i in (0, len(lines) - 1) or r >> s & 1 == 0]
        for j in range(1, len(ends)):
            out.add((ends[j - 1], ends[j], ends[max(j - 2, 0)], ends[min(j + 1, len(ends) - 1)]))
    return sorted(out, key=lambda c: (c[0], c[2], -c[3], c[1]))


def brute_runs(order):
    """For each (id, text) in order, the places of the lines that go."""
    first, gone = {}, defaultdict(set)
    every = [(i, text, text.split("\n")) for i, text in order]
    for i, text, lines in every:
        for a, b, lo, hi in brute_chunks(lines):
            first.setdefault(tuple(lines[a:b + 1]), (i, text, a, b, lo, hi, lines))
    for i, text, lines in every:
        for a, b, lo, hi in brute_chunks(lines):
            fi, ftext, fa, fb, flo, fhi, fl = first[tuple(lines[a:b + 1])]
            if (fi, ftext, fa) == (i, text, a):
                continue
            u, v = a, b
            while u > lo and fa - (a - u) > flo and lines[u - 1] == fl[fa - (a - u) - 1]:
                u -= 1
            while v < hi and fb + (v - b) < fhi and lines[v + 1] == fl[fb + (v - b) + 1]:
                v += 1
            if sum(bool(space_words(x)) for x in lines[u:v + 1]) >= 2:
                gone[i, text] |= set(range(u, v + 1))
    return gone


def test_line_chunks(docs, rows):
    got = by_id(line_chunks.dedup_lines(docs))
    # the order of texts that share an id is a hash's: none of those shares lines with another
    order = sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    gone = brute_runs(order)
    for i, text, *_ in unique(rows):
        lines, (r,) = (text or "").split("\n"), got[i]
        kept = [x for j, x in enumerate(lines) if j not in gone[i, text or ""]]
        assert (r.kept_text, r.n_lines, r.n_removed_lines) == ("\n".join(kept), len(lines), len(lines) - len(kept)), i
    assert sum(map(len, gone.values())) > 0 and got[23][0] == got[23][1]
    left = {x for rs in got.values() for r in rs for x in r.kept_text.split("\n")}
    assert {x for r in rows for x in (r[1] or "").split("\n") if space_words(x)} <= left


def test_line_chunks_find_short_passages(spark):
    """Passages of three lines in other surroundings go, single lines and new lines stay."""
    rng, words = random.Random(5), vocabulary(5, 3000)
    line = lambda: " ".join(rng.choice(words) for _ in range(6))
    passages, single = [[line() for _ in range(3)] for _ in range(40)], line()
    texts, planted = [], []
    for k in range(200):
        p = passages[k % 40]
        texts.append([*(line() for _ in range(rng.randint(1, 4))), *p, *(line() for _ in range(3)), single, line()])
        planted.append(set(p) if k >= 40 else set())
    docs = frame(spark, [(k, "\n".join(t), "en", "s") for k, t in enumerate(texts)])
    kept = {r.doc_id: r.kept_text.split("\n") for r in line_chunks.dedup_lines(docs).collect()}
    found = sum(len(set(t) - set(kept[k])) for k, t in enumerate(texts))
    assert all(x in kept[k] for k, t in enumerate(texts) for x in t if x not in planted[k])
    assert found >= 0.9 * sum(map(len, planted))


def test_line_chunks_compare_bytes(spark, monkeypatch):
    """A run with a line whose hash another line shares stays."""
    same = line_chunks._line_id
    monkeypatch.setattr(line_chunks, "_line_id", lambda x: same(F.when(x == "fourth line", "third line").otherwise(x)))
    texts = ["first line\nsecond line\nthird line", "first line\nsecond line\nfourth line", "fifth\nsixth", "fifth\nsixth"]
    got = by_id(line_chunks.dedup_lines(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])))
    assert [got[i][0].kept_text for i in range(4)] == [texts[0], texts[1], texts[2], ""]


def brute_fingerprint(text):
    w = space_words(lower_az(text))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(values, near):
    """Smallest reachable index for each value."""
    root = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i in range(len(values)):
            for j in range(i):
                if near(values[i], values[j]) and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    return root


@pytest.mark.parametrize("small", [simhash.SMALL_BUCKET, 2])
def test_simhash(docs, rows, small, monkeypatch):
    monkeypatch.setattr(simhash.links, "__kwdefaults__", {"radius": 3, "small_bucket": small})
    got = by_id(simhash.near_duplicates(docs))
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = groups(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    least = defaultdict(list)
    for r, g in zip(rows, root):
        least[g].append(r[0])
    for r, fp, g in zip(rows, fps, root):
        ids = [x for x in least[g] if x is not None]
        assert (f"{fp:016x}", min(ids, default=None)) in {(x.fingerprint, x.component_id) for x in got[r[0]]}
    kept = simhash.keep_first(docs, simhash.near_duplicates(docs))
    assert kept.columns == docs.columns and kept.count() == len(set(root))


def test_covering_masks_hide_every_small_difference():
    import itertools
    rng = random.Random(0)
    for kept in (0, simhash.covering_masks(0, 3)[4]):
        free, masks = [b for b in range(64) if not kept >> b & 1], simhash.covering_masks(kept, 3)
        trios = itertools.combinations(free, 3) if kept else (rng.sample(free, 3) for _ in range(4000))
        assert all(any(not m & (1 << a | 1 << b | 1 << c) for m in masks) for a, b, c in trios)


def test_simhash_splits_a_ball_of_near_copies(spark):
    """Many fingerprints around one centre, chained by three bits, are one component."""
    rng = random.Random(3)
    fps, now = [], 0x0123456789ABCDEF
    for _ in range(700):
        fps.append(now)
        for b in rng.sample(range(64), 3):
            now ^= 1 << b
    far = [x ^ 0xFFFFFFFF for x in fps[:5]]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    values = sorted({signed(x) for x in fps + far})
    df = spark.createDataFrame([(v,) for v in values], "fp bigint")
    roots = {r.node: r.root for r in simhash.components(simhash.links(df, small_bucket=16)).collect()}
    want = groups(values, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    assert [roots.get(v, v) for v in values] == [values[w] for w in want]


def test_bpe_equals_the_library(docs, rows):
    import tiktoken

    path, pattern = queries.byte_vocabulary()
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    got = by_id(byte_bpe.encode_documents(docs, path, pattern, keep_ids=True))
    for i, text, *_ in rows:
        ids = own.encode_ordinary(text or "")
        found = [r for r in got[i] if r.token_ids == ids]
        assert found and found[0].ids_sha256 == sha(",".join(map(str, ids))) and found[0].n_tokens == len(ids)
        assert found[0].decoded_sha256 == sha(text or "") and found[0].round_trip


def test_bpe_transducer_forgets_and_goes_on():
    import tiktoken

    path, pattern = queries.byte_vocabulary()
    ranks = byte_bpe.read_ranks(path)
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.Codec(ranks, pattern)
    codec.transducer.max_states, codec.pieces.limit = 50, 5
    rng = random.Random(5)
    alphabet = ["a", "e", "t", "é", "ß", " ", "\n", "日", "😀", "the", "ing", "0", "\u0301", "A", "Я", "'s"]
    for n in (3, 20, 200, 3000):
        for _ in range(40):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, n)))
            assert [i for part in codec.encode(text) for i in part] == own.encode_ordinary(text)
    long = "".join(rng.choice("abcdeé") for _ in range(byte_bpe.CHUNK + 5000))
    assert codec.transducer.encode(long.encode()) == own.encode_ordinary(long)


def test_stream_decoder_waits_for_whole_characters():
    raw = "aé日😀z".encode() + b"\xff\xc3"
    tokens = {i: bytes([b]) for i, b in enumerate(raw)}
    decoder, said = byte_bpe.StreamDecoder(tokens), []
    for i in range(len(raw)):
        said.append(decoder.feed([i]))
    said.append(decoder.finish())
    assert "".join(said) == raw.decode("utf-8", "replace") and "" in said


def brute_secrets(text):
    assign = re.compile(secrets.ASSIGN, re.A)
    found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_secrets(spark, docs, rows):
    h, live = "0123456789abcdef" * 3, "Zx81Qw93Lm27Bn46Vc50Kk"
    texts = ["password = 'hunter2hunter2' é token: " + h, "token=secret:abcdefgh", f"AKIA{'A' * 12} AKIA123 xAKIAAKIA{'9' * 20}",
             "API_KEY='é" + "p" * 9 + f"' apikey={'q' * 9} {h}", f"see {live} there", f"copied {live}x {'Z9' * 15}", f"and {'Z9' * 15}",
             "PassWd:\x20\x20\"A=b/c+d.e_f-g", "paſſword=12345678 toKen=12345678"]
    more = [(100 + i, t, "en", f"o{i}") for i, t in enumerate(texts)] + [(108, texts[8], "en", "o8")]
    every = rows + more
    got = by_id(secrets.scan_secrets(docs.select("doc_id", "text", "source").union(frame(spark, more).select("doc_id", "text", "source"))))
    for i, text, *_ in unique(every):
        spans, (r,) = brute_secrets(text or ""), got[i]
        assert r.base == ",".join(f"{k}:{a}:{e}" for a, _, k, e in spans), i
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert {x for x in r.base.split(",") if x} <= {x for x in r.spans.split(",") if x}
    assert got[104][0].spans == "owned:4:26" and got[106][0].spans == "" and got[106][0].n_copied == 1
    assert len(got[108]) == 2 and got[108][0] == got[108][1]


def test_rows_with_null_and_shared_ids_are_judged_apart(spark):
    """What befalls one row befalls no other row of a null or shared doc_id."""
    words = vocabulary(9, 2000)
    clean = [" ".join(words[60 * k:60 * k + 60]) for k in range(4)]
    ids = [None, None, 7, 7]
    left = lambda df: sorted(r.text for r in df.collect())
    docs = frame(spark, [(i, t, "en", "s") for i, t in zip(ids, clean)] + [(None, "short", "en", "s"), (7, "too short", "en", "s")])
    assert left(quality_rules.keep_good(docs)) == sorted(clean)
    bench = spark.createDataFrame([(1, " ".join(words[1900:1920]))], "item_id bigint, text string")
    docs = frame(spark, [(i, t, "en", "s") for i, t in zip(ids, clean)] + [(i, f"{' '.join(words[1900:1920])} x{i}", "en", "s") for i in (None, 7)])
    found = decontaminate.benchmark_overlap(docs, bench)
    assert left(decontaminate.drop_contaminated(docs, found)) == sorted(clean)
    assert sorted(r.n_hit for r in found.collect()) == [0, 0, 0, 0, 20, 20]
    near = frame(spark, [(i, t, "en", "s") for i, t in zip(ids, clean)] + [(None, clean[0], "en", "s"), (8, clean[2], "en", "s")])
    assert left(simhash.keep_first(near, simhash.near_duplicates(near))) == sorted(clean)
    scores = hmm.score_documents(docs, rounds=1, classes=64).collect()
    c = Counter(w for r in docs.collect() for w in [*lower_az(r.text).split(), ""])
    total = sum(c.values())
    base = [sum(math.log10((c[w] + 1) / (total + len(c) + 1)) for w in [*lower_az(r.text).split(), ""]) for r in docs.collect()]
    assert sorted(r.base_score for r in scores) == pytest.approx(sorted(base))
    lines = ["\n".join(" ".join(words[40 * k + 4 * j:40 * k + 4 * j + 4]) for j in range(40)) for k in (0, 10, 20, 30)]
    copies = ["head one\n" + lines[0], "head two\n" + lines[2]]
    docs = frame(spark, [(i, t, "en", "s") for i, t in zip([None, None, 7, 7, None, 7], lines + copies)])
    kept = left(line_chunks.drop_repeats(docs))
    assert len(set(kept) & {lines[1], lines[3]}) == 2 and len(kept) == 6
    assert len(set(kept) & {lines[0], copies[0]}) == 1 and len(set(kept) & {lines[2], copies[1]}) == 1
    assert sorted(r.kept_text for r in line_chunks.dedup_lines(docs).collect()) == kept


def test_secrets_by_owners_and_repositories(spark):
    """Many copies in one source are copied, a mirror in a second source is not."""
    example, live, shared = "Ex81Qw93Lm27Bn46Vc50Kk", "Zx81Qw93Lm27Bn46Vc50Kk", "Yy81Qw93Lm27Bn46Vc50Kk"
    rows = [(i, f"page {i} {example}", "en", "hot") for i in range(1000)]
    rows += [(2000, f"see {live}", "en", "s1"), (2001, f"see {live}", "en", "s2")]
    rows += [(3000 + i, f"mirrored {shared}", "en", f"s{i % 3}") for i in range(11)]
    got = by_id(secrets.scan_secrets(frame(spark, rows)))
    assert all(got[i][0].spans == "" and got[i][0].n_copied == 1 for i in [*range(1000), *range(3000, 3011)])
    assert all(got[i][0].spans == "owned:4:26" and got[i][0].n_live == 1 for i in (2000, 2001))


def test_urls(spark):
    urls = ["http://Example.ORG/es/1?q#f", "https://a.example.org/en/12", "x.org/fr", None, "http://b.com/fr/2", "http://com/de/3",
            "ftp://notcom/fr/", "http://x.org", "http://x.org?y", "://", "http://bad.net/1", "http://sub.bad.net/1", "a://b://c/d",
            "http://good.net/", "http://É.Org/es/", "http://u:p@h.org:80/x"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, "http://bad.net/2", "h"), (3, None, "h")]
                                  + [(1000 + i, f"http://{'bad' if i % 2 else 'good'}.net/{i}", "h") for i in range(200)],
                                  "page_id bigint, url string, host string")
    labels = spark.createDataFrame([(1000 + i, 0 if i % 2 else 1, 0) for i in range(200)] + [(None, 0, 1), (1000, None, None)],
                                   "doc_id bigint, quality int, toxic int")
    got = {r.page_id: r for r in host_reputation.judge_urls(pages, labels).collect()}
    want = {0: ("example.org", "/es/1", "example.org/es/", "block"), 1: ("a.example.org", "/en/12", "example.org/en/1", "block"),
            2: ("", "", None, "allow"), 3: ("", "", None, "allow"), 4: ("b.com", "/fr/2", "com/fr/", "allow"), 5: ("com", "/de/3", "com/de/", "block"),
            6: ("notcom", "/fr/", None, "allow"), 7: ("x.org", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("bad.net", "/1", None, "block"),
            12: ("b:", "//c/d", None, "allow"), 13: ("good.net", "/", None, "allow"), 14: ("É.org", "/es/", "org/", "allow")}
    for i, x in want.items():
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == x, i
    assert got[None].verdict == "block" and got[15].host == "u:p@h.org:80"
    assert got[10].bad_low > got[11].bad_low > 0.5 > got[13].bad_low  # without labels of its own, as its domain
    none = host_reputation.judge_urls(pages, labels.limit(0))
    assert none.count() == pages.count() and host_reputation.judge_urls(pages.limit(0), labels).count() == 0


def test_severity_held_out(spark, rows):
    rng, words, bad = random.Random(2), vocabulary(4), ["vile", "awful", "nasty"]
    docs, labels = [], []
    for i in range(1200):
        grade = i % 3
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))] + rng.choices(bad, k=grade * 2)
        rng.shuffle(text)
        docs.append((i, " ".join(text), "en", "s"))
        if i < 800:
            labels.append((i, grade))
    docs += [(5000 + (r[0] or 0), *r[1:]) for r in rows]
    table = spark.createDataFrame(labels + [(None, 1), (3, None), (4, 9), (99999, 2)], "doc_id bigint, grade int")
    got = by_id(severity.predict_severity(frame(spark, docs, CLASHING), table))
    assert sum(got[i][0].grade == i % 3 for i in range(800, 1200)) / 400 > 0.9
    means = [sum(got[i][0].expected_severity for i in range(800, 1200) if i % 3 == g) / 133 for g in range(3)]
    assert means[0] < means[1] < means[2] and all(abs(sum(r.p) - 1) < 1e-9 for rs in got.values() for r in rs)
    assert severity.predict_severity(frame(spark, docs), table.limit(0)).count() == len(docs)


def test_hidden_markov_scores(docs, rows):
    got = by_id(hmm.score_documents(docs, rounds=2, classes=64))
    token = {i: [*(w.encode() for w in space_words(lower_az(t))), b""] for i, t, *_ in unique(rows)}
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t, *_ in rows if i is None or not held(i) for w in [*(x.encode() for x in space_words(lower_az(t))), b""])
    total, v = sum(c.values()), len(c)
    for i, words in token.items():
        (r,) = got[i]
        base = sum(math.log10((c[w] + 1) / (total + v + 1)) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(words), sum(c[w] > 0 for w in words), total, held(i))
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert got[23][0].score == pytest.approx(got[23][1].score)


def plain_forward(text, start, move, emit):
    """The scaled forward values of one text, step by step, and its log probability."""
    alphas, log = [], 0.0
    for t, c in enumerate(text):
        now = (start if t == 0 else alphas[-1] @ move) * emit[c]
        alphas.append(now / now.sum())
        log += math.log(now.sum())
    return alphas, log


def plain_round(texts, start, move, emit):
    """One Baum-Welch round over all texts, step by step."""
    first, moves, seen = np.zeros_like(start), np.zeros_like(move), np.zeros_like(emit)
    for text in texts:
        alphas, _ = plain_forward(text, start, move, emit)
        beta = np.ones(len(start))
        for t in range(len(text) - 1, -1, -1):
            gamma = alphas[t] * beta
            seen[text[t]] += gamma / gamma.sum()
            if t == 0:
                first += gamma / gamma.sum()
                break
            step = alphas[t - 1][:, None] * move * (emit[text[t]] * beta)
            moves += step / step.sum()
            beta = move @ (emit[text[t]] * beta)
            beta /= beta.sum()
    return hmm.Model.from_counts(first, moves, seen)


def test_hidden_markov_query_against_plain_model(spark):
    """Scores of whole documents, held out or not, equal a plain model trained by plain rounds."""
    rng, words = random.Random(11), vocabulary(5, 300)
    texts = [" ".join(rng.choices(words[:200] if i % 2 else words[100:], k=rng.choice([0, 1, 5, 63, 64, 130]))) for i in range(50)]
    classes, states, rounds = 32, 3, 2
    got = by_id(hmm.score_documents(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).repartition(3),
                                    states=states, classes=classes, rounds=rounds))
    token = [[w.encode() for w in t.split()] for t in texts]
    coded = [np.array([xxhash.xxh3_64_intdigest(w) % classes for w in t] + [classes]) for t in token]
    train = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for i in train for w in token[i])
    totals, distinct = np.zeros(classes + 1), np.zeros(classes)
    for w, n in counts.items():
        totals[xxhash.xxh3_64_intdigest(w) % classes] += n
        distinct[xxhash.xxh3_64_intdigest(w) % classes] += 1
    totals[classes] = len(train)
    model = hmm.Model.first(states, totals, 7)
    for _ in range(rounds):
        model = plain_round([coded[i] for i in train], model.start, model.move, model.emit)
    for i in range(50):
        score = plain_forward(coded[i], model.start, model.move, model.emit)[1] / math.log(10)
        score += sum(math.log10((counts[w] + 1) / (totals[k] + distinct[k] + 1)) for w, k in zip(token[i], coded[i]))
        assert got[i][0].score == pytest.approx(score, rel=1e-9), i
        assert got[i][0].held_out == (i not in train)


def test_hidden_markov_groups(spark, monkeypatch):
    """Small groups of numbered texts, and a text beyond a group's bounds, give the same scores."""
    rng, words = random.Random(12), vocabulary(6, 400)
    docs = frame(spark, [(i, " ".join(rng.choices(words, k=300 if i == 5 else 12)), "en", "s") for i in range(30)])
    whole = {i: r[0].score for i, r in by_id(hmm.score_documents(docs, classes=16, rounds=1)).items()}
    monkeypatch.setattr(hmm, "GROUP_WORDS", 40)
    monkeypatch.setattr(hmm, "GROUP_DISTINCT", 25)
    group, made = hmm._Group(), []
    for i, (_, text, *_) in enumerate(docs.collect()):
        group.add(i, False, text)
        if group.full():
            made, group = [*made, group], hmm._Group()
    assert len(made) > 8
    rows = [b for g in made for b in g.batches(1, 16, pa.int64())]
    assert all(b.num_rows for b in rows) and sum(b.num_rows for b in rows[::2]) + len(group.texts) == 30
    parts = {i: r[0].score for i, r in by_id(hmm.score_documents(docs.repartition(30, "doc_id"), classes=16, rounds=1)).items()}
    assert parts == pytest.approx(whole, rel=1e-12)


def test_hidden_markov_recursions():
    """Segments against the plain recursions, and training against a rising likelihood."""

    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 6, n) for n in (1, 2, 63, 64, 65, 200, 129)]
    model = hmm.Model.first(3, np.ones(6), 1)

    def alphas(t):
        out, log = [model.start * model.emit[t[0]]], 0.0
        for x in t[1:]:
            log += np.log(out[-1].sum())
            out.append((out[-1] / out[-1].sum()) @ model.move * model.emit[x])
        return out, log + np.log(out[-1].sum())

    logs = hmm._Segments(texts, model).forward()[1]
    assert np.allclose(logs, [alphas(t)[1] for t in texts])
    moves, start, emit = np.zeros((3, 3)), np.zeros(3), np.zeros((6, 3))
    for t in texts:
        a = [x / x.sum() for x in alphas(t)[0]]
        b = [np.ones(3)]
        for x in t[:0:-1]:
            b.insert(0, model.move @ (model.emit[x] * b[0]))
            b[0] /= b[0].sum()
        for i, x in enumerate(t):
            g = a[i] * b[i] / (a[i] * b[i]).sum()
            emit[x] += g
            start += g * (i == 0)
            if i:
                xi = a[i - 1][:, None] * model.move * (model.emit[x] * b[i])[None]
                moves += xi / xi.sum()
    s, m, seen, gamma = hmm._Segments(texts, model).expected()
    own = np.zeros((6, 3))
    np.add.at(own, seen, gamma)
    assert np.allclose(s, start) and np.allclose(m, moves) and np.allclose(own, emit)
    before = logs.sum()
    for _ in range(3):
        s, m, seen, gamma = hmm._Segments(texts, model).expected()
        own = np.zeros((6, 3))
        np.add.at(own, seen, gamma)
        model = hmm.Model.from_counts(s, m, own)
    assert hmm._Segments(texts, model).forward()[1].sum() > before


def test_hidden_markov_probabilities_add_up():
    """Over all short texts of a small vocabulary the probability comes to one."""
    import itertools

    model = hmm.Model.first(2, np.array([5.0, 3.0, 2.0]), 3)  # two classes and the end
    texts = [np.array([*t, 2]) for n in range(13) for t in itertools.product(range(2), repeat=n)]
    done = np.exp(hmm._Segments(texts, model).forward()[1]).sum()
    open_ = np.exp(hmm._Segments([np.array(t) for t in itertools.product(range(2), repeat=13)], model).forward()[1]).sum()
    assert math.isclose(done + open_, 1.0, rel_tol=1e-9)


@pytest.mark.parametrize("window", [50, 7, 1, 2])
def test_substrings(docs, rows, window):
    got, first = by_id(substrings.remove_repeats(docs, window=window)), {}
    for i, text, *_ in rows:
        w = space_words(text)
        for j in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[j:j + window])
            first[key] = min(first.get(key, i), i)
    for i, text, *_ in unique(rows):
        w, (r,) = space_words(text), got[i]
        gone = {j + k for j in range(len(w) - window + 1) if first[tuple(w[j:j + window])] < i for k in range(window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), len(gone), sha(kept)), i
    assert all(r.n_removed == 0 for r in got[None]) and got[23][0] == got[23][1]


@pytest.mark.parametrize("swap", [False, True])
def test_substrings_of_rows_that_share_an_id(spark, swap):
    """Each row of a shared doc_id keeps its own words, in either order."""
    words = vocabulary(11, 900)
    a, b, other = " ".join(words[:60]), " ".join(words[100:160]), " ".join(words[200:280])
    rows = [(1, a), (2, b), (5, " ".join(words[300:310]) + " " + a), (5, " ".join(words[400:433]) + " " + b), (5, other), (6, other), (5, other)]
    rows = rows[::-1] if swap else rows
    got = substrings.remove_repeats(frame(spark, [(i, t, None, None) for i, t in rows])).collect()
    kept = [(1, 60, 0, a), (2, 60, 0, b), (5, 70, 60, " ".join(words[300:310])), (5, 93, 60, " ".join(words[400:433])),
            (5, 80, 0, other), (5, 80, 0, other), (6, 80, 80, "")]
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted((i, n, m, sha(t)) for i, n, m, t in kept)


def test_substring_copies_are_joined_without_their_aggregate(docs, monkeypatch):
    """A join that reuses the aggregate's partitions could not split a hot text's rows."""
    plans, write = {}, substrings.write_scratch

    def spied(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(substrings, "write_scratch", spied)
    substrings.remove_repeats(docs)
    assert "min(doc_id" in plans["substring_copies"] and "min(doc_id" not in plans["substring_first"]


def test_empty_tables(spark):
    docs = frame(spark, [], CLASHING)
    items = spark.createDataFrame([], "item_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, grade int")
    path, pattern = queries.byte_vocabulary()
    for df in (quality_rules.quality_rules(docs), decontaminate.benchmark_overlap(docs, items), line_chunks.dedup_lines(docs),
               simhash.near_duplicates(docs), byte_bpe.encode_documents(docs, path, pattern), secrets.scan_secrets(docs),
               severity.predict_severity(docs, labels), hmm.score_documents(docs, rounds=1, classes=8), substrings.remove_repeats(docs)):
        assert df.collect() == []
    some = frame(spark, awkward_rows(), CLASHING)
    assert sum(r.n_hit for r in decontaminate.benchmark_overlap(some, items).collect()) == 0


def test_idle_worker_forgets_its_codec(monkeypatch):
    """A codec is shared while tasks follow each other, and dropped when none has come for a while."""
    monkeypatch.setattr(byte_bpe, "IDLE_SECONDS", 0.2)
    ranks, keeper = {bytes([i]): i for i in range(256)}, byte_bpe.Keeper()
    codec = keeper.take(ranks, r"\S+|\s+")
    keeper.give_back()
    assert keeper.take(ranks, r"\S+|\s+") is codec
    time.sleep(0.5)
    assert keeper.codec is codec  # in use
    keeper.give_back()
    time.sleep(0.5)
    assert keeper.codec is None
    assert keeper.take(ranks, r"\S+|\s+").digest("a b", True)[4] == [97, 32, 98]
