"""Small tables with every awkward case, and brute-force versions of the operators."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: A table whose other columns clash with names that the operators use inside.
CLASHING = SCHEMA + ", words string, kept int, fp string, hash int, id int, fingerprint int, n_words string"


def vocabulary(seed=1, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghiklmnoprstuvé") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def awkward_rows(seed=1):
    """(doc_id, text, lang, source): nulls, empty, blank, very long, copies, near copies, shared lines."""
    rng, words = random.Random(seed), vocabulary(seed)
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = text(70)
    lines = "\n".join(text(6) for _ in range(9))
    base = text(120)
    near = base.split()
    near[60] = "changed"
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n "), (7, "word"), (8, "Two words"),
            (9, text(30) + " " + shared + " " + text(30)), (10, text(40) + " " + shared + " " + text(10)),
            (11, text(30) + "\n" + lines + "\n" + text(12)), (12, text(5) + "\n" + lines),
            (13, text(3) + "\n" + lines + "\n" + text(20)), (14, text(20_000)), (15, "same line\n" * 300),
            (16, "\n".join(text(8) for _ in range(40))), (17, "| a | b |\n" * 4 + "## ** ## 12 34"), (18, text(200).upper()),
            (19, "日本 語 😀 " * 30), (20, shared), (21, shared.upper()), (None, base), (None, text(60)), (22, text(64)),
            (22, text(0)), (23, base), (23, base), (24, "\x00\x01 nul \x0b vt \x85 nel \u00a0 nbsp \u2003 em"), (25, shared + " x")]
    return [(i, t, rng.choice(["en", "de", None, "xx"]), rng.choice(["s1", "s2", None])) for i, t in rows]


def frame(spark, rows, schema=SCHEMA):
    n = len(schema.split(",")) - 4
    return spark.createDataFrame([(i, t, lang, src, *([None] * n)) for i, t, lang, src in rows], schema)


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_az(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def unique(rows):
    """Rows whose doc_id is theirs alone, and not null."""
    ids = [r[0] for r in rows]
    return [r for r in rows if r[0] is not None and ids.count(r[0]) == 1]
