"""The fill-in-the-middle transformation against a plain version."""

import hashlib
import re

import pytest
from helpers import CLASHING, SCHEMA, awkward_rows, frame
from hypothesis import given
from hypothesis import strategies as st

from sparkdesk.llm.fill_in_middle import Transformation, restore, transform_documents


def plain_version(doc_id, text, rate=100, spm_rate=50):
    """(n, form, prefix_chars, middle_chars, output), line by line."""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return len(lines), "plain", None, None, text
    if h4 % 100 < spm_rate:
        return len(lines), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(lines), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


MORE = [(31, "a <P> b\nc", "en", "s"), (32, "ends <\nS> begins\n<M", "en", "s"), (33, "\n\n\n", "en", "s"), (34, "no feed", "en", "s"),
        (35, "<S\n>P>\nM>", "en", "s"), (36, "\r\n x\n", "en", "s"), (37, "<M>", "en", "s")]


@pytest.mark.parametrize("schema", [SCHEMA, CLASHING + ", form string, output int, restored int"], ids=["plain", "clashing"])
@pytest.mark.parametrize("rate, spm_rate", [(100, 50), (40, 10), (0, 50), (100, 100)])
def test_documents(spark, schema, rate, spm_rate):
    rows = awkward_rows() + MORE
    got = transform_documents(frame(spark, rows, schema), rate=rate, spm_rate=spm_rate).collect()
    want = [(i, *plain_version(i, t or "", rate, spm_rate), t or "") for i, t, *_ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert transform_documents(frame(spark, [], schema)).collect() == []


@given(st.integers(0, 10**6), st.text(alphabet="<>PSM\nab", max_size=60))
def test_restored_from_output_and_form(doc_id, text):
    made = Transformation()(doc_id, text)
    assert restore(made.output, made.form) == text
    assert (made.n, made.form, made.prefix_chars, made.middle_chars, made.output) == plain_version(doc_id, text)


def test_other_units_and_long_texts(spark):
    words = Transformation(unit=r"\s*\S+\s*")
    made = words(5, "one two  three")
    assert made.n == 3 and restore(made.output, made.form) == "one two  three"
    with pytest.raises(ValueError):
        words(5, "   ")
    text = "line of text\n" * 400_000
    (row,) = transform_documents(frame(spark, [(1, text, None, None)])).collect()
    assert row.n == 400_000 and row.restored == text
