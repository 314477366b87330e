"""Fill-in-the-middle transformation by repeated-capture matching.

One ``fullmatch`` of ``(unit)*`` over the whole text keeps every repetition of its group, so
``match.ends(1)`` holds the end of each unit: its length is the number of units, and the two
cuts are read from it by index.  A hash of the document's id chooses cuts and form, so a
re-run task writes the same rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sparkdesk.llm.common import documents

#: The markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A unit is a line with its line feed, or the last line without one.
LINE = r"[^\n]*\n|[^\n]+"
#: Rows are passed on when their texts reach so many characters.
BATCH_CHARS = 4 << 20


def numbers(salt: str, doc_id: object) -> tuple[int, int, int, int]:
    """The first four 8-digit groups of the SHA-256 of "salt:doc_id" (a null id is the empty string)."""
    digest = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


@dataclass(frozen=True)
class Example:
    """A text rewritten for infilling; the lengths are null in the plain form."""

    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: str


class Transformation:
    """Cuts texts into whole units and writes them in one of three forms."""

    def __init__(self, unit: str = LINE, salt: str = "7", rate: int = 100, spm_rate: int = 50):
        self.units = regex.compile(f"({unit})*")
        self.salt, self.rate, self.spm_rate = salt, rate, spm_rate

    def __call__(self, doc_id: object, text: str) -> Example:
        match = self.units.fullmatch(text)
        if match is None:
            raise ValueError("the units do not cover the text")
        ends = match.ends(1)
        n = len(ends)
        h1, h2, h3, h4 = numbers(self.salt, doc_id)
        if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= self.rate:
            return Example(n, "plain", None, None, text)
        first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
        begin, end = (ends[k - 1] if k else 0 for k in (first, last))
        prefix, middle, suffix = text[:begin], text[begin:end], text[end:]
        if h4 % 100 < self.spm_rate:
            return Example(n, "spm", begin, end - begin, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle)
        return Example(n, "psm", begin, end - begin, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle)


def restore(output: str, form: str) -> str:
    """The text that ``output`` was made of.  Each marker is there once: the text holds none, and
    no marker can begin inside another, so none arises where a part and a marker meet."""
    if form == "plain":
        return output
    head, _, middle = output.partition(MIDDLE)
    if form == "psm":
        prefix, _, suffix = head.removeprefix(PREFIX).partition(SUFFIX)
    else:
        suffix, _, prefix = head.removeprefix(SUFFIX).partition(PREFIX)
    return prefix + middle + suffix


def transform_documents(docs: DataFrame, *, unit: str = LINE, salt: str = "7", rate: int = 100, spm_rate: int = 50,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n (units), form, prefix_chars, middle_chars, output, restored.

    Of 100 documents about ``rate`` are rewritten, and of these ``spm_rate`` in a hundred with
    the suffix first; the rest, empty texts and texts that hold a marker stay plain, with null
    lengths.  ``unit`` must match every non-empty text from end to end and nothing empty.
    ``restored`` is rebuilt from output and form alone.  No shuffle; a lost executor costs its tasks.

    Null and empty texts are plain, with no unit; a very long text is matched whole (one number
    a unit) and passed on in a batch of its own; equal cuts give an empty middle; rows of equal
    doc_id and text get the same output, others that share a doc_id the same numbers; a null
    doc_id counts as the empty string; an empty table gives no rows; other columns are ignored.
    """
    d = documents(docs, id_col, text_col)
    kind = d.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = Transformation(unit, salt, rate, spm_rate)
        for batch in batches:
            for part in _parts(batch):
                made = [change(i, t.as_py()) for i, t in zip(part.column(0).to_pylist(), part.column(1))]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([m.n for m in made], pa.int64()), pa.array([m.form for m in made], pa.string()),
                    pa.array([m.prefix_chars for m in made], pa.int64()), pa.array([m.middle_chars for m in made], pa.int64()),
                    pa.array([m.output for m in made], pa.string()),
                    pa.array([restore(m.output, m.form) for m in made], pa.string())], names)

    return d.mapInArrow(work, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
                              "output string, restored string")


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about BATCH_CHARS bytes of text, at least a row each."""
    begin, size = 0, 0
    for i, text in enumerate(batch.column(1)):
        size += text.as_buffer().size
        if size >= BATCH_CHARS:
            yield batch.slice(begin, i + 1 - begin)
            begin, size = i + 1, 0
    if begin < batch.num_rows:
        yield batch.slice(begin)
