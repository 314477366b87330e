"""Line deduplication by content-defined chunks.

A rolling hash over the hashes of the last two lines sets boundaries where one of its digits
is zero; each digit is a choice of boundaries of its own.  Boundaries depend on nearby lines
alone, so a passage gives the same chunks wherever it stands, and with several choices even
a short passage holds a whole chunk of one of them.  A chunk runs from one boundary line to
the next, both included.  A chunk that the corpus has more than once is grown line by line into
its two neighbours as far as they equal those of the chunk's first place; with the chunks
beyond them being seeds themselves, the grown runs together cover the whole passage.  Runs
are removed where they do not stand first, after the bytes of their lines are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.llm.common import broadcast_if_small, documents, same_row, text_key
from sparkdesk.session import write_scratch

#: Hashes are broadcast up to this measured size; beyond it they are joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 8 << 20


def _line_id(line: Column) -> Column:
    """63 bits of a line's hash, then one bit that says whether it holds more than white space."""
    filled = line.rlike(r"[^\x20\x09-\x0D]").cast("bigint")
    return F.xxhash64(line).bitwiseAND(F.lit(-2)).bitwiseOR(filled)


def _boundary_hash(line: Column) -> Column:
    """32 bits of a line's MD5, as a number."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("bigint")


def _chunks(docs: DataFrame, divisor: int, choices: int) -> DataFrame:
    """(doc_id, text_key, a, b, lo, hi, ids) for each chunk of lines a to b: its neighbours reach from lo
    to hi, whose line ids are ``ids``.

    Several choices may make the same chunk, with the same or other neighbours.
    """
    d = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), F.split("text", "\n").alias("lines"))
    d = d.select("doc_id", "text_key", F.transform("lines", _line_id).alias("ids"),
                 F.transform("lines", _boundary_hash).alias("hashes"))
    before = F.concat(F.array(F.lit(0).cast("bigint")), F.col("hashes"))  # one longer, its end meets null
    d = d.withColumn("rolled", F.zip_with("hashes", before, lambda x, y: x + 31 * y)).withColumn("last", F.size("hashes") - 1)

    def boundaries(unit: int) -> Column:
        digit = lambda x: F.floor(x / unit) % divisor
        at = F.transform("rolled", lambda x, i: F.when(
            (i <= F.col("last")) & ((i == 0) | (i == F.col("last")) | (digit(x) == 0)), i))
        return F.array_compact(at)

    d = d.withColumns({f"ends{s}": boundaries(divisor ** s) for s in range(choices)})

    def chunks_of(ends: Column) -> Column:
        n = F.size(ends)
        return F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda j: F.struct(
            ends[j - 1].alias("a"), ends[j].alias("b"), ends[F.greatest(j - 2, F.lit(0))].alias("lo"),
            ends[F.least(j + 1, n - 1)].alias("hi")))).otherwise(F.array().cast("array<struct<a:int,b:int,lo:int,hi:int>>"))

    d = d.withColumn("chunks", F.flatten(F.array(*[chunks_of(F.col(f"ends{s}")) for s in range(choices)])))
    # the ids are looked up before the rows are made, so that no row carries a whole document's
    # (and named twice, as a column named once would be worked out anew inside the function)
    with_ids = F.when(F.size("ids") > 1, F.transform("chunks", lambda c: F.struct(
        c.a.alias("a"), c.b.alias("b"), c.lo.alias("lo"), c.hi.alias("hi"),
        F.transform(F.sequence(c.lo, c.hi), lambda i: F.col("ids")[i]).alias("ids"))))
    d = d.select("doc_id", "text_key", with_ids.alias("chunks"))
    # inline_outer: plain inline would have the chunks made a second time in a filter on their number
    return d.select("doc_id", "text_key", F.inline_outer("chunks")).filter("a IS NOT NULL")


def _equal_run(most: Column, same) -> Column:
    """How many of the steps 1, 2, ... up to ``most`` are the same before the first that is not."""
    steps = F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.lit(0), lambda n, j: F.when((n == j - 1) & same(j), j).otherwise(n))


def _grown(copies: DataFrame, first: DataFrame, min_lines: int) -> DataFrame:
    """(doc_id, text_key, start, stop, ids): the lines around a chunk that also stand around its first place."""
    f = first.select("hash", *[F.col(f"first.{c}").alias(f"f_{c}") for c in ("doc_id", "text_key", "a", "lo", "ids")])
    n = F.col("b") - F.col("a") + 1
    mine, theirs = F.col("a") - F.col("lo"), F.col("f_a") - F.col("f_lo")
    back = _equal_run(F.least(mine, theirs), lambda j: F.col("ids")[mine - j] == F.col("f_ids")[theirs - j])
    rest = lambda ids, at: F.size(ids) - at - n
    ahead = _equal_run(F.least(rest("ids", mine), rest("f_ids", theirs)),
                       lambda j: F.col("ids")[mine + n + j - 1] == F.col("f_ids")[theirs + n + j - 1])
    place = F.struct("doc_id", "text_key", "a")
    later = (copies.join(f, "hash")
             .filter(~place.eqNullSafe(F.struct("f_doc_id", "f_text_key", "f_a")))
             .filter(F.slice("ids", mine + 1, n) == F.slice("f_ids", theirs + 1, n))
             .withColumn("back", back).withColumn("ahead", ahead))
    runs = later.select("doc_id", "text_key", (F.col("a") - F.col("back")).alias("start"), (F.col("b") + F.col("ahead")).alias("stop"),
                        F.slice("ids", mine - F.col("back") + 1, n + F.col("back") + F.col("ahead")).alias("ids"))
    return runs.filter(F.size(F.filter("ids", lambda x: x.bitwiseAND(F.lit(1)) == 1)) >= min_lines).distinct()


def _small(hashes: DataFrame, col: str) -> DataFrame:
    sized = hashes.withColumn("size_of", F.col(col).cast("string"))
    return broadcast_if_small(sized, max_rows=BROADCAST_ROWS, max_bytes=4 * BROADCAST_BYTES, size_col="size_of").drop("size_of")


def _unlike_lines(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """The ids in ``runs`` that lines of different bytes share somewhere in the corpus."""
    used = write_scratch(runs.select(F.explode("ids").alias("line_id")).distinct(), "run_lines")
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).withColumn("line_id", _line_id(F.col("line")))
    bodies = lines.join(_small(used, "line_id"), "line_id").select("line_id", "line").distinct()
    return write_scratch(bodies.groupBy("line_id").agg(F.count("*").alias("bodies")).filter("bodies > 1")
                         .select("line_id"), "unlike_lines")


def repeated_runs(docs: DataFrame, *, divisor: int, choices: int, min_lines: int, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(__id, __key, runs): a row's runs of lines, as (start, stop), that stand earlier in the corpus."""
    docs = documents(docs, id_col, text_col)
    chunks = (_chunks(docs, divisor, choices)
              .withColumn("hash", F.xxhash64(F.slice("ids", F.col("a") - F.col("lo") + 1, F.col("b") - F.col("a") + 1)))
              .withColumn("place", F.xxhash64("doc_id", "text_key", "a")))
    # several choices may give one place, and repeated rows are one document
    repeated = write_scratch(chunks.groupBy("hash").agg(F.min("place").alias("p"), F.max("place").alias("q"))
                             .filter("p != q").select("hash"), "repeated_hashes")
    copies = write_scratch(chunks.join(_small(repeated, "hash"), "hash")
                           .select("hash", "doc_id", "text_key", "a", "b", "lo", "hi", "ids"), "repeated_chunks")
    # written first, so that the next join can split a hot chunk's rows
    first = write_scratch(copies.groupBy("hash").agg(
        F.min(F.struct("doc_id", "text_key", "a", "lo", (-F.col("hi")).alias("hi"), "ids")).alias("first")), "first_chunks")
    runs = write_scratch(_grown(copies, first, min_lines), "repeated_runs")
    unlike = _unlike_lines(docs, runs)
    spoiled = (runs.select(*[F.col(c).alias(f"x_{c}") for c in ("doc_id", "text_key", "start", "stop")], F.explode("ids").alias("line_id"))
               .join(unlike, "line_id").drop("line_id").distinct())
    sound = runs.join(spoiled, F.col("doc_id").eqNullSafe(F.col("x_doc_id")) & (F.col("text_key") == F.col("x_text_key"))
                      & (F.col("start") == F.col("x_start")) & (F.col("stop") == F.col("x_stop")), "left_anti")
    return (sound.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
            .agg(F.collect_set(F.struct("start", "stop")).alias("runs")))


def _with_kept(rows: DataFrame, text: str, runs: str) -> DataFrame:
    """Adds ``__lines`` and ``__kept``, the lines outside the runs."""
    rows = rows.withColumn("__lines", F.split(F.coalesce(text, F.lit("")), "\n"))
    gone = F.flatten(F.transform(runs, lambda r: F.sequence(r.start, r.stop)))
    places = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.coalesce(gone, F.array().cast("array<int>")))
    rows = rows.withColumn("__places", places)
    return rows.withColumn("__kept", F.transform("__places", lambda i: F.col("__lines")[i]))


def dedup_lines(docs: DataFrame, *, divisor: int = 2, choices: int = 8, min_lines: int = 2, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines, n_removed_lines, kept_text.

    A run of lines is removed if an equal one stands in a document with a smaller doc_id, or
    earlier in the same, and it has ``min_lines`` lines or more with a character other than
    white space.  Every line removed stands at least once in what is left.

    Null texts are read as empty: one empty line, which is never removed.  A null doc_id
    comes before all others.  Rows of equal doc_id and text are copies of one document and
    lose the same lines; other rows that share a doc_id (null too) are documents of their
    own, ordered by a hash of the text.  Ties cannot occur, as (doc_id, text, place) orders
    all chunks.  Very long texts are cut whole; a run's row holds its two neighbours at most.
    Runs with a line whose 63-bit hash belongs to different lines of the corpus stay.  An
    empty table gives no rows; other columns are ignored.
    """
    runs = repeated_runs(docs, divisor=divisor, choices=choices, min_lines=min_lines, id_col=id_col, text_col=text_col)
    d = documents(docs, id_col, text_col)
    rows = _with_kept(d.join(runs, same_row(d, "doc_id", "text"), "left"), "text", "runs")
    return rows.select("doc_id", F.size("__lines").cast("bigint").alias("n_lines"),
                       (F.size("__lines") - F.size("__kept")).cast("bigint").alias("n_removed_lines"),
                       F.array_join("__kept", "\n").alias("kept_text"))


def drop_repeats(docs: DataFrame, *, divisor: int = 2, choices: int = 8, min_lines: int = 2, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``docs`` without the runs that stand earlier; rows and columns stay, and so do the
    texts (null too) that lose nothing."""
    runs = repeated_runs(docs, divisor=divisor, choices=choices, min_lines=min_lines, id_col=id_col, text_col=text_col)
    rows = _with_kept(docs.join(runs.withColumnRenamed("runs", "__runs"), same_row(docs, id_col, text_col), "left"), text_col, "__runs")
    text = F.when(F.col("__runs").isNotNull(), F.array_join("__kept", "\n")).otherwise(F.col(text_col))
    return rows.withColumn(text_col, text).select(*docs.columns)
