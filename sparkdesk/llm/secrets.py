"""Secret scans with corpus-wide ownership.

Three patterns give base spans.  Long mixed tokens are weak candidates: they become spans
("owned") only if the corpus shows them with few owners and few repositories, since a value
that many hold is a copied example and not a live credential.  A text that stands in several
places has one owner, so a mirror adds a repository only.  Owners and repositories of a value
are counted over all candidates, by hash, so no value leaves its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.llm.common import documents
from sparkdesk.session import write_scratch

#: Each kind's pattern, the group that holds the value, and its least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Of a run of at least so many characters the longest match is the whole run, so these
#: two hold their least length in the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = {"assign": (ASSIGN, 2, 8), "access": (ACCESS, 0, 16), "hex": (HEX, 0, 32)}
#: A weak candidate: a long run with a digit and a letter.
MIXED = r"[A-Za-z0-9+/_=-]{20,}"

#: Every ``ASSIGN`` match holds one of these in lower case; looking for them is much cheaper.
ASSIGN_PARTS = ["passw", "secret", "token", "api"]


def _may_assign(text: Column) -> Column:
    low = F.lower(text)
    found = F.lit(False)
    for part in ASSIGN_PARTS:
        found = found | low.contains(part)
    return found


def _with_spans(d: DataFrame, kind: str, pattern: str, group: int, least: int, guard: Column) -> DataFrame:
    """Adds an array of (start, rank, kind, end, hash) for the matches whose value is long enough.

    The text between matches and the matches themselves, in turn, give the places.
    """
    rank = F.lit([*KINDS, "owned"].index(kind))
    d = (d.withColumn("found", F.when(guard, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
         .withColumn("between", F.when(F.size("found") > 0, F.split("text", pattern)))
         .withColumn("values", F.when(F.size("found") > 0, F.regexp_extract_all("text", F.lit(pattern), F.lit(group)))))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,hash:string>>")
    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(a, i):
        start = a.at + F.length(F.col("between")[i])
        end = start + F.length(F.col("found")[i])
        span = F.struct(start.alias("start"), rank.alias("rank"), F.lit(kind).alias("kind"), end.alias("end"),
                        F.sha2(F.col("values")[i], 256).alias("hash"))
        long_enough = F.length(F.col("values")[i]) >= least
        return F.struct(end.alias("at"), F.when(long_enough, F.concat(a.spans, F.array(span))).otherwise(a.spans).alias("spans"))

    places = F.when(F.size("found") > 0, F.sequence(F.lit(0), F.size("found") - 1))
    return (d.withColumn(kind, F.coalesce(F.aggregate(places, begin, step, lambda a: a.spans), none))
            .drop("found", "between", "values"))


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories), from rows of (hash, body, owner, repository).

    ``body`` stands for the text that holds the value; its owner is the smallest of its rows'.
    Equal rows are merged before the shuffle, so a value that is copied a million times
    costs a row for each task and pair.
    """
    first = found.groupBy("hash", "body").agg(F.min("owner").alias("owner"))
    owners = (first.select("hash", "owner").distinct().groupBy("hash").agg(F.count("*").alias("n_owners")))
    repositories = (found.select("hash", "repository").distinct()
                    .groupBy("hash").agg(F.count("*").alias("n_repositories")))
    return owners.join(repositories, "hash")


def scan_secrets(docs: DataFrame, *, max_owners: int = 1, max_repositories: int = 10, id_col: str = "doc_id",
                 text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base (spans as text), spans (with
    the added ones), n_live, n_copied.

    Places count code points, the end is exclusive, spans are ordered by start and kind.  A
    value of at most ``max_owners`` owners and ``max_repositories`` repositories is
    live-looking, any other is copied; a value that two kinds find counts once.  Equal texts count for one owner, the smallest of theirs.

    Null and empty texts have no spans; null owners and repositories each count as one;
    very long texts are scanned whole; repeated rows get the same spans and add neither an
    owner nor a repository; an empty table gives no rows; other columns are ignored.
    """
    d = documents(docs, id_col, text_col, docs[owner_col].alias("owner"), docs[repository_col].alias("repository"))
    d = d.withColumn("row", F.monotonically_increasing_id())
    for kind, (pattern, group, least) in KINDS.items():
        d = _with_spans(d, kind, pattern, group, least, _may_assign(F.col("text")) if kind == "assign" else F.lit(True))
    d = _with_spans(d, "owned", MIXED, 0, 20, F.lit(True))
    d = d.withColumn("base", F.concat(*KINDS))
    span_text = lambda s: F.substring(F.col("text"), s.start + 1, s.end - s.start)
    weak = F.filter("owned", lambda s: span_text(s).rlike("[0-9]") & span_text(s).rlike("[A-Za-z]")
                    & ~F.exists("base", lambda b: (b.start < s.end) & (s.start < b.end)))
    scanned = write_scratch(d.select("row", "doc_id", "owner", "repository", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
                                     F.xxhash64("text").alias("body"), "base", weak.alias("weak")), "secret_candidates")
    each = scanned.select("row", "body", "owner", "repository", F.inline_outer(F.concat("base", "weak"))).filter("hash IS NOT NULL")
    counts = write_scratch(ownership(each), "secret_owners")
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)
    added = F.collect_list(F.when((F.col("kind") == "owned") & live, F.struct("start", "rank", "kind", "end", "hash")))
    values = lambda those: F.size(F.collect_set(F.when(those, F.col("hash")))).cast("bigint")
    marked = (each.join(counts, "hash").groupBy("row")
              .agg(values(live).alias("n_live"), values(~live).alias("n_copied"), added.alias("added")))
    n = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    every = F.concat("base", F.coalesce("added", F.slice("base", 1, 0)))
    return (scanned.join(marked, "row", "left")
            .select("doc_id", *[f"n_{k}" for k in KINDS], _text_of(F.col("base")).alias("base"),
                    _text_of(every).alias("spans"), n("n_live"), n("n_copied")))
