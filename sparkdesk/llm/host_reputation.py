"""URL filters: rules first, then empirical-Bayes host reputation.

Labelled page outcomes (bad or not) give each host a beta-binomial posterior.  Its prior has
the posterior mean of the registered domain, whose prior has that of the suffix, whose prior
has the overall mean; each level's prior strength is estimated from how much the shares at
that level vary beyond chance.  A host is blocked if even the lower bound of its posterior
share of bad pages is above the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.llm.common import lower_ascii
from sparkdesk.session import write_scratch

#: Rules as (verdict, host and path); the longest that fits wins.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]

#: Suffixes of two labels under which names are registered (a parameter of the operator).
TWO_LABEL_SUFFIXES = ["co.jp", "co.uk", "com.au", "com.br", "org.uk"]

#: Bounds of the correlation between the pages of one host, domain or suffix.
LEAST_RHO, MOST_RHO = 0.001, 0.5


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null and for a text without "://"."""
    pattern = r"://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return lower_ascii(part(1)), part(2)


def _rule_columns(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The winning rule and its verdict, null where none fits.  Of rules of equal length the
    one with the longer host wins, then the one that blocks."""
    split = [(v, r, r.partition("/")[0], r[r.find("/"):] if "/" in r else "") for v, r in rules]
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r, host, path in sorted(split, key=lambda x: (len(x[1]), len(x[2]), x[0] == "block")):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _domain_and_suffix(host: Column, two_label: list[str]) -> tuple[Column, Column]:
    two = F.substring_index(host, ".", -2)
    long_suffix = two.isin(two_label)
    return (F.when(long_suffix, F.substring_index(host, ".", -3)).otherwise(two),
            F.when(long_suffix, two).otherwise(F.substring_index(host, ".", -1)))


def _shrunk(units: DataFrame, name: str) -> DataFrame:
    """``units`` (n, bad, prior mean m) with the posterior's ``a`` and ``b``.

    The correlation rho within a unit solves sum n (p - m)^2 = sum m (1 - m) (1 + (n - 1) rho);
    the prior counts as 1 / rho - 1 pages.  Two sums reach the driver.
    """
    p = F.col("bad") / F.col("n")
    spread = F.col("m") * (1 - F.col("m"))
    over, room = (units.filter("n > 0").agg(F.sum(F.col("n") * (p - F.col("m")) * (p - F.col("m")) - spread),
                                            F.sum(spread * (F.col("n") - 1))).first())
    rho = min(MOST_RHO, max(LEAST_RHO, over / room)) if room else MOST_RHO
    strength = 1 / rho - 1
    return (units.withColumn("a", strength * F.col("m") + F.col("bad"))
            .withColumn("b", strength * (1 - F.col("m")) + F.col("n") - F.col("bad"))
            .withColumn(f"{name}_mean", F.col("a") / (F.col("a") + F.col("b"))))


def host_posteriors(outcomes: DataFrame, *, two_label_suffixes: list[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """(host, n, bad, a, b) from rows of (host, bad): bad is 1 or 0, null if the page has no label.

    Hosts are counted first (one row for each task and host reaches the shuffle); all
    further levels are sums of those rows.
    """
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    domain, suffix = _domain_and_suffix(F.col("host"), two_label_suffixes)
    hosts = write_scratch(hosts.select("host", "n", "bad", domain.alias("domain"), suffix.alias("suffix")), "hosts")
    total = lambda df, *by: df.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    suffixes = _shrunk(total(hosts, "suffix").withColumn("m", F.lit((bad + 1) / (n + 2))), "suffix")
    domains = total(hosts, "domain", "suffix").join(suffixes.select("suffix", F.col("suffix_mean").alias("m")), "suffix")
    domains = _shrunk(domains, "domain")
    hosts = _shrunk(hosts.join(domains.select("domain", F.col("domain_mean").alias("m")), "domain"), "host")
    return hosts.select("host", "n", "bad", "a", "b")


def judge_urls(pages: DataFrame, labels: DataFrame, *, rules: list[tuple[str, str]] = RULES, max_bad: float = 0.5,
               z: float = 1.645, two_label_suffixes: list[str] = TWO_LABEL_SUFFIXES, id_col: str = "page_id",
               url_col: str = "url", label_id_col: str = "doc_id", quality_col: str = "quality",
               toxic_col: str = "toxic") -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, n, bad, bad_low.

    A page's outcome is the label of its id: bad if the quality is 0 or toxic is 1.
    ``bad_low`` is the lower bound of the host's share of bad pages (mean less ``z`` standard
    deviations of the posterior); without a rule, hosts above ``max_bad`` are blocked.

    Null urls and those without "://" have an empty host and path, and the empty host is judged
    like any other; labels that are null, and pages without a label or id, count for nothing;
    every repeated label counts; empty tables give no rows or the prior alone; other columns
    are ignored.
    """
    host, path = url_parts(pages[url_col])
    judged = pages.select(pages[id_col].alias("page_id"), host.alias("host"), path.alias("path"))
    bad = (labels[quality_col] == 0) | (labels[toxic_col] == 1)
    known = labels.select(labels[label_id_col].alias("label_id"), bad.cast("int").alias("bad"))
    outcomes = judged.join(known, F.col("page_id") == F.col("label_id"), "left").select("host", "bad")
    a, b = F.col("a"), F.col("b")
    low = a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    hosts = (host_posteriors(outcomes, two_label_suffixes=two_label_suffixes)
             .select(F.col("host").alias("of_host"), "n", "bad", low.alias("bad_low")))
    rule, verdict = _rule_columns(rules)
    by_method = F.when(F.col("bad_low") > max_bad, "block").otherwise("allow")
    return (judged.join(hosts, F.col("host") == F.col("of_host"))
            .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"),
                    "n", "bad", "bad_low"))
