"""Hash keys for vault hubs and links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stands for a NULL part; every other part begins with a digit.
NULL_PART = "N"


def key_text(*cols) -> Column:
    """Canonical text of a composite business key.

    Every part is trimmed and upper-cased, and written as its length, a colon and itself;
    a NULL part is a mark of its own.  So two keys have the same text only if all parts
    are equal, whatever characters they hold.
    """
    part = lambda x: F.concat(F.length(x).cast("string"), F.lit(":"), x)
    texts = [F.upper(F.trim(F.col(c).cast("string"))) for c in cols]
    return F.concat(*[F.coalesce(part(x), F.lit(NULL_PART)) for x in texts])


def hash_key(*cols) -> Column:
    """SHA-256 hex digest of :func:`key_text`."""
    return F.sha2(key_text(*cols), 256)
