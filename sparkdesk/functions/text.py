"""String, date and masking expressions (all JVM-side except the pandas cross-check)."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# The card mask replaces characters 5..12 (1-based) with eight 'X'.
MASK_TEXT = "XXXXXXXX"
MASK_START = 5
MASK_LEN = 8

# Characters a Python str.strip() removes in the taxi lines we care about.
WHITE = " \t\r\n\x0b\x0c"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Trim space, tab, CR, LF, VT and FF from both ends (Python ``str.strip`` on ASCII)."""
    return F.btrim(_c(col), F.lit(WHITE))


def card_mask(col) -> Column:
    """Characters 5-12 replaced with 'XXXXXXXX' (pandas ``str.slice_replace(4, 12, ...)``).

    Shorter strings behave like the slice: text past the end is appended, so
    ``'123'`` becomes ``'123XXXXXXXX'``.  NULL stays NULL.
    """
    return F.overlay(_c(col), F.lit(MASK_TEXT), F.lit(MASK_START), F.lit(MASK_LEN))


@pandas_udf(returnType=StringType())
def card_mask_pandas(s: pd.Series) -> pd.Series:
    """Arrow-batched twin of :func:`card_mask`, kept as a cross-check of the native form."""
    return s.str.slice_replace(MASK_START - 1, MASK_START - 1 + MASK_LEN, MASK_TEXT)


def iso_weekday(col) -> Column:
    """ISO weekday, Monday = 1 ... Sunday = 7 (Spark ``weekday`` is Monday = 0)."""
    return F.weekday(_c(col)) + F.lit(1)


def iso_weekday_of(run_date: str) -> int:
    return dt.datetime.strptime(run_date, "%Y-%m-%d").isoweekday()


def day_range(col, day: str) -> Column:
    """``to_date(col) = day`` written as a half-open range so it reaches the parquet scan."""
    start = dt.datetime.strptime(day, "%Y-%m-%d")
    end = start + dt.timedelta(days=1)
    c = _c(col)
    return (c >= F.lit(start).cast("timestamp_ntz")) & (c < F.lit(end).cast("timestamp_ntz"))
