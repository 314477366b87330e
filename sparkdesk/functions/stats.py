"""Aggregate expressions that stay defined under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_corr(x, y) -> Column:
    """Pearson correlation over rows where both values are present.

    ``F.corr`` raises DIVIDE_BY_ZERO on a constant group under ANSI; this form
    returns NULL instead (no variance -> correlation undefined).
    """
    xc, yc = _c(x), _c(y)
    both = xc.isNotNull() & yc.isNotNull()
    xs = F.when(both, xc.cast("double"))
    ys = F.when(both, yc.cast("double"))
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def round_half(col, scale: int = 6) -> Column:
    """Round a double to a fixed scale for stable reports; ``+ 0.0`` folds -0.0 into 0.0."""
    return F.round(_c(col).cast("double"), scale) + F.lit(0.0)


def usable(col, scale: int = 6, precision: int = 26) -> Column:
    """The one rule for numbers in exact sums and means: a value that is NULL, NaN,
    infinite or of more than ``precision - scale`` whole digits is left out, of the
    sum *and* of the count."""
    c = _c(col)
    whole = c.cast("double")
    return F.when(~F.isnan(whole) & (F.abs(whole) < F.lit(10.0 ** (precision - scale))), c)


def left_out(col, scale: int = 6, precision: int = 26) -> Column:
    """How many values :func:`usable` leaves out of a sum or mean (NULLs are no values): a
    report that gives it beside the sum accounts for every number."""
    return F.count(_c(col)) - F.count(usable(col, scale, precision))


def exact_sum(col, scale: int = 6, precision: int = 26) -> Column:
    """Sum through ``decimal(precision, scale)``: exact and order-independent, so the
    same on every engine and every partitioning.

    Values are taken to ``scale`` decimals (pass the data's own number if it has more);
    those outside :func:`usable` are left out.  NULL for an empty group, and where the
    total itself does not fit in 38 digits.
    """
    return F.try_sum(usable(col, scale, precision).cast(f"decimal({precision},{scale})")).cast("double")


def exact_avg(col, scale: int = 6, precision: int = 26) -> Column:
    """Mean as ``exact_sum / count`` over the same values (NULL for an empty group).

    A plain double ``avg`` depends on summation order; this one is one IEEE
    division of two exact numbers, so repeated runs and other engines agree
    to the last bit.
    """
    return F.try_divide(exact_sum(col, scale, precision), F.count(usable(col, scale, precision)).cast("double"))
