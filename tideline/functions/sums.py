"""Sums and means that do not depend on task order.

Adding doubles gives a last digit that depends on which task finished first,
and labels compare sums with strict limits. Inputs are added as they are, in
doubles; the result is rounded to nine digits after the point, which clears
the order's noise for results up to about ten thousand. Larger ones keep their
digits, the last of which may then vary. Means of rounded values often lie
halfway between two results, where noise would decide; the border is therefore
drawn a little below the half (``BESIDE``). NaN counts as missing, as in the
landed files, where both stand for an absent reading; infinities stay.
"""
from __future__ import annotations

from pyspark.sql import Column, Window, functions as F

DIGITS = 9
BESIDE = 1.37e-11


def value(col) -> Column:
    col = (F.col(col) if isinstance(col, str) else col).cast("double")
    return F.when(~F.isnan(col), col)


def settle(x: Column) -> Column:
    """Nine digits after the point, as SQL's ROUND on doubles has them; for sizes below 1e299."""
    return F.round((x + F.lit(BESIDE)) * F.lit(10.0 ** DIGITS), 0) / F.lit(10.0 ** DIGITS)


def total(col) -> Column:
    return settle(F.sum(value(col)))


def mean(col) -> Column:
    return settle(F.avg(value(col)))


def total_over(col, window: Window) -> Column:
    return settle(F.sum(value(col)).over(window))


def mean_over(col, window: Window) -> Column:
    return settle(F.avg(value(col)).over(window))
