"""Parsing and normalising raw text fields.

ANSI mode stays on everywhere; every parse of input text uses a ``try_``
form so one malformed value yields NULL for that row instead of aborting the
job, and the outcome never depends on which columns a consumer happens to read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.schemas import ORDER_DATE_FORMAT


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: str | Column) -> Column:
    """NULL, empty, or only spaces (``trim`` removes spaces, not tabs).

    Never NULL itself, so it is safe inside ``NOT`` and ``CASE``.
    """
    c = _col(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def parse_amount(c: str | Column) -> Column:
    """Text -> double; malformed text gives NULL (``" 12 "`` and ``1e3`` parse)."""
    return _col(c).try_cast("double")


def is_finite(c: str | Column) -> Column:
    """True for a real number; false for NULL, NaN and +/-Infinity.

    Spark orders NaN above every number, so ``NaN > 0`` is true and a later
    ``cast(sum as long)`` would fail; non-finite amounts are rejected up front.
    """
    c = _col(c)
    return F.coalesce(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.lit(False))


# Largest amount a row may have: the largest double that fits Gold's long total.
MAX_AMOUNT = float(2**63 - 2**10)


def normalise_status(c: str | Column) -> Column:
    """``upper(trim(status))``: folds ``success`` / `` Success `` / ``SUCCESS``."""
    return F.upper(F.trim(_col(c)))


def parse_date(c: str | Column, fmt: str = ORDER_DATE_FORMAT) -> Column:
    """Text -> date with a fixed pattern; anything else is NULL (row is kept)."""
    return F.try_to_date(_col(c), fmt)
