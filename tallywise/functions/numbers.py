"""Text to number coercion with the reference's lenient rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywise.functions.text import col_

__all__ = ["to_number", "to_number_or_zero", "within", "same_or_both_null", "non_negative"]

# Plain decimal or scientific notation, or a signed infinity. Spark's cast also
# accepts suffixes such as ``1d``; the guard keeps those (and ``NaN``) out so
# they become null.
_NUMERIC = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def to_number(c) -> Column:
    """Text (or number) to double; anything non-numeric becomes null."""
    s = col_(c).cast("string")
    return F.when(s.rlike(_NUMERIC), F.trim(s).try_cast("double"))


def to_number_or_zero(c) -> Column:
    return F.coalesce(to_number(c), F.lit(0.0))


def within(a, b, tol: float) -> Column:
    """``|a - b| < tol``, false when either side is null."""
    return F.coalesce(F.abs(col_(a) - col_(b)) < F.lit(tol), F.lit(False))


def same_or_both_null(a, b) -> Column:
    return col_(a).eqNullSafe(col_(b))


def non_negative(c) -> Column:
    return F.greatest(F.lit(0.0), col_(c))
