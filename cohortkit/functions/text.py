"""Scalar text / logical functions (SC7-SC16).  All are built-in column
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flag_text(col, true_value=1) -> Column:
    """Simple CASE to text (SC7): ``'TRUE'`` when equal to ``true_value``,
    otherwise -- NULL included -- ``'FALSE'``."""
    return F.when(_c(col) == F.lit(true_value), F.lit("TRUE")).otherwise(F.lit("FALSE"))


def first_true(pairs: Sequence[tuple[Column | str, str]], default: str | None = None) -> Column:
    """First-true CASE over flags (SC8): label of the first flag that is TRUE.
    A NULL flag counts as not matched; no match gives ``default`` (NULL)."""
    expr = None
    for flag, label in pairs:
        expr = F.when(_c(flag), F.lit(label)) if expr is None else expr.when(_c(flag), F.lit(label))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def fill(col, value) -> Column:
    """Coalesce to a default (SC9)."""
    return F.coalesce(_c(col), F.lit(value))


def to_missing(col, value) -> Column:
    """Value -> missing (SC10)."""
    return F.nullif(_c(col), F.lit(value))


def present(col) -> Column:
    """Presence flag (SC11)."""
    return _c(col).isNotNull()


def title_case(col) -> Column:
    """Title case, words split on blanks (SC12)."""
    return F.initcap(_c(col))


def strip_prefix(col, pattern: str) -> Column:
    """Regex replace of a leading pattern (SC13)."""
    return F.regexp_replace(_c(col), pattern, "")


def safe_number(col, to: str = "double") -> Column:
    """Text -> number, anything unparsable -> NULL (SC14, ANSI-safe)."""
    return _c(col).try_cast(to)


def is_one(col) -> Column:
    """Number -> logical keeping NULL (SC15)."""
    return _c(col) == F.lit(1)
