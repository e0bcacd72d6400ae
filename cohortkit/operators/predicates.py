"""Filter helpers (FLT1-FLT11) that keep Parquet pushdown working."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import or_
from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeops import ntz_literal

_META = set(".^$*+?{}[]\\|()")

# Fixed value: a version row is current when it is valid beyond this date.
CURRENT_AFTER = dt.date(2099, 12, 31)


def literal_prefix(pattern: str) -> str:
    """Literal text an anchored regex must start with ('' if none).

    ``'^027[0-3]'`` -> ``'027'``.  A quantifier after the last literal char
    makes that char optional, so it is dropped.  Alternation at top level
    gives no prefix.
    """
    if not pattern.startswith("^") or "|" in pattern:
        return ""
    out = []
    i = 1
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern) and not pattern[i + 1].isalnum():
            out.append(pattern[i + 1])
            i += 2
            continue
        if ch in _META:
            if ch in "*?{" and out:
                out.pop()
            break
        out.append(ch)
        i += 1
    return "".join(out)


#: prefixes beyond which a further class is not expanded (the regex decides then)
MAX_PREFIXES = 256


def _class_chars(body: str) -> list[str]:
    """Members of a plain character class; [] where it is negated or holds escapes."""
    if not body or body[0] == "^" or "\\" in body or "[" in body or "&&" in body:
        return []
    out, i = [], 0
    while i < len(body):
        if i + 2 < len(body) and body[i + 1] == "-":
            out += [chr(c) for c in range(ord(body[i]), ord(body[i + 2]) + 1)]
            i += 3
        else:
            out.append(body[i])
            i += 1
    return list(dict.fromkeys(out))


def literal_prefixes(pattern: str) -> list[str]:
    """Every text an anchored regex can start with, classes expanded ([] if none).

    ``'^027[0-3]'`` -> 0270, 0271, 0272, 0273.  A quantifier after a char or
    class ends the list there (``+`` keeps it, the others drop it).
    """
    if not pattern.startswith("^") or "|" in pattern or "(" in pattern:
        return [p for p in [literal_prefix(pattern)] if p]
    out, i = [""], 1
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern) and not pattern[i + 1].isalnum():
            step, end = [pattern[i + 1]], i + 2
        elif ch == "[" and "]" in pattern[i + 2:]:
            end = pattern.index("]", i + 2) + 1
            step = _class_chars(pattern[i + 1:end - 1])
        elif ch in _META:
            break
        else:
            step, end = [ch], i + 1
        after = pattern[end:end + 1]
        if not step or after in ("*", "?", "{") and after or len(out) * len(step) > MAX_PREFIXES:
            break
        out = [p + c for p in out for c in step]
        if after == "+":
            break
        i = end
    return [] if out == [""] else out


def matches(col: str | Column, pattern: str) -> Column:
    """Regex match (FLT2/FLT3).  An anchored pattern also gets a
    ``startswith`` on each text it can start with, and on what these have in
    common: both are pushed to the Parquet reader (``rlike`` itself is not), so
    row groups are skipped early."""
    c = F.col(col) if isinstance(col, str) else col
    cond = c.rlike(pattern)
    texts = literal_prefixes(pattern)
    if not texts:
        return cond
    cond = reduce(or_, [c.startswith(p) for p in texts]) & cond
    common = commonprefix(texts)
    return c.startswith(common) & cond if common and common not in texts else cond


def in_codes(df: DataFrame, col: str, codes) -> DataFrame:
    """IN-list filter (FLT5).  A Python list becomes ``isin`` (pushed to the
    scan); a DataFrame code set becomes a left-semi join, so a large list is
    never inlined into the plan."""
    if isinstance(codes, DataFrame):
        key = codes.columns[0]
        return df.join(codes.select(F.col(key).alias(col)), on=col, how="left_semi")
    return df.filter(F.col(col).isin(list(codes)))


def current_rows(df: DataFrame, valid_until: str = "valid_until_dt_tm",
                 after: dt.date = CURRENT_AFTER) -> DataFrame:
    """Keep the current version of each row (FLT8): valid beyond ``after``."""
    return df.filter(F.col(valid_until) > ntz_literal(after))


def between(col: str | Column, lo: Column, hi: Column) -> Column:
    """Closed interval (FLT6)."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= lo) & (c <= hi)


def before(col: str | Column, bound: str | Column, strict: bool) -> Column:
    """Time bound taken from another table (FLT7): ``<`` or ``<=``.
    A NULL bound makes the comparison unknown, so the row is dropped."""
    c = F.col(col) if isinstance(col, str) else col
    b = F.col(bound) if isinstance(bound, str) else bound
    return c < b if strict else c <= b


def any_of(conds: Iterable[Column]) -> Column:
    """Disjunction under SQL three-valued logic (FLT9)."""
    conds = list(conds)
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def complete(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Rows with none of ``cols`` missing (FLT10)."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df if cond is None else df.filter(cond)


def negate(col: str) -> Column:
    """Negated logical (FLT11); NULL stays NULL and the row is dropped."""
    return ~F.col(col)
