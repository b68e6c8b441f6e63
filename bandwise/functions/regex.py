"""Regular-expression column functions.

Spark uses Java regular expressions. Python-only syntax is rewritten:
``(?P<name>...)`` -> ``(?<name>...)``, ``(?P=name)`` -> ``\\k<name>``,
``\\Z`` -> ``\\z``. Conditional groups ``(?(1)yes|no)`` have no Java form; use
:func:`conditional_match` (two predicates in a CASE) instead.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAMED_GROUP = re.compile(r"\(\?P<([A-Za-z_][A-Za-z0-9_]*)>")
_NAMED_REF = re.compile(r"\(\?P=([A-Za-z_][A-Za-z0-9_]*)\)")
_COND = re.compile(r"\(\?\(")


def to_java_regex(pattern: str) -> str:
    """Rewrite Python ``re`` syntax to Java syntax."""
    if _COND.search(pattern):
        raise ValueError("conditional groups are not supported; use conditional_match()")
    out = _NAMED_GROUP.sub(r"(?<\1>", pattern)
    out = _NAMED_REF.sub(r"\\k<\1>", out)
    # \Z (Python: end of string) -> \z (Java: end of input); keep escaped backslashes.
    out = re.sub(r"(?<!\\)((?:\\\\)*)\\Z", r"\1\\z", out)
    return out


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def search(col, pattern: str, required: str | None = None) -> Column:
    """True when the pattern matches anywhere (``re.search``).

    ``required``: a literal every match must contain (e.g. "@" for e-mail
    addresses); rows without it skip the regex engine. Nulls stay null."""
    c = _c(col)
    hit = c.rlike(to_java_regex(pattern))
    if required is None:
        return hit
    return F.when(c.isNull(), F.lit(None).cast("boolean")).when(c.contains(required), hit) \
        .otherwise(F.lit(False))


def first_match(col, pattern: str) -> Column:
    """First matching substring, null when there is none (R2)."""
    return F.regexp_substr(_c(col), F.lit(to_java_regex(pattern)))


def group(col, pattern: str, idx: int = 1) -> Column:
    """Capture group ``idx`` of the first match, null when nothing matches."""
    p = to_java_regex(pattern)
    return F.when(_c(col).rlike(p), F.regexp_extract(_c(col), p, idx))


def groups(col, pattern: str, n: int) -> Column:
    """Array of capture groups 1..n of the first match, null when nothing matches."""
    p = to_java_regex(pattern)
    return F.when(_c(col).rlike(p), F.array(*[F.regexp_extract(_c(col), p, i) for i in range(1, n + 1)]))


def all_matches(col, pattern: str, idx: int = 0) -> Column:
    """All non-overlapping matches (``re.findall``) of group ``idx``."""
    return F.regexp_extract_all(_c(col), F.lit(to_java_regex(pattern)), F.lit(idx))


def conditional_match(col, condition: str, yes: str, no: str) -> Column:
    """Equivalent of a conditional group: when ``condition`` matches, the text must
    match ``yes``, otherwise ``no`` (R11)."""
    c = _c(col)
    return F.when(c.rlike(to_java_regex(condition)), c.rlike(to_java_regex(yes))) \
        .otherwise(c.rlike(to_java_regex(no)))


def split_list(col, sep: str) -> Column:
    """Split text by a literal separator into an array."""
    return F.split(_c(col), re.escape(sep))


def join_list(col, sep: str) -> Column:
    """Join an array of strings with a separator."""
    return F.array_join(_c(col), sep)
