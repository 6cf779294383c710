"""Tag predicates and lookups (P2, P3, P4, O2) as Column expressions.

Tags are ``ARRAY<STRING>``; registry entries carry ``ARRAY<STRUCT<name>>``,
``tag_names`` turns those into strings.  Everything runs as higher-order
functions inside whole-stage code generation, no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tag_names(tags: Column | str) -> Column:
    """``ARRAY<STRUCT<name>>`` → ``ARRAY<STRING>``."""
    return F.transform(_c(tags), lambda t: t["name"])


def has_tag_prefix(tags: Column | str, prefix: str) -> Column:
    """True when at least one tag starts with ``prefix``."""
    return F.coalesce(F.exists(_c(tags), lambda t: t.startswith(prefix)), F.lit(False))


def tag_value(tags: Column | str, prefix: str, separator_len: int = 1) -> Column:
    """First tag (array order) starting with ``prefix``, without the
    prefix and ``separator_len`` separator characters; null when none."""
    first = F.try_element_at(F.filter(_c(tags), lambda t: t.startswith(prefix)), F.lit(1))
    return F.substring(first, len(prefix) + separator_len + 1, 1 << 30)


def has_tag(tags: Column | str, value: str) -> Column:
    """Exact tag match."""
    return F.coalesce(F.array_contains(_c(tags), value), F.lit(False))


def first_match(tags: Column | str, prefix: str) -> Column:
    """O2: the matching tag that sorts first (tags are a set, so the
    smallest match stands in for "the first"); null when none."""
    return F.array_min(F.filter(_c(tags), lambda t: t.startswith(prefix)))
