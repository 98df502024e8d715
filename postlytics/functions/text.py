"""Text expressions: name joining, prefix removal, character patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col


def join_names(*parts: Column | str) -> Column:
    """Join name parts with one space, trimmed, inner whitespace collapsed.

    NULL parts are skipped; all NULL gives the empty string (D18).
    """
    joined = F.concat_ws(" ", *[as_col(p) for p in parts])
    return F.regexp_replace(F.trim(joined), r"\s+", " ")


def without_prefix(c: Column | str, prefix: str) -> Column:
    """Remove ``prefix`` when the text starts with it; other text is unchanged."""
    col = as_col(c)
    quoted = "\\Q" + prefix.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    return F.regexp_replace(col, "^" + quoted, "")


def digit_pattern(c: Column | str, collapse_runs: bool = True) -> Column:
    """Shape of a value: every digit (or run of digits) becomes ``9``."""
    return F.regexp_replace(as_col(c), r"[0-9]+" if collapse_runs else r"[0-9]", "9")
