"""Bucketing expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col

# Age bands as (label, lowest age, highest age), None = open end.
DEFAULT_AGE_BANDS: tuple[tuple[str, int, int | None], ...] = (
    ("18-24", 18, 24),
    ("25-35", 25, 35),
    ("36-50", 36, 50),
    ("+50", 51, None),
)
UNKNOWN_AGE = "Unknown"


def age_band(c: Column | str, bands: Sequence[tuple[str, int, int | None]] = DEFAULT_AGE_BANDS,
             unknown: str = UNKNOWN_AGE) -> Column:
    """Label of the first band holding the age; ``unknown`` for NULL or no band."""
    col = as_col(c)
    expr = None
    for label, low, high in bands:
        cond = col >= low if high is None else col.between(low, high)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.lit(unknown) if expr is None else expr.otherwise(unknown)
