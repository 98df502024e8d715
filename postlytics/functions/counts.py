"""Human-readable counts such as ``12k`` or ``3M`` turned into numbers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col

# Suffix multipliers (case-sensitive) and the error placeholder.
DEFAULT_SUFFIXES: dict[str, int] = {"k": 1000, "M": 1000000}
DEFAULT_ERROR_VALUES: tuple[str, ...] = ("User Info Error",)


def count_multiplier(c: Column | str, suffixes: Mapping[str, int] = DEFAULT_SUFFIXES) -> Column:
    """Multiplier from the text's trailing suffix; 1 when none matches."""
    col = as_col(c)
    expr = None
    for suffix, factor in suffixes.items():
        cond = col.endswith(suffix)
        expr = F.when(cond, F.lit(factor).cast("bigint")) if expr is None \
            else expr.when(cond, F.lit(factor).cast("bigint"))
    return F.lit(1).cast("bigint") if expr is None else expr.otherwise(F.lit(1).cast("bigint"))


def parse_count(c: Column | str, suffixes: Mapping[str, int] = DEFAULT_SUFFIXES,
                error_values: Iterable[str] = DEFAULT_ERROR_VALUES,
                mode: str = "digits") -> Column:
    """Parse a count written as ``117``, ``12k`` or ``3M`` into a bigint.

    ``mode='digits'`` keeps the reference's rule: every non-digit is removed
    before the multiplier applies, so ``1.5k`` reads as 15 000.
    ``mode='decimal'`` keeps the decimal point, so ``1.5k`` reads as 1 500
    (fractions left after the multiplier are truncated).
    Error placeholders, empty text and text without digits give NULL; so does
    a product past the bigint range (ANSI-safe ``try_`` arithmetic, D2).
    """
    col = as_col(c)
    errors = list(error_values)
    mult = count_multiplier(col, suffixes)
    if mode == "digits":
        number = F.regexp_replace(col, r"[^0-9]+", "").try_cast("bigint")
        value = F.try_multiply(number, mult)
    elif mode == "decimal":
        number = F.regexp_replace(col, r"[^0-9.]+", "").try_cast("decimal(38,6)")
        value = F.try_multiply(number, mult.cast("decimal(38,6)")).try_cast("bigint")
    else:
        raise ValueError(f"unknown mode {mode!r}; expected 'digits' or 'decimal'")
    if errors:
        value = F.when(col.isin(errors), F.lit(None).cast("bigint")).otherwise(value)
    return value
