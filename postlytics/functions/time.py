"""Timestamp expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col

# Fixed value: timestamp text format of the messages.
MESSAGE_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


_MESSAGE_TS_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def to_ts(c: Column | str, fmt: str | None = MESSAGE_TS_FORMAT) -> Column:
    """Text to timestamp; malformed text gives NULL instead of failing (D3).

    Only text of exactly the pattern ``fmt`` is accepted, so time-only text (which
    a cast would date today), zone suffixes and ISO forms are malformed. The message
    format is checked by shape and then cast, which is faster than a pattern parser;
    ``fmt=None`` parses like a cast.
    """
    col = as_col(c)
    if fmt is None:
        return col.try_cast("timestamp")
    if fmt == MESSAGE_TS_FORMAT:
        return F.when(col.rlike(_MESSAGE_TS_SHAPE), col.try_cast("timestamp"))
    return F.try_to_timestamp(col, F.lit(fmt))


def ts_text(c: Column | str, fmt: str = MESSAGE_TS_FORMAT) -> Column:
    """Timestamp to text in the message format."""
    return F.date_format(as_col(c), fmt)
