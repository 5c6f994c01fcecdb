"""Surrogate keys: md5 over normalised text, identical in every engine.

``surrogate_key(a, b)`` = md5(norm(a) || '|' || norm(b) || '|'), where
norm(x) = coalesce(lower(trim(string(x))), ''); the trailing pipe is part of
the format. Timestamps enter through ``ts_to_key`` (millisecond text with no
dot before the milliseconds), dates render as midnight.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the key text.
KEY_SEPARATOR = "|"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_to_key(c) -> Column:
    """yyyy-MM-ddTHH:mm:ssSSS of a date or a zoneless timestamp, cut from its
    text: ``date_format`` would go through the session time zone."""
    text = _c(c).cast("timestamp_ntz").cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8),
                    F.rpad(F.substring(text, 21, 3), 3, "0"))


def day_to_key(c) -> Column:
    """``ts_to_key`` of a date: its text and midnight."""
    return F.concat(F.substring(_c(c).cast("string"), 1, 10), F.lit("T00:00:00000"))


def surrogate_key(*cols) -> Column:
    parts = []
    for c in cols:
        parts.append(F.coalesce(F.lower(F.trim(_c(c).cast("string"))), F.lit("")))
        parts.append(F.lit(KEY_SEPARATOR))
    return F.md5(F.concat(*parts))


def project_row_key(project_id, month) -> Column:
    """Row key of the project fact: md5(id '|' yyyyMMdd), no trailing pipe, no lower."""
    return F.md5(F.concat_ws(
        KEY_SEPARATOR,
        F.coalesce(_c(project_id).cast("string"), F.lit("")),
        F.coalesce(F.replace(_c(month).cast("date").cast("string"), F.lit("-"), F.lit("")), F.lit(""))))


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal built from text, so it never depends on the
    session or process time zone (``F.lit(datetime)`` would)."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def month_start(c) -> Column:
    """date_trunc('month', c)::date"""
    return F.trunc(_c(c), "month")


HEX, PAD = r"^[0-9a-f]{32}\z", b"\0" * 17      # fixed values: see packed


def packed(key) -> Column:
    """A key's text as bytes, unequal texts as unequal bytes: the 32 digits of a
    surrogate key are 16 bytes, any other text is 17 bytes longer than it is."""
    text = _c(key).cast("string")
    return F.when(text.rlike(HEX), F.unhex(text)).otherwise(F.concat(text.cast("binary"), F.lit(PAD)))


def unpacked(key) -> Column:
    """The text of ``packed`` bytes."""
    held = _c(key)
    return F.when(F.octet_length(held) == 16, F.lower(F.hex(held))).otherwise(
        F.substring(held, F.lit(1), F.octet_length(held) - len(PAD)).cast("string"))
