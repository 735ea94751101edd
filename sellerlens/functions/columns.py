"""Column expressions shared by the operators; all of them stay in codegen."""

from __future__ import annotations

import hashlib
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    return F.trim(_col(c))


def cleaned(c: Column | str) -> Column:
    """Lower case without surrounding spaces (tabs stay, as in SQL TRIM)."""
    return F.lower(trimmed(c))


def parsed_timestamp(c: Column | str) -> Column:
    """ISO text with or without fractions; unreadable text becomes null, also under ANSI."""
    return F.try_to_timestamp(_col(c))


def parsed_date(c: Column | str) -> Column:
    return trimmed(c).try_cast("date")


def parsed_number(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def open_interval(c: Column | str, low: float, high: float) -> Column:
    return (_col(c) > F.lit(low)) & (_col(c) < F.lit(high))


def ratio(part: Column | str, whole: Column | str) -> Column:
    """part / whole, and 0.0 where there is nothing to divide by."""
    return F.when(_col(whole) > 0, _col(part) / _col(whole)).otherwise(F.lit(0.0))


def as_of_column(as_of: str | date | datetime | None) -> Column:
    """The run's reference instant, read in the session time zone; null means now."""
    if as_of is None:
        return F.current_timestamp()
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else str(as_of)
    return F.lit(text).cast("timestamp")


def masked(c: Column | str, salt: str | None = None) -> Column:
    """SHA-256 hex digest; null stays null.

    Without a salt the digest of a small id space can be reversed by hashing every
    possible id. The unsalted form is the default for comparable output; pass a
    secret salt wherever the result leaves the trusted zone.
    """
    value = _col(c)
    return F.sha2(value if salt is None else F.concat(F.lit(salt), value), 256)


def masked_prefix(c: Column | str, length: int = 8, salt: str | None = None) -> Column:
    return F.substring(masked(c, salt), 1, length)


def keyed_mask(c: Column | str, secret: bytes) -> Column:
    """HMAC-SHA256 of the text as hex digits; null stays null.

    Unlike a salted digest it says nothing without the secret, which stands in the query's plan: keep plans
    and event logs where the secret may be.
    """
    key = (hashlib.sha256(secret).digest() if len(secret) > 64 else secret).ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(b ^ pad for b in key)) for pad in (0x36, 0x5C))
    digest = F.sha2(F.concat(inner, F.encode(_col(c), "UTF-8")), 256)
    return F.sha2(F.concat(outer, F.unhex(digest)), 256)
