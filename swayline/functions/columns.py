"""Column expressions shared by the operators. All of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, functions as F

from swayline.config import URL_PATTERN


def midnight(day: date) -> Column:
    """A zone-free timestamp literal, so that no session time zone takes part in comparisons."""
    return F.expr(f"TIMESTAMP_NTZ '{day.isoformat()} 00:00:00'")


def strict_timestamp(text: Column) -> Column:
    """Text to timestamp; a value that is present but unreadable raises, whatever the ANSI setting."""
    parsed = text.try_cast("timestamp_ntz")
    complaint = F.concat(F.lit("not a timestamp: "), text)
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(complaint)).otherwise(parsed)


def zoned_timestamp(text: Column) -> Column:
    """Text to zone-free timestamp; a zone suffix (``Z``, ``+02:00``) is turned to UTC, and one that is present but unreadable raises."""
    zoned = text.rlike(r"\d(Z|[+-]\d{2}:?\d{2})$") & text.contains(":")
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz"))
    parsed = F.when(zoned, utc).otherwise(text.try_cast("timestamp_ntz"))
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(F.concat(F.lit("not a timestamp: "), text))).otherwise(parsed)


def lenient_timestamp(text: Column, formats: Sequence[str]) -> Column:
    """First format that fits, else null. The formats say the day/month order; nothing is guessed."""
    tries = [F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz") for fmt in formats]
    return F.coalesce(*tries)


def whole_days_until(day: date, start: Column) -> Column:
    """Whole days from ``start`` to midnight of ``day``, rounded towards minus infinity."""
    start_day = F.to_date(start)
    partial = (start.cast("timestamp_ntz") > start_day.cast("timestamp_ntz")).cast("int")
    return (F.date_diff(F.lit(day), start_day) - partial).cast("bigint")


def url_part(url: Column, group: int) -> Column:
    """Domain (1), category (2) or page (3) of a visit URL; null where the pattern is absent."""
    return F.nullif(F.regexp_extract(url, URL_PATTERN, group), F.lit(""))


def is_own_domain(domain: Column, token: str) -> Column:
    return F.coalesce(domain.contains(token), F.lit(False))


def code_prefix(code: Column) -> Column:
    return F.substring(code, 1, 3)


def code_bit(code: Column, wanted: Sequence[str]) -> Column:
    """A number with the bit of the listed code set; 0 for any other code and for null. At most 63 codes."""
    bit = F.lit(0).cast("bigint")
    for i, c in reversed(list(enumerate(wanted))):
        bit = F.when(code == c, F.lit(1 << i).cast("bigint")).otherwise(bit)
    return bit


def has_bit(bits: Column, i: int) -> Column:
    return F.getbit(bits, F.lit(i)).cast("int")


def hash32(*parts: Column) -> Column:
    """Deterministic 32-bit value of ``a:b:...``, equal on every engine that has MD5."""
    joined = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")


def hash_share(*parts: Column) -> Column:
    """``hash32`` as a share in [0, 1)."""
    return hash32(*parts) / F.lit(4294967296.0)


def clean(score: Column) -> Column:
    """NaN has no place in an ordering: treat it as missing. Negative zero is zero."""
    value = score.cast("double")
    return F.when(~F.isnan(value), value + F.lit(0.0))


def rate(hits: Column, n: Column) -> Column:
    """``hits / n`` as a double, null on an empty group."""
    return F.try_divide(hits.cast("double"), n.cast("double"))
