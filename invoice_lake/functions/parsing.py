"""Brazilian-format text to typed values. Text that does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# day/month/year with an optional time of day
_BR_TIMESTAMP = r"^(\d{1,2})/(\d{1,2})/(\d{4})( \d{1,2}:\d{1,2}:\d{1,2})?$"


def _dotted(text: Column) -> Column:
    """'1.234,56' -> '1234.56'"""
    return F.replace(F.replace(text.cast("string"), F.lit("."), F.lit("")), F.lit(","), F.lit("."))


def parse_br_timestamp(text: Column) -> Column:
    """'01/03/2026 14:30:00' or '01/03/2026' to a timestamp without time zone.

    The text is rearranged and cast, not parsed as an instant, so that the session time zone and
    its daylight-saving gaps cannot move or drop a value.
    """
    text = F.trim(text)
    # A text that does not match comes back unchanged; it must not be read as an ISO date.
    iso = F.regexp_replace(text, _BR_TIMESTAMP, "$3-$2-$1$4")
    return F.when(iso != text, iso.try_cast("timestamp_ntz"))


def parse_br_int(text: Column) -> Column:
    """'1.234' -> 1234. A fraction is rounded half up, which a plain cast to bigint would reject."""
    number = _dotted(text)
    rounded = F.round(number.try_cast("decimal(38,10)"), 0).try_cast("bigint")
    # A failing decimal cast is slow, so only texts with a fraction or an exponent try it.
    return F.coalesce(number.try_cast("bigint"), F.when(number.rlike("[.eE]"), rounded))


def parse_br_decimal(text: Column, keep_sign: bool = False) -> Column:
    """'R$ 1.234,56' -> 1234.56. The minus sign is dropped unless ``keep_sign`` is set."""
    digits = F.regexp_replace(_dotted(text), "[^0-9.]", "")
    value = F.nullif(digits, F.lit("")).try_cast("decimal(18,2)")
    if keep_sign:
        value = F.when(text.rlike("^[^0-9]*-"), F.negate(value)).otherwise(value).cast("decimal(18,2)")
    return value
