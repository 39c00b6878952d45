"""Date parsing and date predicates."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names in front of a date.
_WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
_REST = "d MMM yyyy H:m:s 'GMT'"
_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"


def has_date(raw: Column) -> Column:
    """True where a date text is given at all."""
    return raw.isNotNull() & (raw != "")


def parse_rfc1123(raw: Column) -> Column:
    """``Mon, 05 Jan 2021 10:00:00 GMT`` to a timestamp without zone.

    Null and empty texts give null; any other text that does not parse raises.
    The weekday is checked to be one, and then ignored.
    """
    named = F.lower(F.substring(raw, 1, 3)).isin(_WEEKDAYS) & (F.substring(raw, 4, 2) == ", ")
    # without a weekday in front the text is malformed, and marked so that it does not parse
    text = F.when(named, F.ltrim(F.substring(raw, 6, 64))).otherwise(F.concat(F.lit("? "), raw))
    return F.when(has_date(raw), F.to_timestamp_ntz(text, F.lit(_REST)))


def parse_iso(raw: Column) -> Column:
    """ISO date and time to a timestamp without zone; the local time is kept.

    Texts that do not parse give null.
    """
    return F.regexp_replace(F.trim(raw), _OFFSET, "").try_cast("timestamp_ntz")


def in_window(date: Column, lo: datetime | None, hi: datetime | None) -> Column:
    """``lo < date < hi``, both ends excluded; ``None`` leaves an end open."""
    ends = [date > _ntz(lo)] if lo is not None else []
    if hi is not None:
        ends.append(date < _ntz(hi))
    return reduce(and_, ends) if ends else date.isNotNull()


def day(date: Column) -> Column:
    """Midnight of the day, still a timestamp."""
    return F.to_date(date).cast("timestamp_ntz")


def _ntz(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
