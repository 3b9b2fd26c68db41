"""Column helpers that pin the warehouse semantics the results depend on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text that stands for a null part inside a surrogate key,
# the separator between parts, and the digits kept before a threshold is tested.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
THRESHOLD_DIGITS = 6

# Unit sizes in milliseconds.
MS_PER_HOUR = 3_600_000
MS_PER_MINUTE = 60_000

_ISO_8601 = (
    r"^(\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,3})?)?)?)"
    r"(?:(?<=\.\d{3})\d+)?(?:Z|[+-]\d{2}(?::?\d{2}(?::\d{2})?)?)?$"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_to_long(c: Column | str) -> Column:
    """Fractional number to whole number, halves away from zero (a cast truncates).

    The fraction of a double is exact, so this needs no decimal arithmetic.
    """
    c = _col(c)
    size = F.abs(c)
    down = F.floor(size)
    up = down + (size - down >= 0.5).cast("long")
    return F.when(c < 0, -up).otherwise(up).cast("long")


def _ms_in(c: Column | str, unit: int) -> Column:
    """Milliseconds in a unit at six decimals, halves away from zero.

    The cast goes through the shortest text of the quotient, so a tie at the
    seventh decimal is seen as one; a decimal division would cost five times more.
    """
    return (_col(c).cast("double") / F.lit(float(unit))).cast("decimal(18,6)")


def ms_to_hours(c: Column | str) -> Column:
    return _ms_in(c, MS_PER_HOUR)


def ms_to_minutes(c: Column | str) -> Column:
    return _ms_in(c, MS_PER_MINUTE)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Number of minute boundaries from ``start`` to ``end`` (not elapsed minutes)."""

    start, end = _col(start), _col(end)

    def minute_of_day(c: Column) -> Column:
        return F.hour(c) * 60 + F.minute(c)

    days = F.datediff(F.to_date(end), F.to_date(start))
    return (days * 1440 + minute_of_day(end) - minute_of_day(start)).cast("long")


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient that is null where the denominator is zero or null."""
    return _col(numerator) / F.nullif(_col(denominator), F.lit(0))


def clamp(c: Column | str, low: float, high: float) -> Column:
    """Bound a value; a null stays null (greatest/least alone would skip it)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def stable(c: Column | str) -> Column:
    """Drop last-bit noise so that a threshold sees the same number everywhere."""
    return F.round(_col(c), THRESHOLD_DIGITS)


def weighted_sum(terms: Sequence[tuple[Column, float]]) -> Column:
    """Sum of column x weight, in double."""
    total: Column | None = None
    for c, weight in terms:
        part = c.cast("double") * F.lit(weight)
        total = part if total is None else total + part
    if total is None:
        raise ValueError("no terms")
    return total


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 text key over one or more columns, nulls marked by a fixed text."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_PART)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def hash64_key(*cols: Column | str) -> Column:
    """64-bit hash of the ``|``-joined columns; null if any of them is null."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("|"))
        parts.append(_col(c).cast("string"))
    joined = F.concat(*parts)
    return F.when(joined.isNotNull(), F.xxhash64(joined))


def parse_timestamp(c: Column | str) -> Column:
    """ISO-8601 text to wall-clock time: offset dropped, cut to milliseconds.

    Empty and unreadable text give null; see :func:`is_bad_timestamp`.
    """
    return F.regexp_extract(_col(c), _ISO_8601, 1).try_cast("timestamp_ntz")


def is_bad_timestamp(c: Column | str) -> Column:
    """True for text that is neither empty nor a readable timestamp."""
    c = _col(c)
    return F.coalesce((c != "") & parse_timestamp(c).isNull(), F.lit(False))


def date_key(d: Column | str) -> Column:
    """Date to its yyyymmdd number."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def list_as_json(c: Column | str) -> Column:
    """List (or other nested value) to JSON text."""
    return F.to_json(_col(c))
