"""Timestamps: raw values to epoch milliseconds, and epoch milliseconds to +08:00 text. No session time zone is used."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillfeed.functions.binding import let
from quillfeed.functions.ids import SHORT_NUMBER
from quillfeed.functions.text import ascii_trim

OFFSET_MS = 8 * 3600 * 1000
#: 2000-01-01 and 10000-01-01 in UTC milliseconds; records lie between them on the +08:00 calendar.
FIRST_MS, END_MS = 946_684_800_000, 253_402_300_800_000
#: From here on a number is milliseconds, below it seconds.
MILLISECONDS_FROM = 1e11
UNKNOWN = "unknown"
#: Spellings of an unknown time, lower-cased.
UNKNOWN_SPELLINGS = ("", "unknown", "未知时间")

_ISO = r"\A([0-9]{4})-([0-9]{2})-([0-9]{2})[ T]([0-9]{2}):([0-9]{2}):([0-9]{2})(?:\.([0-9]{1,3}))?(?:(Z)|([+-])([0-9]{2}):([0-9]{2}))?\z"


def _in_range(ms: Column) -> Column:
    local = ms + F.lit(OFFSET_MS)
    return F.when((local >= FIRST_MS) & (local < END_MS), ms)


def epoch_ms_from_number(value: Column) -> Column:
    """Seconds or milliseconds as a number; null unless positive and in the years 2000 to 9999."""
    v = value.cast("double")
    finite = (v > 0) & (v < 1e18)
    ms = F.when(v >= MILLISECONDS_FROM, v).otherwise(v * 1000)
    return _in_range(F.when(finite, ms).try_cast("long"))


def _iso_epoch_ms(p: Column) -> Column:
    """Of the eleven parts of a matched date with time."""
    number = lambda k: p[k - 1].try_cast("int")
    fraction = F.rpad(p[6], 3, "0").try_cast("int")
    midnight = F.try_make_timestamp(number(1), number(2), number(3), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC"))
    valid = (number(1) >= 2000) & (number(4) <= 23) & (number(5) <= 59) & (number(6) <= 59)
    offset = (
        F.when(p[7] == "Z", F.lit(0))
        .when(p[8] == "", F.lit(480))
        .when((number(10) <= 23) & (number(11) <= 59), (number(10) * 60 + number(11)) * F.when(p[8] == "-", -1).otherwise(1))
    )
    clock = (number(4) * 3600 + number(5) * 60 + number(6)).cast("long") * 1000 + fraction
    return F.when(valid, F.unix_millis(midnight) + clock - offset.cast("long") * 60000)


def epoch_ms_from_text(value: Column) -> Column:
    """Digits as a number, or a date with time to the second; without an offset it is +08:00. Null if neither."""

    def of(t: Column) -> Column:
        digits = let(t.try_cast("double"), epoch_ms_from_number)
        parts = F.array(*(F.regexp_extract(t, _ISO, k) for k in range(1, 12)))
        return F.when(t.rlike(r"\A[0-9]+(?:\.[0-9]+)?\z"), digits).when(t.rlike(_ISO), let(parts, lambda p: let(_iso_epoch_ms(p), _in_range)))

    return let(ascii_trim(value), of)


def _inner(literal: Column) -> Column:
    """The text of a quoted JSON literal."""
    return F.get_json_object(F.concat(F.lit('{"x":'), literal, F.lit("}")), "$.x")


def epoch_ms_from_literal(literal: Column) -> Column:
    """Of a JSON literal: a number, a quoted text, or null."""
    other = let(literal, lambda x: F.when(x.startswith('"'), epoch_ms_from_text(_inner(x))).otherwise(let(x.try_cast("double"), epoch_ms_from_number)))
    n = literal.try_cast("long")
    short = F.when(n > 0, _in_range(F.when(n >= int(MILLISECONDS_FROM), n).otherwise(n * 1000)))
    return F.when(literal.rlike(SHORT_NUMBER), short).otherwise(other)  # nearly all times are short numbers


def format_epoch_ms(ms: Column) -> Column:
    """`YYYY-MM-DDThh:mm:ss+08:00`, or `unknown` for null."""

    seconds = F.floor((ms + F.lit(OFFSET_MS)) / 1000).cast("decimal(18,6)")
    local = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.coalesce(F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00")), F.lit(UNKNOWN))


def is_unknown_literal(literal: Column) -> Column:
    """Whether a JSON literal states that the time is unknown: null, 0, or one of the spellings."""
    spelled = lambda x: F.coalesce(F.lower(ascii_trim(_inner(x))), F.lit("")).isin(*UNKNOWN_SPELLINGS)
    return let(literal, lambda x: F.when(x.startswith('"'), spelled(x)).otherwise((x == "null") | (x.try_cast("double") == 0)))


def since_cutoff_ms(date: str) -> int:
    """Epoch milliseconds of midnight, +08:00, of a strict YYYY-MM-DD date; ValueError for any other text."""
    import datetime
    import re

    if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", date):
        raise ValueError(f"not a YYYY-MM-DD date: {date!r}")
    day = datetime.date.fromisoformat(date)
    return int((day - datetime.date(1970, 1, 1)).total_seconds() * 1000) - OFFSET_MS
