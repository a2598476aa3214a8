"""Column expressions (scalar functions). All JVM-side, no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridemart.sources.schemas import BOOKING_TS_PATTERN

# Calendar order of weekday names and of weather groups.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
WEATHER_GROUPS = ["Dry/Clear", "Overcast/Fog", "Light Rain", "Heavy Rain", "Snow/Ice"]

# Weather grouping, case-insensitive substring match, first hit wins,
# anything else (including NULL) is Dry/Clear.
WEATHER_GROUP_RULES = [
    ("Snow/Ice", ["snow", "blizzard", "sleet", "ice"]),
    ("Heavy Rain", ["heavy rain", "moderate rain", "torrential"]),
    ("Light Rain", ["light rain", "drizzle", "patchy rain", "shower"]),
    ("Overcast/Fog", ["fog", "mist", "overcast", "cloudy"]),
]
WEATHER_DEFAULT_GROUP = "Dry/Clear"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: str | Column, pattern: str = BOOKING_TS_PATTERN) -> Column:
    """Text -> timestamp; unparseable or blank text is NULL (ANSI to_timestamp would raise)."""
    return F.try_to_timestamp(col(c), F.lit(pattern))


def parse_number(c: str | Column) -> Column:
    """Text with thousands separators -> double: every ',' removed, bad text is NULL."""
    return F.regexp_replace(col(c), ",", "").try_cast("double")


def parse_int(c: str | Column) -> Column:
    """Text or number -> integer; '85.0' is 85 and '85.9' is 85, bad text is NULL."""
    return col(c).try_cast("double").try_cast("int")


def blank_to_null(c: str | Column) -> Column:
    """NULL when the trimmed text is empty, otherwise the value unchanged (not trimmed)."""
    c = col(c)
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def conform_text(c: str | Column) -> Column:
    """initcap(trim(x)); words split on whitespace only ('B/E13' -> 'B/e13')."""
    return F.initcap(F.trim(col(c)))


def minutes_between(later: str | Column, earlier: str | Column) -> Column:
    """Whole-second difference in minutes as a double (negative when out of order)."""
    return (F.unix_timestamp(col(later)) - F.unix_timestamp(col(earlier))) / F.lit(60)


def date_key(d: str | Column) -> Column:
    """yyyyMMdd as an int, computed arithmetically (no string round trip)."""
    d = col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_name(d: str | Column) -> Column:
    return F.date_format(col(d), "EEEE")


def month_name(d: str | Column) -> Column:
    return F.date_format(col(d), "MMMM")


def weekend_flag(d: str | Column) -> Column:
    return F.dayofweek(col(d)).isin(1, 7)


def weekday_index(day: str | Column) -> Column:
    """1 = Monday ... 7 = Sunday for a weekday name, NULL for anything else."""
    idx = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), col(day))
    return F.when(idx > 0, idx.cast("int"))


def weather_group(desc: str | Column) -> Column:
    """Weather description -> group by the fixed keyword cascade (one CASE expression)."""
    lowered = F.lower(col(desc))
    expr = None
    for group, words in WEATHER_GROUP_RULES:
        cond = None
        for w in words:
            hit = lowered.contains(w)
            cond = hit if cond is None else (cond | hit)
        cond = F.coalesce(cond, F.lit(False))
        expr = F.when(cond, F.lit(group)) if expr is None else expr.when(cond, F.lit(group))
    return expr.otherwise(F.lit(WEATHER_DEFAULT_GROUP))


def weather_group_index(group: str | Column) -> Column:
    return F.array_position(F.array(*[F.lit(g) for g in WEATHER_GROUPS]), col(group)).cast("int")


def safe_divide(num: str | Column, den: str | Column) -> Column:
    """num / den with a zero divisor replaced by 1 (ANSI division by zero would raise)."""
    den = col(den)
    return col(num) / F.when(den == 0, F.lit(1)).otherwise(den)


def money(c: str | Column, symbol: str = "£") -> Column:
    """Display text such as '£1,234.50'."""
    return F.concat(F.lit(symbol), F.format_number(col(c), 2))
