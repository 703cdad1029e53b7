"""Column expressions on dates, clock times and durations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from eavcube.functions.text import first_token, map_labels, trim_whitespace

# Month and season labels of the time dimension.
MONTH_NAMES = {
    1: "Enero", 2: "Febrero", 3: "Marzo", 4: "Abril", 5: "Mayo", 6: "Junio",
    7: "Julio", 8: "Agosto", 9: "Septiembre", 10: "Octubre", 11: "Noviembre", 12: "Diciembre",
}
SEASON_NAMES = {1: "Invierno", 2: "Primavera", 3: "Verano", 4: "Otoño"}

ISO_THEN_DAY_FIRST = ("yyyy-M-d", "d/M/yyyy")
DAY_FIRST = ("d/M/yyyy",)


def parse_date(c: Column, formats: Sequence[str] = ISO_THEN_DAY_FIRST) -> Column:
    """First format that fits the part before the first space; NULL when none does.

    The shape is tested first: a failed parse costs far more than a pattern that does not match.
    """
    text = first_token(trim_whitespace(c))
    return F.coalesce(*[F.when(text.rlike(_shape(f)), F.try_to_date(text, f)) for f in formats])


def _shape(pattern: str) -> str:
    body = pattern.replace("yyyy", "{Y}").replace("M", "{D}").replace("d", "{D}")
    return "^" + body.format(Y=r"\d{4}", D=r"\d{1,2}") + "$"


def clock_seconds(c: Column) -> Column:
    """Seconds of day of `H:MM` or `H:MM:SS`; NULL when it is not a clock time."""
    hour, minute, second = _clock_parts(c)
    valid = (hour < 24) & (minute < 60) & (second < 60)
    return F.when(valid, hour * 3600 + minute * 60 + second).cast("int")


def duration_seconds(c: Column) -> Column:
    """Seconds of an `H:MM[:SS]` duration (hours may exceed 24) or of `N day(s)`."""
    text = F.lower(F.trim(c))
    hour, minute, second = _clock_parts(c, hours=r"\d+")
    days = F.regexp_extract(text, r"^(\d+) days?$", 1).try_cast("bigint")
    clock = F.when((minute < 60) & (second < 60), hour * 3600 + minute * 60 + second)
    return F.coalesce(clock, days * 86400).cast("bigint")


def _clock_parts(c: Column, hours: str = r"\d{1,2}") -> tuple[Column, Column, Column]:
    pattern = rf"^({hours}):(\d{{2}})(?::(\d{{2}}))?$"
    text = F.trim(c)
    hour, minute, second = (F.regexp_extract(text, pattern, i).try_cast("bigint") for i in (1, 2, 3))
    return hour, minute, F.coalesce(second, F.lit(0))


def seconds_to_hours(c: Column) -> Column:
    return c / F.lit(3600.0)


def days_before(start: Column, observed: Column) -> Column:
    """Whole days from the observation to the start (positive: observed earlier)."""
    return F.datediff(start, observed)


def in_lag_window(lag: Column, low: int, high: int) -> Column:
    """Lag within the closed range of days."""
    return lag.between(low, high)


def season_number(date: Column) -> Column:
    """1 December-February, 2 March-May, 3 June-August, 4 September-November."""
    return F.floor(F.month(date) % 12 / 3).cast("int") + 1


def season_name(date: Column) -> Column:
    return map_labels(season_number(date), SEASON_NAMES)


def month_name(date: Column) -> Column:
    return map_labels(F.month(date), MONTH_NAMES)


def is_weekend(date: Column) -> Column:
    return F.dayofweek(date).isin(1, 7)


def ends_before_start(start: Column, end: Column, detected: Column, arrived: Column) -> Column:
    """End date before the start, or the same day with arrival before detection."""
    return (end < start) | ((end == start) & (arrived < detected))
