"""Clock arithmetic: HHMM integers, local and UTC instants, epoch keys, calendar ladders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ladder


def _instant(col: Column) -> Column:
    return col.cast("timestamp_ntz")


def epoch_seconds(col: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), _instant(col))


def epoch_micros(col: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), _instant(col))


def epoch_day(col: Column) -> Column:
    return F.date_diff(F.to_date(col), F.lit("1970-01-01").cast("date"))


def hhmm(col: Column) -> Column:
    """Clock reading of an instant as an integer such as 1345."""
    return F.hour(col) * 100 + F.minute(col)


def hhmm_hour(col: Column) -> Column:
    return F.floor(col / 100).cast("int")


def hhmm_minute(col: Column) -> Column:
    return (col % 100).cast("int")


def hhmm_minutes(col: Column) -> Column:
    """Minutes since midnight; null when the minute part is not a minute or the hour is over 24."""
    valid = (hhmm_minute(col) < 60) & (col >= 0) & (col <= 2400)
    return F.when(valid, hhmm_hour(col) * 60 + hhmm_minute(col))


def local_instant(day: Column, clock: Column) -> Column:
    """Date plus HHMM; 2400 is midnight of the next day."""
    return F.timestamp_add("MINUTE", hhmm_minutes(clock), _instant(day))


def prediction_instant(local: Column, zone: Column, horizon_hours: int) -> Column:
    """Local instant moved back by the horizon, then to UTC by the zone named in a column."""
    moved = F.timestamp_add("HOUR", F.lit(-horizon_hours), _instant(local))
    return F.convert_timezone(zone, F.lit("UTC"), moved)


def hours_between(start: Column, end: Column) -> Column:
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(3.6e9)


# Fixed labels: season by month number, time block by hour.
def season(month: Column) -> Column:
    return ladder(
        [
            (month.isin(12, 1, 2), "Winter"),
            (month.isin(3, 4, 5), "Spring"),
            (month.isin(6, 7, 8), "Summer"),
        ],
        "Fall",
    )


def time_block(hour: Column) -> Column:
    return ladder(
        [
            (hour.between(0, 5), "Early AM (12-6a)"),
            (hour.between(6, 11), "Morning (6a-12p)"),
            (hour.between(12, 16), "Afternoon (12-5p)"),
            (hour.between(17, 20), "Evening (5-9p)"),
        ],
        "Night (9p-12a)",
    )


def gap_class(hours: Column) -> Column:
    return ladder(
        [
            (hours < 1, "Quick (<1h)"),
            (hours < 3, "Normal (1-3h)"),
            (hours < 6, "Long (3-6h)"),
            (hours >= 6, "Very Long (>6h)"),
        ],
        None,
    )
