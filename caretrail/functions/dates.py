"""Calendar arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def complete_units(unit: str, start: Column, end: Column) -> Column:
    """Complete years, months, weeks or days between two dates, signed."""
    if unit == "day":
        return F.datediff(end, start)
    if unit == "week":
        return (F.datediff(end, start) / 7).cast("int")
    return F.timestamp_diff(unit.upper(), start.cast("timestamp_ntz"), end.cast("timestamp_ntz")).cast("int")


def months_between(start: Column, end: Column) -> Column:
    return complete_units("month", start, end)


def years_between(start: Column, end: Column) -> Column:
    return complete_units("year", start, end)


def age_at(birth: Column, at: Column) -> Column:
    """Whole years from one year on, before that the twelfths of a year."""
    years = years_between(birth, at)
    return F.when(years > 0, years.cast("double")).otherwise(F.round(months_between(birth, at) / 12, 2))


def yearweek(day: Column) -> Column:
    """Year and week with weeks starting on Sunday; days before the first Sunday belong to the year before."""

    def week_in_year(d: Column) -> Column:
        return F.floor((F.dayofyear(d) + 6 - (F.dayofweek(d) - 1)) / 7).cast("int")

    week = week_in_year(day)
    last_year = F.make_date(F.year(day) - 1, F.lit(12), F.lit(31))
    return F.when(week > 0, F.year(day) * 100 + week).otherwise(
        F.year(last_year) * 100 + week_in_year(last_year)
    )


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMM")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month").cast("date")


def within_month_of(day: Column, end: Column) -> Column:
    """The day lies between the first of the month of `end` and `end` itself."""
    return day.between(month_start(end), end)


def in_zone(stamp: Column, zone: str = "+03:00") -> Column:
    """UTC wall time as wall time of a fixed zone, whatever the session zone is."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), stamp.cast("timestamp_ntz"))


def due_date_from_period(last_period: Column) -> Column:
    return F.date_add(last_period, 280)


def due_date_from_weeks(seen: Column, weeks: Column) -> Column:
    return F.date_add(seen, ((40 - weeks) * 7).cast("int"))


def conception_from_due(due: Column) -> Column:
    return F.add_months(due, -9)


def date_from_parts(text: Column) -> Column:
    """Date from a text whose first ten characters read year-month-day; null when they do not."""
    return F.try_to_date(F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 6, 2), F.substring(text, 9, 2)), "yyyy-MM-dd")


def timely(created: Column, happened: Column) -> dict[str, Column]:
    """Entered in the month it happened, or before the 3rd or the 10th day after that month's last day."""
    end = F.last_day(happened)
    return {
        "by_month_end": F.last_day(created) == end,
        "by_3rd": created < F.date_add(end, 3),
        "by_10th": created < F.date_add(end, 10),
    }
