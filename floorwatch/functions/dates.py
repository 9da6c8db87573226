"""Dates in file names and week columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from floorwatch.config import FILE_DATE_FORMAT, TEXT_DATE_FORMAT


def file_date(text: Column) -> Column:
    """'250131' as a date; NULL for '' and for days that do not exist."""
    return F.try_to_date(text, FILE_DATE_FORMAT)


def date_text(day: Column) -> Column:
    return F.date_format(day, TEXT_DATE_FORMAT)


def text_date(text: Column) -> Column:
    return F.try_to_date(text, TEXT_DATE_FORMAT)


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day)


def week_columns(day: Column, by_iso_year: bool = False) -> tuple[Column, Column]:
    """(week, year): ISO week with the calendar year, or with its own ISO year."""
    year = iso_year(day) if by_iso_year else F.year(day)
    return F.weekofyear(day).alias("week"), year.alias("year")


def year_week(year: Column, week: Column) -> Column:
    return year * 100 + week
