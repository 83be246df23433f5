"""Calendar columns. Months are DATEs on the first of the month, never strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Season names of the two vocabularies, in the order winter, spring, summer, autumn.
SEASONS_PT = ("inverno", "primavera", "verão", "outono")
SEASONS_EN = ("Winter", "Spring", "Summer", "Autumn")


def season(month: Column, names=SEASONS_PT) -> Column:
    winter, spring, summer, autumn = names
    return (
        F.when(month.isin(12, 1, 2), winter)
        .when(month.isin(3, 4, 5), spring)
        .when(month.isin(6, 7, 8), summer)
        .otherwise(autumn)
    )


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def days_in_month(date: Column) -> Column:
    return F.dayofmonth(F.last_day(date))


def with_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    d = F.col(date)
    return df.withColumns(
        {
            "year": F.year(d),
            "month": F.month(d),
            "day": F.dayofmonth(d),
            "day_of_week": F.weekday(d),
            "week_of_year": F.weekofyear(d),
            "season": season(F.month(d)),
            "month_start": month_start(d),
        }
    )


def month_from_text(text: Column) -> Column:
    """'yyyy-MM' -> DATE."""
    return F.to_date(F.concat(text, F.lit("-01")))


def week_ending_sunday(date: Column) -> Column:
    return F.date_add(F.trunc(date, "WEEK"), 6)
