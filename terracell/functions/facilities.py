"""Was a facility open in a year?  Two rules, one for borders and one for points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def open_in_year(year: int) -> Column:
    """Border rule: opened by the end of the year, not closed before it began, in operation."""
    return (
        (F.col("date") <= F.lit(f"{year}-12-31"))
        & (F.col("date_c").isNull() | (F.col("date_c") >= F.lit(f"{year}-01-01")))
        & (F.col("operation") == 1)
    )


def open_by_year_prefix(year: int) -> Column:
    """Point rule: only the years of opening and closing count, the operation flag does not."""
    return (F.substring("date", 1, 4).cast("int") <= year) & (
        F.col("date_c").isNull() | (F.substring("date_c", 1, 4).cast("int") >= year)
    )
