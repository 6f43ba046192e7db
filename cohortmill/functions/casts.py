"""Text -> typed value, null instead of an error.

The guards make the accepted texts explicit: engines differ on `2024-01`,
`12.7` and `1e3`, so none of them is let through to a plain cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FULL_DATE = r"^\d{4}-\d{2}-\d{2}"
YEAR_MONTH = r"^\d{4}-\d{2}$"
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"


def strict_date(column: Column, partial_dates: str = "null") -> Column:
    """`yyyy-MM-dd`, also with a time behind it. `partial_dates="first_of_month"`
    also reads `yyyy-MM`, which registries send for planned dates."""
    text = F.trim(column)
    full = F.when(text.rlike(FULL_DATE), text.try_cast("date"))
    if partial_dates == "null":
        return full
    if partial_dates == "first_of_month":
        month = F.when(text.rlike(YEAR_MONTH), F.concat(text, F.lit("-01")).try_cast("date"))
        return F.coalesce(full, month)
    raise ValueError(f"partial_dates must be 'null' or 'first_of_month', not {partial_dates!r}")


def strict_int(column: Column) -> Column:
    return F.when(column.rlike(WHOLE_NUMBER), column.try_cast("int"))
