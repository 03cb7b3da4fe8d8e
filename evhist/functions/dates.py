"""Date helpers: run date (``as_of``) and the plausibility window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import PLAUSIBLE_YEARS_AHEAD, PLAUSIBLE_YEARS_BACK



def as_of_col(as_of: str | dt.date | None) -> Column:
    """The run date as a DATE column; ``None`` means ``current_date()``."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def is_plausible(col: Column | str, as_of: str | dt.date | None = None,
                 back: int = PLAUSIBLE_YEARS_BACK, ahead: int = PLAUSIBLE_YEARS_AHEAD) -> Column:
    """NULL, or within [as_of - back years, as_of + ahead years]."""
    day = as_of_col(as_of)
    c = F.col(col) if isinstance(col, str) else col
    return c.isNull() | c.between(F.add_months(day, -12 * back), F.add_months(day, 12 * ahead))


def plausible_dates(df: DataFrame, col: str = "event_date", as_of: str | dt.date | None = None,
                    back: int = PLAUSIBLE_YEARS_BACK, ahead: int = PLAUSIBLE_YEARS_AHEAD) -> DataFrame:
    """keep NULL dates and dates within the window."""
    return df.where(is_plausible(col, as_of, back, ahead))
