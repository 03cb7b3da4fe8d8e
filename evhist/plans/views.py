"""S9 views and S10 bounded result hand-off."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .models import Models

VIEW_NAMES = {
    "stg_events": "stg_events", "stg_event_snapshots": "snapshots", "dim_artists": "dim_artists",
    "dim_venues": "dim_venues", "fct_events": "fct_events", "fct_events_by_city": "fct_events_by_city",
}


def register_views(m: Models, prefix: str = "") -> list[str]:
    """Expose the models as temporary views for ``spark.sql`` (lazy, like a SQL view)."""
    names = []
    for view, attr in VIEW_NAMES.items():
        getattr(m, attr).createOrReplaceTempView(prefix + view)
        names.append(prefix + view)
    return names


class ResultTooLarge(RuntimeError):
    pass


def to_local(df: DataFrame, max_rows: int = 100_000):
    """Hand a result to a local pandas frame only if it has at most ``max_rows`` rows.

    The bound is checked on executors (``limit(max_rows + 1)``), so an
    unbounded result never reaches the driver.
    """
    pdf = df.limit(max_rows + 1).toPandas()
    if len(pdf) > max_rows:
        raise ResultTooLarge(f"result has more than {max_rows} rows; aggregate or filter first")
    return pdf
