"""Dashboard and finding queries.

Every function takes current fact rows (or the daily aggregate) and returns a
small DataFrame; filters are predicates that Catalyst pushes towards the scan,
aggregation runs on executors, and only the final frame would be collected by
a caller.  Filter defaults ("all non-NULL cities/genres, full date range") are
written as NULL tests, which keep exactly the same rows as ``isin`` over the
complete value lists and ``between`` the global date bounds, without pulling
those lists to the driver first.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import LOOKAHEAD_DAYS, TOP_GENRES_N, UPCOMING_ROWS
from ..functions.dates import as_of_col
from ..operators.quantile import exact_quantiles

# FIXED VALUES: shown columns and their headings.
UPCOMING_DISPLAY = [
    ("event_name", "Event"), ("fetched_city", "City"), ("event_date", "Date"),
    ("artist_name", "Artist"), ("venue_name", "Venue"), ("genre", "Genre"),
    ("price_min", "Min Price"), ("price_max", "Max Price"), ("event_url", "Ticket Link"),
]


def _date(x) -> Column:
    return F.lit(str(x)).cast("date")


def dashboard_filter(df: DataFrame, cities: Sequence[str] | None = None,
                     genres: Sequence[str] | None = None,
                     start: str | dt.date | None = None, end: str | dt.date | None = None) -> DataFrame:
    """multi-select on city and genre plus an inclusive date range.

    ``None`` = the dashboard default (every non-NULL value / the full range).
    NULL city, genre or date never passes, as with ``isin`` and comparisons.
    """
    city = F.col("fetched_city")
    genre = F.col("genre")
    day = F.col("event_date")
    cond = (city.isin(list(cities)) if cities is not None else city.isNotNull())
    cond = cond & (genre.isin(list(genres)) if genres is not None else genre.isNotNull())
    cond = cond & (day >= _date(start) if start is not None else day.isNotNull())
    if end is not None:
        cond = cond & (day <= _date(end))
    return df.where(cond)


def kpis(f: DataFrame) -> DataFrame:
    """Totals; artists are counted by name, venues by id.

    ``avg_min_price`` is NULL when no row has a price (shown as N/A)."""
    return f.agg(F.count(F.lit(1)).alias("total_events"),
                 F.count_distinct("artist_name").alias("unique_artists"),
                 F.count_distinct("venue_id").alias("unique_venues"),
                 F.avg("price_min").alias("avg_min_price"))


def price_text(c: Column | str) -> Column:
    """Display form ``$x.xx``, ``N/A`` when there is no value."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), F.lit("N/A")).otherwise(F.format_string("$%.2f", c))


def kpi_display(k: DataFrame) -> DataFrame:
    """K1 as shown: the average price as text."""
    return k.select("total_events", "unique_artists", "unique_venues",
                    price_text("avg_min_price").alias("avg_min_price"))


def events_by_city(f: DataFrame) -> DataFrame:
    """K2/A2: events per city, ascending."""
    return (f.groupBy("fetched_city").agg(F.count(F.lit(1)).alias("total_events"))
            .orderBy("total_events", "fetched_city"))


def top_genres(f: DataFrame, n: int = TOP_GENRES_N) -> DataFrame:
    """K3/A3: the ``n`` largest genres (ties by name) -> TakeOrderedAndProject."""
    return (f.groupBy("genre").agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy(F.col("event_count").desc(), F.col("genre").asc_nulls_last()).limit(n))


def events_over_time(daily: DataFrame, as_of: str | dt.date | None = None,
                     days: int = LOOKAHEAD_DAYS, lower_bound: bool = False) -> DataFrame:
    """K4/A4: daily totals per city up to ``as_of + days`` (no lower bound by default, T12)."""
    day = F.col("event_date")
    cond = day <= F.date_add(as_of_col(as_of), days)
    if lower_bound:
        cond = cond & (day >= as_of_col(as_of))
    return (daily.where(cond).groupBy("event_date", "fetched_city")
            .agg(F.sum("total_events").cast("long").alias("total_events")))


def price_distribution(f: DataFrame, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Box-plot figures of ``price_min`` per city.

    Rows are first reduced to (city, price, count) with a map-side-combined
    aggregate — a hot city costs one row per distinct price, not per event.
    Exact quartiles come from rank selection over prefix counts
    (``operators.quantile``), so a hot city's prices spread over many tasks;
    whiskers are the most extreme prices inside the 1.5 x IQR fences, from the
    same counted rows.  ``exact=False`` uses ``percentile_approx``.
    """
    priced = f.where(F.col("price_min").isNotNull())
    counts = priced.groupBy("fetched_city", "price_min").agg(F.count(F.lit(1)).alias("_n"))
    probs, names = (0.25, 0.5, 0.75), ("q1", "median", "q3")
    if exact:
        quartiles = exact_quantiles(counts, "fetched_city", "price_min", "_n", probs, names)
    else:
        sketch = F.percentile_approx("price_min", F.array(*map(F.lit, probs)), accuracy)
        quartiles = priced.groupBy("fetched_city").agg(sketch.alias("_q"))
        quartiles = quartiles.select("fetched_city", *(F.col("_q")[i].cast("double").alias(n) for i, n in enumerate(names)))
    rows = counts.join(quartiles, "fetched_city")
    iqr = F.col("q3") - F.col("q1")
    rows = (rows.withColumn("lower_fence", F.col("q1") - F.lit(1.5) * iqr)
                .withColumn("upper_fence", F.col("q3") + F.lit(1.5) * iqr))
    p = F.col("price_min")
    inside = p.between(F.col("lower_fence"), F.col("upper_fence"))
    same = [F.first(c).alias(c) for c in ("q1", "median", "q3", "lower_fence", "upper_fence")]
    return (rows.groupBy("fetched_city")
            .agg(F.sum("_n").cast("long").alias("n"), F.min(p).alias("min_price"), F.max(p).alias("max_price"), *same,
                 F.min(F.when(inside, p)).alias("lower_whisker"), F.max(F.when(inside, p)).alias("upper_whisker"),
                 F.sum(F.when(~inside, F.col("_n")).otherwise(0)).cast("long").alias("n_outliers"))
            .select("fetched_city", "n", "min_price", "q1", "median", "q3", "max_price", "lower_fence", "upper_fence",
                    "lower_whisker", "upper_whisker", "n_outliers"))


def venue_map(venues: DataFrame, f: DataFrame) -> DataFrame:
    """Current mappable venues with their event counts (inner join)."""
    counts = f.groupBy("venue_id").agg(F.count(F.lit(1)).alias("event_count"))
    return mappable_venues(venues).join(counts, "venue_id", "inner").select(*venues.columns, "event_count")


def mappable_venues(venues: DataFrame) -> DataFrame:
    """current venue versions with both coordinates."""
    return venues.where(F.col("venue_latitude").isNotNull() & F.col("venue_longitude").isNotNull()
                        & F.col("is_current"))


def filter_values(f: DataFrame) -> DataFrame:
    """Distinct non-NULL cities and genres (kind, value), sorted."""
    pair = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value"))
    both = f.select(F.inline(F.array(pair("city", "fetched_city"), pair("genre", "genre"))))
    return both.where(F.col("value").isNotNull()).distinct().orderBy("kind", "value")


def date_bounds(f: DataFrame) -> DataFrame:
    """K7/A10: the default date range."""
    return f.agg(F.min("event_date").alias("min_date"), F.max("event_date").alias("max_date"))


def upcoming_events(f: DataFrame, n: int = UPCOMING_ROWS) -> DataFrame:
    """K8/O1/O2: first ``n`` rows by event date (NULLs last, T14), display names.

    The event key breaks ties so that the ``n`` rows are reproducible.
    """
    ordered = f.orderBy(F.col("event_date").asc_nulls_last(), F.col("event_sk").asc()).limit(n)
    return ordered.select(*[F.col(c).alias(d) for c, d in UPCOMING_DISPLAY])


def upcoming_counts(f: DataFrame, n: int = UPCOMING_ROWS) -> DataFrame:
    """K8 caption: rows shown and rows available."""
    return f.agg(F.count(F.lit(1)).alias("total")).select(
        F.least(F.col("total"), F.lit(n).cast("long")).alias("shown"), "total")


def city_share(f: DataFrame) -> DataFrame:
    """K9: each city's share of all filtered events.

    The window runs over the per-city counts (one row per city), never over rows.
    """
    counts = f.groupBy("fetched_city").agg(F.count(F.lit(1)).alias("total_events"))
    total = F.sum("total_events").over(Window.partitionBy())
    return counts.withColumn("share", F.col("total_events") / total)


def top_genre_per_city(f: DataFrame) -> DataFrame:
    """Most frequent genre per city (ties by genre name)."""
    counts = f.groupBy("fetched_city", "genre").agg(F.count(F.lit(1)).alias("event_count"))
    w = Window.partitionBy("fetched_city").orderBy(F.col("event_count").desc(), F.col("genre"))
    return counts.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def city_price_rank(f: DataFrame) -> DataFrame:
    """Cities ranked by mean minimum price (highest first)."""
    stats = f.groupBy("fetched_city").agg(F.avg("price_min").alias("avg_min_price"),
                                          F.avg("price_max").alias("avg_max_price"),
                                          F.count("price_min").alias("priced_events"))
    w = Window.orderBy(F.col("avg_min_price").desc_nulls_last())
    return stats.withColumn("price_rank", F.rank().over(w).cast("long"))


def price_changes(history: DataFrame) -> DataFrame:
    """Version transitions that changed the status or a price.

    Runs on the event history, partitioned by its key like the history's own
    windows (bounded by runs per key).
    """
    w = Window.partitionBy("event_id", "fetched_city").orderBy("valid_from")
    prev = {c: F.lag(c).over(w) for c in ["event_status", "price_min", "price_max"]}
    out = history.select(
        "event_id", "fetched_city", "version", "valid_from",
        prev["event_status"].alias("prev_status"), "event_status",
        prev["price_min"].alias("prev_price_min"), "price_min",
        prev["price_max"].alias("prev_price_max"), "price_max",
        F.lag("version").over(w).alias("_prev_version"))
    status_changed = ~F.col("prev_status").eqNullSafe(F.col("event_status"))
    price_changed = (~F.col("prev_price_min").eqNullSafe(F.col("price_min"))
                     | ~F.col("prev_price_max").eqNullSafe(F.col("price_max")))
    return (out.where(F.col("_prev_version").isNotNull())
            .withColumn("status_changed", status_changed)
            .withColumn("price_changed", price_changed)
            .where(F.col("status_changed") | F.col("price_changed"))
            .drop("_prev_version"))
