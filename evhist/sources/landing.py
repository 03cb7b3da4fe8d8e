"""Landing: API page documents -> observations -> append-only raw table.

S1 page landing, S2 per-city page cap, S3 run stamping, S4 in-run dedup,
S5/S6 partitioned append.  Pages are JSON documents on shared storage (one file
or one row per page), not HTTP responses.  Nothing is dropped silently: a page
that is no JSON document fails the run or goes to ``bad_pages``, and the page
cap acts only where a caller asks for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MAX_PAGES_PER_CITY
from .tables import path_exists

PAGE_SCHEMA = "struct<_embedded: struct<events: array<string>>, _bad: string>"
PAGE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
ID_SCHEMA = "struct<id: string>"
RUN_KEYS = ["event_id", "fetched_city", "ingested_at"]


def _cols(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def dedup_run(df: DataFrame, keys: Sequence[str], order: str | Sequence[str],
              drop_null_keys: bool = True) -> DataFrame:
    """Keep the first row per ``keys`` by ``order``.

    An aggregate instead of ``row_number``: partial aggregation collapses a hot
    key inside every map task before the shuffle, so one key observed a billion
    times costs one row per task on the wire.  All columns travel in one
    ``min(struct(order, rest))``, so the ordering is carried and compared once;
    ``order`` must make the winner unique per key (ties fall to the other
    columns, which keeps the result the same on every run).
    """
    keys, order = list(keys), _cols(order)
    rest = [c for c in df.columns if c not in keys]
    if drop_null_keys:
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).isNotNull()
        df = df.where(cond)
    if not rest:
        return df.select(*keys).distinct()
    ordering = [c for c in order if c in rest]
    packed = F.struct(*[F.col(c) for c in ordering], *[F.col(c) for c in rest if c not in ordering])
    won = df.groupBy(*keys).agg(F.min(packed).alias("_won"))
    return won.select(*[F.col(c) if c in keys else F.col(f"_won.{c}").alias(c) for c in df.columns])


PAGE_FILE_SCHEMA = "value string, run string, city string, page int"
RUN_FORMAT = "yyyyMMdd'T'HHmmss.SSSSSS"


def run_stamp(run: Column) -> Column:
    """The run's timestamp, to the microsecond, from its folder name
    ``yyyyMMddTHHmmss[.ffffff]``; built from its parts, so no session zone is involved."""
    part = lambda a, n: F.substring(run, a, n).cast("int")
    seconds = F.substring(run, 14, 9).cast("decimal(8,6)")
    return F.make_timestamp_ntz(part(1, 4), part(5, 2), part(7, 2), part(10, 2), part(12, 2), seconds)


def pages_frame(files: DataFrame, max_pages: int | None = None) -> DataFrame:
    """S2/S3 on stored pages: run stamp and city from the folders.

    ``max_pages`` keeps the first pages of each (city, run); it is a partition
    filter, so the others are never opened.  By default all pages are read.
    """
    if max_pages is not None:
        files = files.where(F.col("page") < max_pages)
    return files.select(F.col("city").alias("fetched_city"), run_stamp(F.col("run")).alias("ingested_at"),
                        F.col("page").cast("long").alias("page_no"), F.col("value").alias("page_text"))


def read_page_files(spark: SparkSession, path: str, max_pages: int | None = None) -> DataFrame:
    """Stored pages, each file one document whatever its line breaks."""
    files = spark.read.format("text").option("wholetext", True).schema(PAGE_FILE_SCHEMA).load(path)
    return pages_frame(files, max_pages)


def read_pages(spark: SparkSession, path: str, max_pages: int | None = None,
               on_bad: str = "fail") -> DataFrame:
    """S1-S3 from page files: landed rows of all runs."""
    return land_pages(read_page_files(spark, path, max_pages), on_bad)


def _parsed(pages: DataFrame) -> DataFrame:
    return pages.withColumn("_p", F.from_json("page_text", PAGE_SCHEMA, PAGE_OPTIONS))


def _is_bad() -> Column:
    return F.col("_p").isNull() | F.col("_p._bad").isNotNull()


def bad_pages(pages: DataFrame) -> DataFrame:
    """The pages that are no JSON document: fetched_city, ingested_at, page_no, page_text."""
    return _parsed(pages).where(_is_bad()).select("fetched_city", "ingested_at", "page_no", "page_text")


def land_pages(pages: DataFrame, on_bad: str = "fail") -> DataFrame:
    """One row per ``_embedded.events[]`` element; missing/empty -> no rows.

    Output: seq-free landed rows (fetched_city, ingested_at, page_no, pos,
    event_id, payload); ``payload`` keeps the element's JSON text.  A page that
    does not parse raises (``"fail"``) or is left to ``bad_pages`` (``"reject"``).
    """
    if on_bad not in ("fail", "reject"):
        raise ValueError(f"on_bad must be fail or reject, not {on_bad!r}")
    events = F.col("_p._embedded.events")
    if on_bad == "fail":
        where = F.concat(F.lit("page is not a JSON document: city "), F.coalesce("fetched_city", F.lit("?")),
                         F.lit(", run "), F.coalesce(F.col("ingested_at").cast("string"), F.lit("?")),
                         F.lit(", page "), F.coalesce(F.col("page_no").cast("string"), F.lit("?")))
        events = F.when(_is_bad(), F.raise_error(where)).otherwise(events)
    else:
        events = F.when(~_is_bad(), events)
    exploded = _parsed(pages).select("fetched_city", "ingested_at", "page_no",
                                     F.posexplode(events).alias("pos", "payload"))
    return exploded.select("fetched_city", "ingested_at", "page_no", "pos",
                           F.from_json("payload", ID_SCHEMA)["id"].alias("event_id"),
                           "payload")


def land_or_reject(pages: DataFrame) -> DataFrame:
    """``land_pages`` and ``bad_pages`` in one pass, for streams: a page that does not
    parse gives one row with ``is_bad``, its text as the payload and no event id."""
    text = F.coalesce("page_text", F.lit(""))
    events = F.when(_is_bad(), F.array(text)).otherwise(F.col("_p._embedded.events"))
    rows = _parsed(pages).select("fetched_city", "ingested_at", "page_no", _is_bad().alias("is_bad"),
                                 F.posexplode(events).alias("pos", "payload"))
    event_id = F.when(~F.col("is_bad"), F.from_json("payload", ID_SCHEMA)["id"])
    return rows.select("fetched_city", "ingested_at", "page_no", "pos", event_id.alias("event_id"), "payload", "is_bad")


def cap_per_city(landed: DataFrame, max_pages: int = MAX_PAGES_PER_CITY) -> DataFrame:
    """Keep the first ``max_pages`` pages of every (city, run), by page number from 0."""
    return landed.where(F.col("page_no") < max_pages)


def landed_to_raw(landed: DataFrame) -> DataFrame:
    """S4 on landed page rows: drop documents without id (missing or empty), first per key and run."""
    named = landed.where(F.col("event_id") != "").withColumn("_ord", F.struct("page_no", "pos"))
    out = dedup_run(named.select(*RUN_KEYS, "_ord", "payload"), RUN_KEYS, order="_ord")
    return out.select(*RUN_KEYS, "payload")


def raw_layout(df: DataFrame) -> DataFrame:
    """The raw table's layout: ``ingest_date`` column plus a REBALANCE on the
    partition columns.  AQE then sizes the writer tasks from measured bytes
    (``advisoryPartitionSizeInBytes``): small (date, city) groups are merged
    into one writer, a hot city is split across several, so files stay near
    the advisory size whatever the skew."""
    return (df.withColumn("ingest_date", F.to_date("ingested_at"))
              .hint("rebalance", "ingest_date", "fetched_city"))


def append_raw(df: DataFrame, path: str) -> None:
    """Append a run to the raw table, laid out by (ingest_date, city).

    An empty run writes no data files; the job commit makes a run all-or-nothing.
    """
    raw_layout(df).write.mode("append").partitionBy("ingest_date", "fetched_city").parquet(path)


def of_days(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of ``stored``, a table in ``ingest_date`` folders, from the days that ``batch`` holds.

    The batch's days (one short row per calendar day, so broadcast) reach the scan as a
    dynamic partition filter: folders of other days are not opened.
    """
    days = batch.where(F.col("event_id") != "").select(F.to_date("ingested_at").alias("ingest_date")).distinct()
    return stored.join(F.broadcast(days), "ingest_date", "left_semi")


def not_stored(df: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``df`` whose (event, city, run) ``stored`` does not hold; null-safe, opens the days of ``df`` only."""
    held = of_days(stored, df).select(*[F.col(k).alias(f"_{k}") for k in RUN_KEYS])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in RUN_KEYS]
    return df.join(held, same, "left_anti")


def append_new(df: DataFrame, path: str) -> None:
    """Append the observations that are not stored yet; repeated, or after a death
    in the middle of an append, it adds what is missing and nothing twice."""
    spark = df.sparkSession
    if path_exists(spark, path):
        df = not_stored(df, spark.read.schema(f"{RAW_FILE_SCHEMA}, {RAW_PARTITIONS}").parquet(path))
    append_raw(df, path)


RAW_FILE_SCHEMA = "event_id string, ingested_at timestamp_ntz, payload string"
RAW_PARTITIONS = "ingest_date date, fetched_city string"


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """S7 over a table written by ``append_raw``.

    The schema is given, so partition values keep their types (a city label is
    always a string), a table without rows reads as empty, and filters on
    ``ingest_date``/``fetched_city`` prune folders before any file is opened.
    """
    return (spark.read.schema(f"{RAW_FILE_SCHEMA}, {RAW_PARTITIONS}").parquet(path)
            .select("event_id", "fetched_city", "ingested_at", "payload"))


def documents(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows as JSON documents again (``to_json``), NULL values kept as ``null``."""
    return raw.select(*RUN_KEYS, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("document"))
