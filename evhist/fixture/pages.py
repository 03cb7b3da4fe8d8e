"""Page documents of the fixture feed, as an API would have returned them."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import PAGE_SIZE
from ..sources.landing import RUN_FORMAT

GROUP = ["fetched_city", "ingested_at"]
STRETCH_ROWS = 250_000


def numbered(landed: DataFrame, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """``landed`` with ``_at``, a row's place from 0 in its (city, run) by ``seq``.

    No (city, run) meets in one task: ``seq`` is cut into stretches of about ``stretch_rows``
    rows, rows are numbered within (city, run, stretch), and the counts of the stretches
    before, one row each, are added.
    """
    seq = F.coalesce(F.col("seq").cast("double"), F.lit(float("-inf")))  # nulls come first
    placed = landed.withColumn("_seq", seq)
    n = -(-landed.count() // stretch_rows)
    cuts = placed.approxQuantile("_seq", [i / n for i in range(1, n)], 0.25 / n) if n > 1 else []
    splits = [float("-inf"), *sorted({c for c in cuts if abs(c) < float("inf")}), float("inf")]
    if len(splits) > 2:
        placed = Bucketizer(splits=splits, inputCol="_seq", outputCol="_stretch", handleInvalid="keep").transform(placed)
        placed = placed.withColumn("_stretch", F.col("_stretch").cast("int"))
    else:
        placed = placed.withColumn("_stretch", F.lit(0))
    placed = placed.drop("_seq")
    part = [*GROUP, "_stretch"]
    before = Window.partitionBy(*GROUP).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    ahead = placed.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
    ahead = ahead.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(part)], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    rows = placed.withColumn("_rn", F.row_number().over(Window.partitionBy(*part).orderBy("seq")))
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(part)]
    return rows.join(ahead, same).select(*landed.columns, (F.col("_ahead") + F.col("_rn") - 1).alias("_at"))


def pages_from_landed(landed: DataFrame, page_size: int = PAGE_SIZE, payload: Column | None = None) -> DataFrame:
    """Page documents: ``page_size`` observations each, numbered within (city, run).

    ``payload``, if given, is built from the columns of ``landed`` once rows have their
    page, so that only narrow rows are numbered.
    Output: fetched_city, ingested_at, page_no (from 0), page_text.
    """
    rows = numbered(landed).withColumn("page_no", F.floor(F.col("_at") / page_size).cast("long"))
    if payload is not None:
        rows = rows.select("seq", *GROUP, "page_no", payload.alias("payload"))
    grouped = (rows.groupBy(*GROUP, "page_no")
               .agg(F.array_sort(F.collect_list(F.struct("seq", "payload"))).alias("_items")))
    text = F.concat(F.lit('{"_embedded":{"events":['),
                    F.array_join(F.transform("_items", lambda x: x["payload"]), ","),
                    F.lit(']},"page":{"number":'), F.col("page_no").cast("string"), F.lit("}}"))
    return grouped.select("fetched_city", "ingested_at", "page_no", text.alias("page_text"))


def write_pages(pages: DataFrame, path: str) -> None:
    """Store page documents as ``<path>/run=<stamp>/city=<label>/page=<n>/*.txt``, one a file."""
    (pages.select(F.col("page_text").alias("value"),
                  F.date_format("ingested_at", RUN_FORMAT).alias("run"),
                  F.col("fetched_city").alias("city"),
                  F.col("page_no").alias("page"))
     .write.mode("append").partitionBy("run", "city", "page").text(path))
