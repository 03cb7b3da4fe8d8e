"""Incremental landing and fact upkeep as a Structured Streaming query.

New page files (``run=/city=/page=``) arrive under ``in_dir``; every micro-batch

1. lands them (parses the pages); pages that are no JSON document go on as such and
   end in ``rejected_pages``, so one bad file neither stops the stream nor vanishes;
2. keeps the first row of each (event, city, run) by page and place.  Which events of a
   run came in earlier batches is kept state of the stream (``first_observations``):
   earlier batches are not read again, and only the states of the runs at hand are;
3. parses the new rows and writes them to ``observations/batch_id=<id>`` with
   overwrite, so a replayed batch rewrites the same rows instead of appending twice;
4. advances the fact and both dimensions (``advance``): extend mode when the
   batch is newer than everything processed, changed-key replay otherwise
   (also when a run spans two micro-batches).

The checkpoint folder (on shared storage) records which files belong to which
batch and the state after each; after a crash Spark replays the unfinished batch with
the same id on the state before it.  Steps 3 and 4 give the same result when repeated,
hence the sink is exactly-once in effect.  No watermark is set: rows may be late by any
time (SURVEY T3), so what the state knows of a run never expires.  It lies in RocksDB
on the executors' disks, and a batch checkpoints its changes only.  The stream keeps
its tables under ``<warehouse>/stream``, apart from the daily run's.
"""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.merge import State, advance
from ..plans.pipeline import read_observations, typed_events, write_observations
from ..session import shared_dir
from ..sources.landing import PAGE_FILE_SCHEMA, RUN_KEYS, bad_pages, land_or_reject, land_pages, landed_to_raw, pages_frame
from ..sources.tables import delete

LANDED_SCHEMA = ("fetched_city string, ingested_at timestamp_ntz, page_no bigint, pos int, event_id string, "
                 "payload string, is_bad boolean")
PARTS = 64  # a run of one city keeps its state in this many parts, by event id


def root_of(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/stream"


def state_of(spark: SparkSession, warehouse: str) -> State:
    """Fact, dimensions and watermark of the stream."""
    return State(spark, f"{root_of(warehouse)}/state")


def _first_seen(key, frames, state):
    """Rows of one part of a run: the first of each event that no earlier batch brought."""
    seen = set(state.get[0]) if state.exists else set()
    first = None
    for rows in frames:
        rows = rows.drop(columns="part")
        if rows["is_bad"].any():
            yield rows[rows["is_bad"]]
        rows = rows[~rows["is_bad"] & ~rows["event_id"].isin(seen)]
        rows = rows if first is None else pd.concat([first, rows])
        first = rows.sort_values(["page_no", "pos"]).drop_duplicates("event_id")
    if first is not None and len(first):
        yield first
        state.update((sorted(seen.union(first["event_id"])),))


def first_observations(pages: DataFrame) -> DataFrame:
    """S4 on a stream of pages: LANDED_SCHEMA rows, one per (event, city, run) over all batches,
    and the bad pages."""
    rows = land_or_reject(pages).where(F.col("is_bad") | (F.col("event_id") != ""))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(PARTS)))
    return rows.groupBy("fetched_city", "ingested_at", "part").applyInPandasWithState(
        _first_seen, LANDED_SCHEMA, "seen array<string>", "append", GroupStateTimeout.NoTimeout)


def _store(spark: SparkSession, batch: DataFrame, batch_id: int, warehouse: str, as_of) -> str:
    """Write a batch's observations and advance; ``empty`` without new rows."""
    root = root_of(warehouse)
    out = f"{root}/observations/batch_id={batch_id}"
    write_observations(typed_events(batch), out, "overwrite")
    landed = read_observations(spark, out)
    if landed.isEmpty():
        return "empty"
    stored = read_observations(spark, f"{root}/observations", batches=True).drop("batch_id")
    return advance(state_of(spark, warehouse), stored, landed, as_of)


def process_rows(spark: SparkSession, rows: DataFrame, batch_id: int, warehouse: str,
                 as_of: str | dt.date | None = None) -> str:
    """One micro-batch of ``first_observations``; returns the mode of ``advance``.

    The rows are written once, since every action on them would run the stateful step again.
    """
    root = root_of(warehouse)
    at = f"{root}/landed/batch_id={batch_id}"
    rows.write.mode("overwrite").parquet(at)
    landed = spark.read.schema(LANDED_SCHEMA).parquet(at)
    bad = landed.where("is_bad").select("fetched_city", "ingested_at", "page_no", F.col("payload").alias("page_text"))
    bad.write.mode("overwrite").parquet(f"{root}/rejected_pages/batch_id={batch_id}")
    mode = _store(spark, landed.where("NOT is_bad").select(*RUN_KEYS, "payload"), batch_id, warehouse, as_of)
    delete(spark, at)
    return mode


def process_batch(spark: SparkSession, files: DataFrame, batch_id: int, warehouse: str,
                  as_of: str | dt.date | None = None) -> str:
    """The same for page files at hand, without the stream's state: what earlier batches
    brought is read from their observations, of the days at hand only."""
    root = root_of(warehouse)
    pages = pages_frame(files)
    bad_pages(pages).write.mode("overwrite").parquet(f"{root}/rejected_pages/batch_id={batch_id}")
    batch = landed_to_raw(land_pages(pages, on_bad="reject"))
    if batch_id:
        earlier = read_observations(spark, f"{root}/observations", batches=True, days_of=batch).where(F.col("batch_id") < batch_id)
        batch = batch.join(earlier.select(*RUN_KEYS), RUN_KEYS, "left_anti")
    return _store(spark, batch, batch_id, warehouse, as_of)


def run_stream(spark: SparkSession, in_dir: str, warehouse: str, checkpoint: str | None = None,
               as_of: str | dt.date | None = None, available_now: bool = True,
               max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the landing stream; the checkpoint defaults to a folder under the
    cluster's shared ``spark.checkpoint.dir``."""
    if checkpoint is None:
        checkpoint = f"{shared_dir(spark)}/evhist-stream-checkpoint"
    reader = spark.readStream.format("text").option("wholetext", True).schema(PAGE_FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = first_observations(pages_frame(reader.load(in_dir)))
    writer = (rows.writeStream.outputMode("append")
              .foreachBatch(lambda df, bid: process_rows(spark, df, bid, warehouse, as_of))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
