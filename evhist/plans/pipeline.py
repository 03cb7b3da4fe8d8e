"""Materialized pipeline: raw table -> typed table -> model tables.

This is the production shape of the model graph.  The payload is parsed
exactly once per observation into a typed table (every model then reads only
the columns it needs, straight from Parquet), and each model is written, which
also cuts lineage: a lost executor only recomputes the stage it was running.
Joins carry no hints; AQE broadcasts a dimension after measuring it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import ALL_FIELDS, PAYLOAD_PATHS, flatten
from ..sources.landing import RAW_FILE_SCHEMA, RAW_PARTITIONS, RUN_KEYS, dedup_run, of_days, raw_layout
from ..sources.tables import path_exists
from .models import (EVENT_ATTRS, FCT_PARTITIONS, dim_artists, dim_venues, fct_events,
                     fct_events_by_city, fct_from_files, fct_layout, stg_event_snapshots, stg_events)

MODEL_TABLES = ["events_typed", "stg_events", "stg_event_snapshots", "dim_artists", "dim_venues",
                "fct_events", "fct_events_by_city"]


@dataclass
class PipelineResult:
    tables: dict[str, str]


def typed_events(raw: DataFrame) -> DataFrame:
    """The flattened observations: keys, all 21 typed fields and the payload."""
    return flatten(raw, ALL_FIELDS, keep_payload=True)


def run_pipeline(spark: SparkSession, raw: DataFrame, warehouse: str,
                 as_of: str | dt.date | None = None, segment: Column | None = None) -> PipelineResult:
    """Write every model (a full refresh); returns the table paths.

    A key has one observation per run, so its history window holds as many rows
    as there are runs.  Where runs are so frequent that this is too much,
    ``segment`` (e.g. ``date_trunc('day', ingested_at)``) windows it in parts.
    """
    root = warehouse.rstrip("/")
    paths = {name: f"{root}/{name}" for name in MODEL_TABLES}

    def put(name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(paths[name])
        return spark.read.schema(df.schema).parquet(paths[name]).select(*df.columns)

    typed = put("events_typed", typed_events(one_per_run(raw)))
    stg = put("stg_events", stg_events(typed, as_of))
    snaps = put("stg_event_snapshots", stg_event_snapshots(typed, segment=segment, unique=True))
    artists = put("dim_artists", dim_artists(typed))
    venues = put("dim_venues", dim_venues(typed))
    fct = put("fct_events", fct_layout(fct_events(snaps, stg.select("event_id", "fetched_city", *EVENT_ATTRS),
                                                  artists, venues)), FCT_PARTITIONS)
    put("fct_events_by_city", fct_events_by_city(fct))
    return PipelineResult(paths)


def run_checks(spark: SparkSession, result: PipelineResult, raw: DataFrame) -> DataFrame:
    """Q4 after a run: the data tests over the written tables (column scans only)."""
    from ..operators.quality import dq_report
    from .checks import CHECKS

    tables = {name: spark.read.parquet(path) for name, path in result.tables.items()}
    tables["fct_events"] = fct_from_files(tables["fct_events"])
    tables["raw_events"] = raw
    return dq_report(tables, CHECKS)


# ---- observations: the raw rows and their parsed fields in one append-only table -------

OBSERVATION_SCHEMA = ", ".join([RAW_FILE_SCHEMA, *(f"{f} {PAYLOAD_PATHS[f][1]}" for f in ALL_FIELDS)])


def one_per_run(rows: DataFrame) -> DataFrame:
    """One row per (event, city, run), ids present; of repeated ones the least payload."""
    named = rows.where(F.col("event_id") != "").select(*RUN_KEYS, "payload")
    return dedup_run(named, RUN_KEYS, order="payload")


def write_observations(rows: DataFrame, path: str, mode: str) -> None:
    """Raw rows with their parsed fields, by (ingest_date, fetched_city)."""
    (raw_layout(rows).write.mode(mode).option("partitionOverwriteMode", "static")
     .partitionBy("ingest_date", "fetched_city").parquet(path))


def read_observations(spark: SparkSession, path: str, batches: bool = False, days_of: DataFrame | None = None) -> DataFrame:
    """Observations with a given schema: labels stay text, no rows is an empty frame.

    ``days_of``: only those of the days that this frame's rows have (other folders stay closed).
    """
    parts = ("batch_id bigint, " if batches else "") + RAW_PARTITIONS
    df = spark.read.schema(f"{OBSERVATION_SCHEMA}, {parts}").parquet(path)
    if days_of is not None:
        df = of_days(df, days_of)
    return df.select("event_id", "fetched_city", "ingested_at", *ALL_FIELDS, "payload",
                     *(["batch_id"] if batches else []))


def daily_paths(warehouse: str) -> dict[str, str]:
    root = f"{warehouse.rstrip('/')}/daily"
    return {name: f"{root}/{name}" for name in ("incoming", "observations", "state")}


def run_daily(spark: SparkSession, batch: DataFrame, warehouse: str,
              as_of: str | dt.date | None = None) -> str:
    """The daily incremental run: reads, parses and writes in proportion to the new rows.

    1. parse the batch once, one row per (event, city, run), to ``incoming``;
    2. append those not stored yet to ``observations``, of which only the batch's days
       are opened;
    3. ``advance`` the fact, both dimensions and the watermark, by the batch's buckets.
    A run that is repeated, or was cut off anywhere, gives the same tables.
    Returns the mode ``advance`` used; an empty batch changes nothing.
    """
    from ..operators.merge import State, advance

    at = daily_paths(warehouse)
    write_observations(typed_events(one_per_run(batch)), at["incoming"], "overwrite")
    incoming = read_observations(spark, at["incoming"])
    if incoming.isEmpty():
        return "empty"
    new = incoming
    if path_exists(spark, at["observations"]):
        held = read_observations(spark, at["observations"], days_of=incoming)
        new = incoming.join(held.select(*RUN_KEYS), RUN_KEYS, "left_anti")
    write_observations(new, at["observations"], "append")
    landed = read_observations(spark, at["observations"], days_of=incoming).join(incoming.select(*RUN_KEYS), RUN_KEYS, "left_semi")
    return advance(State(spark, at["state"]), read_observations(spark, at["observations"]), landed, as_of)
