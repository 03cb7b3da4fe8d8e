"""Streaming landing + changed-key fact equals the batch rebuild; replay is a no-op."""

import json
import os

from fixtures import doc
from pyspark.sql import functions as F

from conftest import SF001
from evhist.plans.models import Models
from evhist.fixture.feed import landed_feed, raw_feed, read_table
from evhist.fixture.pages import pages_from_landed, write_pages
from evhist.sources.landing import PAGE_FILE_SCHEMA
from evhist.streaming.stream import process_batch, root_of, run_stream, state_of


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_rebuild_and_replay_is_idempotent(spark, scratch):
    pages = pages_from_landed(landed_feed(read_table(spark, SF001, "events")))
    split = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    in_dir, wh, ck = f"{scratch}/in", f"{scratch}/wh", f"{scratch}/ck"
    write_pages(pages.where(F.col("ingested_at") < split), in_dir)
    run_stream(spark, in_dir, wh, ck, as_of="2024-01-30").awaitTermination()
    write_pages(pages.where(F.col("ingested_at") >= split), in_dir)
    run_stream(spark, in_dir, wh, ck, as_of="2024-01-30").awaitTermination()

    state = state_of(spark, wh)
    m = Models(raw_feed(spark, SF001), as_of="2024-01-30")
    got = rows(state.fct_events.read())
    assert got == rows(m.fct_events)
    assert rows(state.dim_artists.read()) == rows(m.dim_artists)
    assert rows(state.dim_venues.read()) == rows(m.dim_venues)

    # replay the second batch (same id, same files): nothing changes
    files = spark.read.format("text").option("wholetext", True).schema(PAGE_FILE_SCHEMA) \
        .load(in_dir).where(F.substring("run", 1, 8) >= "20240116")
    process_batch(spark, files, 1, wh, as_of="2024-01-30")
    assert rows(state.fct_events.read()) == got


def _page(folder, run, city, page, text):
    path = f"{folder}/run={run}/city={city}/page={page}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/p.txt", "w") as f:
        f.write(text)


def _doc_page(*docs, indent=None):
    return json.dumps({"_embedded": {"events": [json.loads(d) for d in docs]}}, indent=indent)


def test_odd_pages_and_a_run_over_two_batches(spark, scratch):
    in_dir, wh, ck = f"{scratch}/in", f"{scratch}/wh", f"{scratch}/ck"
    run = "20240115T060000.123456"
    _page(in_dir, run, "0412", 0, _doc_page(doc("E1", pmin=20), indent=2))
    run_stream(spark, in_dir, wh, ck, as_of="2024-01-30").awaitTermination()
    _page(in_dir, run, "0412", 1, _doc_page(doc("E1", pmin=99), doc("E2")))
    _page(in_dir, run, "0412", 2, _doc_page(doc("E3"))[:-9])
    run_stream(spark, in_dir, wh, ck, as_of="2024-01-30").awaitTermination()
    _page(in_dir, "20240116T060000", "0412", 0, '{"page":{"number":0}}')  # no events: an empty batch
    run_stream(spark, in_dir, wh, ck, as_of="2024-01-30").awaitTermination()
    fct = state_of(spark, wh).fct_events.read().collect()
    assert sorted((r.event_id, r.fetched_city, r.version, r.price_min) for r in fct) == [("E1", "0412", 1, 20.0), ("E2", "0412", 1, 20.0)]
    assert all(r.valid_to is None and r.valid_from.microsecond == 123456 for r in fct)
    bad = spark.read.parquet(f"{root_of(wh)}/rejected_pages").collect()
    assert [(r.page_no, r.fetched_city) for r in bad] == [(2, "0412")]


def test_a_batch_opens_no_earlier_batch(spark, scratch):
    """Six batches, each after the files of all earlier observations were spoiled; input stays flat."""
    in_dir, wh, ck = f"{scratch}/in", f"{scratch}/wh", f"{scratch}/ck"
    docs, inputs, states = [], [], []
    for day in range(1, 7):
        run = f"2024010{day}T060000"
        for page in range(2):  # E1 is on all pages of a run; page 1 of the run before comes late
            text = _doc_page(doc("E1", pmin=10 * day + page), doc(f"E{day}{page}", artist=("A1", f"Name {day // 3}")))
            late = page == 1 and day > 1
            _page(in_dir, f"2024010{day - 1}T060000" if late else run, "X", 9 if page and day == 1 else page, text)
        query = run_stream(spark, in_dir, wh, ck, as_of="2024-01-30")
        query.awaitTermination()
        ran = [p for p in query.recentProgress if p.numInputRows]
        inputs += [p.numInputRows for p in ran]
        states.append(ran[-1].stateOperators[0].numRowsUpdated)
        docs += spark.read.parquet(f"{root_of(wh)}/observations/batch_id={day - 1}").select(
            "event_id", F.lit("X").alias("fetched_city"), "ingested_at", "payload").collect()
        for folder, _, names in os.walk(f"{root_of(wh)}/observations"):
            for name in names:
                if name.endswith(".parquet"):
                    with open(f"{folder}/{name}", "wb") as f:
                        f.write(b"spoiled")
                    if os.path.exists(f"{folder}/.{name}.crc"):
                        os.remove(f"{folder}/.{name}.crc")
    assert inputs == [2] * 6 and max(states) <= 3
    raw = spark.createDataFrame([tuple(r) for r in docs], "event_id string, fetched_city string, ingested_at timestamp_ntz, payload string")
    assert raw.count() == raw.select("event_id", "ingested_at").distinct().count() == 6 + 12
    assert rows(state_of(spark, wh).fct_events.read()) == rows(Models(raw, as_of="2024-01-30").fct_events)
