"""Page landing (S1-S3), in-run dedup (S4), partitioned raw append."""

import json
import re

from fixtures import R1, doc
from pyspark.sql import functions as F

from conftest import SF001
from evhist.fixture.feed import landed_feed, raw_feed, read_table
from evhist.fixture.pages import numbered, pages_from_landed, write_pages
from evhist.sources.landing import (append_raw, bad_pages, cap_per_city, documents, land_pages, landed_to_raw,
                                    read_page_files, read_pages, read_raw)

PAGES_SCHEMA = "fetched_city string, ingested_at timestamp_ntz, page_no long, page_text string"


def page(*docs):
    return json.dumps({"_embedded": {"events": [json.loads(d) for d in docs]}, "page": {"number": 0}})


def test_page_landing_shapes(spark):
    pages = spark.createDataFrame(
        [("X", R1, 0, page(doc("E1"), doc("E2"))), ("X", R1, 1, '{"page":{"number":1}}'),
         ("X", R1, 2, '{"_embedded":{"events":[]}}')], PAGES_SCHEMA)
    got = land_pages(pages).collect()
    assert [(r.event_id, r.page_no, r.pos) for r in got] == [("E1", 0, 0), ("E2", 0, 1)]
    assert json.loads(got[0].payload) == json.loads(doc("E1"))


def test_page_cap_keeps_first_ten_pages(spark):
    pages = spark.createDataFrame([("X", R1, n, page(doc(f"E{n}"))) for n in range(11)]
                                  + [("Y", R1, 50, page(doc("E50")))], PAGES_SCHEMA)
    kept = cap_per_city(land_pages(pages))
    assert sorted(r.event_id for r in kept.collect()) == sorted([f"E{n}" for n in range(10)])
    assert sorted(r.event_id for r in cap_per_city(land_pages(pages), 2).collect()) == ["E0", "E1"]


def test_nothing_is_capped_unless_asked(spark, scratch):
    rows = [(i, f"E{i}", "X", R1, doc(f"E{i}")) for i in range(25)]
    landed = spark.createDataFrame(rows, "seq long, event_id string, fetched_city string, ingested_at timestamp_ntz, payload string")
    write_pages(pages_from_landed(landed, page_size=2), f"{scratch}/pages")
    assert read_pages(spark, f"{scratch}/pages").count() == 25
    assert read_pages(spark, f"{scratch}/pages", max_pages=10).count() == 20


def test_a_city_and_run_is_numbered_in_several_tasks(spark):
    seqs = [*range(0, 4000, 3), 7, 7, 7, None, None, -5, 2**62]
    rows = [(s, c, r, str(i)) for c, r in [("X", R1), ("Y", R1), (None, None)] for i, s in enumerate(seqs)]
    landed = spark.createDataFrame(rows, "seq long, fetched_city string, ingested_at timestamp_ntz, payload string")
    out = numbered(landed, stretch_rows=300)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"row_number\(\) windowspecdefinition\(fetched_city#\d+, ingested_at#\d+, _stretch#", plan)
    got = out.collect()
    order = sorted(seqs, key=lambda s: (s is not None, s or 0))
    for city in ("X", "Y", None):
        mine = sorted((r for r in got if r.fetched_city == city), key=lambda r: r["_at"])
        assert [r["_at"] for r in mine] == list(range(len(seqs)))
        assert [r.seq for r in mine] == order
    assert numbered(landed.limit(0)).count() == 0


def test_whole_file_pages_and_bad_pages(spark, scratch):
    import os

    import pytest

    good = json.dumps({"_embedded": {"events": [json.loads(doc("E1")), json.loads(doc("E2"))]}}, indent=2)
    for n, text in enumerate([good, good[:-20], ""]):
        os.makedirs(f"{scratch}/run=20240115T060000.000001/city=0412/page={n}")
        with open(f"{scratch}/run=20240115T060000.000001/city=0412/page={n}/p.txt", "w") as f:
            f.write(text)
    with pytest.raises(Exception, match="page is not a JSON document"):
        read_pages(spark, scratch).collect()
    got = read_pages(spark, scratch, on_bad="reject").collect()
    assert [(r.event_id, r.fetched_city, r.ingested_at.microsecond) for r in got] == [("E1", "0412", 1), ("E2", "0412", 1)]
    bad = {r.page_no for r in bad_pages(read_page_files(spark, scratch)).collect()}
    assert 1 in bad and 0 not in bad


def test_empty_ids_are_dropped(spark):
    pages = spark.createDataFrame([("X", R1, 0, page(doc(""), doc("E1")))], PAGES_SCHEMA)
    assert [r.event_id for r in landed_to_raw(land_pages(pages)).collect()] == ["E1"]


def test_documents_are_written_as_json(spark):
    df = spark.createDataFrame([("E1", "X", R1, 2.5, None)], "event_id string, fetched_city string, ingested_at timestamp_ntz, a double, b string")
    assert documents(df, ["a", "b"]).first().document == '{"a":2.5,"b":null}'


def test_in_run_dedup(spark):
    pages = spark.createDataFrame(
        [("X", R1, 0, page(doc("E1", status="first"), doc("E1", status="second"), json.dumps({"name": "no id"}))),
         ("Y", R1, 0, page(doc("E1")))], PAGES_SCHEMA)
    raw = landed_to_raw(land_pages(pages)).collect()
    assert sorted((r.event_id, r.fetched_city) for r in raw) == [("E1", "X"), ("E1", "Y")]
    x = [r for r in raw if r.fetched_city == "X"][0]
    assert json.loads(x.payload)["dates"]["status"]["code"] == "first"


def test_pages_round_trip_through_files(spark, scratch):
    landed = landed_feed(read_table(spark, SF001, "events"))
    write_pages(pages_from_landed(landed), f"{scratch}/pages")
    back = landed_to_raw(read_pages(spark, f"{scratch}/pages"))
    cols = ["event_id", "fetched_city", "ingested_at", "payload"]
    assert sorted(tuple(r) for r in back.select(cols).collect()) == \
        sorted(tuple(r) for r in raw_feed(spark, SF001).select(cols).collect())
    capped = read_pages(spark, f"{scratch}/pages", max_pages=1)
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(page" in plan and "(page#" in plan   # an explicit cap prunes folders


def test_append_and_partition_pruning(spark, scratch):
    raw = raw_feed(spark, SF001)
    append_raw(raw, scratch)
    append_raw(raw.limit(0), scratch)          # an empty run writes nothing
    back = read_raw(spark, scratch)
    assert back.count() == raw.count() == 602
    q = back.where(F.col("fetched_city") == "Chicago")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fetched_city" in plan
    assert q.count() == raw.where(F.col("fetched_city") == "Chicago").count()
