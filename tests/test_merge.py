"""Upsert (J5), table versions (S8) and changed-key incremental fact."""

import os

import pytest
from fixtures import R1, R2, R3, R4, doc, raw_df
from pyspark.sql import functions as F

from conftest import SF001
from evhist.operators.merge import (DuplicateKeyError, State, advance, fct_incremental_frame, merge_frames,
                                    merge_upsert)
from evhist.plans.models import Models
from evhist.fixture.feed import raw_feed
from evhist.sources.tables import BucketTable


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_upsert_update_insert_reject(spark, scratch):
    t = BucketTable(spark, scratch, "k string, v int", ["k"], buckets=8)
    frame = lambda *r: spark.createDataFrame(list(r), "k string, v int")
    merge_upsert(t, frame(("a", 1), ("b", 2)))
    merge_upsert(t, frame(("b", 20), ("c", 3)))
    assert rows(t.read()) == [("a", 1), ("b", 20), ("c", 3)]
    with pytest.raises(DuplicateKeyError):
        merge_upsert(t, frame(("d", 1), ("d", 2)))
    assert rows(t.read()) == [("a", 1), ("b", 20), ("c", 3)]


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_upsert_rewrites_touched_buckets_only(spark, scratch):
    t = BucketTable(spark, scratch, "k string, v int", ["k"], buckets=16)
    t.replace_all(spark.createDataFrame([(f"k{i}", i) for i in range(200)], "k string, v int"))
    before = _files(scratch)
    one = spark.createDataFrame([("k7", 70)], "k string, v int")
    merge_upsert(t, one)
    after = _files(scratch)
    assert len(t.touched(one)) == 1
    assert {os.path.dirname(f) for f in before ^ after} == {f"{scratch}/bucket={t.touched(one)[0]}"}
    assert rows(t.read()) == sorted((f"k{i}", 70 if i == 7 else i) for i in range(200))


@pytest.mark.parametrize("dies_at", ["stage", "log", 0, 1, 3])
def test_a_death_inside_a_swap_leaves_the_old_or_the_new_rows(spark, scratch, monkeypatch, dies_at):
    """Staging and log: old rows.  From the log on, also between delete and rename: new ones."""
    from evhist.sources import tables

    old = spark.createDataFrame([(f"k{i}", i) for i in range(60)], "k string, v int")
    new = old.where("v >= 30").withColumn("v", F.col("v") + 1000)  # k0 to k29 go
    BucketTable(spark, scratch, "k string, v int", ["k"], buckets=5).replace_all(old)
    real, calls = tables.rename, []

    def rename(*args):
        calls.append(args)
        if len(calls) == dies_at + 1:
            raise InterruptedError
        real(*args)

    t = BucketTable(spark, scratch, "k string, v int", ["k"], buckets=5)
    if dies_at == "stage":
        monkeypatch.setattr(tables, "path_exists", lambda *a: 1 / 0)
    elif dies_at == "log":
        monkeypatch.setattr(tables.Swap, "commit", lambda self: 1 / 0)
    else:
        monkeypatch.setattr(tables, "rename", rename)
    with pytest.raises((InterruptedError, ZeroDivisionError)):
        t.replace(new, range(5))
    monkeypatch.undo()
    after = BucketTable(spark, scratch, "k string, v int", ["k"], buckets=5)
    assert rows(after.read()) == rows(old if isinstance(dies_at, str) else new)
    after.replace_all(old)
    assert rows(after.read()) == rows(old)
    assert not os.path.exists(f"{scratch}/_swap") and not os.path.exists(f"{scratch}/_staged")


def test_a_touched_bucket_without_rows_becomes_empty(spark, scratch):
    t = BucketTable(spark, scratch, "k string, v int", ["k"], buckets=3)
    t.replace_all(spark.createDataFrame([(f"k{i}", i) for i in range(20)], "k string, v int"))
    gone = t.touched(spark.createDataFrame([("k7",)], "k string"))
    t.replace(t.read().limit(0), gone)
    assert t.read(gone).count() == 0 < t.read().count()


def test_a_table_without_rows_reads_as_empty(spark, scratch):
    t = BucketTable(spark, scratch, "k string, v int", ["k"])
    t.replace_all(spark.createDataFrame([], "k string, v int"))
    assert t.exists() and t.read().count() == 0


def _full(raw):
    return Models(raw, as_of="2024-01-30").fct_events


def test_incremental_equals_full_micro(spark):
    """Load r1,r2; then r3 changes -> one current row per key, equal to full rebuild."""
    r = [("E1", "X", R1, doc(pmin=20)), ("E1", "X", R2, doc(pmin=20)), ("E1", "X", R3, doc(pmin=25)),
         ("E2", "X", R1, doc("E2")), ("E2", "X", R2, doc("E2"))]
    raw = raw_df(spark, r)
    stored = _full(raw.where(F.col("ingested_at") < R3))
    batch = raw.where(F.col("ingested_at") >= R3)
    inc = fct_incremental_frame(stored, raw, batch, "2024-01-30")
    assert rows(inc) == rows(_full(raw))
    assert inc.groupBy("event_id").agg(F.count_if("is_current").alias("n")).where("n != 1").count() == 0
    # the append-only merge (new versions by event_sk) leaves two current rows for E1
    newer = _full(raw).where(F.col("valid_from") > R2)
    append = merge_frames(stored, newer, "event_sk")
    assert append.where("event_id = 'E1' and is_current").count() == 2


def test_late_row_replay(spark):
    """Load r1,r3; then r2 arrives late and differs -> replay equals full rebuild."""
    r = [("E1", "X", R1, doc(pmin=20, artist=("A1", "Old"))), ("E1", "X", R3, doc(pmin=20, artist=("A1", "Old"))),
         ("E2", "X", R1, doc("E2", artist=("A1", "Old"))), ("E2", "X", R4, doc("E2", artist=("A1", "Old")))]
    late = [("E1", "X", R2, doc(pmin=30, artist=("A1", "New")))]
    stored = _full(raw_df(spark, r))
    raw = raw_df(spark, r + late)
    inc = fct_incremental_frame(stored, raw, raw_df(spark, late), "2024-01-30")
    assert rows(inc) == rows(_full(raw))


@pytest.mark.parametrize("split_day", [5, 29])
def test_incremental_equals_full_fixture(spark, split_day):
    raw = raw_feed(spark, SF001)
    split = F.lit(f"2024-01-{split_day:02d} 00:00:00").cast("timestamp_ntz")
    stored = _full(raw.where(F.col("ingested_at") < split))
    inc = fct_incremental_frame(stored, raw, raw.where(F.col("ingested_at") >= split), "2024-01-30")
    assert rows(inc) == rows(_full(raw))


def test_nothing_runs_while_the_incremental_fact_is_built(spark):
    raw = raw_feed(spark, SF001)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    fct_incremental_frame(_full(raw), raw, raw, "2024-01-30")
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _equal_rebuild(st, raw):
    m = Models(raw, as_of="2024-01-30")
    for name, df in [("fct_events", m.fct_events), ("dim_artists", m.dim_artists), ("dim_venues", m.dim_venues)]:
        assert rows(getattr(st, name).read().select(*df.columns)) == rows(df), name


def test_advance_extend_then_replay(spark, scratch):
    """Extend mode (work ~ batch) equals the rebuild; a late batch falls back to replay."""
    raw = raw_feed(spark, SF001)
    ts = lambda d: F.lit(f"2024-01-{d:02d} 00:00:00").cast("timestamp_ntz")
    upto = lambda d: raw.where(F.col("ingested_at") < ts(d))
    st = State(spark, scratch, buckets=8)
    modes = [advance(st, upto(10), upto(10), "2024-01-30")]
    for a, b in [(10, 11), (11, 20), (20, 31)]:
        batch = raw.where((F.col("ingested_at") >= ts(a)) & (F.col("ingested_at") < ts(b)))
        modes.append(advance(st, upto(b), batch, "2024-01-30"))
    assert modes == ["full", "extend", "extend", "extend"]
    _equal_rebuild(st, raw)
    assert advance(st, raw, raw.where(F.col("ingested_at") < ts(3)), "2024-01-30") == "replay"
    _equal_rebuild(st, raw)
    assert advance(st, raw, raw.limit(0), "2024-01-30") == "empty"


def test_one_key_rewrites_its_bucket_and_a_cut_off_run_can_be_repeated(spark, scratch, monkeypatch):
    old = [(f"E{i}", "X", R1, doc(f"E{i}", pmin=20, artist=(f"A{i}", "P"))) for i in range(30)]
    new = [("E3", "X", R2, doc("E3", pmin=25, artist=("A3", "Q"))), ("E3", "X", R3, doc("E3", pmin=20, artist=("A3", "P")))]
    raw = raw_df(spark, old + new)
    st = State(spark, scratch, buckets=16)
    advance(st, raw_df(spark, old), raw_df(spark, old), "2024-01-30")
    before = _files(f"{scratch}/fct_events")
    monkeypatch.setattr(State, "advance_to", lambda self, when: 1 / 0)  # dies before the mark is written
    with pytest.raises(ZeroDivisionError):
        advance(st, raw, raw_df(spark, new), "2024-01-30")
    monkeypatch.undo()
    assert advance(st, raw, raw_df(spark, new), "2024-01-30") == "extend"
    changed = {os.path.dirname(f) for f in before ^ _files(f"{scratch}/fct_events")}
    assert changed == {f"{scratch}/fct_events/bucket={b}" for b in st.fct_events.touched(raw_df(spark, new))}
    _equal_rebuild(st, raw)


def test_late_row_on_state(spark, scratch):
    r = [("E1", "X", R1, doc(pmin=20, artist=("A1", "Old"))), ("E1", "X", R3, doc(pmin=20, artist=("A1", "Old"))),
         ("E2", "X", R1, doc("E2", artist=("A1", "Old"))), ("E2", "X", R4, doc("E2", artist=("A1", "Old")))]
    late = [("E1", "X", R2, doc(pmin=30, artist=("A1", "New")))]
    st = State(spark, scratch, buckets=8)
    advance(st, raw_df(spark, r), raw_df(spark, r), "2024-01-30")
    assert advance(st, raw_df(spark, r + late), raw_df(spark, late), "2024-01-30") == "replay"
    _equal_rebuild(st, raw_df(spark, r + late))


def test_extend_micro_new_and_changed_keys(spark):
    from evhist.operators.merge import extend_frames

    old = [("E1", "X", R1, doc(pmin=20, artist=("A1", "P"))), ("E1", "X", R2, doc(pmin=20, artist=("A1", "P")))]
    new = [("E1", "X", R3, doc(pmin=25, artist=("A1", "P Band"))), ("E2", "X", R3, doc("E2", artist=("A1", "P Band"))),
           ("E1", "X", R4, doc(pmin=20, artist=("A1", "P Band")))]
    before = Models(raw_df(spark, old), as_of="2024-01-30")
    fct, art, ven = extend_frames(before.fct_events, before.dim_artists, before.dim_venues, raw_df(spark, new),
                                  "2024-01-30")
    full = Models(raw_df(spark, old + new), as_of="2024-01-30")
    assert rows(fct) == rows(full.fct_events)
    assert rows(art) == rows(full.dim_artists)
    assert [r.version for r in fct.where("event_id = 'E1'").orderBy("version").collect()] == [1, 2, 3]


def test_a_death_in_the_common_swap_of_a_state(spark, scratch, monkeypatch):
    """The tables of a step change together, whatever it dies of; the step can then be repeated."""
    from evhist.sources import tables

    old = [(f"E{i}", "X", R1, doc(f"E{i}", artist=(f"A{i}", "P"), venue=(f"V{i}", "H"))) for i in range(12)]
    new = [(f"E{i}", "X", R2, doc(f"E{i}", pmin=25, artist=(f"A{i}", "Q"), venue=(f"V{i}", "H"))) for i in range(3)]
    raw, batch = raw_df(spark, old + new), raw_df(spark, new)
    st = State(spark, scratch, buckets=4)
    advance(st, raw_df(spark, old), raw_df(spark, old), "2024-01-30")
    real, calls = tables.rename, []

    def rename(*args):
        calls.append(args)
        if len(calls) == 3:
            raise InterruptedError
        real(*args)

    monkeypatch.setattr(tables, "rename", rename)
    with pytest.raises(InterruptedError):
        advance(st, raw, batch, "2024-01-30")
    monkeypatch.undo()
    _equal_rebuild(State(spark, scratch, buckets=4), raw)  # reading finishes the moves
    assert advance(State(spark, scratch, buckets=4), raw, batch, "2024-01-30") == "extend"
    _equal_rebuild(State(spark, scratch, buckets=4), raw)


def _spoil(path, spared):
    """Overwrite the files of all buckets but ``spared``; returns what was in them."""
    held = {}
    for file in _files(path):
        if int(file.split("bucket=")[1].split("/")[0]) not in spared:
            with open(file, "rb") as f:
                held[file] = f.read()
            with open(file, "wb") as f:
                f.write(b"spoiled")
            crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
            if os.path.exists(crc):
                with open(crc, "rb") as f:
                    held[crc] = f.read()
                os.remove(crc)
    return held


def test_a_late_row_opens_the_buckets_it_concerns_only(spark, scratch):
    """E1 and E2 share an artist: a late row of E1 reads both keys, their ids and nothing else."""
    own = lambda i: {"artist": ("AS" if i in (1, 2) else f"A{i}", "Old"), "venue": (f"V{i}", "Hall")}
    r = [(f"E{i}", "X", when, doc(f"E{i}", **own(i))) for i in range(40) for when in (R1, R3)]
    late = [("E1", "X", R2, doc("E1", pmin=30, artist=("AS", "New"), venue=("V1", "Hall")))]
    st = State(spark, scratch, buckets=64)
    advance(st, raw_df(spark, r), raw_df(spark, r), "2024-01-30")
    frame = lambda schema, *values: spark.createDataFrame(list(values), schema)
    keys = frame("event_id string, fetched_city string", ("E1", "X"), ("E2", "X"))
    ids = frame("kind string, id string", ("artist", "AS"), ("venue", "V1"))
    spared = {"observed": st.observed.touched(keys), "links": st.links.touched(ids), "fct_events": st.fct_events.touched(keys),
              "dim_artists": st.dim_artists.touched(frame("artist_id string", ("AS",))),
              "dim_venues": st.dim_venues.touched(frame("venue_id string", ("V1",), ("V2",)))}
    assert max(map(len, spared.values())) <= 2
    held = {}
    for name, buckets in spared.items():
        held |= _spoil(f"{scratch}/{name}", buckets)
    assert len(held) > 100
    assert advance(st, raw_df(spark, r + late), raw_df(spark, late), "2024-01-30") == "replay"
    for file, data in held.items():
        with open(file, "wb") as f:
            f.write(data)
    _equal_rebuild(st, raw_df(spark, r + late))
    assert [x.artist_name for x in st.fct_events.read().where("event_id = 'E2'").collect()] == ["Old"]


def test_late_and_new_rows_in_one_batch(spark, scratch):
    r = [(f"E{i}", "X", when, doc(f"E{i}", artist=("A1", "Old"))) for i in range(3) for when in (R1, R3)]
    more = [("E1", "X", R2, doc("E1", pmin=30, artist=("A1", "New"))), ("E1", "X", R4, doc("E1", artist=("A2", "Other"))),
            ("E9", "X", R4, doc("E9", artist=("A1", "Newest"))), ("E2", "X", R2, doc("E2", artist=("A3", "Gone")))]
    st = State(spark, scratch, buckets=4)
    advance(st, raw_df(spark, r), raw_df(spark, r), "2024-01-30")
    for _ in range(2):  # the second time as after a death before the mark
        assert advance(st, raw_df(spark, r + more), raw_df(spark, more), "2024-01-30") == "replay"
        _equal_rebuild(st, raw_df(spark, r + more))


def test_checks_read_the_buckets_that_changed(spark, scratch):
    """Partials equal the report over whole tables; a one-key batch reads one bucket of each table."""
    from evhist.operators.quality import Check, check_log, dq_report, refresh_checks, report_of_partials
    from evhist.plans.checks import CHECKS

    old = [(f"E{i}", "X", R1, doc(f"E{i}", status="odd" if i % 9 == 0 else "onsale", artist=(f"A{i}", "P"), venue=(f"V{i}", "H"))) for i in range(30)]
    new = [("E3", "X", R2, doc("E3", status="odder", artist=("A3", "Q"), venue=("V3", None)))]
    st, log = State(spark, f"{scratch}/state", buckets=16), check_log(spark, f"{scratch}/checks")
    tables = {name: getattr(st, name) for name in ("fct_events", "dim_artists", "dim_venues")}
    checks = [c for c in CHECKS if c.model in tables] + [Check("dim_venues", "not_null", "venue_latitude")]
    compare = lambda: (rows(report_of_partials(log, checks)), rows(dq_report({n: t.read() for n, t in tables.items()}, checks)))
    advance(st, raw_df(spark, old), raw_df(spark, old), "2024-01-30")
    first = refresh_checks(log, tables, checks)
    assert all(first.values())
    got, want = compare()
    assert got == want
    advance(st, raw_df(spark, old + new), raw_df(spark, new), "2024-01-30")
    held = {}
    spared = {"fct_events": st.fct_events.touched(raw_df(spark, new)), "dim_artists": st.dim_artists.touched(spark.createDataFrame([("A3",)], "artist_id string")),
              "dim_venues": st.dim_venues.touched(spark.createDataFrame([("V3",)], "venue_id string"))}
    for name, buckets in spared.items():
        held |= _spoil(f"{scratch}/state/{name}", buckets)
    assert refresh_checks(log, tables, checks) == spared  # one bucket each, the others cannot be read
    assert refresh_checks(log, tables, checks) == {name: [] for name in tables}
    for file, data in held.items():
        with open(file, "wb") as f:
            f.write(data)
    got, want = compare()
    assert got == want and ("fct_events", "accepted_values", "event_status", "warn", "warn", 2) in got
