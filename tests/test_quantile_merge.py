"""Exact quantiles over ranges (A7), one-pass as-of merge (J2/J3), sketches (A1), VARIANT."""

import datetime as dt
import random

import pytest
from fixtures import R1, doc, raw_df
from pyspark.sql import functions as F

from evhist.functions.paths import ALL_FIELDS, flatten, flatten_variant, variant_rows
from evhist.operators.pit import pit_join, pit_merge
from evhist.operators.quantile import exact_quantiles
from evhist.operators.sketches import estimate, merge, sketch

PROBS, NAMES = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0), ("p0", "q1", "median", "q3", "p90", "p100")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("buckets", [1, 3, 4096])
def test_quantiles_equal_percentile(spark, buckets):
    rng = random.Random(buckets)
    data = [(g, make()) for g, n, make in [
        ("hot", 3000, lambda: round(rng.lognormvariate(3, 1), 2)), ("one", 1, lambda: 7.5), ("two", 2, lambda: rng.random()),
        ("same", 50, lambda: 20.0), ("neg", 80, lambda: rng.uniform(-50, 5)), (None, 9, lambda: float(rng.randrange(4))),
        ("far", 30, lambda: rng.choice([1.0, 1.01, 2.0, 1e12]))] for _ in range(n)]
    df = spark.createDataFrame(data, "g string, v double")
    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = exact_quantiles(counts, "g", "v", "n", PROBS, NAMES, buckets)
    want = df.groupBy("g").agg(*[F.percentile("v", p).alias(n) for p, n in zip(PROBS, NAMES)])
    assert rows(got) == rows(want)
    assert exact_quantiles(counts.limit(0), "g", "v", "n", PROBS, NAMES).count() == 0


def test_a_hot_city_is_never_one_window(spark):
    """The windows run over ranges of a city or over one range's prices, not over a city's prices."""
    df = spark.range(100).select(F.lit("c").alias("g"), F.col("id").cast("double").alias("v"), F.lit(1).alias("n"))
    plan = exact_quantiles(df, "g", "v", "n", (0.5,), ("m",))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("[_b#" in line or ", _b#" in line for line in windows)


def _history(key, starts):
    ends = [*starts[1:], None]
    return [(key, a, b, f"{key}{i}") for i, (a, b) in enumerate(zip(starts, ends))]


def test_merge_equals_join(spark):
    rng = random.Random(5)
    day = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 200))
    hist = [h for k in "abc" for h in _history(k, sorted({day() for _ in range(40)}))]
    hist += [("gap", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 9), "g0"), ("gap", dt.datetime(2024, 3, 1), None, "g1"), (None, R1, None, "none")]
    facts = [(i, rng.choice(["a", "b", "c", "gap", "unknown", None]), rng.choice([day(), R1, None])) for i in range(600)]
    facts += [(1000 + i, k, a) for i, (k, a, _, _) in enumerate(hist)]  # at the very start of a version
    facts += facts[:5]
    f = spark.createDataFrame(facts, "id int, k string, valid_from timestamp_ntz")
    h = spark.createDataFrame(hist, "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, name string")
    for segment in ("day", "month", "year"):
        assert rows(pit_merge(f, h, "k", columns=["name"], segment=segment)) == rows(pit_join(f, h, "k", columns=["name"]))


def test_merge_of_a_key_with_ten_thousand_versions_is_linear(spark):
    """No join pairs facts with versions: the only one meets a segment's facts with one carried row."""
    start = dt.datetime(2000, 1, 1)
    h = spark.range(10_000).select(F.lit("hot").alias("k"), (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("valid_from"), F.col("id").alias("v"))
    h = h.withColumn("valid_to", F.when(F.col("v") < 9_999, F.col("valid_from") + F.expr("INTERVAL 1 DAY")))
    f = h.select("k", (F.col("valid_from") + F.expr("INTERVAL 5 HOURS")).alias("valid_from"), F.col("v").alias("want"))
    out = pit_merge(f, h, "k", columns=["v"])
    assert out.where("v = want").count() == 10_000 == out.count()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 1 and "_cs" in joins[0] and "_ck" in joins[0]


def test_sketches_roll_up_without_the_rows(spark):
    df = spark.range(120_000).select((F.col("id") % 3).alias("city"), (F.col("id") % 40).alias("day"), (F.col("id") % 50_000).alias("a"))
    daily = sketch(df, ["city", "day"], ["a"])
    exact = {r.city: r.n for r in df.groupBy("city").agg(F.count_distinct("a").alias("n")).collect()}
    for r in estimate(merge(daily, ["city"]), {"a": "n"}).collect():
        assert abs(r.n - exact[r.city]) < 0.03 * exact[r.city]
    old, new = daily.where("day < 39"), daily.where("day = 39")  # a new day joins what is stored
    for r in estimate(merge(merge(old, ["city"]).unionByName(new.drop("day")), ["city"]), {"a": "n"}).collect():
        assert abs(r.n - exact[r.city]) < 0.03 * exact[r.city]
    small = spark.createDataFrame([("x", None), ("x", "p"), ("x", "p"), ("x", "q"), ("y", None)], "city string, a string")
    assert rows(estimate(sketch(small, ["city"], ["a"]), {"a": "n"})) == [("x", 2), ("y", 0)]


def test_variant_reads_like_the_parsed_text(spark, scratch):
    texts = [doc("E1"), doc("E2", pmin="17.5", lat=None, artist=("A", None), genre=None), doc("E3", date="soon", time=None), "{}", "[1]",
             '{"name":5,"priceRanges":[],"dates":{"start":{"localDate":null}}}', '{"priceRanges":[{"min":1e3,"max":"x"}]}']
    raw = raw_df(spark, [(f"E{i}", "X", R1, t) for i, t in enumerate(texts)] + [("bad", "X", R1, '{"name":'), ("none", "X", R1, None)])
    variant_rows(raw).write.parquet(scratch)
    stored = spark.read.parquet(scratch)
    assert dict(stored.dtypes)["doc"] == "variant"
    plan = flatten_variant(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "parse_json" not in plan
    got, want = rows(flatten_variant(stored)), rows(flatten(raw, ALL_FIELDS))
    assert got == want
    with pytest.raises(Exception, match="MALFORMED_RECORD|MALFORMED_VARIANT|JSON"):
        variant_rows(raw, on_error="fail").collect()
    with pytest.raises(ValueError):
        variant_rows(raw, on_error="skip")
