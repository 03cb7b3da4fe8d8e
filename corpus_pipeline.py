"""The training-corpus pipeline: filter, dedup, near-dedup, cut repeats, pack.

Every stage takes all rows its predecessor kept and returns the columns of
``documents`` (the last one the packed pieces).  Row keys: a stage decides by doc_id.
Rows that share a doc_id are told apart by their text in the exact stage and by their
shingles in the near-duplicate stage.  Null ids are an id of
their own in the exact stage and always stay in the near-duplicate stage.  Empty tables
pass through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evhist.llm.common import keep, light, prepare
from evhist.llm.exact_dedup import exact_dedup
from evhist.llm.minhash import SAME, near_duplicates, with_fingerprints
from evhist.llm.packing import pack
from evhist.llm.quality import accept
from evhist.llm.suffix_dedup import cut_repeats


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose doc_id is not among ``ids`` (null-safe), a stored table."""
    ids = ids.select(F.col("doc_id").alias("_gone"))
    ids = ids.hint("broadcast" if light(ids) else "merge")
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_gone"]), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from ``labels``, does not reject."""
    prepare(spark)
    return accept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    prepare(spark)
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    rows = keep(exact_dedup(docs, carry={"_sha": sha}), "decisions")
    per = rows.groupBy("doc_id").agg(F.sum(F.col("kept").cast("int")).alias("_k"), F.count(F.lit(1)).alias("_n"))
    per = keep(per.where("_k < _n"), "touched")
    out = _without(docs, per)
    mixed = per.where("_k > 0").select(F.col("doc_id").alias("_id"))
    if not mixed.isEmpty():  # ids that several rows share: these rows are told apart by text
        stay = rows.where("kept").join(mixed, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        stay = stay.select(F.col("doc_id").alias("_id"), F.col("_sha").alias("_s"))
        again = docs.withColumn("_sha", sha).join(stay, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_s")), "left_semi")
        out = out.unionByName(again.dropDuplicates(["doc_id", "_sha"]).drop("_sha"))
    return out


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    prepare(spark)
    sets = near_duplicates(docs, fingerprint=True).groupBy("doc_id", *SAME).agg(F.max("kept").alias("_kept"), F.count(F.lit(1)).alias("_n"))
    # a set counts as repeated if several rows with its id have it; texts without words are no copies
    sets = keep(sets.withColumn("_again", F.col("_kept") & F.col("doc_id").isNotNull() & (F.col("_w") > 0) & (F.col("_n") > 1)), "near-sets")
    per = sets.groupBy("doc_id").agg(F.max("_kept").alias("_any"), F.min("_kept").alias("_all"), F.max("_again").alias("_again"))
    per = keep(per.where("NOT _all OR _again"), "near-copies")
    out = _without(docs, per)
    mixed = per.where("_any").select(F.col("doc_id").alias("_id"))
    if not mixed.isEmpty():  # ids that several rows share: these rows are told apart by their shingles
        own = F.col("doc_id") == F.col("_id")
        stay = sets.where("_kept").join(mixed, own, "left_semi").select(F.col("doc_id").alias("_id"), *SAME)
        again = with_fingerprints(docs.join(mixed, own, "left_semi"))
        again = again.withColumnRenamed("doc_id", "_id").join(stay, ["_id", *SAME], "left_semi").withColumnRenamed("_id", "doc_id")
        one = again.where("_w > 0").groupBy("doc_id", *SAME).agg(F.min_by(F.struct(*docs.columns), "text").alias("_row")).select("_row.*")
        out = out.unionByName(one).unionByName(again.where("_w = 0").select(*docs.columns))
    return out


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that also start earlier; n_chars follows."""
    prepare(spark)
    out = cut_repeats(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in sequences of at most 1024 tokens."""
    prepare(spark)
    return pack(docs)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("suffix_dedup", repeats), ("packing", packing)]

#: A learned filter, near copies and token packing cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
