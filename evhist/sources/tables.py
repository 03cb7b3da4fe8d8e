"""Keyed Parquet tables in hash buckets, replaced bucket by bucket (S8), and append-only ones.

A table's rows lie in ``bucket=<n>`` folders by the hash of their key.  An update reads
and replaces only the buckets of the keys it touches, so its cost follows the batch.

A replacement is written ahead (``Swap``): the new buckets of one or several tables are
staged beside them, then one log entry names all that is to be moved, then the folders
are moved and the entry goes.  Before the entry nothing has changed; after it every
reader and writer first finishes the moves, so a process that dies anywhere leaves
either the old tables or, after the redo, all of the new ones.  This needs a file
system that renames a folder as one step (HDFS, local disks), and one driver at a time
per folder; a cluster with a transactional table format should use that instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, source = _fs(spark, old)
    _, target = _fs(spark, new)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {old} to {new}")


class Swap:
    """One replacement of buckets in the tables below ``home``."""

    LOG = "_swap"
    STAGED = "_staged"
    LOG_SCHEMA = "tab string, bucket int, has_rows boolean, staged string"

    def __init__(self, spark: SparkSession, home: str):
        self.spark, self.home = spark, home.rstrip("/")
        redo(spark, self.home)
        delete(spark, f"{self.home}/{self.STAGED}")  # left by a run that died before its log entry
        self.staged = f"{self.STAGED}/{uuid.uuid4().hex[:12]}"
        self.moves: list[tuple[str, int, bool, str]] = []

    def stage(self, table: BucketTable, df: DataFrame, buckets: Iterable[int]) -> DataFrame:
        """Write the new rows of ``buckets``; those without rows become empty.  Returns the rows."""
        at = f"{self.staged}/{table.name or 'table'}"
        path = f"{self.home}/{at}"
        laid = df.withColumn("bucket", table.bucket()).hint("rebalance", "bucket")
        laid.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(path)
        for b in sorted(set(buckets)):
            self.moves.append((table.name, b, path_exists(self.spark, f"{path}/bucket={b}"), at))
        return self.spark.read.schema(f"{table.schema}, bucket int").parquet(path).drop("bucket")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Rows that several steps of this replacement use, written once; gone after the commit."""
        path = f"{self.home}/{self.staged}/_{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self) -> None:
        """Log the moves, then make them.  The log's mark of success is the point of no return."""
        log = self.spark.createDataFrame(self.moves, self.LOG_SCHEMA).coalesce(1)
        log.write.mode("overwrite").json(f"{self.home}/{self.LOG}")
        redo(self.spark, self.home)


def redo(spark: SparkSession, home: str) -> None:
    """Finish the moves of a logged swap, if there is one; may itself be cut off and repeated."""
    log = f"{home}/{Swap.LOG}"
    if not path_exists(spark, f"{log}/_SUCCESS"):
        return
    for tab, bucket, has_rows, at in spark.read.schema(Swap.LOG_SCHEMA).json(log).collect():  # one row per bucket
        target = "/".join(x for x in (home, tab, f"bucket={bucket}") if x)
        source = f"{home}/{at}/bucket={bucket}"
        if not has_rows:
            delete(spark, target)
        elif path_exists(spark, source):  # else it was moved before
            delete(spark, target)
            rename(spark, source, target)
        fs, mark = _fs(spark, "/".join(x for x in (home, tab, "_SUCCESS") if x))
        fs.mkdirs(mark.getParent())
        fs.createNewFile(mark)
    delete(spark, f"{log}/_SUCCESS")
    delete(spark, log)
    delete(spark, f"{home}/{Swap.STAGED}")


class BucketTable:
    """``schema`` is given, so a table without rows reads as empty and types never change.

    ``home`` is the folder that logs swaps, for tables that change together; a table of
    its own logs them itself.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int = BUCKETS,
                 home: str | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.buckets = list(keys), buckets
        self.home = (home or path).rstrip("/")
        self.name = self.path[len(self.home):].strip("/")

    def exists(self) -> bool:
        redo(self.spark, self.home)
        return path_exists(self.spark, f"{self.path}/_SUCCESS")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets of the given keys (``buckets`` numbers at most)."""
        return sorted(r[0] for r in keys.select(self.bucket()).distinct().collect())

    def read(self, buckets: Iterable[int] | None = None, with_bucket: bool = False) -> DataFrame:
        redo(self.spark, self.home)
        df = self.spark.read.schema(f"{self.schema}, bucket int").parquet(self.path)
        if buckets is not None:
            df = df.where(F.col("bucket").isin(list(buckets)))  # a partition filter
        return df if with_bucket else df.drop("bucket")

    def files(self) -> dict[int, str]:
        """The names of each bucket's files, in one text; a replaced bucket has others."""
        redo(self.spark, self.home)
        fs, p = _fs(self.spark, f"{self.path}/bucket=*/part-*")
        found: dict[int, list[str]] = {}
        for status in fs.globStatus(p) or []:
            at = status.getPath()
            found.setdefault(int(at.getParent().getName().split("=")[1]), []).append(at.getName())
        return {b: " ".join(sorted(names)) for b, names in found.items()}

    def replace_all(self, df: DataFrame) -> None:
        self.replace(df, range(self.buckets))

    def replace(self, df: DataFrame, buckets: Iterable[int]) -> None:
        """Replace ``buckets`` by the rows of ``df``, which holds all their rows and no others."""
        swap = Swap(self.spark, self.home)
        swap.stage(self, df, buckets)
        swap.commit()


class BucketLog:
    """An append-only table in buckets: a batch adds files to the buckets of its keys only.

    A repeated batch, or one that died while it was added, leaves rows twice; readers
    get each row once (``read`` is distinct).  Where it is read in few buckets, only their
    folders are opened.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.buckets = list(keys), buckets

    bucket = BucketTable.bucket
    touched = BucketTable.touched

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/_SUCCESS")

    def read(self, buckets: Iterable[int]) -> DataFrame:
        df = self.spark.read.schema(f"{self.schema}, bucket int").parquet(self.path)
        return df.where(F.col("bucket").isin(list(buckets))).drop("bucket").distinct()

    def append(self, df: DataFrame) -> None:
        laid = df.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
        laid.write.mode("append").partitionBy("bucket").parquet(self.path)
