"""Declarative data-quality checks (Q1-Q4).

A check is data: (model, test, column or expression, severity, extra args).
Each check compiles to one aggregate DataFrame with a single ``failing_rows``
figure, computed on executors; all not-null checks of one model share one
pass with its uniqueness check.  The report is the union of the
per-check rows plus a status: ``fail``/``warn`` when ``failing_rows > 0``
and the severity is ``error``/``warn``, else ``pass``.

``failing_rows`` follows the usual data-test convention: NULL rows for
``not_null``, duplicated values for ``unique`` (NULLs ignored), distinct
non-accepted values for ``accepted_values`` (NULLs ignored).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import BucketTable

REPORT_COLUMNS = ["model", "test", "column_name", "severity", "status", "failing_rows"]


@dataclass(frozen=True)
class Check:
    model: str
    test: str                     # not_null | unique | accepted_values
    column: str                   # column name or SQL expression
    severity: str = "error"       # error | warn
    values: tuple = field(default_factory=tuple)


def _expr(column: str) -> Column:
    return F.expr(column)


def dq_not_null(df: DataFrame, cols: Sequence[str], model: str = "") -> DataFrame:
    """Q1: one row per column with its NULL count, from a single pass."""
    counts = df.agg(*[F.count_if(_expr(c).isNull()).alias(f"_c{i}") for i, c in enumerate(cols)])
    row = lambda c, i: F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                                F.col(f"_c{i}").alias("failing_rows"))
    return counts.select(F.inline(F.array(*[row(c, i) for i, c in enumerate(cols)])))


def dq_unique(df: DataFrame, column: str, model: str = "") -> DataFrame:
    """Q2: number of non-NULL values of ``column`` (or expression) seen more than once."""
    v = _expr(column).alias("_v")
    dup = (df.select(v).where(F.col("_v").isNotNull()).groupBy("_v").count()
           .where(F.col("count") > 1))
    return dup.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), "failing_rows")


def dq_model(df: DataFrame, cols: Sequence[str], unique: str, model: str = "") -> DataFrame:
    """Q1 and Q2 of one model in one pass: NULL counts ride along with the uniqueness groups."""
    nulls = [F.count_if(_expr(c).isNull()).alias(f"_c{i}") for i, c in enumerate(cols)]
    groups = df.groupBy(_expr(unique).alias("_v")).agg(F.count(F.lit(1)).alias("_n"), *nulls)
    found = groups.agg(F.count_if(F.col("_v").isNotNull() & (F.col("_n") > 1)).alias("_u"),
                       *[F.coalesce(F.sum(f"_c{i}"), F.lit(0)).alias(f"_c{i}") for i in range(len(cols))])
    row = lambda test, c, n: F.struct(F.lit(model).alias("model"), F.lit(test).alias("test"),
                                      F.lit(c).alias("column_name"), F.col(n).alias("failing_rows"))
    return found.select(F.inline(F.array(row("unique", unique, "_u"),
                                         *[row("not_null", c, f"_c{i}") for i, c in enumerate(cols)])))


def dq_accepted_values(df: DataFrame, column: str, values: Sequence[str], model: str = "") -> DataFrame:
    """Q3 detail: every non-NULL value outside ``values`` with its row count."""
    v = _expr(column)
    return (df.where(v.isNotNull() & ~v.isin(list(values)))
            .groupBy(v.alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"), "value", "n_rows"))


def _status(severity: Column | str) -> Column:
    sev = F.lit(severity) if isinstance(severity, str) else severity
    return (F.when(F.col("failing_rows") == 0, F.lit("pass"))
            .when(sev == "warn", F.lit("warn")).otherwise(F.lit("fail")))


def dq_report(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Q4: run ``checks`` against ``tables`` -> REPORT_COLUMNS, one row per check."""
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = defaultdict(list)
    for c in checks:
        if c.test not in ("not_null", "unique", "accepted_values"):
            raise ValueError(f"unknown test {c.test!r}")
        by_model[c.model].append(c)
    for model, cs in by_model.items():
        df = tables[model]
        nulls, uniques = ([c for c in cs if c.test == t] for t in ("not_null", "unique"))
        severity = F.create_map(*[x for c in cs for x in (F.lit(f"{c.test} {c.column}"), F.lit(c.severity))])
        found = []
        if uniques:  # the first one carries the NULL counts
            found.append(dq_model(df, [c.column for c in nulls], uniques[0].column, model))
            found += [dq_unique(df, c.column, model).withColumn("test", F.lit("unique")) for c in uniques[1:]]
        elif nulls:
            found.append(dq_not_null(df, [c.column for c in nulls], model).withColumn("test", F.lit("not_null")))
        for c in cs:
            if c.test == "accepted_values":
                bad = dq_accepted_values(df, c.column, c.values, model).agg(F.count(F.lit(1)).alias("failing_rows"))
                found.append(bad.select(F.lit(model).alias("model"), F.lit(c.test).alias("test"),
                                        F.lit(c.column).alias("column_name"), "failing_rows"))
        rows = reduce(DataFrame.unionByName, found)
        key = F.concat_ws(" ", "test", "column_name")
        parts.append(rows.withColumn("severity", F.element_at(severity, key)))
    report = reduce(DataFrame.unionByName, parts)
    return report.select("model", "test", "column_name", "severity",
                         _status(F.col("severity")).alias("status"),
                         F.col("failing_rows").cast("long").alias("failing_rows"))


# ---- incremental checks: partial results per bucket ---------------------------------

PARTIAL_SCHEMA = "model string, part int, test string, column_name string, value string, n bigint"
_FILES = "files"  # the row that names the files a bucket's partials were taken from


def check_log(spark: SparkSession, path: str) -> BucketTable:
    """The stored partials: a few rows per bucket and check, whatever the tables hold."""
    return BucketTable(spark, path, PARTIAL_SCHEMA, ["model"], buckets=1)


def check_partials(rows: DataFrame, model: str, checks: Sequence[Check], part: str = "bucket") -> DataFrame:
    """PARTIAL_SCHEMA rows of each ``part`` of a table, in one pass per uniqueness check.

    Equal values of a ``unique`` column must lie in one part, as surrogate keys do
    in the buckets of the key they are made of.
    """
    out = []
    nulls = [c for c in checks if c.test == "not_null"]
    uniques = [c for c in checks if c.test == "unique"]
    counted = [F.count_if(_expr(c.column).isNull()).alias(f"_c{i}") for i, c in enumerate(nulls)]
    row = lambda c, n: F.struct(F.lit(c.test).alias("test"), F.lit(c.column).alias("column_name"),
                                F.lit(None).cast("string").alias("value"), F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("n"))
    for k, unique in enumerate(uniques or [None]):
        own = nulls if k == 0 else []
        if unique is None:
            found = rows.groupBy(part).agg(F.lit(0).alias("_u"), *counted) if own else None
        else:
            groups = rows.groupBy(part, _expr(unique.column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"), *(counted if own else []))
            found = groups.groupBy(part).agg(F.count_if(F.col("_v").isNotNull() & (F.col("_n") > 1)).alias("_u"),
                                             *[F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(own))])
        if found is not None:
            structs = [row(c, f"_c{i}") for i, c in enumerate(own)] + ([row(unique, "_u")] if unique else [])
            out.append(found.select(F.col(part).alias("part"), F.inline(F.array(*structs))))
    for c in checks:
        if c.test == "accepted_values":
            v = _expr(c.column)
            bad = rows.where(v.isNotNull() & ~v.isin(list(c.values))).groupBy(part, v.cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
            out.append(bad.select(F.col(part).alias("part"), F.lit(c.test).alias("test"), F.lit(c.column).alias("column_name"), "value", "n"))
    rows = reduce(DataFrame.unionByName, out)
    return rows.select(F.lit(model).alias("model"), "part", "test", "column_name", "value", "n")


def refresh_checks(log: BucketTable, tables: Mapping[str, BucketTable], checks: Sequence[Check]) -> dict[str, list[int]]:
    """Bring the partials up to date; returns the buckets that were read, by model.

    A bucket is read again only if its files are others than those its partials name,
    so nothing has to be remembered between runs, and a run that died is repeated.
    """
    spark = log.spark
    old = log.read() if log.exists() else spark.createDataFrame([], PARTIAL_SCHEMA)
    named = {(r.model, r.part): r.value for r in old.where(F.col("test") == _FILES).collect()}  # one row per bucket
    done: dict[str, list[int]] = {}
    fresh, gone = [], []
    for model, table in tables.items():
        now = table.files()
        before = {part: value for (m, part), value in named.items() if m == model}
        changed = sorted(b for b in now.keys() | before.keys() if now.get(b) != before.get(b))
        done[model] = changed
        if not changed:
            continue
        gone += [(model, b) for b in changed]
        rows = table.read(changed, with_bucket=True)
        own = [c for c in checks if c.model == model]
        fresh.append(check_partials(rows, model, own))
        marks = [(model, b, _FILES, None, now[b], 0) for b in changed if b in now]
        fresh.append(spark.createDataFrame(marks, PARTIAL_SCHEMA))
    if fresh:
        kept = old.join(spark.createDataFrame(gone, "model string, part int"), ["model", "part"], "left_anti")
        log.replace_all(reduce(DataFrame.unionByName, [kept.select(*[c.split()[0] for c in PARTIAL_SCHEMA.split(", ")]), *fresh]))
    return done


def report_of_partials(log: BucketTable, checks: Sequence[Check]) -> DataFrame:
    """Q4 from the partials alone: the same rows as ``dq_report`` over the whole tables."""
    listed = log.spark.createDataFrame([(c.model, c.test, c.column, c.severity) for c in checks],
                                       "model string, test string, column_name string, severity string")
    found = log.read().groupBy("model", "test", "column_name").agg(F.sum("n").alias("_n"), F.count_distinct("value").alias("_values"))
    failing = F.when(F.col("test") == "accepted_values", F.col("_values")).otherwise(F.col("_n"))
    rows = listed.join(found, ["model", "test", "column_name"], "left").withColumn("failing_rows", F.coalesce(failing, F.lit(0)).cast("long"))
    return rows.select("model", "test", "column_name", "severity", _status(F.col("severity")).alias("status"), "failing_rows")
