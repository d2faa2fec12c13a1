"""Keyed tables: upsert, insert-ignore, keyed update, keyset pages, anti-joins, profiles."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def upsert(existing: DataFrame, batch: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """All rows of `existing` and `batch`, one a key. The batch wins; within it the row with the greatest `order`.

    A null `order` comes before all others; among equals, and without an order, the greatest of the other columns wins, so the
    result never depends on the order of rows.
    """
    cols = existing.columns
    rest = [c for c in cols if c not in (key, order)]
    rows = existing.withColumn("_b", F.lit(0)).unionByName(batch.withColumn("_b", F.lit(1)))
    best = rows.groupBy(key).agg(F.max(F.struct("_b", *([order] if order else []), *rest)).alias("_r"))
    return best.select(*[F.col(key) if c == key else F.col(f"_r.{c}").alias(c) for c in cols])


def latest(rows: DataFrame, key: str, time: str) -> DataFrame:
    """The row of each key with the greatest time; among equals the greatest of the other columns. No sort, no window."""
    others = [c for c in rows.columns if c not in (key, time)]
    best = rows.groupBy(key).agg(F.max(F.struct(time, *others)).alias("_r"))
    return best.select(*[F.col(key) if c == key else F.col(f"_r.{c}").alias(c) for c in rows.columns])


def insert_ignore(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """`existing` and those rows of `new`, one a key, whose key it doesn't hold."""
    return existing.unionByName(new.dropDuplicates(keys).join(existing.select(keys), keys, "left_anti"))


def keyed_update(base: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """`base` with the columns of `updates` taken over where the key matches, nulls too; other keys change nothing."""
    cols = [c for c in updates.columns if c != key]
    u = updates.select(key, *[F.col(c).alias(f"_u_{c}") for c in cols], F.lit(True).alias("_hit"))
    j = base.join(u, key, "left")
    return j.select(*[F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in base.columns])


def keyset_page(rows: DataFrame, key: str, after: str | None, size: int = 500) -> DataFrame:
    """The next `size` rows in key order after a key: a bounded top-k, never a full sort."""
    page = rows if after is None else rows.where(F.col(key) > after)
    return page.orderBy(key).limit(size)


def remaining(urls: DataFrame, done: DataFrame, key: str = "url") -> DataFrame:
    """Distinct urls that aren't done."""
    return urls.select(key).distinct().join(done.select(key).distinct(), key, "left_anti")


def unverified(main: DataFrame, verified: DataFrame, key: str) -> DataFrame:
    """Rows of `main` (repeats and null keys kept) whose key isn't among the verified ones."""
    return main.join(verified.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def dedupe_counts(main: DataFrame, verified: DataFrame, key: str) -> DataFrame:
    """(initial, final, removed) of `unverified`, in one pass."""
    flag = main.select(key).join(verified.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_v", F.lit(1)), key, "left")
    return flag.agg(F.count(F.lit(1)).alias("initial"), F.sum(F.when(F.col("_v").isNull(), 1).otherwise(0)).alias("final"), F.sum(F.coalesce("_v", F.lit(0))).alias("removed"))


def without_parents(children: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """`children` without the rows whose `key` is among the deleted parents'; null keys stay."""
    return children.join(deleted.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def pages_of(rows: DataFrame, key: str, size: int = 500):
    """All rows in key order, a bounded page at a time: the loop of a keyset scan, each page from the last key on."""
    after = None
    while True:
        page = keyset_page(rows, key, after, size).collect()
        if page:
            yield page
            after = page[-1][key]
        if len(page) < size:
            return


def numbered_batches(rows: DataFrame, key: str, size: int) -> DataFrame:
    """`rows` with `batch`: rows of one batch, about `size` of them, share a number; no sort and no window."""
    n = max(1, -(-rows.count() // size))
    return rows.withColumn("batch", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))


def found_of_total(found: DataFrame, total: DataFrame, seconds: float | None = None) -> DataFrame:
    """(found, total, seconds): one row."""
    f = found.agg(F.count(F.lit(1)).alias("found"))
    return f.crossJoin(F.broadcast(total.agg(F.count(F.lit(1)).alias("total")))).withColumn("seconds", F.lit(seconds).cast("double"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("total_rows")) for n, df in sorted(tables.items())])


def column_list(tables: dict[str, DataFrame]) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    rows = [(n, f.name, f.dataType.simpleString()) for n, df in sorted(tables.items()) for f in df.schema.fields]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def catalog_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(table_name, column_name, data_type) of all tables and views of the catalog."""
    rows = [(t.name, c.name, c.dataType) for t in spark.catalog.listTables(database) for c in spark.catalog.listColumns(t.name if t.isTemporary or database is None else f"{database}.{t.name}")]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def table_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, bytes): what the files of each table below `folder` take; only their lengths are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    name = F.regexp_extract("path", re.escape(folder.split("://")[-1].rstrip("/")) + r"/([^/]+?)(?:\.parquet)?(?:/|$)", 1)
    return files.select(name.alias("table_name"), "length").groupBy("table_name").agg(F.sum("length").alias("bytes"))


def pretty_size(n: Column) -> Column:
    """Bytes as text in the largest unit of which there are ten or more, as databases print sizes."""
    out = F.concat(n.cast("string"), F.lit(" bytes"))
    for power, unit in enumerate(("kB", "MB", "GB", "TB"), 1):
        out = F.when(n >= 10 * 1024**power, F.concat(F.round(n / 1024**power).cast("long").cast("string"), F.lit(f" {unit}"))).otherwise(out)
    return out


def report(values: DataFrame) -> DataFrame:
    """(line_no, line): each column of a one-row table as `NAME: value` between lines of dashes."""
    parts = [F.lit("-" * 30), *[F.concat(F.lit(f"{c.upper()}: "), F.coalesce(F.col(c).cast("string"), F.lit("None"))) for c in values.columns], F.lit("-" * 30)]
    return values.select(F.posexplode(F.array(*parts)).alias("line_no", "line"))
