"""File sources and sinks: url lists, CSV globs, tree JSON, frontier state, sorted text, markdown."""

from __future__ import annotations

import csv
import json
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shapla import schemas
from shapla.functions.text import trim_ws
from shapla.session import exists, file_system, remove


def url_list(spark: SparkSession, path: str, distinct: bool = True) -> DataFrame:
    """Lines that aren't blank, trimmed, bad bytes replaced; as a set or with repeats."""
    line = trim_ws(F.make_valid_utf8(F.col("value").cast("binary").cast("string"))).alias("url")
    urls = spark.read.text(path).select(line).where("url <> ''")
    return urls.distinct() if distinct else urls


def attempted(spark: SparkSession, path: str) -> int:
    """How many lines that aren't blank a url list has, repeats included."""
    return url_list(spark, path, distinct=False).count()


def header_of(spark: SparkSession, path: str) -> list[str] | None:
    """The column names of a CSV file, or None where it can't be read."""
    try:
        fs, p = file_system(spark, path)
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
        try:
            line = reader.readLine()
        finally:
            reader.close()
    except Exception:  # noqa: BLE001 - one bad file doesn't stop the others
        return None
    return next(csv.reader([line.removeprefix("\ufeff")])) if line else []


def read_csv(spark: SparkSession, paths: list[str], names: list[str]) -> DataFrame:
    """CSV files of one header as text columns, quoted line breaks kept, bad bytes replaced."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).csv(paths, header=True, multiLine=True, escape='"', encoding="UTF-8")


def verified_urls(spark: SparkSession, paths: list[str], column: str = "Link") -> DataFrame:
    """Distinct non-null values of `column` over those CSV files that have it; unreadable files are left out.

    Files with the same header are read together, so the plan grows with the headers, not with the files.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        names = header_of(spark, p)
        if names and column in names:
            groups.setdefault(tuple(names), []).append(p)
    parts = [read_csv(spark, files, list(names)).select(F.col(column).alias("url")) for names, files in sorted(groups.items())]
    if not parts:
        return spark.createDataFrame([], "url string")
    return reduce(DataFrame.unionAll, parts).where("url IS NOT NULL").distinct()


def tree_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Adjacency rows of tree files with any of three roots: a list, or a dict with `structure` or else `nodes`.

    A file that isn't JSON, and nodes that aren't objects, give no rows and stop nothing.
    """
    schema = pa.schema([("node_id", pa.string()), ("parent_id", pa.string()), ("ordinal", pa.int64()), ("title", pa.string()), ("text", pa.string()), ("url", pa.string())])

    def run(batches):
        for b in batches:
            rows = []
            for text in b.column(0).to_pylist():
                try:
                    root = json.loads(text)
                except ValueError:
                    continue
                if isinstance(root, dict):
                    root = root["structure"] if "structure" in root else root.get("nodes")
                todo = [(None, i, n) for i, n in reversed(list(enumerate(root if isinstance(root, list) else [])))]
                while todo:
                    parent, i, n = todo.pop()
                    if not isinstance(n, dict):
                        continue
                    rows.append((str(n.get("node_id", "")), parent, i, n.get("title", n.get("heading", "Unknown")), n.get("text", ""), n.get("url")))
                    kids = n.get("nodes")
                    if isinstance(kids, list):
                        todo += [(str(n.get("node_id", "")), j, c) for j, c in reversed(list(enumerate(kids)))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return spark.read.text(path, wholetext=True).mapInArrow(run, schemas.NODES)


def frontier_state(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(visited, queue) of a saved state; missing keys are empty."""
    state = spark.read.schema("visited_urls array<string>, queue array<string>").json(path, multiLine=True)
    return state.select(F.explode("visited_urls").alias("url")).distinct(), state.select(F.explode("queue").alias("url"))


def eval_queries(spark: SparkSession, path: str) -> DataFrame:
    """(queries, expected_answer); the second column is null where the file doesn't have it."""
    names = header_of(spark, path)
    if names is None or "queries" not in names:
        raise ValueError(f"{path} has no column queries")
    df = read_csv(spark, [path], names)
    return df.select("queries", F.col("expected_answer") if "expected_answer" in names else F.lit(None).cast("string").alias("expected_answer"))


def write_sorted(df: DataFrame, column: str, path: str) -> None:
    """One sorted column as text; range-partitioned, so part files are in order."""
    df.select(F.col(column).cast("string").alias("value")).orderBy("value").write.mode("overwrite").text(path)


def write_if_absent(df: DataFrame, path: str) -> None:
    df.write.mode("ignore").parquet(path)


def write_index(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Refuses a target that exists unless told to overwrite it."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """With a header and without row numbers; line breaks and quotes within fields survive `read_csv`."""
    df.write.mode("overwrite").csv(path, header=True, escape='"', quoteAll=True)


def write_document(parts: DataFrame, path: str) -> None:
    """(ordinal, markdown) as text in order; part files follow each other."""
    parts.orderBy("ordinal").select(F.regexp_replace("markdown", r"\n\z", "").alias("value")).write.mode("overwrite").text(path)


def append_lines(df: DataFrame, column: str, path: str) -> None:
    """Adds the values of a column to a folder of text files; nothing there is rewritten."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("append").text(path)


def save_frontier(visited: DataFrame, queue: DataFrame, path: str) -> None:
    """A crawl's state, as `saved_frontier` reads it: one column file each, whatever their size."""
    visited.select("url").distinct().write.mode("overwrite").parquet(f"{path}/visited")
    queue.select("url").write.mode("overwrite").parquet(f"{path}/queue")


def saved_frontier(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(visited, queue) of `save_frontier`."""
    return spark.read.schema("url string").parquet(f"{path}/visited"), spark.read.schema("url string").parquet(f"{path}/queue")


def drop_index(spark: SparkSession, path: str, sure: bool = False) -> bool:
    """Deletes a folder; only when told to be sure. Says whether there was one."""
    return bool(sure) and exists(spark, path) and remove(spark, path)
