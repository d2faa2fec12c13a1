"""Resumable ingestion into keyed tables: merge on read, with compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shapla.session import exists, file_system, remove


class KeyedTable:
    """A table with one row a key, to which batches are written as they come.

    A batch is a folder of its own, batch=N, so only its rows are written, and a batch that is applied again replaces itself.
    Readers take the row of each key from the latest batch, in it that with the greatest `order`, among equals the greatest. A
    compaction writes what is read into base=N; batches up to the latest base count no more and are deleted. Spark
    publishes a folder by renaming, so readers see whole batches and bases only.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, order: str | None = None):
        self.spark, self.path, self.schema, self.key, self.order = spark, path.rstrip("/"), schema, key, order

    def numbers(self, kind: str) -> list[int]:
        """The numbers of finished folders, in order."""
        if not exists(self.spark, self.path):
            return []
        fs, p = file_system(self.spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        found = [int(n.split("=")[1]) for n in names if n.startswith(f"{kind}=")]
        return sorted(n for n in found if exists(self.spark, f"{self.path}/{kind}={n}/_SUCCESS"))

    def state(self) -> int:
        """The number of the last batch, -1 if there is none."""
        return max([-1, *self.numbers("batch"), *self.numbers("base")])

    def write(self, batch: DataFrame, number: int) -> None:
        """Rows without a key are left out."""
        rows = batch.select(*[f.name for f in self.schema.fields]).where(F.col(self.key).isNotNull())
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={number}")

    def read(self) -> DataFrame:
        base = max([-1, *self.numbers("base")])
        folders = ([f"base={base}"] if base >= 0 else []) + [f"batch={n}" for n in self.numbers("batch") if n > base]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        number = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:batch|base)=(\d+)/", 1).cast("long")
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders]).select("*", number.alias("_batch"))
        names = [f.name for f in self.schema.fields]
        rest = [c for c in names if c not in (self.key, self.order)]
        best = rows.groupBy(self.key).agg(F.max(F.struct("_batch", *([self.order] if self.order else []), *rest)).alias("_r"))
        return best.select(*[F.col(c) if c == self.key else F.col(f"_r.{c}").alias(c) for c in names])

    def compact(self) -> None:
        """Folds all batches into one base and deletes what came before it."""
        last = self.state()
        if last < 0 or last in self.numbers("base"):
            return
        self.read().write.mode("overwrite").parquet(f"{self.path}/base={last}")
        for kind in ("batch", "base"):
            for n in self.numbers(kind):
                if n < last or (kind == "batch" and n == last):
                    remove(self.spark, f"{self.path}/{kind}={n}")

    def drop(self, sure: bool = False) -> bool:
        """Deletes the table; only when told to be sure."""
        return bool(sure) and exists(self.spark, self.path) and remove(self.spark, self.path)


def ingest(spark: SparkSession, folder: str, name: str, schema: StructType, target: str, key: str, order: str | None = None, compact_from: int = 16) -> DataFrame:
    """Reads all new parquet files of the table `name` (a file or a folder of files) in `folder`, upserts them by `key`, and returns the table.

    The stream's checkpoint keeps what has been read, and a batch that is run again replaces itself, so reruns change nothing.
    From `compact_from` batches on the table is compacted.
    """
    table = KeyedTable(spark, f"{target.rstrip('/')}/table", schema, key, order)
    fs, path = file_system(spark, f"{folder}/{name}")
    whole = fs.getFileStatus(path).isDirectory()
    reader = spark.readStream.schema(schema)
    stream = reader.parquet(f"{folder}/{name}") if whole else reader.option("pathGlobFilter", name).parquet(folder)
    query = stream.writeStream.foreachBatch(table.write).option("checkpointLocation", f"{target.rstrip('/')}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    if len(table.numbers("batch")) >= compact_from:
        table.compact()
    return table.read()


def index_by_key(rows: DataFrame, path: str, key: str, order: str | None = None, size: int = 500, stop_after: int | None = None) -> int:
    """Writes `rows` to a keyed table in key order, `size` keys a batch, from the last written key on; returns the batches written.

    What is left after a stop goes on with the next call: the last key of the last finished batch is the checkpoint, so no
    state is kept elsewhere, and a finished scan writes nothing again.
    """
    table = KeyedTable(rows.sparkSession, path, rows.schema, key, order)
    written = 0
    while stop_after is None or written < stop_after:
        number = table.state()
        after = table.read().agg(F.max(key)).first()[0] if number >= 0 else None
        left = rows.where(F.col(key).isNotNull()) if after is None else rows.where(F.col(key) > after)
        last = left.select(key).distinct().orderBy(key).limit(size).agg(F.max(key)).first()[0]
        if last is None:
            break
        table.write(left.where(F.col(key) <= last), number + 1)
        written += 1
    return written


def publish(parts: dict[str, DataFrame], path: str) -> str:
    """Several outputs as one version: all are written below path/version=N, and only then does path/current=N name it.

    Readers (`published`) never see one output without the others.
    """
    spark = next(iter(parts.values())).sparkSession
    number = len(versions(spark, path))
    for name, df in sorted(parts.items()):
        df.write.mode("overwrite").parquet(f"{path}/version={number}/{name}")
    spark.range(1).write.mode("overwrite").parquet(f"{path}/current={number}")
    return f"{path}/version={number}"


def versions(spark: SparkSession, path: str) -> list[int]:
    n = 0
    while exists(spark, f"{path}/current={n}/_SUCCESS"):
        n += 1
    return list(range(n))


def published(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """One output of the latest whole version."""
    found = versions(spark, path)
    return spark.read.parquet(f"{path}/version={found[-1]}/{name}") if found else None
