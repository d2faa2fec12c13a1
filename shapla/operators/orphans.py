"""References to records that don't exist: a distributed left anti-join of distinct keys, joined back to the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shapla.functions.urls import key_host, page_key
from shapla.session import materialize

SALTS = 16
#: A key is hot from this many references on, or from a 10,000th of all of them, whichever is more: at most 10,000 keys.
HOT_ROWS = 200_000


def orphan_keys(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Distinct non-null `child_key` values that no row of `parents` holds, as column `key`.

    Null keys on either side never match and are never reported. Repeated rows count once. With no parents
    every key is an orphan; with no children the result is empty. Other columns are ignored, whatever their names.
    """
    c = children.select(F.col(child_key).alias("key")).where("key IS NOT NULL").distinct()
    p = parents.select(F.col(parent_key).alias("key")).where("key IS NOT NULL").distinct()
    return c.join(p, "key", "left_anti")


def presence(parents: DataFrame) -> DataFrame:
    """(key, since, until): the half-open times in which the latest row of a page isn't a deletion.

    At one time stamp a living row wins over a deletion; rows with no url or time are ignored. Change points are
    first found within each day, so a page with very many rows is never sorted in one task as a whole.
    """
    p = (
        parents.select(page_key(F.col("url")).alias("key"), F.col("processed_at").alias("t"), F.when(F.col("status") == "deleted", 0).otherwise(1).alias("alive"))
        .where("key IS NOT NULL AND t IS NOT NULL")
        .groupBy("key", "t")
        .agg(F.max("alive").alias("alive"))
    )

    def changes(df: DataFrame, *by) -> DataFrame:
        w = Window.partitionBy(*by).orderBy("t")
        return df.withColumn("before", F.lag("alive").over(w)).where("before IS NULL OR before <> alive").drop("before")

    points = changes(changes(p.withColumn("day", F.to_date("t")), "key", "day").drop("day"), "key")
    w = Window.partitionBy("key").orderBy("t")
    return points.withColumn("until", F.lead("t").over(w)).where("alive = 1").select("key", F.col("t").alias("since"), "until")


def references(links: DataFrame, suffix: str) -> DataFrame:
    """(id, side, created_at, key): one row for each distinct non-null reference to a host under `suffix`."""
    sides = F.explode(F.array(F.struct(F.lit("source").alias("side"), F.col("source_url").alias("url")), F.struct(F.lit("target").alias("side"), F.col("target_url").alias("url"))))
    r = links.select("id", "created_at", sides.alias("s")).select("id", "created_at", "s.side", F.col("s.url").alias("url")).where("url IS NOT NULL")
    return r.select("id", "side", "created_at", page_key(F.col("url")).alias("key")).where(key_host(F.col("key")).endswith(suffix)).distinct()


def orphan_references(links: DataFrame, pages: DataFrame, suffix: str = ".gov.bd") -> DataFrame:
    """References whose page doesn't exist at the link's created_at: (id, side, created_at, key).

    A page exists when the latest of its rows up to that time isn't a deletion. A null created_at is before all
    rows, so such references are orphans; null urls are no references; repeated rows count once. Distinct keys
    with their times go through the anti-join and are joined back to the references. Rows of hot keys are salted
    and their few spans copied, so that no task gets all references to one page.
    """
    refs = materialize(references(links, suffix))
    probes = refs.select("key", "created_at").distinct()
    spans = presence(pages)
    counts = probes.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    total, most = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    hot_from, by = max(HOT_ROWS, total // 10_000), ["key"]
    if most >= hot_from:
        hot = F.broadcast(counts.where(F.col("n") >= hot_from).select("key", F.lit(True).alias("hot")))
        salt = F.when(F.col("hot"), F.pmod(F.xxhash64("created_at"), F.lit(SALTS)).cast("int")).otherwise(0)
        salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        probes = probes.join(hot, "key", "left").withColumn("salt", salt).drop("hot")
        spans, by = spans.join(hot, "key", "left").withColumn("salt", F.explode(salts)).drop("hot"), ["key", "salt"]
    p, s = probes.alias("p"), spans.alias("s")
    within = (F.col("s.since") <= F.col("p.created_at")) & (F.col("s.until").isNull() | (F.col("p.created_at") < F.col("s.until")))
    on = within
    for c in by:
        on = on & (F.col(f"p.{c}") == F.col(f"s.{c}"))
    orphans = p.join(s, on, "left_anti").select(F.col("p.key").alias("okey"), F.col("p.created_at").alias("at"))
    same = (F.col("key") == F.col("okey")) & F.col("created_at").eqNullSafe(F.col("at"))
    return refs.join(orphans, same, "left_semi")


def orphan_report(links: DataFrame, pages: DataFrame, suffix: str = ".gov.bd") -> DataFrame:
    """(side, month, orphans, keys): orphan references and their distinct pages per side and month of created_at."""
    o = orphan_references(links, pages, suffix)
    per_key = o.groupBy("side", F.date_format("created_at", "yyyy-MM").alias("month"), "key").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("side", "month").agg(F.sum("n").alias("orphans"), F.count(F.lit(1)).alias("keys"))
