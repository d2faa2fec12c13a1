"""Links and the frontier: markdown links, edges, domains, level-wise traversal."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapla.functions.urls import domain_of, fetched, html_hrefs, markdown_hrefs, resolve_href
from shapla.session import exists, materialize


def markdown_links(pages: DataFrame, url: str, markdown: str, longest: int | None = None) -> DataFrame:
    """Distinct (source_url, target_url): links of each page but those to itself and its own fragments."""
    e = pages.select(F.col(url).alias("source_url"), F.explode(markdown_hrefs(F.col(markdown))).alias("target_url"))
    keep = (F.col("target_url") != F.col("source_url")) & ~F.col("target_url").startswith(F.concat("source_url", F.lit("/#")))
    if longest is not None:
        keep = keep & (F.length("target_url") <= longest)
    return e.where(keep).distinct()


def domains(urls: DataFrame, url: str, suffix: str = ".gov.bd") -> DataFrame:
    return urls.select(domain_of(F.col(url), suffix).alias("domain")).where("domain IS NOT NULL").distinct()


def bfs(edges: DataFrame, seeds: DataFrame, levels: int | None = None, visited: DataFrame | None = None) -> DataFrame:
    """(url, level) of everything reachable from `seeds`; each level is written out, which cuts the lineage.

    `edges`: source_url, target_url. Visited urls are anti-joined, so cycles end; the loop stops when a level is empty.
    Urls of `visited` (url), as from a saved state, are neither entered nor passed through again and aren't in the result. With
    `levels`, urls further away than that are an error.
    """
    links = edges.select("source_url", "target_url").where("source_url IS NOT NULL AND target_url IS NOT NULL").distinct()
    first = seeds.select("url").where("url IS NOT NULL").distinct()
    known = None if visited is None else visited.select("url")
    frontier = materialize((first if known is None else first.join(known, "url", "left_anti")).withColumn("level", F.lit(0)))
    found = frontier

    def beyond(rows: DataFrame) -> DataFrame:
        step = rows.join(links, rows["url"] == links["source_url"]).select(F.col("target_url").alias("url")).distinct()
        step = step.join(found.select("url"), "url", "left_anti")
        return step if known is None else step.join(known, "url", "left_anti")

    for level in count(1):
        frontier = materialize(beyond(frontier).withColumn("level", F.lit(level)))
        if frontier.isEmpty():
            return found
        found = found.unionAll(frontier)
        if level == levels and not beyond(frontier).isEmpty():
            raise ValueError(f"urls are reachable beyond level {levels}")


def crawl(seeds: DataFrame, fetch: Callable[[DataFrame], DataFrame], state: str, suffix: str = ".gov.bd", levels: int | None = None) -> DataFrame:
    """(url, domain, level) of all pages reachable from `seeds` over links of fetched pages to hosts under `suffix`.

    `fetch` gives (url, code, html) of the asked urls. Each level is written to state/level=N when it is found, so a run
    that was stopped, or stopped by `levels`, goes on from the last level; a level's new domains are in its rows (`crawled`).
    """
    spark = seeds.sparkSession
    done = 0
    while exists(spark, f"{state}/level={done}/_SUCCESS"):
        done += 1
    if not done:
        first = seeds.select("url").where("url IS NOT NULL").distinct()
        first.select("url", domain_of(F.col("url"), suffix).alias("domain")).write.mode("overwrite").parquet(f"{state}/level=0")
        done = 1
    while levels is None or done <= levels:
        frontier = spark.read.parquet(f"{state}/level={done - 1}").select("url")
        pages = fetch(frontier).where(fetched(F.col("code")))
        targets = pages.select("url", F.explode(html_hrefs(F.col("html"))).alias("href")).select(resolve_href(F.col("url"), F.col("href")).alias("url")).distinct()
        new = targets.withColumn("domain", domain_of(F.col("url"), suffix)).where("domain IS NOT NULL").join(crawled(spark, state).select("url"), "url", "left_anti")
        new.write.mode("overwrite").parquet(f"{state}/level={done}")
        done += 1
        if spark.read.parquet(f"{state}/level={done - 1}").isEmpty():
            break
    return crawled(spark, state)


def crawled(spark: SparkSession, state: str) -> DataFrame:
    """(url, domain, level) of a crawl's saved levels."""
    n = 0
    while exists(spark, f"{state}/level={n}/_SUCCESS"):
        n += 1
    parts = [spark.read.parquet(f"{state}/level={k}").select("url", "domain", F.lit(k).alias("level")) for k in range(n)]
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], "url string, domain string, level int")
