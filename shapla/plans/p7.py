"""Queries of problem 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shapla.functions.urls import page_key
from shapla.operators import orphans
from shapla.session import table


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_references(table(spark, d, "website_links"), table(spark, d, "websites")).select("id", "side").distinct()


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(table(spark, d, "website_links"), table(spark, d, "websites"))


def p7_orphan_keys(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "website_links").withColumn("k", page_key("target_url"))
    return orphans.orphan_keys(links, table(spark, d, "websites").withColumn("k", page_key("url")), "k", "k")


def _key(c: str) -> str:
    rest = rf"regexp_replace(regexp_replace(trim({c}), '#[\s\S]*$', ''), '^https?://', '', 'i')"
    host = rf"regexp_replace(regexp_replace(lower(regexp_extract({rest}, '^[^/?]*')), '^www\.', ''), ':(80|443)$', '')"
    return rf"({host} || regexp_replace(regexp_replace({rest}, '^[^/?]*', ''), '/+$', ''))"


_ORPHANS = f"""
WITH refs AS (
  SELECT DISTINCT id, side, created_at, {_key("url")} AS k
  FROM (SELECT id, created_at, 'source' AS side, source_url AS url FROM website_links
        UNION ALL SELECT id, created_at, 'target', target_url FROM website_links)
  WHERE url IS NOT NULL),
r AS (SELECT * FROM refs WHERE regexp_extract(k, '^[^/?]*') LIKE '%.gov.bd'),
w AS (SELECT {_key("url")} AS k, processed_at AS t, max(CASE WHEN status = 'deleted' THEN 0 ELSE 1 END) AS alive FROM websites GROUP BY 1, 2),
o AS (SELECT r.id, r.side, r.created_at, r.k FROM r LEFT JOIN w ON w.k = r.k AND w.t <= r.created_at
      GROUP BY 1, 2, 3, 4 HAVING coalesce(arg_max(w.alive, w.t), 0) = 0)
"""

QUERIES = {"p7_found": p7_found, "p7_report": p7_report, "p7_orphan_keys": p7_orphan_keys}
ORACLE = {
    "p7_found": _ORPHANS + "SELECT DISTINCT id, side FROM o",
    "p7_report": _ORPHANS + "SELECT side, strftime(created_at, '%Y-%m') AS month, count(*) AS orphans, count(DISTINCT k) AS keys FROM o GROUP BY 1, 2",
    "p7_orphan_keys": f"SELECT DISTINCT {_key('target_url')} AS key FROM website_links WHERE target_url IS NOT NULL EXCEPT SELECT {_key('url')} FROM websites",
}
