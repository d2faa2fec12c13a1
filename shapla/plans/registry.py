"""All queries of the core and their SQL."""

from __future__ import annotations

from shapla.plans import crawl, p7, retrieve

FLAGSHIP = "bm25_topk"


def queries() -> dict:
    return crawl.Q | retrieve.Q | p7.QUERIES


def oracle_sql() -> dict:
    return crawl.O | retrieve.O | p7.ORACLE
