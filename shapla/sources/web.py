"""Listings in pages as a Spark data source, and fetching behind an interface."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from shapla.functions.text import html_markdown


class FolderPages:
    """Answers of a listing from files: `first.json`, then `<token>.json` for each continuation."""

    def __init__(self, folder: str):
        self.folder = folder

    def __call__(self, params: dict[str, str]) -> dict:
        token = params.get("apcontinue", "first")
        with open(os.path.join(self.folder, f"{token}.json"), encoding="utf-8") as f:
            return json.load(f)


def titles(ask, size: int = 500) -> Iterator[str]:
    """All titles of a listing: the answers' continuations are followed until there is none."""
    params = {"action": "query", "list": "allpages", "aplimit": str(size), "format": "json"}
    while True:
        answer = ask(params)
        for page in answer["query"]["allpages"]:
            yield page["title"]
        if "continue" not in answer:
            return
        params |= answer["continue"]


class Listing(DataSource):
    """`spark.read.format("paged_listing").load(folder)`: (title). The pages hang on each other, so one task reads them."""

    @classmethod
    def name(cls) -> str:
        return "paged_listing"

    def schema(self) -> str:
        return "title string"

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(self.options["path"], int(self.options.get("size", "500")))


class ListingReader(DataSourceReader):
    def __init__(self, folder: str, size: int):
        self.folder, self.size = folder, size

    def read(self, partition):
        for title in titles(FolderPages(self.folder), self.size):
            yield (title,)


def listing(spark: SparkSession, folder: str) -> DataFrame:
    spark.dataSource.register(Listing)
    return spark.read.format("paged_listing").load(folder)


class Fetcher(Protocol):
    """(url, code, html) of the asked urls; a url that can't be had has a null code or no row."""

    def __call__(self, urls: DataFrame) -> DataFrame: ...


class TableFetcher:
    """Fetches from a table of pages (url, code, html): the offline web."""

    def __init__(self, pages: DataFrame):
        self.pages = pages

    def __call__(self, urls: DataFrame) -> DataFrame:
        return urls.select("url").distinct().join(self.pages.select("url", "code", "html"), "url")


def fetch_markdown(urls: DataFrame, fetch: Fetcher) -> DataFrame:
    """(url, code, raw_markdown): pages without furniture elements as markdown; null without an answer."""
    return urls.select("url").distinct().join(fetch(urls), "url", "left").select("url", "code", html_markdown(F.col("html")).alias("raw_markdown"))
