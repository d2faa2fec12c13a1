"""Problem 1: lines repeated across one source's documents.

Pass one builds a counter summary for each source: counters in proportion to its lines, SUMMARY_CELLS at least, each the
sum over all lines that hash to it. Such summaries merge by addition (Spark's map-side aggregation does so), and a counter
is never below the count of any of its lines, so a line below the threshold in its counter can be left out for good. Pass two
counts distinct urls exactly, for lines of the remaining counters only. Lines are removed where the pages are read, by a
broadcast set of the confirmed keys. A source may hold any share of all rows: both passes aggregate before they shuffle, by
source and line, never by source alone, and where a set is too large to be broadcast the join is salted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapla.llm.common import Page, distinct_pages, hash64, host_of, in_batches, line_key, rows_of, titles_of
from shapla.session import BROADCAST_BYTES, broadcast_if, materialize

MIN_URLS = 8
SUMMARY_CELLS = 1 << 16
KEYED = "tbl string, url string, tid long, source long, nos array<int>, keys array<long>"


def page_keys(tbl: str, host: str, title: str | None, text: str, page: Page | None = None) -> tuple[list[int], list[int]]:
    """Line numbers and 64-bit keys of the lines that can count."""
    page = page or Page(None, text)
    titles = titles_of(title, page.lines)
    nos, keys = [], []
    head = f"{tbl}\n{host}\n"
    for no, line in enumerate(page.lines, 1):
        if line and (k := line_key(line, titles, page.plain(no))):
            nos.append(no)
            keys.append(hash64(head + k))
    return nos, keys


def keyed(pages: DataFrame) -> DataFrame:
    """(tbl, url, tid, source, nos, keys): for each page its lines' numbers and keys; tid stands for the text."""
    schema = pa.schema([("tbl", pa.string()), ("url", pa.string()), ("tid", pa.int64()), ("source", pa.int64()), ("nos", pa.list_(pa.int32())), ("keys", pa.list_(pa.int64()))])

    def run(batches):
        def rows():
            for b in batches:
                for tbl, url, title, text, tid in rows_of(b, "tbl", "url", "title", "text", "tid"):
                    host = host_of(url)
                    nos, keys = page_keys(tbl, host, title, text)
                    if nos:
                        yield tbl, url, tid, hash64(f"{tbl}\n{host}"), nos, keys

        yield from in_batches(rows(), schema)

    return pages.select("tbl", "url", "title", "text", F.xxhash64("text").alias("tid")).mapInArrow(run, KEYED)


#: Parts into which a key's rows are cut in a shuffled join.
SALTS = 16


def semi_join(rows: DataFrame, wanted: DataFrame, on: list[str], row_bytes: int, salt: str) -> DataFrame:
    """`rows` whose `on` is among `wanted`, which is broadcast below the bound; else joined in SALTS parts by a hash of `salt`."""
    n = wanted.count()
    if n * row_bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(wanted), on, "left_semi")
    parts = wanted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int")).join(parts, [*on, "_salt"], "left_semi").drop("_salt")


def heavy_cells(lines: DataFrame, min_urls: int = MIN_URLS) -> DataFrame:
    """(source, cell): counters that reach the threshold; `lines` has source, cell."""
    return lines.groupBy("source", "cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_urls).select("source", "cell")


def in_cells(keys: DataFrame, cells: int = SUMMARY_CELLS) -> DataFrame:
    """(source, u, key, cell) of all lines; a source with more lines than four a counter gets as many counters as a quarter of them."""
    sizes = keys.groupBy("source").agg(F.sum(F.size("keys")).alias("n")).where(F.col("n") > 4 * cells)
    large = materialize(sizes.select("source", (F.col("n") / 4).cast("long").alias("cells")))
    rows = keys.select("source", F.xxhash64("url").alias("u"), F.explode(F.array_distinct("keys")).alias("key"))
    n = large.count()
    if n:
        rows = rows.join(broadcast_if(large, n, 24), "source", "left")
        return rows.withColumn("cell", F.pmod("key", F.coalesce("cells", F.lit(cells).cast("long")))).drop("cells")
    return rows.withColumn("cell", F.pmod("key", F.lit(cells).cast("long")))


def confirmed(keys: DataFrame, min_urls: int = MIN_URLS, cells: int = SUMMARY_CELLS) -> DataFrame:
    """(key, urls): keys of lines that stand on at least `min_urls` different urls of their source."""
    lines = in_cells(keys, cells)
    summary = materialize(heavy_cells(lines, min_urls))
    candidates = semi_join(lines, summary, ["source", "cell"], 48, "u")
    return candidates.groupBy("key").agg(F.countDistinct("u").alias("urls")).where(F.col("urls") >= min_urls)


def repeated_keys(pages: DataFrame, min_urls: int = MIN_URLS) -> DataFrame:
    """(tbl, url, tid, line_no) of all repeated lines; may hold a row twice where `pages` does."""
    keys = materialize(keyed(pages))
    found = materialize(confirmed(keys, min_urls).select("key"))
    lines = keys.select("tbl", "url", "tid", F.explode(F.arrays_zip("nos", "keys")).alias("l")).select("tbl", "url", "tid", F.col("l.nos").alias("line_no"), F.col("l.keys").alias("key"))
    return semi_join(lines, found, ["key"], 24, "url").drop("key")


class KeySet:
    """Confirmed keys as a sorted array, to be sent to all tasks."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)

    def lines(self, tbl: str, url: str, title: str | None, text: str, page: Page | None = None) -> list[int]:
        """Numbers of a page's repeated lines."""
        nos, keys = page_keys(tbl, host_of(url), title, text, page)
        if not nos or not len(self.keys):
            return []
        k = np.array(keys, np.int64)
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.array(nos)[self.keys[at] == k].tolist()


def key_set(pages: DataFrame, min_urls: int = MIN_URLS) -> KeySet | None:
    """All confirmed keys, or None where they exceed the broadcast bound."""
    found = materialize(confirmed(materialize(keyed(pages)), min_urls).select("key"))
    return KeySet(found.toArrow()["key"].to_numpy()) if found.count() * 8 <= BROADCAST_BYTES else None


def with_repeated(pages: DataFrame, min_urls: int = MIN_URLS) -> tuple[DataFrame, KeySet | None]:
    """`pages` with `repeated` and the set that finds the lines within a task: only where there is no such set are the
    line numbers joined to the pages, else `repeated` is null and no page is shuffled."""
    keys = key_set(pages, min_urls)
    if keys is not None:
        return pages.withColumn("repeated", F.lit(None).cast("array<int>")), keys
    rep = repeated_keys(pages, min_urls).groupBy("tbl", "url", "tid").agg(F.collect_set(F.col("line_no").cast("int")).alias("repeated"))
    return pages.withColumn("tid", F.xxhash64("text")).join(rep, ["tbl", "url", "tid"], "left").drop("tid"), None


def repeated_lines(pages: DataFrame, min_urls: int = MIN_URLS) -> DataFrame:
    """(tbl, url, line_no): lines that stand on at least `min_urls` different urls of the same host in the same table.

    `pages` has tbl, url, title, text. Wording is compared without numbers, dates, personal names, the page's title,
    spacing and marks; lines left with fewer than three letters never count. Null urls and texts are ignored, repeated
    rows count once, and a host is taken without regard to the scheme. Empty input gives an empty result.
    """
    return repeated_keys(pages, min_urls).select("tbl", "url", "line_no").distinct()


def cleaned(pages: DataFrame, min_urls: int = MIN_URLS) -> DataFrame:
    """(tbl, url, text): the distinct pages without their repeated lines; a text may be left empty."""
    rows, keys = with_repeated(distinct_pages(pages), min_urls)
    schema = pa.schema([("tbl", pa.string()), ("url", pa.string()), ("text", pa.string())])

    def run(batches):
        def out():
            for b in batches:
                for tbl, url, title, text, repeated in rows_of(b, "tbl", "url", "title", "text", "repeated"):
                    cut = set(keys.lines(tbl, url, title, text) if keys is not None else repeated or ())
                    yield tbl, url, "\n".join(x for no, x in enumerate(text.split("\n"), 1) if no not in cut) if cut else text

        yield from in_batches(out(), schema, 1024)

    return rows.select("tbl", "url", "title", "text", "repeated").mapInArrow(run, "tbl string, url string, text string")
