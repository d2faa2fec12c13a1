"""What several text operators share: fields of the tables, line keys, Arrow helpers."""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapla.session import broadcast_if, materialize, table

# Month names, words that introduce a person, words around a title.
MONTHS = (
    "January February March April May June July August September October November December "
    "জানুয়ারি ফেব্রুয়ারি মার্চ এপ্রিল মে জুন জুলাই আগস্ট সেপ্টেম্বর অক্টোবর নভেম্বর ডিসেম্বর"
).split()
BY = "তথ্যদাতা|লিখেছেন|প্রকাশক|প্রতিবেদক|সম্পাদক|Published by|Written by|Edited by|source|author"

LINK = re.compile(r"\]\([^)\n]*\)")
DATE = re.compile(r"\d{1,2}\s+(?:%s)\s+\d{2,4}|(?:%s)\s+\d{1,2},?\s+\d{4}|(?:%s)\s+\d{4}" % (("|".join(MONTHS),) * 3))
#: What every date holds.
DATED = re.compile(r"(?:%s)\s+\d" % "|".join(MONTHS))
NUMBER = re.compile(r"\d+(?:[.,/:\-]\d+)*")
NAME = re.compile(r"(?<!\w)(%s)(:?\s)\s*[^\s,|]+(?:\s+[^\s,|]+){0,3}(?=\s*(?:[,|]|$))" % BY)
#: What no name can do without: the first word of each introduction.
INTRODUCED = [x.split()[0] for x in BY.split("|")]
DIGIT = re.compile(r"\d")
LETTERS3 = re.compile(r"(?:[^\W\d_][\W\d_]*?){3}")
HOST = re.compile(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)")
INVISIBLE = [chr(c) for c in (0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD)]
#: Four of one letter or more, which tokens cut to three.
RUN = re.compile(r"(\w)\1\1\1")
MARKS = "*_#>+-•|~` \t "
TAILED = re.compile(r"[/>»:“\"]")
TAIL = re.compile(r"[/>»:]\s*([^/>»:]+?)\s*$|[“\"]([^”\"]+)[”\"]")


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m.group(1).lower() if m else ""


def has_any(text: str, words: list[str]) -> bool:
    """Whether one of some fixed words stands anywhere in a text; much quicker than an expression of them."""
    for w in words:  # noqa: SIM110 - a generator takes longer
        if w in text:
            return True
    return False


def visible(text: str) -> str:
    if not text.isascii():
        for c in INVISIBLE:
            if c in text:
                text = text.replace(c, "")
    return text


def plain(line: str) -> str:
    """A line without invisible characters, outer marks and repeated white space."""
    return " ".join(visible(line).split()).strip(MARKS)


def has_run(text: str) -> bool:
    """Whether a letter stands four times or more in a row."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    same = c[1:] == c[:-1]
    return bool((same[2:] & same[1:-1] & same[:-2]).any()) and RUN.search(text) is not None


class Page:
    """One text's lines and what several steps ask of them, made once and only when asked for."""

    def __init__(self, url: str | None, text: str):
        self.host, self.text, self.lines = host_of(url), text, text.split("\n")
        seen = visible(text)
        self.clean = seen is text
        self.seen = self.lines if self.clean else seen.split("\n")
        self.forms: list[str | None] = [None] * len(self.lines)
        self.rows: list | None = None
        self._small: list[str] | None = None

    def plain(self, no: int) -> str:
        """`plain` of the line with this number, counted from one."""
        p = self.forms[no - 1]
        if p is None:
            p = self.forms[no - 1] = " ".join(self.seen[no - 1].split()).strip(MARKS)
        return p

    def named(self, no: int) -> bool:
        """Whether the line with this number introduces a person."""
        return has_any(self.seen[no - 1], INTRODUCED) and NAME.search(self.plain(no)) is not None

    def small(self) -> list[str]:
        """The lines in small letters, or none of them where something is invisible or a letter is repeated in a long run."""
        if self._small is None:
            low = self.text.lower() if self.clean else ""
            self._small = low.split("\n") if self.clean and not has_run(low) else []
        return self._small


def titles_of(title: str | None, lines: list[str]) -> list[str]:
    """The page's own title: the given one, its first heading, and any whole line that a path or share line ends with."""
    found = []
    if title and title.strip():
        found.append(plain(title))
    for line in lines:
        if line.lstrip().startswith("#"):
            found.append(plain(line))
            break
    if not found:
        whole = {plain(x) for x in lines}
        for line in lines:
            if TAILED.search(line) and (m := TAIL.search(plain(line))):
                t = (m.group(1) or m.group(2)).strip(MARKS)
                if t in whole and t != plain(line):
                    found.append(t)
                    break
    return [t for t in found if len(t) > 2]


def line_key(line: str, titles: list[str], form: str | None = None) -> str:
    """A line's wording without link targets, numbers, dates, names, the title, spacing and outer marks; "" if too little is left.

    `form` is the line's plain form, where it is at hand.
    """
    s = plain(LINK.sub("]", line)) if "](" in line else plain(line) if form is None else form
    if "**" in s:
        s = s.replace("**", "")
    for t in titles:
        if t in s:
            s = s.replace(t, "\x01")
    if DIGIT.search(s):
        s = " ".join(NUMBER.sub("", DATE.sub("", s) if has_any(s, MONTHS) and DATED.search(s) else s).split())
    if has_any(s, INTRODUCED):
        s = NAME.sub(r"\1", s)
    return s.strip(MARKS) if LETTERS3.search(s) else ""


def hash64(text: str) -> int:
    h = xxhash.xxh64_intdigest(text)
    return h - (1 << 64) if h >> 63 else h


#: table, field, title column of the page bodies.
BODIES = {"gov_bd_pages": ("markdown_body", "title"), "websites": ("raw_markdown", None), "banglapedia_pages": ("markdown_body", "title")}


def bodies(spark: SparkSession, d: str, tables: list[str]) -> DataFrame:
    """(tbl, url, field, title, text) of all bodies with text."""
    parts = []
    for t in tables:
        field, title = BODIES[t]
        parts.append(table(spark, d, t).select(F.lit(t).alias("tbl"), "url", F.lit(field).alias("field"), (F.col(title) if title else F.lit(None).cast("string")).alias("title"), F.col(field).alias("text")))
    return reduce(DataFrame.unionAll, parts).where("url IS NOT NULL AND text <> ''")


def distinct_pages(pages: DataFrame) -> DataFrame:
    """`pages` without repeated (tbl, url, text): only rows that do repeat are shuffled, found by their hashes.

    Of repeats that differ in other columns the one with the greatest title stays.
    """
    own = [F.col(c) for c in ("tbl", "url")] + [F.xxhash64("text").alias("tid"), F.length("text").alias("size")]
    repeated = materialize(pages.select(*own).groupBy("tbl", "url", "tid", "size").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("tbl", "url", "tid", "size", F.lit(True).alias("again")))
    marked = pages.withColumns({"tid": F.xxhash64("text"), "size": F.length("text")}).join(broadcast_if(repeated, repeated.count(), 160), ["tbl", "url", "tid", "size"], "left").drop("tid", "size")
    rest = [c for c in pages.columns if c not in ("tbl", "url", "text")]
    one = marked.where("again").groupBy("tbl", "url", "text").agg(F.max(F.struct(*rest)).alias("_r")).select(*[F.col(c) if c in ("tbl", "url", "text") else F.col(f"_r.{c}").alias(c) for c in pages.columns]) if rest else marked.where("again").select(*pages.columns).distinct()
    return marked.where("again IS NULL").select(*pages.columns).unionByName(one)


def rows_of(batch: pa.RecordBatch, *names: str) -> zip:
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def flush(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def in_batches(rows, schema: pa.Schema, size: int = 4096):
    """Row tuples as record batches of bounded size."""
    out: list[tuple] = []
    for r in rows:
        out.append(r)
        if len(out) >= size:
            yield flush(out, schema)
            out = []
    if out:
        yield flush(out, schema)
