"""Problem 6: cutting oversized texts at natural places, with overlap, by range-maximum queries.

Every position of a text has a boundary strength (blank line, line break, sentence end, clause, space). A sparse table
over (strength, position) answers "the strongest cut in this window, the rightmost of equals" in constant time; each
piece ends at the strongest cut of its permissible lengths, and the next one starts at the strongest place within the
overlap before that cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapla.llm.common import distinct_pages, in_batches, rows_of

LIMIT, OVERLAP = 2000, 300
#: A piece that isn't the last one is at least this share of the limit long.
LEAST = 0.5


class RangeMax:
    """Sparse table over int64 values: maximum of values[a:b] in two look-ups; levels up to windows of `widest`."""

    def __init__(self, values: np.ndarray, widest: int):
        self.levels = [values]
        step = 1
        while 2 * step <= min(widest, len(values)):
            last = self.levels[-1]
            self.levels.append(np.maximum(last[:-step], last[step:]))
            step *= 2

    def query(self, a: int, b: int) -> int:
        k = (b - a).bit_length() - 1
        level = self.levels[k]
        return int(max(level[a], level[b - (1 << k)]))


def strengths(text: str) -> np.ndarray:
    """Strength of a cut before each code point, and after the last: 0 within a word, negative within a character."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(len(c) + 1, np.int64)
    if len(c) < 2:
        return out
    prev, here = c[:-1], c[1:]
    space = (c == 32) | (c == 9) | (c == 0xA0) | (c == 0x3000) | (c == 13)
    line = c == 10
    end = np.isin(c, np.array([ord(x) for x in "।॥.?!۔؟。！？၊။…"], np.uint32))
    clause = np.isin(c, np.array([ord(x) for x in ",;:،؛，；：、)]}–—"], np.uint32))
    closing = np.isin(c, np.array([ord(x) for x in "\"'”’»」』)"], np.uint32))
    wide_end = np.isin(c, np.array([ord(x) for x in "。！？।။"], np.uint32))
    joins = ((here >= 0x300) & (here < 0x370)) | (here == 0x200C) | (here == 0x200D) | ((here >= 0x0900) & (here < 0x0E00) & np.isin(here & 0x7F, np.array(MARKS, np.uint32))) | ((here >= 0xFE00) & (here < 0xFE10))
    s = np.where(space[:-1] & ~space[1:], 1, 0)
    s = np.where(clause[:-1] & ~clause[1:], 1, s)
    s[1:] = np.where(space[1:-1] & clause[:-2], 2, s[1:])
    s = np.where(wide_end[:-1] & ~closing[1:] & ~end[1:], 3, s)
    s[1:] = np.where(space[1:-1] & ~space[2:] & (end[:-2] | closing[:-2]), np.where(end[:-2], 3, 2), s[1:])
    s[2:] = np.where(space[2:-1] & closing[1:-2] & end[:-3], 3, s[2:])
    s = np.where(line[:-1], 4, s)
    s[1:] = np.where(line[1:-1] & line[:-2], 6, s[1:])
    s = np.where((here == 35) & line[:-1], 7, s)
    s = np.where(joins | (line[1:] & ~line[:-1]) | (line[1:] & line[:-1]), -1, s)
    out[1:-1] = s
    return out


# Low seven bits of the dependent signs in the blocks of the Indic scripts.
MARKS = [0x01, 0x02, 0x03, *range(0x3C, 0x3D), *range(0x3E, 0x4E), *range(0x55, 0x58), 0x62, 0x63]


#: Code points of a text for which tables are kept at a time, beside the limit; a text of any length takes no more memory.
STRETCH = 1 << 16


class Boundaries:
    """Range maxima of the boundary strengths around the place that is being cut, built a stretch at a time."""

    def __init__(self, text: str, limit: int):
        self.text, self.limit, self.at, self.to = text, limit, 0, -1

    def strongest(self, a: int, b: int) -> tuple[int, int]:
        """(position, strength) of the strongest cut in [a, b), the rightmost of equals."""
        if not (self.at <= a and b <= self.to):
            self.at, self.to = a, min(len(self.text) + 1, b + max(STRETCH, self.limit))
            lo = max(0, a - 8)  # what stands around the edges decides on their strength
            s = strengths(self.text[lo : self.to + 8])[a - lo : self.to - lo]
            self.table = RangeMax((s + 1) * (len(s) + 1) + np.arange(len(s)), self.limit)
            self.base = len(s) + 1
        v = self.table.query(a - self.at, b - self.at)
        return self.at + v % self.base, v // self.base - 1


def cuts(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of the pieces, in order; one piece where the text is within the limit, none for an empty one.

    A piece starts at the strongest boundary of the overlap's first two thirds, else where a character starts.
    """
    n = len(text)
    if n <= limit:
        return [(0, n)] if n else []
    overlap = max(0, min(overlap, int(limit * LEAST) - 1))
    least = max(1, int(limit * LEAST), overlap + 1)
    found = Boundaries(text, limit)
    out, start = [], 0
    while n - start > limit:
        end, _ = found.strongest(start + least, start + limit + 1)
        out.append((start, end))
        start = end
        if overlap:
            start, strength = found.strongest(end - overlap, max(end - overlap + 1, end - overlap // 3))
            if strength < 1:
                start, strength = found.strongest(end - overlap, min(end, end - overlap + 16))
    out.append((start, n))
    return out


def pieces(items: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(tbl, item_key, piece_no, start_pos, end_pos, piece) of each text longer than `limit` code points.

    `items` has tbl, item_key, text. Pieces are at most `limit` long, numbered from 1, and neighbours overlap by at most
    `overlap`; without overlaps they give the text again. A text without any natural place is cut at the limit. Null
    texts and keys and texts within the limit give no rows; repeated rows count once, and only they are shuffled.
    """
    schema = pa.schema([("tbl", pa.string()), ("item_key", pa.string()), ("piece_no", pa.int32()), ("start_pos", pa.int32()), ("end_pos", pa.int32()), ("piece", pa.string())])

    def run(batches):
        def rows():
            for b in batches:
                for tbl, key, text in rows_of(b, "tbl", "url", "text"):
                    for no, (a, e) in enumerate(cuts(text, limit, overlap), 1):
                        yield tbl, key, no, a, e, text[a:e]

        yield from in_batches(rows(), schema, 1024)

    long = items.select("tbl", F.col("item_key").alias("url"), "text").where(F.col("url").isNotNull() & (F.length("text") > limit))
    return distinct_pages(long).mapInArrow(run, "tbl string, item_key string, piece_no int, start_pos int, end_pos int, piece string")
