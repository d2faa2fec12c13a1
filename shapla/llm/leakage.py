"""Problem 9: evaluation items in training text, by the CGK embedding and bit-sampling LSH over item-sized windows.

From every word of a text a random walk reads a window: at step j it puts out the word under the pointer, and a hash of
(walk, j, word) decides whether the pointer moves on. Windows at a small edit distance come out at a small Hamming
distance, so equal samples of a few output positions find them. The windows' length follows the items' length, and walks are
repeated until leaks of half an item, with one word in EDIT_EVERY changed, are found at the target recall: this is measured on the
items themselves. Texts look their windows up in hash tables over all windows of the items, and each hit is verified by an exact
alignment of the item with the words around it. Items of up to SHORT words are looked up by plain windows of half their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapla.llm.common import in_batches

#: Words that a window reads, by the least number of an item's words.
WINDOWS = [(4, 2), (8, 3), (16, 4), (32, 6), (64, 8)]
SHORT = 3
#: Recall of candidates on leaks of half an item with one word in so many changed, and the most walks a length gets for it.
TARGET, EDIT_EVERY, MOST_WALKS = 0.995, 8, 8
#: Items are matched in blocks of about so many words, and so many blocks in one scan, so that tables stay small.
BLOCK_WORDS, BLOCKS_TOGETHER = 300_000, 16
#: Share of an item's words that counts as a leak; a changed word between right ones counts as held.
SHARE = 0.5
#: Texts are read together up to about so many words.
TOGETHER = 20_000
#: An alignment of a span has at least this share of its words in common, as a match outweighs 1 / 0.6 changes (see `held`).
LEAST_MATCHES = 0.375
GAP = np.uint64(1)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _table() -> dict[int, object]:
    import sys
    import unicodedata

    t: dict[int, object] = {}
    for o in range(sys.maxunicode + 1):
        ch = chr(o)
        cat = unicodedata.category(ch)
        if cat == "Nd":
            if o > 127:
                t[o] = str(unicodedata.digit(ch))
        elif cat == "Cf" or o in (0xFE0F, 0xFE0E):
            t[o] = None
        elif cat[0] in "PSZC" and cat not in ("Cn", "Co", "Cs") and not ch.isspace():
            t[o] = " "
    for o in (0x9DC, 0x9DD, 0x9DF, 0x95C, 0x95D):
        t[o] = unicodedata.normalize("NFD", chr(o))
    return t


class Words:
    """Texts as arrays of 64-bit word codes; punctuation, case, digits' script, spacing and invisible signs don't matter."""

    def __init__(self) -> None:
        self.table = _table()
        self.codes: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.translate(self.table).lower().split()
        codes = self.codes
        if len(codes) > 500_000:
            codes.clear()
        out = []
        for w in words:
            c = codes.get(w)
            if c is None:
                c = codes[w] = xxhash.xxh64_intdigest(w)
            out.append(c)
        return np.array(out, np.uint64)


class Walk:
    """One random walk: reads windows of about `words` words and samples as many of its outputs; `plain` ones read words in a row."""

    def __init__(self, words: int, number: int, plain: bool = False):
        rng = np.random.default_rng([7, words, number])
        self.words, self.plain = words, plain
        self.steps = words if plain else 2 * words
        self.moves = rng.integers(1 << 32, 1 << 63, self.steps, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        inner = rng.choice(np.arange(1, self.steps - 1), max(0, words - 2), replace=False).tolist() if self.steps > 2 and not plain else []
        self.at = set(range(self.steps)) if plain else {0, self.steps - 1, *inner}

    def samples(self, codes: np.ndarray) -> np.ndarray:
        """The sampled output of the window that starts at each word; windows end in zeros at the end."""
        padded = np.concatenate([codes, np.zeros(self.steps + 1, np.uint64)])
        pointer = np.arange(len(codes))
        sample = np.full(len(codes), self.words, np.uint64)
        for j in range(self.steps):
            here = padded[pointer]
            if j in self.at:
                sample = sample * MULTIPLIER + here + np.uint64(j)
                sample ^= sample >> np.uint64(29)
            pointer += 1 if self.plain else ((here * self.moves[j]) >> np.uint64(63)).astype(np.int64)
        return sample


def window_of(n: int) -> int:
    """The window length of an item of `n` words; 0 for a short one."""
    return max((w for least, w in WINDOWS if n >= least), default=0)


def edited(codes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Half of an item from a random word on, with one word in EDIT_EVERY changed, dropped or added to."""
    half = -(-len(codes) // 2)
    at = int(rng.integers(0, len(codes) - half + 1))
    out = []
    for c in codes[at : at + half].tolist():
        kind = int(rng.integers(0, 3 * EDIT_EVERY))
        if kind != 0:  # 0: dropped, 1: changed, 2: another word comes before it
            out += [int(rng.integers(1 << 62)), c] if kind == 2 else [int(rng.integers(1 << 62))] if kind == 1 else [c]
    return np.array(out, np.uint64)


def walks_for(items: list[np.ndarray], window: int, target: float = TARGET, sample: int = 400) -> list[Walk]:
    """As many walks as find the target share of edited halves of the items; at most MOST_WALKS."""
    rng = np.random.default_rng(window)
    probes = [(items[i], edited(items[i], rng)) for i in rng.integers(0, len(items), sample).tolist()]
    missed, walks = list(range(len(probes))), []
    while len(walks) < MOST_WALKS and (not walks or len(missed) > (1 - target) * len(probes)):
        walk = Walk(window, len(walks))
        walks.append(walk)
        missed = [k for k in missed if not np.isin(walk.samples(probes[k][1]), walk.samples(probes[k][0])).any()]
    return walks


class ItemIndex:
    """Hash tables over all windows of a block of item fields, for each walk those of the items of its window length."""

    BITS = 22

    def __init__(self, fields: list[tuple[int, str]], words: Words):
        self.item = np.array([i for i, _ in fields], np.int64)
        codes = [words(t) for _, t in fields]
        self.lengths = np.array([len(c) for c in codes], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        self.flat = np.concatenate([*codes, np.zeros(0, np.uint64)])
        groups: dict[tuple[bool, int], list[int]] = {}
        for k, n in enumerate(self.lengths.tolist()):
            if n:
                groups.setdefault((n <= SHORT, -(-n // 2) if n <= SHORT else window_of(n)), []).append(k)
        self.walks: list[Walk] = []
        self.tables: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for (plain, window), ids in sorted(groups.items()):
            owner = np.concatenate([np.full(len(codes[k]), k) for k in ids])
            place = np.concatenate([np.arange(len(codes[k])) for k in ids])
            whole = place + window <= self.lengths[owner] if plain else np.ones(len(owner), bool)
            for walk in [Walk(window, 0, True)] if plain else walks_for([codes[k] for k in ids], window):
                s = np.concatenate([walk.samples(codes[k]) for k in ids])[whole]
                order = np.argsort(s, kind="stable")
                bitmap = np.zeros(1 << self.BITS, bool)
                bitmap[(s >> np.uint64(64 - self.BITS)).astype(np.int64)] = True
                self.walks.append(walk)
                self.tables.append((s[order], owner[whole][order], place[whole][order], np.packbits(bitmap)))
        self.places: dict[int, dict[int, int]] = {}
        self.gap = max((w.steps for w in self.walks), default=0) + 1

    def codes(self, field: int) -> np.ndarray:
        return self.flat[self.starts[field] : self.starts[field + 1]]

    def in_order(self, field: int, window: np.ndarray) -> int:
        """How many of an item's words stand in a window in order: the longest common subsequence, all rows of it in one number."""
        places = self.places.get(field)
        if places is None:
            places = self.places[field] = {}
            for i, w in enumerate(self.codes(field).tolist()):
                places[w] = places.get(w, 0) | 1 << i
        whole = free = (1 << int(self.lengths[field])) - 1
        for w in window.tolist():
            at = places.get(w)
            if at:
                met = free & at
                free = (free + met | free - met) & whole
        return int(self.lengths[field]) - free.bit_count()

    def candidates(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fields, diagonals (text position minus item position) and text positions of windows that meet in some table."""
        pairs, places = [], []
        for walk, (keys, owner, place, bitmap) in zip(self.walks, self.tables, strict=True):
            s = walk.samples(codes)
            cell = (s >> np.uint64(64 - self.BITS)).astype(np.int64)
            hit = np.flatnonzero(bitmap[cell >> 3] & (0x80 >> (cell & 7)).astype(np.uint8))
            if not len(hit):
                continue
            lo, hi = np.searchsorted(keys, s[hit], "left"), np.searchsorted(keys, s[hit], "right")
            counts = hi - lo
            total = int(counts.sum())
            if total:
                p = np.repeat(hit, counts)
                e = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lo, counts)
                pairs.append(owner[e] << 40 | (p - place[e] + (1 << 39)))
                places.append(p)
        if not pairs:
            return (np.zeros(0, np.int64),) * 3
        found, first = np.unique(np.concatenate(pairs), return_index=True)
        return found >> 40, (found & ((1 << 40) - 1)) - (1 << 39), np.concatenate(places)[first]

    def agreeing(self, codes: np.ndarray, share: float):
        """(field, diagonal, position) where enough of the item's words stand on the diagonal: `share` of them, or of one window
        half, as added and missing words move the rest to other diagonals."""
        fields, diagonals, places = self.candidates(codes)
        sizes = self.lengths[fields]
        enough = np.maximum(np.minimum(share * sizes, 0.5 * np.array([window_of(n) or n for n in sizes.tolist()])), 1)
        at = 0
        while at < len(fields):
            to = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), 2_000_000, "right")))
            f, d, n = fields[at:to], diagonals[at:to], sizes[at:to]
            row = np.repeat(np.arange(len(f)), n)
            step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            where = d[row] + step
            inside = (where >= 0) & (where < len(codes))
            same = np.zeros(len(row), bool)
            same[inside] = codes[where[inside]] == self.flat[(self.starts[f][row] + step)[inside]]
            ok = np.bincount(row, same, len(f)) >= enough[at:to]
            yield from zip(f[ok].tolist(), d[ok].tolist(), places[at:to][ok].tolist(), strict=True)
            at = to


def held(item: list[int], text: list[int]) -> int:
    """How many words of `item` stand in `text` together and in order; single words may differ, be missing or added.

    Local alignment (match 1, change -0.6, missing or added word -0.8); the changed words within it count as held.
    """
    m = len(text)
    score, start = [0.0] * (m + 1), [0] * (m + 1)
    best, span = 0.0, 0
    for i, w in enumerate(item):
        new, first = [0.0] * (m + 1), [i + 1] * (m + 1)
        for j in range(m):
            if w == text[j]:
                d, f = score[j] + 1.0, (start[j] if score[j] > 0 else i)
            else:
                d, f = score[j] - 0.6, start[j]
            if score[j + 1] - 0.8 > d:
                d, f = score[j + 1] - 0.8, start[j + 1]
            if new[j] - 0.8 > d:
                d, f = new[j] - 0.8, first[j]
            if d > 0:
                new[j + 1], first[j + 1] = d, f
                if d > best:
                    best, span = d, i + 1 - f
        score, start = new, first
    return span


def leaked(texts: list[np.ndarray], index: ItemIndex, share: float = SHARE) -> list[set[int]]:
    """For each text, given as word codes, the item ids that leak into it. Texts are read together, apart by gaps."""
    gap = np.full(index.gap, GAP)
    starts = np.cumsum([0, *(len(t) + len(gap) for t in texts)])
    whole = np.concatenate([x for t in texts for x in (t, gap)]) if texts else np.zeros(0, np.uint64)
    found: list[set[int]] = [set() for _ in texts]
    for field, d, p in sorted(index.agreeing(whole, 0.4 * share)):
        k = int(np.searchsorted(starts, p, "right")) - 1
        item_id = int(index.item[field])
        if item_id in found[k]:
            continue
        item, d = index.codes(field), d - int(starts[k])
        slack = 2 + len(item) // 8
        window = texts[k][max(0, d - slack) : max(0, d + len(item) + slack)]
        if index.in_order(field, window) < LEAST_MATCHES * share * len(item):
            continue
        if held(item.tolist(), window.tolist()) >= share * len(item):
            found[k].add(item_id)
    return found


def indexes(items: DataFrame):
    """Indexes of blocks of items, one after the other; the driver holds one block's texts at a time."""
    words, block, size = Words(), [], 0
    for r in items.select("item_id", "queries", "expected_answer").where("item_id IS NOT NULL").distinct().orderBy("item_id", "queries", "expected_answer").toLocalIterator():
        for t in (r.queries, r.expected_answer):
            if t:
                block.append((r.item_id, t))
                size += len(t.split())
        if size >= BLOCK_WORDS:
            yield ItemIndex(block, words)
            block, size = [], 0
    if block:
        yield ItemIndex(block, words)


def leaks(documents: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id): documents that hold at least `share` of the words of one field of an item, together and in order.

    `documents` has doc_id, text; `items` has item_id, queries, expected_answer. Null and empty texts and fields match
    nothing, repeated rows count once. Items are a stated query set: each block's index is built once and broadcast, its size
    bounded by BLOCK_WORDS, and BLOCKS_TOGETHER blocks share one scan and one splitting into words of all documents.
    """
    context = documents.sparkSession.sparkContext
    texts = documents.select("doc_id", "text").where("text <> ''")
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64())])

    def match(blocks: list) -> DataFrame:
        def run(batches):
            words = Words()
            together = TOGETHER * len(blocks)

            def pairs(some):
                for block in blocks:
                    for (i, _), found in zip(some, leaked([c for _, c in some], block.value, share), strict=True):
                        for item in found:
                            yield i, item

            def rows():
                for b in batches:
                    some, size = [], 0
                    for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                        some.append((i, words(t)))
                        size += len(some[-1][1])
                        if size > together:
                            yield from pairs(some)
                            some, size = [], 0
                    yield from pairs(some)

            yield from in_batches(rows(), schema)

        return texts.mapInArrow(run, "doc_id long, item_id long")

    out, blocks = None, []
    for index in indexes(items):
        blocks.append(context.broadcast(index))
        if len(blocks) == BLOCKS_TOGETHER:
            out, blocks = match(blocks) if out is None else out.unionAll(match(blocks)), []
    if blocks or out is None:
        out = match(blocks) if out is None else out.unionAll(match(blocks))
    return out.distinct()
