"""Problem 8: filling containers of fixed capacity with whole documents, by linear grouping.

Sizes are whole numbers up to the capacity, so all planning works on their histogram, which the capacity bounds. Large
sizes are put into groups of equal cardinality and rounded up to their group's largest; column generation (simplex with
a knapsack as pricing) finds the best mix of container configurations for these few sizes; actual documents take the
slots of their group by rank; what is left, and all small documents, goes where it fits best. Ranks within one size are
found without sorting it in one task: rows are numbered within as many hashed buckets as the histogram asks for, and shifted
by the buckets' counts.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shapla.llm.common import in_batches, rows_of
from shapla.session import broadcast_if, materialize

# Fixed value: how the byte-level vocabularies part a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CAPACITY, GROUPS, SMALL = 2048, 48, 0.1
#: Rows of one value that are numbered in one task, about.
BUCKET_ROWS = 100_000


def tokenizer(path: str):
    """A function from texts to token counts, for a vocabulary file of sentencepiece or tiktoken ranks."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    import base64

    import tiktoken

    ranks = {}
    with open(path, "rb") as f:
        for line in f:
            a, b = line.split()
            ranks[base64.b64decode(a)] = int(b)
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(enc.encode_ordinary(t)) for t in texts]


def items(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start_token, tokens): documents as items; those above the capacity are cut into pieces of it."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start_token", pa.int32()), ("tokens", pa.int32())])

    def run(batches):
        count = tokenizer(vocabulary)

        def rows():
            for b in batches:
                ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                for i, n in zip(ids, count(texts), strict=True):
                    for k in range(-(-n // capacity)):
                        yield i, k, k * capacity, min(capacity, n - k * capacity)

        yield from in_batches(rows(), schema, 16384)

    return documents.select("doc_id", "text").where("doc_id IS NOT NULL AND text <> ''").mapInArrow(run, "doc_id long, piece int, start_token int, tokens int").distinct()


def best_mix(sizes: list[int], need: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(configuration, times): whole parts of the best fractional mix of configurations for `need` items of each size."""
    m = len(sizes)
    cols = [np.eye(m)[i] * (capacity // sizes[i]) for i in range(m)]
    inverse = np.diag([1.0 / (capacity // s) for s in sizes])
    x = inverse @ np.array(need, float)
    s = np.array(sizes)
    for _ in range(40 * m):
        dual = inverse.sum(axis=0)
        best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(int(s.min()), capacity + 1):
            fit = s <= c
            v = np.where(fit, best[c - np.minimum(s, c)] + dual, -1.0)
            k = int(v.argmax())
            if v[k] > best[c - 1]:
                best[c], take[c] = v[k], k
            else:
                best[c], take[c] = best[c - 1], -2
        if best[capacity] <= 1 + 1e-7:
            break
        new, c = np.zeros(m), capacity
        while c > 0 and take[c] != -1:
            if take[c] == -2:
                c -= 1
            else:
                new[take[c]] += 1
                c -= int(s[take[c]])
        d = inverse @ new
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        r = int(ratio.argmin())
        step = ratio[r]
        x = x - step * d
        x[r] = step
        cols[r] = new
        row = inverse[r] / d[r]
        inverse = inverse - np.outer(d, row)
        inverse[r] = row
    return [(tuple(int(v) for v in col), int(np.floor(t + 1e-6))) for col, t in zip(cols, x, strict=True) if t >= 1 - 1e-6]


class Plan:
    """Where each (size, rank) goes; all parts are bounded by the capacity, never by the number of documents."""

    def __init__(self, histogram: dict[int, int], capacity: int, groups: int = GROUPS, small: float = SMALL):
        self.capacity = capacity
        large = sorted(n for n in histogram if small * capacity < n < capacity)
        total = sum(histogram[n] for n in large)
        self.group_of: dict[int, int] = {}
        tops: list[int] = []
        counts: list[int] = []
        for n in large:
            if not tops or counts[-1] >= total / groups:
                tops.append(n)
                counts.append(0)
            self.group_of[n] = len(tops) - 1
            tops[-1] = n
            counts[-1] += histogram[n]
        self.before: dict[int, int] = {}
        seen = [0] * len(tops)
        for n in large:
            g = self.group_of[n]
            self.before[n] = seen[g]
            seen[g] += histogram[n]
        mix = best_mix(tops, counts, capacity) if tops else []
        # slots of group g: (first rank, configuration's first container, items a container), in order of rank
        self.slots: list[list[tuple[int, int, int]]] = [[] for _ in tops]
        ends = [0] * len(tops)
        containers = 0
        for config, times in mix:
            for g, a in enumerate(config):
                if a and ends[g] < counts[g]:
                    self.slots[g].append((ends[g], containers, a))
                    ends[g] += a * times
            containers += times
        self.containers = containers
        self.placed = [min(e, c) for e, c in zip(ends, counts, strict=True)]

    def slot(self, size: int, rank: int) -> int | None:
        """The container of the rank-th document of a large size, or None if it is left to best fit."""
        g = self.group_of.get(size)
        if g is None:
            return None
        r = self.before[size] + rank
        if r >= self.placed[g]:
            return None
        at = self.slots[g][bisect.bisect_right(self.slots[g], (r, 1 << 62, 0)) - 1]
        return at[1] + (r - at[0]) // at[2]

    def left(self, histogram: dict[int, int]) -> dict[int, tuple[int, int]]:
        """size -> (first rank, count) of what best fit places."""
        out = {}
        for n, c in histogram.items():
            if n >= self.capacity:
                continue
            first = max(0, min(c, self.placed[self.group_of[n]] - self.before[n])) if n in self.group_of else 0
            if c > first:
                out[n] = (first, c - first)
        return out


def best_fit(space: dict[int, int], left: dict[int, tuple[int, int]], capacity: int) -> tuple[dict[int, list[tuple[int, int, int, int]]], int]:
    """Places sizes, largest first, into the fullest containers that take them; whole runs of equals at a time.

    `space`: free space -> number of containers. Result: size -> [(first rank, count, class, first container of the
    class)], and the number of new containers, whose class is -1.
    """
    free: dict[int, list[tuple[int, int, int]]] = {r: [(r, 0, c)] for r, c in space.items() if c > 0}
    keys = sorted(free)
    opened = 0
    moves: dict[int, list[tuple[int, int, int, int]]] = {}

    def put(r: int, run: tuple[int, int, int]) -> None:
        if r > 0:
            if r not in free:
                free[r] = []
                bisect.insort(keys, r)
            free[r].append(run)

    for n in sorted(left, reverse=True):
        rank, todo = left[n]
        while todo:
            at = bisect.bisect_left(keys, n)
            if at == len(keys):
                fresh = -(-todo // (capacity // n))
                put(capacity, (-1, opened, fresh))
                opened += fresh
                continue
            r = keys[at]
            cls, first, count = free[r].pop()
            if not free[r]:
                del free[r]
                keys.pop(at)
            k = min(count, todo)
            moves.setdefault(n, []).append((rank, k, cls, first))
            put(r - n, (cls, first, k))
            if count > k:
                put(r, (cls, first + k, count - k))
            rank += k
            todo -= k
    return moves, opened


def ranked(df: DataFrame, by: str, histogram: dict[int, int], *order: str) -> DataFrame:
    """`df` with rank: 0, 1, ... within each value of `by`, whose number of values is bounded.

    Values are numbered in hashed buckets of about BUCKET_ROWS rows, as many as the value's count in `histogram` needs.
    """
    many = {v: -(-n // BUCKET_ROWS) for v, n in histogram.items() if n > BUCKET_ROWS}
    buckets = F.coalesce(F.create_map(*[F.lit(x) for kv in sorted(many.items()) for x in kv])[F.col(by)], F.lit(1)) if many else F.lit(1)
    b = df.withColumn("bucket", F.pmod(F.xxhash64(*order), buckets.cast("long")))
    w = Window.partitionBy(by, "bucket").orderBy(*order)
    b = b.withColumn("r", F.row_number().over(w).cast("long"))
    if not many:
        return b.withColumn("rank", F.col("r") - 1).drop("bucket", "r")
    counts = b.where(F.col(by).isin(sorted(many))).groupBy(by, "bucket").agg(F.count(F.lit(1)).alias("n"))
    shift = materialize(counts.select(by, "bucket", (F.sum("n").over(Window.partitionBy(by).orderBy("bucket")) - F.col("n")).alias("shift")))
    return b.join(broadcast_if(shift, sum(many.values()), 40), [by, "bucket"], "left").withColumn("rank", F.coalesce("shift", F.lit(0)) + F.col("r") - 1).drop("bucket", "r", "shift")


def pack(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """(container, doc_id, piece, start_token, tokens, unused): each item's container and the space left in it.

    Documents stay whole unless they are longer than `capacity` tokens; those are cut into full pieces and a rest. Null
    and empty texts hold no tokens and take no place; repeated rows count once; with no documents the result is empty.
    """
    spark = documents.sparkSession
    all_items = materialize(items(documents, vocabulary, capacity))
    histogram = {r.tokens: r.n for r in all_items.groupBy("tokens").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    plan = Plan(histogram, capacity)
    own = F.concat_ws("-", F.lit("own"), "doc_id", "piece")
    full = all_items.where(F.col("tokens") == capacity).withColumn("container", own)
    rest = ranked(all_items.where(F.col("tokens") < capacity), "tokens", histogram, "doc_id", "piece")
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start_token", pa.int32()), ("tokens", pa.int32()), ("rank", pa.int64()), ("slot", pa.int64())])

    def slots(batches):
        def rows():
            for b in batches:
                for i, p, s, t, r in rows_of(b, "doc_id", "piece", "start_token", "tokens", "rank"):
                    yield i, p, s, t, r, plan.slot(t, r)

        yield from in_batches(rows(), schema, 16384)

    rest = materialize(rest.mapInArrow(slots, "doc_id long, piece int, start_token int, tokens int, rank long, slot long"))
    slotted = rest.where("slot IS NOT NULL")
    free = materialize(slotted.groupBy("slot").agg((F.lit(capacity) - F.sum("tokens")).cast("int").alias("space")))
    space = {r.space: r.n for r in free.groupBy("space").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    free = ranked(free, "space", space, "slot")
    moves, _ = best_fit(space, plan.left(histogram), capacity)

    def fits(batches):
        starts = {n: [m[0] for m in ms] for n, ms in moves.items()}

        def rows():
            for b in batches:
                for i, p, s, t, r in rows_of(b, "doc_id", "piece", "start_token", "tokens", "rank"):
                    first, _, cls, at = moves[t][bisect.bisect_right(starts[t], r) - 1]
                    yield i, p, s, t, cls, at + r - first

        yield from in_batches(rows(), pa.schema([*list(schema)[:4], ("space", pa.int32()), ("at", pa.int64())]), 16384)

    small = rest.where("slot IS NULL").mapInArrow(fits, "doc_id long, piece int, start_token int, tokens int, space int, at long")
    into = small.join(free.select("space", F.col("rank").alias("at"), "slot"), ["space", "at"], "left")
    into = into.withColumn("container", F.when(F.col("space") < 0, F.concat_ws("-", F.lit("new"), "at")).otherwise(F.concat_ws("-", F.lit("mix"), "slot")))
    cols = ["container", "doc_id", "piece", "start_token", "tokens"]
    shared = into.select(cols).unionAll(slotted.withColumn("container", F.concat_ws("-", F.lit("mix"), "slot")).select(cols))
    unused = shared.groupBy("container").agg((F.lit(capacity) - F.sum("tokens")).cast("int").alias("unused"))
    return full.select(*cols, F.lit(0).alias("unused")).unionAll(shared.join(unused, "container").select(*cols, "unused"))
