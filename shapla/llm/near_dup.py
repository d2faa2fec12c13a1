"""Problem 4: near-duplicate records, by vantage-point trees over fingerprints within shards.

A tree over all fingerprints can't prune: unrelated texts lie 128 +- 8 of 256 bits apart, the radius for the wanted
similarity is 84, and no triangle bound excludes a branch (see the README). So the collection is first sharded. All
texts put their distinct runs of words into one global order: runs that are hot in the whole collection last, the others
by hash. The first runs of a text are its shards. Two texts whose similarity reaches t share one of their first
m - ceil(t m) + 1 runs for certain, and one of far fewer with a chance of MISS that they don't, as the order of the others is
random: see `keys_needed`. Hot runs come from a sample first and then from exact counts of the shards of all texts.

In a shard the first vantage point is the empty text: its distances are the texts' sizes, and the triangle bound parts a
shard into bands of which only neighbours meet. Further vantage points are texts; a node is split at the distance whose
boundary band is emptiest, or, where the bands hold nearly everything, compared row by row within the bounds of size. Shared
runs are then counted exactly. Texts are handled once, whatever the number of their copies.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapla.llm.common import flush, hash64, rows_of
from shapla.session import broadcast_if, materialize

SIMILARITY, RUN, MIN_WORDS = 0.6, 3, 40
BITS, RADIUS = 256, 84
#: The chance that a pair of the wanted similarity shares none of its shards.
MISS = 1e-9
#: A shard with more texts than this, or than a 100,000th of all, is hot: at most 100,000 x shards of a text of them.
HOT = 4096
#: Runs of about so many in sampled texts tell which are hot at the start; the sample never changes the result.
SAMPLE_RUNS = 4_000_000
#: Shards up to this size are compared directly.
LEAF = 48
#: Classes of equal texts up to this size are expanded into all pairs, larger ones into pairs with their first member.
EXPAND = 64
SEEDS = np.random.default_rng(11).integers(1, 1 << 63, BITS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def run_hashes(text: str, cache: dict[str, int], run: int = RUN, min_words: int = MIN_WORDS) -> np.ndarray | None:
    """Sorted hashes of the distinct runs of `run` lower-cased words; None below `min_words` words."""
    words = text.lower().split()
    if len(words) < max(min_words, run):
        return None
    if len(cache) > 500_000:
        cache.clear()
    codes = []
    for w in words:
        c = cache.get(w)
        if c is None:
            c = cache[w] = xxhash.xxh64_intdigest(w)
        codes.append(c)
    c = np.array(codes, np.uint64)
    h = np.zeros(len(c) - run + 1, np.uint64)
    for k in range(run):
        h = (h ^ c[k : k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return np.unique(h.view(np.int64))


def fingerprint(hashes: np.ndarray) -> bytes:
    """One bit of each of BITS minima: two texts differ in about half of (1 - similarity) of the bits."""
    h = hashes.view(np.uint64)
    least = np.full(BITS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), 512):
        least = np.minimum(least, (h[at : at + 512, None] * SEEDS).min(axis=0))
    return np.packbits((least >> np.uint64(40)) & np.uint64(1)).tobytes()


def distances(prints: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints given as rows of 64-bit words."""
    return np.bitwise_count(prints ^ others).sum(axis=-1, dtype=np.int32)


def keys_needed(m: int, hot: int, similarity: float = SIMILARITY, miss: float = MISS) -> int:
    """How many of its first runs a text of `m` runs, `hot` of them hot, needs as shards.

    m - ceil(t m) + 1 are enough for certain. Of two texts with similarity t the union's runs that aren't hot are common
    with a share of at least (t - h) / (1 - h), h being the share of hot runs in either text; in a random order the first
    k of them hold none that is common with a chance of at most (1 - that) ** k.
    """
    whole = m - math.ceil(similarity * m - 1e-9) + 1
    h = hot / m
    if h >= similarity:
        return whole
    share = (similarity - h) / (1 - h)
    return whole if share >= 1 else min(whole, math.ceil(math.log(miss) / math.log1p(-share)))


def small_pairs(keys: np.ndarray, sizes: np.ndarray, prints: np.ndarray, similarity: float = SIMILARITY, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs within each key of small shards at once; rows are in order of key, then size."""
    left, right = [], []
    for d in range(1, len(keys)):
        at = np.flatnonzero(keys[:-d] == keys[d:])
        if not len(at):
            break
        at = at[sizes[at] >= similarity * sizes[at + d] - 1e-9]
        for k in range(0, len(at), 1 << 18):
            a = at[k : k + (1 << 18)]
            a = a[distances(prints[a], prints[a + d]) <= radius]
            left.append(a)
            right.append(a + d)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def tree_pairs(prints: np.ndarray, sizes: np.ndarray | None = None, similarity: float = SIMILARITY, radius: int = RADIUS, leaf: int = LEAF, tally: dict | None = None) -> list[tuple[int, int]]:
    """All pairs of rows within `radius` whose sizes allow the similarity, by a vantage-point tree.

    Sizes are the distances from the empty text; rows are kept in their order, so the bound between two rows cuts a slice. A
    node takes a vantage row and parts the others at the distance mu that leaves the least to compare: pairs across the parts
    have both ends within the radius of mu. Where no mu saves a fifth, the node is compared row by row. `tally` counts both.
    """
    m = np.ones(len(prints), np.int64) if sizes is None else np.asarray(sizes, np.int64)
    out: list[tuple[int, int]] = []

    def meet(i: int, rows: np.ndarray) -> None:
        if len(rows):
            out.extend((min(i, j), max(i, j)) for j in rows[distances(prints[rows], prints[i]) <= radius].tolist())

    def reach(i: int, rows: np.ndarray) -> np.ndarray:
        of = m[rows]
        return rows[np.searchsorted(of, similarity * m[i] - 1e-9, "left") : np.searchsorted(of, m[i] / similarity + 1e-9, "right")]

    todo = [np.argsort(m, kind="stable")]
    while todo:
        ids = todo.pop()
        n = len(ids)
        split = False
        if n > leaf:
            v, rest = ids[n // 2], np.delete(ids, n // 2)
            d = distances(prints[rest], prints[v])
            upto = np.cumsum(np.bincount(d, minlength=BITS + 1))
            mus = np.arange(BITS + 1)
            near = upto.astype(np.float64)
            far = len(rest) - near
            band_near = near - np.where(mus > radius, upto[np.maximum(mus - radius, 0)], 0)
            band_far = upto[np.minimum(mus + radius, BITS)] - near
            cost = np.where((near > 0) & (far > 0), band_near * band_far + near * near / 2 + far * far / 2, np.inf)
            mu = int(cost.argmin())
            split = cost[mu] < 0.8 * len(rest) ** 2 / 2
        if tally is not None and n > leaf:
            tally["split" if split else "direct"] = tally.get("split" if split else "direct", 0) + 1
        if not split:
            for k, i in enumerate(ids.tolist()):
                meet(i, reach(i, ids[k + 1 :]))
            continue
        meet(int(v), reach(int(v), rest[d <= radius]))
        inner, outer = rest[(d <= mu) & (d > mu - radius - 1)], rest[(d > mu) & (d <= mu + radius)]
        if len(inner) > len(outer):
            inner, outer = outer, inner
        for i in inner.tolist():
            meet(i, reach(i, outer))
        todo += [rest[d <= mu], rest[d > mu]]
    return out


def sketches(records: DataFrame) -> DataFrame:
    """(tid, runs): the distinct runs of each text with enough words, at most once a task; runs of two tables differ."""

    schema = pa.schema([("tid", pa.int64()), ("runs", pa.list_(pa.int64()))])

    def run(batches):
        cache: dict[str, int] = {}
        seen: set[int] = set()
        for b in batches:
            tids, offsets, parts = [], [0], []
            for tbl, text, tid in rows_of(b, "tbl", "text", "tid"):
                if tid not in seen:
                    seen.add(tid)
                    h = run_hashes(text, cache)
                    if h is not None:
                        tids.append(tid)
                        parts.append(np.sort(h ^ np.int64(hash64(tbl))))
                        offsets.append(offsets[-1] + len(h))
            if tids:
                runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts), pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(tids, pa.int64()), runs], schema=schema)

    return records.select("tbl", "text", "tid").mapInArrow(run, "tid long, runs array<long>")


def shard_rows(docs: DataFrame, hot: np.ndarray, similarity: float = SIMILARITY, prints: bool = True) -> DataFrame:
    """(key, tid, m, print): each text's shards with its size and fingerprint; `hot` holds the hot runs, frequent ones last."""
    order = np.argsort(hot, kind="stable")
    known = hot[order]
    fields = [("key", pa.int64()), ("tid", pa.int64()), ("m", pa.int32())] + ([("print", pa.binary())] if prints else [])
    schema = pa.schema(fields)

    def run(batches):
        for b in batches:
            tids = b.column(0).to_pylist()
            runs = b.column(1)
            flat, offsets = runs.values.to_numpy(), runs.offsets.to_numpy()
            if len(known):
                at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
                rank = np.where(known[at] == flat, order[at] + 1, 0)
            else:
                rank = np.zeros(len(flat), np.int64)
            keys, ids, sizes, marks = [], [], [], []
            for k, tid in enumerate(tids):
                h, r = flat[offsets[k] : offsets[k + 1]], rank[offsets[k] : offsets[k + 1]]
                n = keys_needed(len(h), int(np.count_nonzero(r)), similarity)
                usual = h[r == 0]
                first = usual[:n] if len(usual) >= n else h[np.argsort(r, kind="stable")][:n]
                keys.append(first)
                ids += [tid] * len(first)
                sizes += [len(h)] * len(first)
                if prints:
                    marks += [fingerprint(h)] * len(first)
                if len(ids) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys), pa.int64()), pa.array(ids, pa.int64()), pa.array(sizes, pa.int32())] + ([pa.array(marks, pa.binary())] if prints else []), schema=schema)
                    keys, ids, sizes, marks = [], [], [], []
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys), pa.int64()), pa.array(ids, pa.int64()), pa.array(sizes, pa.int32())] + ([pa.array(marks, pa.binary())] if prints else []), schema=schema)

    return docs.select("tid", "runs").mapInArrow(run, "key long, tid long, m int" + (", print binary" if prints else ""))


def hot_runs(docs: DataFrame, similarity: float = SIMILARITY, rounds: int = 3) -> tuple[np.ndarray, DataFrame | None]:
    """The hot runs, frequent ones last, and the shards that stay hot although they come last: (key, m, n) or None.

    Runs of the sampled texts that stand in 8 of them and in a thousandth are hot at the start; then, some rounds long, the
    shards of all texts are counted and those above the bound become hot too. What is collected is bounded by SAMPLE_RUNS / 8
    and by 100,000 x shards of a text, whatever the number of texts.
    """
    n, runs = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("runs")), F.lit(0))).first()
    every = max(1, -(-runs // SAMPLE_RUNS))
    seen = max(8, n // every // 1000)
    sample = docs.where(F.pmod(F.xxhash64("tid"), F.lit(every)) == 0).select(F.explode("runs").alias("run"))
    often = sample.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= seen).orderBy("n", "run").toArrow()
    hot = often["run"].to_numpy()
    bound = max(HOT, n // 100_000)
    for k in range(rounds + 1 if n > bound else 0):
        counts = shard_rows(docs, hot, similarity, prints=False).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bound)
        more = counts.orderBy("n", "key").toArrow()
        new = more["key"].to_numpy()
        if not len(new):
            return hot, None
        if k == rounds or not len(np.setdiff1d(new, hot)):
            by_size = shard_rows(docs, hot, similarity, prints=False).join(F.broadcast(counts.select("key")), "key", "left_semi")
            return hot, by_size.groupBy("key", "m").agg(F.count(F.lit(1)).alias("n"))
        hot = np.concatenate([hot, new[~np.isin(new, hot)]])
    return hot, None


def parted(shards: DataFrame, left: DataFrame, similarity: float, block: int) -> DataFrame:
    """`shards` with the keys of hot shards replaced by those of their parts.

    Parts are bands of size, the distance from the empty text, so wide that similar texts lie in one or in neighbouring
    bands; a band with more than `block` texts is cut into blocks by hash, and every two blocks of one band, or of
    neighbouring ones, meet in a part of their own. `left`: (key, m, n) of the hot shards.
    """
    width = math.log(1 / similarity) * 1.001
    band = F.floor(F.log("m") / width).cast("int")
    bands = left.groupBy("key", band.alias("band")).agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
    plan = bands.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("plan"))
    rows = shards.join(F.broadcast(plan), "key", "left").withColumn("band", band)
    own = F.pmod(F.xxhash64("tid"), F.col("plan")[F.col("band")]).cast("int")

    def each(shift: int, name):
        n = F.coalesce(F.try_element_at("plan", F.col("band") + shift), F.lit(0))
        return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), name)

    same = each(0, lambda j: F.xxhash64("key", F.lit(0), "band", F.least(own, j), F.greatest(own, j)))
    upper = each(1, lambda j: F.xxhash64("key", F.lit(1), "band", own, j))
    lower = each(-1, lambda j: F.xxhash64("key", F.lit(1), F.col("band") - 1, j, own))
    parts = F.when(F.col("plan").isNull(), F.array("key")).otherwise(F.concat(same, upper, lower))
    return rows.select(F.explode(parts).alias("key"), "tid", "m", "print")


def similar_texts(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): pairs tid_a < tid_b of different texts of one table whose runs overlap by at least `similarity`."""
    hot, left = hot_runs(docs, similarity)
    shards = shard_rows(docs, hot, similarity)
    if left is not None:
        shards = parted(shards, left, similarity, HOT)
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(batches):
        found: list[np.ndarray] = []

        def add(a: np.ndarray, b: np.ndarray) -> None:
            if len(a):
                found.append(np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0))

        def search(k: np.ndarray, t: np.ndarray, m: np.ndarray, f: np.ndarray) -> None:
            own = np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])])  # copies of a text have equal rows
            k, t, m, f = k[own], t[own], m[own], f[own]
            cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]]))
            size = np.diff(cut)
            of = np.repeat(size, size)
            little = np.flatnonzero((of > 1) & (of <= LEAF))
            a, b = small_pairs(k[little], m[little], f[little], similarity)
            add(t[little[a]], t[little[b]])
            for i in np.flatnonzero(size > LEAF).tolist():
                x = slice(cut[i], cut[i + 1])
                got = np.array(tree_pairs(f[x], m[x], similarity), np.int64).reshape(-1, 2)
                add(t[x][got[:, 0]], t[x][got[:, 1]])

        def given():
            if found:
                both = np.unique(np.concatenate(found), axis=0)
                found.clear()
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], schema=out)

        rest: tuple | None = None
        for b in batches:
            k, t, m = (b.column(c).to_numpy() for c in range(3))
            f = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint64).reshape(-1, BITS // 64)
            if rest is not None:
                k, t, m, f = (np.concatenate([x, y]) for x, y in zip(rest, (k, t, m, f), strict=True))
            last = int(np.searchsorted(k, k[-1], "left")) if len(k) else 0
            if last:
                search(k[:last], t[:last], m[:last], f[:last])
            rest = (k[last:], t[last:], m[last:], f[last:])
            if sum(map(len, found)) > 200_000:
                yield from given()
        if rest is not None and len(rest[0]) > 1:
            search(*rest)
        yield from given()

    grouped = shards.repartition("key").sortWithinPartitions("key", "m", "tid")
    candidates = materialize(grouped.mapInArrow(pairs, "a long, b long").distinct())
    need = materialize(candidates.select(F.explode(F.array("a", "b")).alias("tid")).distinct())
    runs = docs.join(broadcast_if(need, need.count(), 32), "tid", "left_semi").select("tid", "runs").dropDuplicates(["tid"])
    both = candidates.join(runs.select(F.col("tid").alias("a"), F.col("runs").alias("ra")), "a").join(runs.select(F.col("tid").alias("b"), F.col("runs").alias("rb")), "b")
    shared = F.size(F.array_intersect("ra", "rb"))
    return both.where(shared >= similarity * (F.size("ra") + F.size("rb") - shared) - 1e-9).select("a", "b")


def classes_of(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches, (tbl, url, tid) of the records with enough words, and (tid, n, first, last) of the classes of equal texts."""
    tagged = records.where("url IS NOT NULL AND text IS NOT NULL").select("tbl", "url", "text", F.xxhash64("tbl", "text").alias("tid"))
    docs = materialize(sketches(tagged))
    members = materialize(tagged.select("tbl", "url", "tid").distinct().join(docs.select("tid"), "tid", "left_semi").select("tbl", "url", "tid"))
    return docs, members, members.groupBy("tid").agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("first"), F.max("url").alias("last"))


def near_duplicates(records: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(tbl, url_a, url_b), url_a < url_b: records of one table whose texts' distinct runs of three words overlap by `similarity`.

    `records` has tbl, url, text. Texts under 40 words, null texts and null urls take no part; repeated rows count once.
    Copies of one text are all paired up to EXPAND members, beyond that each is paired with the class's first url, and
    two classes whose product is larger than EXPAND squared are paired by one url each. `near_duplicate_classes` gives the
    members of all classes and the numbers of their links, so nothing is lost where pairs stand for classes.
    """
    docs, members, classes = classes_of(records)
    cls = members.join(classes, "tid")
    small = cls.where(F.col("n").between(2, EXPAND))
    equal = small.select("tbl", "tid", F.col("url").alias("u")).join(small.select("tid", F.col("url").alias("v")), "tid").where("u < v").select("tbl", "u", "v")
    large = members.join(classes.where(F.col("n") > EXPAND), "tid").select("tbl", F.col("first").alias("u"), F.col("url").alias("v")).where("u <> v")
    links = materialize(similar_texts(docs, similarity))
    side = lambda s: classes.select(F.col("tid").alias(s), F.col("n").alias(f"n{s}"), F.col("first").alias(f"f{s}"), F.col("last").alias(f"l{s}"))
    sized = links.join(side("a"), "a").join(side("b"), "b")
    whole = F.col("na") * F.col("nb") <= EXPAND * EXPAND
    left = cls.select(F.col("tid").alias("a"), "tbl", F.col("url").alias("u"))
    right = members.select(F.col("tid").alias("b"), F.col("url").alias("v"))
    linked = sized.where(whole).join(left, "a").join(right, "b").select("tbl", "u", "v")
    clash = F.col("fa") == F.col("fb")
    u = F.when(clash & (F.col("nb") == 1), F.col("la")).otherwise(F.col("fa"))
    v = F.when(clash & (F.col("nb") > 1), F.col("lb")).otherwise(F.col("fb"))
    table_of = members.groupBy(F.col("tid").alias("a")).agg(F.min("tbl").alias("tbl"))
    stars = sized.where(~whole).join(table_of, "a").select("tbl", u.alias("u"), v.alias("v"))
    pairs = equal.unionAll(large).unionAll(linked).unionAll(stars).where("u <> v")
    return pairs.select("tbl", F.least("u", "v").alias("url_a"), F.greatest("u", "v").alias("url_b")).distinct()


def near_duplicate_classes(records: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(tbl, url, class, copies, links) of every record with enough words.

    `class` is the first url with the same text, `copies` the number of urls with that text, and `links` that of the other
    texts of the table that are similar to it. A url with two texts has a row for each.
    """
    docs, members, classes = classes_of(records)
    links = similar_texts(docs, similarity)
    degree = links.select(F.explode(F.array("a", "b")).alias("tid")).groupBy("tid").agg(F.count(F.lit(1)).alias("links"))
    out = members.join(classes, "tid").join(degree, "tid", "left")
    return out.select("tbl", "url", F.col("first").alias("class"), F.col("n").alias("copies"), F.coalesce("links", F.lit(0)).alias("links"))
