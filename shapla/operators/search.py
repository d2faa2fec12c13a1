"""Retrieval for batches of queries: a stored lexical index, BM25 (two forms), exact nearest neighbours, fusion, two-stage search, contexts."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shapla.functions.text import tokens
from shapla.session import materialize


def postings(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, term, tf)."""
    return docs.select(F.col(key).alias("key"), F.explode(tokens(text)).alias("term")).groupBy("key", "term").agg(F.count(F.lit(1)).alias("tf"))


def query_terms(queries: DataFrame, key: str, text: Column) -> DataFrame:
    """(query, term, qtf): repeated words of a query count again."""
    return queries.select(F.col(key).alias("query"), F.explode(tokens(text)).alias("term")).groupBy("query", "term").agg(F.count(F.lit(1)).alias("qtf"))


#: Query terms that are matched in one scan of an index; more of them go in further scans.
BLOCK_TERMS = 1_000_000
#: Scores nearer than this may be equal once rounded; both are kept until the final ranking.
NEAR = 2e-6


class Index:
    """A stored lexical index: `docs` (key, dl, terms, tfs), a row a document, `terms` (term, df), and counts of all documents.

    Every document is split into words once; statistics, searches and later sessions read the stored rows. `folder` keeps
    the index, with its postings sorted by term for look-ups of few terms; without it the index lives in the working folder.
    """

    def __init__(self, docs: DataFrame, terms: DataFrame):
        self.docs, self.terms = docs, terms
        self.n, avgdl = docs.agg(F.count(F.lit(1)), F.avg("dl")).first()
        self.avgdl = avgdl or 1.0

    @staticmethod
    def build(docs: DataFrame, key: str, text: Column, folder: str | None = None) -> Index:
        """`docs` has a unique `key`; null texts are documents without words."""
        kind = docs.schema[key].dataType.simpleString()
        spec = f"key {kind}, dl int, terms array<string>, tfs array<int>"

        def run(batches):
            word = re.compile(r"\w+")  # letters, numbers and underscores, as in functions.text
            for b in batches:
                counts = [Counter(word.findall(t or "")) for t in b.column(1).to_pylist()]
                offsets = pa.array(np.cumsum([0, *map(len, counts)]), pa.int32())
                terms = pa.ListArray.from_arrays(offsets, pa.array([t for c in counts for t in c], pa.string()))
                tfs = pa.ListArray.from_arrays(offsets, pa.array([n for c in counts for n in c.values()], pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sum(c.values()) for c in counts], pa.int32()), terms, tfs], ["key", "dl", "terms", "tfs"])

        rows = materialize(docs.select(F.col(key).alias("key"), F.lower(text).alias("text")).mapInArrow(run, spec))
        terms = materialize(rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")))
        if folder is None:
            return Index(rows, terms)
        rows.write.mode("overwrite").parquet(f"{folder}/docs")
        terms.write.mode("overwrite").parquet(f"{folder}/terms")
        one = rows.select("key", "dl", F.explode(F.arrays_zip("terms", "tfs")).alias("p")).select("key", "dl", F.col("p.terms").alias("term"), F.col("p.tfs").alias("tf"))
        one.repartitionByRange("term", "key").sortWithinPartitions("term", "key").write.mode("overwrite").parquet(f"{folder}/postings")
        return Index.load(docs.sparkSession, folder)

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Index:
        return Index(spark.read.parquet(f"{folder}/docs"), spark.read.parquet(f"{folder}/terms"))

    def idf(self, form: str) -> DataFrame:
        """(term, idf) of the whole vocabulary."""
        n, df = F.lit(self.n), F.col("df")
        if form == "lucene":
            return self.terms.select("term", F.log(1 + (n - df + 0.5) / (df + 0.5)).alias("idf"))
        idf = self.terms.select("term", (F.log(n - df + 0.5) - F.log(df + 0.5)).alias("idf"))
        mean = idf.agg(F.avg("idf")).first()[0]
        return idf.select("term", F.when(F.col("idf") < 0, 0.25 * F.lit(mean)).otherwise(F.col("idf")).alias("idf"))


def weight(tf, dl, avgdl: float, k1: float):
    return tf * (k1 + 1) / (tf + k1 * (0.25 + 0.75 * dl / avgdl))


K1 = {"okapi": 1.5, "lucene": 1.2}


def bm25(index: Index, terms: DataFrame, k: int, form: str = "okapi", boost: float = 1.0) -> DataFrame:
    """(query, key, score) of documents that share a term with a query; at least the k best of each query, see `top`.

    okapi: k1 1.5, b 0.75, negative idf raised to a quarter of the mean idf of the whole vocabulary. lucene: k1 1.2, b
    0.75, idf never negative. The queries, a stated set, go to all documents in blocks of about BLOCK_TERMS terms: no posting is
    shuffled, no term is hot, and each task gives out its k best of each query, with those that might tie with the last.
    """
    k1 = K1[form]
    wanted = materialize(terms.join(index.idf(form), "term").select("query", "term", (F.col("qtf") * F.col("idf") * boost).alias("w")))
    rows = wanted.count()
    blocks = max(1, -(-rows // BLOCK_TERMS))
    kinds = {c: index.docs.schema["key"].dataType if c == "key" else terms.schema["query"].dataType for c in ("query", "key")}
    spec = f"query {kinds['query'].simpleString()}, key {kinds['key'].simpleString()}, score double"
    out = None
    for i in range(blocks):
        own = wanted if blocks == 1 else wanted.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == i)
        found = index.docs.mapInArrow(matcher(own.toArrow(), k, k1, index.avgdl), spec)
        found = found if blocks == 1 else materialize(found)
        out = found if out is None else out.unionAll(found)
    return out


def matcher(wanted: pa.Table, k: int, k1: float, avgdl: float):
    """The Arrow step of `bm25` for one block of query terms: (query, term, w)."""
    names = wanted["query"].combine_chunks().dictionary_encode() if wanted.num_rows else None
    queries = names.dictionary if names is not None else pa.array([], wanted.schema.field("query").type)
    width = len(queries)
    terms: dict[str, int] = {}
    tid = np.array([terms.setdefault(t, len(terms)) for t in wanted["term"].to_pylist()], np.int64)
    order = np.argsort(tid, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(tid, minlength=len(terms)))]).astype(np.int64)
    of = names.indices.to_numpy()[order].astype(np.int64) if names is not None else np.zeros(0, np.int64)
    w = wanted["w"].to_numpy()[order]

    def run(batches):
        least = np.full(width, -np.inf)
        kept: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
        best = np.full((k, width), -np.inf)
        for batch in batches if width else ():
            keys, dls = batch.column(0), batch.column(1).to_numpy()
            lists, tfs = batch.column(2), batch.column(3)
            step = max(1, 2_000_000 // width)
            for at in range(0, len(keys), step):
                part = lists.slice(at, step)
                ids = np.array([terms.get(t, -1) for t in part.flatten().to_pylist()], np.int64)
                tf = tfs.slice(at, step).flatten().to_numpy()
                doc = np.repeat(np.arange(len(part)), pa.compute.list_value_length(part).to_numpy())
                hit = np.flatnonzero(ids >= 0)
                ids, tf, doc = ids[hit], tf[hit], doc[hit]
                many = starts[ids + 1] - starts[ids]
                post = np.repeat(starts[ids] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(int(many.sum())) if len(ids) else np.zeros(0, np.int64)
                value = np.repeat(weight(tf, dls[at + doc], avgdl, k1), many) * w[post]
                cell = np.repeat(doc, many) * width + of[post]
                score = np.bincount(cell, value, len(part) * width).reshape(len(part), width)
                met = np.zeros(len(part) * width, bool)
                met[cell] = True
                score[~met.reshape(score.shape)] = -np.inf
                both = np.concatenate([best, score])
                best = -np.partition(-both, k - 1, axis=0)[:k]
                least = best[k - 1]
                d, q = np.nonzero((score >= least - NEAR) & np.isfinite(score))
                if len(d):
                    kept.append((q, keys.slice(at, step).take(pa.array(d)), score[d, q]))
        for q, key, score in kept:
            ok = np.flatnonzero(score >= least[q] - NEAR)
            if len(ok):
                at = pa.array(ok)
                yield pa.RecordBatch.from_arrays([queries.take(pa.array(q[ok])), key.take(at), pa.array(score[ok])], ["query", "key", "score"])

    return run


def pair_scores(index: Index, terms: DataFrame, pairs: DataFrame, form: str = "lucene") -> DataFrame:
    """(query, key, score) of the given (query, key) that share a term; few pairs, so only their documents are opened."""
    docs = index.docs.join(pairs.select("key").distinct(), "key", "left_semi")
    one = docs.select("key", "dl", F.explode(F.arrays_zip("terms", "tfs")).alias("p")).select("key", "dl", F.col("p.terms").alias("term"), F.col("p.tfs").alias("tf"))
    wanted = terms.join(pairs.select("query").distinct(), "query", "left_semi").join(index.idf(form), "term")
    met = pairs.select("query", "key").distinct().join(one, "key").join(wanted, ["query", "term"])
    return met.groupBy("query", "key").agg(F.sum(F.col("qtf") * F.col("idf") * weight(F.col("tf"), F.col("dl"), index.avgdl, K1[form])).alias("score"))


def top(scores: DataFrame, k: int, digits: int = 6, *order: Column) -> DataFrame:
    """(query, rank, key, score): the k best of each query by rounded score, then by key, greatest first."""
    s = scores.withColumn("score", F.round("score", digits))
    w = Window.partitionBy("query").orderBy(F.desc("score"), *(order or (F.desc("key"),)))
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


#: Query vectors that go to all rows in one scan.
BLOCK_VECTORS = 16_384


def knn(vectors: DataFrame, key: str, vector: str, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query, rank, key, cosine): exact nearest neighbours of a stated query set, which goes to all rows in blocks.

    Each task keeps k rows a query, so only k rows a query and task are shuffled; a block of BLOCK_VECTORS queries is a scan
    of its own, so the driver never holds more. `queries`: query, vector. Null or zero vectors match nothing, as queries or
    as rows; a row equal to a query's key is a neighbour like any other.
    """
    some = queries.select(F.col("query").cast("long"), "vector").where("vector IS NOT NULL").distinct()
    blocks = max(1, -(-some.count() // BLOCK_VECTORS))
    near = None
    for i in range(blocks):
        block = some.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == i).orderBy("query").collect()
        found = vectors.select(F.col(key).cast("long"), F.col(vector)).mapInArrow(nearest([(r.query, r.vector) for r in block], k), "query long, key long, cosine double")
        found = found if blocks == 1 else materialize(found)
        near = found if near is None else near.unionAll(found)
    return top(near.withColumnRenamed("cosine", "score"), k).withColumnRenamed("score", "cosine")


def nearest(block: list[tuple[int, list[float]]], k: int):
    """The Arrow step of `knn` for one block of queries."""
    schema = pa.schema([("query", pa.int64()), ("key", pa.int64()), ("cosine", pa.float64())])
    ids = np.array([i for i, v in block if any(v)], np.int64)
    q = np.array([v for _, v in block if any(v)], float)
    if len(ids):
        q /= np.linalg.norm(q, axis=1)[:, None]

    def run(batches):
        keys, scores = np.zeros((len(ids), 0), np.int64), np.zeros((len(ids), 0))
        for b in batches if len(ids) else ():
            pairs = [(i, v) for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if v and any(v)]
            for at in range(0, len(pairs), 4096):
                own, x = np.array([i for i, _ in pairs[at : at + 4096]]), np.array([v for _, v in pairs[at : at + 4096]], float)
                x /= np.linalg.norm(x, axis=1)[:, None]
                s = np.concatenate([scores, np.round(q @ x.T, 9)], axis=1)
                every = np.concatenate([keys, np.broadcast_to(own, (len(ids), len(own)))], axis=1)
                order = np.lexsort((-every, -s), axis=1)[:, :k]
                keys, scores = np.take_along_axis(every, order, 1), np.take_along_axis(s, order, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, keys.shape[1]), pa.int64()), pa.array(keys.reshape(-1), pa.int64()), pa.array(scores.reshape(-1))], schema=schema)

    return run


def fuse(lexical: DataFrame, near: DataFrame, k: int = 4, boost: float = 0.5) -> DataFrame:
    """Lexical score plus `boost` times (1 + cosine) / 2 of the nearest neighbours; a row may come from either side."""
    n = near.select("query", "key", (boost * (1 + F.col("cosine")) / 2).alias("near"))
    j = lexical.join(n, ["query", "key"], "full_outer")
    return top(j.select("query", "key", (F.coalesce("score", F.lit(0.0)) + F.coalesce("near", F.lit(0.0))).alias("score")), k)


def best_fields(scores: list[tuple[float, DataFrame]]) -> DataFrame:
    """The best boosted score over several fields."""
    out = None
    for boost, s in scores:
        part = s.select("query", "key", (boost * F.col("score")).alias("score"))
        out = part if out is None else out.unionAll(part)
    return out.groupBy("query", "key").agg(F.max("score").alias("score"))


def bool_query(docs: DataFrame, key: str, text: Column, must: list[str], should: list[str], minimum: int) -> DataFrame:
    """(key, hits) of documents that hold all `must` terms and at least `minimum` of the `should` terms.

    Search terms go through the same analysis as texts: a term whose marks part it into several words is held where all
    of these stand next to each other. A term without any word is held nowhere; more required than given matches nothing.
    """
    run = F.concat(F.lit(" "), F.array_join(tokens(text), " "), F.lit(" "))

    def held(term: str) -> Column:
        words = re.findall(r"\w+", term.lower())
        return run.contains(f" {' '.join(words)} ") if words else F.lit(False)

    hits = sum((held(t).cast("int") for t in should), F.lit(0))
    ok = hits >= minimum
    for t in must:
        ok = ok & held(t)
    return docs.where(ok).select(F.col(key).alias("key"), hits.alias("hits"))


# The parts of a context block, and what stands for left-out text.
SOURCE, SUMMARY, CONTENT, NO_SUMMARY, PARTED, OMITTED = "Source URL: ", "\nSummary: ", "\nContent Details:\n", "সারসংক্ষেপ পাওয়া যায়নি", "\n\n---\n\n", "\n\n...[text omitted]...\n\n"


def context_blocks(hits: DataFrame, longest: int = 3000) -> DataFrame:
    """(query, context, sources): blocks of url, summary and cut content in order of rank, and the distinct urls in that order.

    One row a query; its hits, k at most, bound the arrays. A hit without url stands under `#`, which is no source.
    """
    block = F.concat(F.lit(SOURCE), F.coalesce("url", F.lit("#")), F.lit(SUMMARY), F.coalesce("summary", F.lit(NO_SUMMARY)), F.lit(CONTENT), F.substring(F.coalesce("raw_markdown", F.lit("")), 1, longest))
    listed = hits.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", block.alias("b"), F.coalesce("url", F.lit("#")).alias("u")))).alias("bs"))
    urls = F.array_distinct(F.filter(F.transform("bs", lambda x: x["u"]), lambda u: u != "#"))
    return listed.select("query", F.array_join(F.transform("bs", lambda x: x["b"]), PARTED).alias("context"), urls.alias("sources"))


def tree_search(nodes: DataFrame, toc: DataFrame, queries: DataFrame, top_nodes: int = 5, top_chunks: int = 3, size: int = 2000, overlap: int = 300, combine_small: bool = True) -> DataFrame:
    """(query, context): BM25 over the table of contents, the chosen nodes' texts in tree order, BM25 again over their chunks.

    The second statistics are those of one query's own chunks. With `top_chunks` chunks or fewer the uncut text is
    returned, or with combine_small=False the chunks joined by the omission mark. `nodes` has ordinal; `queries` query, text.
    """
    from shapla.operators.tree import char_chunks

    nodes = materialize(nodes)
    terms = query_terms(queries, "query", F.col("text"))
    every = queries.select("query").crossJoin(F.broadcast(toc.select("node_id", "ordinal").orderBy(F.desc("ordinal")).limit(top_nodes).select(F.col("node_id").alias("key"))))
    toc = materialize(toc)
    scored = bm25(Index.build(toc, "node_id", F.concat_ws(" ", "title", "summary")), terms, top_nodes)
    filled = scored.unionAll(every.withColumn("score", F.lit(0.0))).groupBy("query", "key").agg(F.max("score").alias("score"))
    placed = filled.join(toc.select(F.col("node_id").alias("key"), "ordinal"), "key")
    chosen = materialize(top(placed, top_nodes, 6, F.desc("ordinal")).select("query", "key"))
    texts = chosen.join(nodes.select(F.col("node_id").alias("key"), F.col("ordinal").alias("at"), F.concat(F.lit("Source: "), F.coalesce("title", F.lit("Unknown")), F.lit("\n"), F.coalesce("text", F.lit(""))).alias("part")), "key")
    combined = texts.groupBy("query").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "part"))), lambda x: x["part"]), "\n\n").alias("whole"))
    combined = materialize(combined)
    chunks = materialize(combined.select("query", F.posexplode(char_chunks(F.col("whole"), size, overlap)).alias("no", "chunk")))
    words = materialize(chunks.select("query", "no", tokens(F.col("chunk")).alias("words")))
    toks = words.select("query", "no", F.size("words").alias("dl"), F.explode("words").alias("term"))
    tf = toks.groupBy("query", "no", "dl", "term").agg(F.count(F.lit(1)).alias("tf"))
    stats = words.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("avgdl"))
    df = tf.groupBy("query", "term").agg(F.count(F.lit(1)).alias("df")).join(stats, "query").withColumn("idf", F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    df = materialize(df)
    mean = df.groupBy("query").agg(F.avg("idf").alias("mean"))
    df = df.join(mean, "query").withColumn("idf", F.when(F.col("idf") < 0, 0.25 * F.col("mean")).otherwise(F.col("idf")))
    hit = tf.join(df.join(terms, ["query", "term"]), ["query", "term"])
    score = hit.groupBy("query", "no").agg(F.sum(F.col("qtf") * F.col("idf") * F.col("tf") * 2.5 / (F.col("tf") + 1.5 * (0.25 + 0.75 * F.col("dl") / F.col("avgdl")))).alias("score"))
    ranked = chunks.join(score, ["query", "no"], "left").withColumn("score", F.round(F.coalesce("score", F.lit(0.0)), 6))
    w = Window.partitionBy("query").orderBy(F.desc("score"), F.desc("no"))
    best = ranked.withColumn("r", F.row_number().over(w)).join(stats.select("query", "n"), "query")
    many = best.where((F.col("n") > top_chunks) & (F.col("r") <= top_chunks))
    order = F.when(F.col("n") > top_chunks, F.col("r")).otherwise(F.col("no"))
    picked = many if combine_small else many.unionAll(best.where(F.col("n") <= top_chunks))
    joined = picked.groupBy("query").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order.alias("o"), "chunk"))), lambda x: x["chunk"]), OMITTED).alias("context"))
    if not combine_small:
        return joined
    return joined.unionAll(combined.join(stats.where(F.col("n") <= top_chunks).select("query"), "query").select("query", F.col("whole").alias("context")))
