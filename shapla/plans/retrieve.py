"""Queries of trees, chunks, retrieval and transcripts, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapla.functions.text import llm_fields, tokens
from shapla.operators import models, search, transcript, tree
from shapla.plans import crawl
from shapla.session import materialize, table

Q, O = {}, {}


def q(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql is not None:
            O[f.__name__] = sql
        return f

    return add


TOK = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+')"


def tok(c: str) -> str:
    return TOK.format(c)


def bm25_sql(docs: str, queries: str, form: str = "okapi", name: str = "") -> str:
    """CTEs d, tf, st, df, sc<name>: scores of (query, key); docs gives (key, text), queries (query, text)."""
    n = name
    idf = "ln(n - df + 0.5) - ln(df + 0.5)" if form == "okapi" else "ln(1 + (n - df + 0.5) / (df + 0.5))"
    k1 = "1.5" if form == "okapi" else "1.2"
    fin = f"CASE WHEN idf < 0 THEN 0.25 * (SELECT avg(idf) FROM i{n}) ELSE idf END" if form == "okapi" else "idf"
    return rf"""d{n} AS (SELECT key, {tok("text")} AS w FROM ({docs})), l{n} AS (SELECT key, coalesce(len(w), 0) AS dl FROM d{n}),
    tf{n} AS (SELECT key, t, count(*) AS tf FROM (SELECT key, unnest(w) AS t FROM d{n}) GROUP BY 1, 2), st{n} AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM l{n}),
    i{n} AS (SELECT t, {idf} AS idf, avgdl FROM (SELECT t, count(*) AS df FROM tf{n} GROUP BY 1), st{n}), f{n} AS (SELECT t, {fin} AS idf, avgdl FROM i{n}),
    q{n} AS (SELECT query, t, count(*) AS qtf FROM (SELECT query, unnest({tok("text")}) AS t FROM ({queries})) GROUP BY 1, 2),
    sc{n} AS (SELECT query, key, sum(qtf * idf * tf * ({k1} + 1) / (tf + {k1} * (0.25 + 0.75 * dl / avgdl))) AS score FROM q{n} JOIN f{n} USING (t) JOIN tf{n} USING (t) JOIN l{n} USING (key) GROUP BY 1, 2)"""


def top_sql(source: str, k: int, digits: int = 6) -> str:
    return f"SELECT query, rank::INT AS rank, key, score FROM (SELECT query, key, round(score, {digits}) AS score, row_number() OVER (PARTITION BY query ORDER BY round(score, {digits}) DESC, key DESC) AS rank FROM {source}) WHERE rank <= {k}"


ITEMS = "SELECT item_id AS query, queries AS text FROM eval_queries"


def items(s, d) -> DataFrame:
    return table(s, d, "eval_queries").select(F.col("item_id").alias("query"), F.col("queries").alias("text"))


def item_terms(s, d) -> DataFrame:
    return search.query_terms(items(s, d), "query", F.col("text"))


def corpus(s, d) -> search.Index:
    return search.Index.build(table(s, d, "documents").select("doc_id", "text").distinct(), "doc_id", F.col("text"))


@q("WITH " + bm25_sql("SELECT doc_id AS key, text FROM documents", ITEMS) + " " + top_sql("sc", 5))
def bm25_topk(s, d):
    return search.top(search.bm25(corpus(s, d), item_terms(s, d), 5), 5)


@q("WITH " + bm25_sql("SELECT doc_id AS key, text FROM documents", ITEMS, "lucene") + " " + top_sql("sc", 4))
def bm25_lucene_topk(s, d):
    return search.top(search.bm25(corpus(s, d), item_terms(s, d), 4, "lucene"), 4)


@q(f"SELECT count(*) AS docs, round(avg(dl), 6) AS avgdl, sum(dl)::BIGINT AS words FROM (SELECT coalesce(len({tok('text')}), 0) AS dl FROM documents)")
def corpus_stats(s, d):
    return table(s, d, "documents").select(F.size(tokens(F.col("text"))).alias("dl")).agg(F.count(F.lit(1)).alias("docs"), F.round(F.avg("dl"), 6).alias("avgdl"), F.sum("dl").alias("words"))


@q(f"SELECT t AS term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM (SELECT doc_id, unnest({tok('text')}) AS t FROM documents) GROUP BY 1")
def term_counts(s, d):
    p = search.postings(table(s, d, "documents"), "doc_id", F.col("text"))
    return p.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


SITES = "SELECT url AS key, max({0}) AS text FROM websites WHERE url IS NOT NULL GROUP BY url"


@q("WITH " + ", ".join([bm25_sql(SITES.format("summary"), ITEMS, "lucene", "1"), bm25_sql(SITES.format("raw_markdown"), ITEMS, "lucene", "2")])
   + ", al AS (SELECT query, key, max(score) AS score FROM (SELECT query, key, 2 * score AS score FROM sc1 UNION ALL SELECT query, key, score FROM sc2 UNION ALL SELECT e.item_id, w.url, 1.5 FROM eval_queries e JOIN (SELECT DISTINCT url, keywords FROM websites) w ON contains(coalesce(w.keywords, ''), '\"' || e.queries || '\"')) GROUP BY 1, 2) "
   + top_sql("al", 4))
def multi_field_bm25(s, d):
    return search.top(fields(s, d), 4)


def fields(s, d) -> DataFrame:
    """Best field of summary (boost 2), a keyword equal to the whole query (1.5) and text."""
    w = table(s, d, "websites").where("url IS NOT NULL")
    terms = item_terms(s, d)
    scores = [(1.0, search.bm25(search.Index.build(w.groupBy("url").agg(F.max(c).alias("text")), "url", F.col("text")), terms, 4, "lucene", b)) for b, c in ((2.0, "summary"), (1.0, "raw_markdown"))]
    words = w.select(F.col("url").alias("key"), F.explode(F.coalesce(F.from_json("keywords", "array<string>"), F.array().cast("array<string>"))).alias("text"))
    exact = words.join(items(s, d), "text").select("query", "key", F.lit(1.0).alias("score")).distinct()
    return search.best_fields([*scores, (1.5, exact)])


COS = "list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]) * list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))"
KNN = f"nn AS (SELECT a.vec_id AS query, b.vec_id AS key, round({COS}, 9) AS score FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0)"


@q(f"WITH {KNN} SELECT query, rank, key, score AS cosine FROM ({top_sql('nn', 10)})")
def knn_exact(s, d):
    e = table(s, d, "embeddings")
    queries = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("vector"))
    return search.knn(e, "vec_id", "embedding", queries, 10)


@q(f"""WITH {KNN}, n4 AS ({top_sql('nn', 4)}), {bm25_sql("SELECT doc_id AS key, text FROM documents", "SELECT doc_id AS query, text FROM documents WHERE doc_id % 50 = 0", "lucene")},
       al AS (SELECT coalesce(sc.query, n4.query) AS query, coalesce(sc.key, n4.key) AS key, coalesce(sc.score, 0) + coalesce(0.5 * (1 + n4.score) / 2, 0) AS score FROM sc FULL JOIN n4 ON sc.query = n4.query AND sc.key = n4.key)
       {top_sql('al', 4)}""")
def hybrid_topk(s, d):
    e = table(s, d, "embeddings")
    near = search.knn(e, "vec_id", "embedding", e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("vector")), 4)
    docs = table(s, d, "documents").select("doc_id", "text").distinct()
    terms = search.query_terms(docs.where("doc_id % 50 = 0"), "doc_id", F.col("text"))
    near, index = materialize(near), search.Index.build(docs, "doc_id", F.col("text"))
    lexical = search.bm25(index, terms, 4, "lucene").unionAll(search.pair_scores(index, terms, near)).groupBy("query", "key").agg(F.max("score").alias("score"))
    return search.fuse(lexical, near, 4)


def held(term: str) -> str:
    """A search term's words next to each other among a text's words; marks part both in the same way."""
    return rf"contains(run, ' ' || array_to_string({tok(chr(39) + term + chr(39))}, ' ') || ' ')"


RUNS = rf"(SELECT chunk_id, ' ' || array_to_string({tok('chunk_text')}, ' ') || ' ' AS run FROM (SELECT DISTINCT chunk_id, chunk_text FROM bd_gov_chunks WHERE chunk_text IS NOT NULL))"


@q(f"SELECT chunk_id AS key, ({held('বিভাগ')}::INT + {held('আইন')}::INT + {held('office')}::INT) AS hits FROM {RUNS} WHERE {held('এবং')} AND ({held('বিভাগ')}::INT + {held('আইন')}::INT + {held('office')}::INT) >= 1")
def bool_query_msm(s, d):
    c = table(s, d, "bd_gov_chunks").where("chunk_text IS NOT NULL").select("chunk_id", "chunk_text").distinct()
    return search.bool_query(c, "chunk_id", F.col("chunk_text"), ["এবং"], ["বিভাগ", "আইন", "office"], 1)


@q(f"SELECT (SELECT count(*) FROM {RUNS} WHERE {held('এবং')}) AS total, (SELECT count(*) FROM {RUNS} WHERE {held('এবং')} AND {held('আইন')}::INT >= 3) AS impossible")
def total_hits(s, d):
    """The number of matches, and that more required clauses than there are match nothing."""
    c = table(s, d, "bd_gov_chunks").where("chunk_text IS NOT NULL").select("chunk_id", "chunk_text").distinct()
    total = search.bool_query(c, "chunk_id", F.col("chunk_text"), ["এবং"], [], 0).agg(F.count(F.lit(1)).alias("total"))
    return total.crossJoin(F.broadcast(search.bool_query(c, "chunk_id", F.col("chunk_text"), ["এবং"], ["আইন"], 3).agg(F.count(F.lit(1)).alias("impossible"))))


@q("""WITH w AS (SELECT url, max(summary) AS summary, max(raw_markdown) AS raw_markdown FROM websites GROUP BY url),
      r AS (SELECT source_url AS query, target_url AS url, row_number() OVER (PARTITION BY source_url ORDER BY target_url) AS rank FROM (SELECT DISTINCT source_url, target_url FROM website_links WHERE target_url IN (SELECT url FROM websites))),
      b AS (SELECT query, rank, url, 'Source URL: ' || url || chr(10) || 'Summary: ' || coalesce(summary, 'সারসংক্ষেপ পাওয়া যায়নি') || chr(10) || 'Content Details:' || chr(10) || coalesce(raw_markdown, '')[1:3000] AS b FROM r JOIN w USING (url) WHERE rank <= 4)
      SELECT query, string_agg(b, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context, coalesce(string_agg(url, ' ' ORDER BY rank) FILTER (WHERE url <> '#'), '') AS sources FROM b GROUP BY query""")
def context_blocks(s, d):
    w = table(s, d, "websites").groupBy("url").agg(F.max("summary").alias("summary"), F.max("raw_markdown").alias("raw_markdown"))
    known = table(s, d, "website_links").select(F.col("source_url").alias("query"), F.col("target_url").alias("key")).distinct().join(w.select(F.col("url").alias("key")), "key", "left_semi")
    hits = search.top(known.withColumn("score", F.lit(0.0)), 4, 6, F.asc("key"))
    return search.context_blocks(hits.join(w, hits["key"] == w["url"])).withColumn("sources", F.array_join("sources", " "))


@q("""SELECT node_id, string_agg(t, ' ' ORDER BY no, t) AS text FROM (SELECT DISTINCT node_id, regexp_extract(chunk_id, '_part_(\\d+)$', 1)::INT AS no, coalesce(chunk_text, '') AS t FROM bd_gov_chunks WHERE chunk_id IS NOT NULL) GROUP BY node_id""")
def concat_chunks(s, d):
    """Each node's chunks in order as one text; a node's own size bounds its row."""
    no = F.regexp_extract("chunk_id", r"_part_(\d+)$", 1).cast("int")
    c = table(s, d, "bd_gov_chunks").where("chunk_id IS NOT NULL").select("node_id", F.struct(no.alias("no"), F.coalesce("chunk_text", F.lit("")).alias("t")).alias("x")).distinct()
    return c.groupBy("node_id").agg(F.sort_array(F.collect_list("x")).alias("xs")).select("node_id", F.array_join(F.transform("xs", lambda x: x["t"]), " ").alias("text"))


NODES_SQL = """SELECT 'r' || r_regionkey AS node_id, NULL AS parent_id, r_regionkey::BIGINT AS ordinal, r_name AS title FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey::BIGINT, n_name FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_custkey, c_name FROM customer"""


def place_nodes(s, d) -> DataFrame:
    def part(name, key, parent, title):
        t = table(s, d, name)
        return t.select(F.concat(F.lit(name[0]), F.col(key).cast("string")).alias("node_id"), parent.cast("string").alias("parent_id"), F.col(key).cast("long").alias("ordinal"), F.col(title).alias("title"))

    return reduce(DataFrame.unionAll, [
        part("region", "r_regionkey", F.lit(None), "r_name"), part("nation", "n_nationkey", F.concat(F.lit("r"), F.col("n_regionkey").cast("string")), "n_name"),
        part("customer", "c_custkey", F.concat(F.lit("n"), F.col("c_nationkey").cast("string")), "c_name"),
    ])


@q(f"""WITH RECURSIVE nodes AS ({NODES_SQL}), t AS (SELECT node_id, title, 1 AS depth, [ordinal] AS p FROM nodes WHERE parent_id IS NULL
       UNION ALL SELECT n.node_id, n.title, t.depth + 1, list_append(t.p, n.ordinal) FROM nodes n JOIN t ON n.parent_id = t.node_id)
       SELECT node_id, title, depth::INT AS depth, array_to_string(p, '.') AS path FROM t""")
def tree_flatten(s, d):
    f = tree.flatten(place_nodes(s, d))
    return f.select("node_id", "title", "depth", F.array_join(F.transform("path", lambda x: x.cast("string")), ".").alias("path"))


EXPORT = """SELECT DISTINCT url, '## ' || url || chr(10) || chr(10) || '**সারসংক্ষেপ (Summary):** ' || coalesce(summary, 'None') || chr(10) || chr(10) || '**কিওয়ার্ড (Keywords):** '
   || coalesce(CASE WHEN json_valid(keywords) AND json_type(keywords) = 'ARRAY' THEN array_to_string(from_json(keywords, '["VARCHAR"]'), ', ') ELSE keywords END, 'None') || chr(10) || chr(10) || '**বিস্তারিত তথ্য (Detailed Content):**' || chr(10)
   || replace(raw_markdown, chr(10) || '# ', chr(10) || '### ') || chr(10) || chr(10) || '---' || chr(10) || chr(10) AS markdown FROM websites WHERE status = 'success' AND raw_markdown IS NOT NULL"""


def exported(s, d) -> DataFrame:
    return tree.export_markdown(table(s, d, "websites").where("status = 'success' AND raw_markdown IS NOT NULL")).distinct()


@q(EXPORT)
def markdown_export(s, d):
    return exported(s, d)


def site_nodes(s, d) -> DataFrame:
    """Sites as nodes of a tree; ordinal follows the url's hash, which needs no global sort."""
    e = exported(s, d).groupBy("url").agg(F.max("markdown").alias("text"))
    return e.select(F.col("url").alias("node_id"), F.col("url").alias("title"), "text", "url", F.conv(F.substring(F.md5("url"), 1, 15), 16, 10).cast("long").alias("ordinal"))


MARK = "split_part(split_part(markdown, '**সারসংক্ষেপ (Summary):**', 2), '**কিওয়ার্ড', 1)"


@q(f"SELECT url AS node_id, url AS title, s AS summary FROM (SELECT url, {crawl.trim(MARK)}[1:250] AS s FROM (SELECT url, max(markdown) AS markdown FROM ({EXPORT}) GROUP BY url)) WHERE s <> ''")
def toc_build(s, d):
    return tree.toc(site_nodes(s, d))


TOC_SQL = f"SELECT url AS node_id, url AS title, s AS summary FROM (SELECT url, {crawl.trim(MARK)}[1:250] AS s FROM (SELECT url, max(markdown) AS markdown FROM ({EXPORT}) GROUP BY url)) WHERE s <> ''"


def tree_sql(small: str) -> str:
    """Two-stage search; `small` gives the context of queries with at most three chunks."""
    idf = "ln(n - df + 0.5) - ln(df + 0.5)"
    gap = "chr(10) || chr(10) || '...[text omitted]...' || chr(10) || chr(10)"
    return rf"""WITH sites AS (SELECT url AS key, max(markdown) AS text, ('0x' || substr(md5(url), 1, 15))::BIGINT AS ord FROM ({EXPORT}) GROUP BY url),
    toc AS (SELECT node_id AS key, title || ' ' || summary AS text, ('0x' || substr(md5(node_id), 1, 15))::BIGINT AS ord FROM ({TOC_SQL})),
    {bm25_sql("SELECT key, text FROM toc", ITEMS)},
    filled AS (SELECT query, key, max(score) AS score FROM (SELECT * FROM sc UNION ALL SELECT item_id, key, 0.0 FROM eval_queries, (SELECT key FROM toc ORDER BY ord DESC LIMIT 5)) GROUP BY 1, 2),
    chosen AS (SELECT query, key, ord FROM (SELECT query, key, ord, row_number() OVER (PARTITION BY query ORDER BY round(score, 6) DESC, ord DESC) AS r FROM filled JOIN toc USING (key)) WHERE r <= 5),
    whole AS (SELECT query, string_agg('Source: ' || key || chr(10) || sites.text, chr(10) || chr(10) ORDER BY chosen.ord) AS whole FROM chosen JOIN sites USING (key) GROUP BY query),
    ch AS (SELECT query, no, whole[no * 1700 + 1 : no * 1700 + 2000] AS chunk FROM (SELECT query, whole, unnest(range(0, (length(whole) + 1699) // 1700)) AS no FROM whole)),
    wd AS (SELECT query, no, {tok("chunk")} AS w FROM ch), st2 AS (SELECT query, count(*) AS n, avg(len(w)) AS avgdl FROM wd GROUP BY 1),
    tf2 AS (SELECT query, no, dl, t, count(*) AS tf FROM (SELECT query, no, len(w) AS dl, unnest(w) AS t FROM wd) GROUP BY ALL),
    i2 AS (SELECT query, t, {idf} AS idf, avgdl FROM (SELECT query, t, count(*) AS df FROM tf2 GROUP BY 1, 2) JOIN st2 USING (query)),
    m2 AS (SELECT query, avg(idf) AS mean FROM i2 GROUP BY 1), f2 AS (SELECT query, t, CASE WHEN idf < 0 THEN 0.25 * mean ELSE idf END AS idf, avgdl FROM i2 JOIN m2 USING (query)),
    s2 AS (SELECT query, no, sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM q JOIN f2 USING (query, t) JOIN tf2 USING (query, t) GROUP BY 1, 2),
    rk AS (SELECT query, no, chunk, n, row_number() OVER (PARTITION BY query ORDER BY round(coalesce(score, 0), 6) DESC, no DESC) AS r FROM ch LEFT JOIN s2 USING (query, no) JOIN st2 USING (query))
    SELECT query, string_agg(chunk, {gap} ORDER BY r) AS context FROM rk WHERE n > 3 AND r <= 3 GROUP BY query UNION ALL {small.format(gap=gap)}"""


@q(tree_sql("SELECT query, whole FROM whole JOIN st2 USING (query) WHERE n <= 3"))
def tree_search(s, d):
    n = site_nodes(s, d)
    t = tree.toc(n).join(n.select("node_id", "ordinal"), "node_id")
    return search.tree_search(n, t, items(s, d))


@q(tree_sql("SELECT query, string_agg(chunk, {gap} ORDER BY no) FROM rk WHERE n <= 3 GROUP BY query"))
def tree_search_chunks(s, d):
    n = site_nodes(s, d)
    t = tree.toc(n).join(n.select("node_id", "ordinal"), "node_id")
    return search.tree_search(n, t, items(s, d), combine_small=False)


@q("""SELECT DISTINCT url, i::INT AS chunk_no, raw_markdown[i * 1700 + 1 : i * 1700 + 2000] AS chunk FROM websites, generate_series(0, 1000) g(i) WHERE i * 1700 < length(raw_markdown)""")
def char_chunks(s, d):
    return table(s, d, "websites").where("raw_markdown <> ''").select("url", F.posexplode(tree.char_chunks(F.col("raw_markdown"))).alias("chunk_no", "chunk")).distinct()


BLANKS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def windows_sql(source: str, size: int = 1500, overlap: int = 200, least: int = 50) -> str:
    """CTE wc (key, chunk_no, chunk) of the word windows of source (key, text); ends[i] is the length up to word i with spaces."""
    before = lambda s: f"CASE WHEN {s} = 0 THEN 0 ELSE ends[{s}] END"
    return f"""ws AS (SELECT DISTINCT key, text, list_filter(regexp_split_to_array(text, '{BLANKS}'), lambda x: x <> '') AS w FROM ({source}) WHERE text IS NOT NULL),
    wl AS (SELECT key, text, w, list(e ORDER BY i) AS ends FROM (SELECT key, text, w, i, sum(length(w[i]) + 1) OVER (PARTITION BY key, text ORDER BY i) AS e FROM (SELECT key, text, w, unnest(range(1, len(w) + 1)) AS i FROM ws)) GROUP BY key, text, w),
    st AS (SELECT key, text, w, ends, 0::BIGINT AS s, 0::BIGINT AS e, -1 AS no, NULL::BIGINT AS a, false AS over FROM wl
      UNION ALL SELECT key, text, w, ends, CASE WHEN e2 IS NULL THEN s ELSE coalesce(list_filter(range(e2 - 1, s - 1, -1), lambda x: ends[e2] - (CASE WHEN x = 0 THEN 0 ELSE ends[x] END) >= {overlap})[1], s) END, coalesce(e2, len(w)), no + 1, s, e2 IS NULL
      FROM (SELECT *, list_filter(range(e + 1, len(w) + 1), lambda i: ends[i] - ({before("s")}) >= {size})[1] AS e2 FROM st WHERE NOT over)),
    wc AS (SELECT key, no::INT AS chunk_no, array_to_string(w[a + 1 : e], ' ') AS chunk, text FROM st WHERE no >= 0 AND (NOT over OR (a < len(w) AND ends[len(w)] - ({before("a")}) - 1 > {least})))"""


@q("WITH RECURSIVE " + windows_sql("SELECT doc_id::VARCHAR AS key, text FROM documents") + " SELECT key, chunk_no, chunk FROM wc")
def word_chunks(s, d):
    return tree.word_chunks(table(s, d, "documents").select("doc_id", "text").distinct(), "doc_id", "text")


@q("WITH RECURSIVE " + windows_sql(f"SELECT url AS key, max(markdown) AS text FROM ({EXPORT}) GROUP BY url") + f""" SELECT key || '_part_' || chunk_no AS chunk_id, key AS node_id, key AS url, key AS site_title, {crawl.trim(MARK.replace("markdown", "text"))} AS site_summary, chunk AS chunk_text,
   'title: none | text: ' || key || ' - ' || chunk AS passage_for_embedding FROM wc""")
def chunk_records(s, d):
    return tree.chunk_records(site_nodes(s, d))


@q("""SELECT node_id, count(DISTINCT chunk_id) AS chunks, min(chunk_id) AS first_chunk FROM bd_gov_chunks WHERE node_id IN (SELECT node_id FROM bd_gov_chunks WHERE chunk_id LIKE '%_part_2') GROUP BY node_id""")
def semijoin_nodes(s, d):
    c = table(s, d, "bd_gov_chunks")
    chosen = c.where("chunk_id LIKE '%_part_2'").select("node_id").distinct()
    return c.join(chosen, "node_id", "left_semi").groupBy("node_id").agg(F.countDistinct("chunk_id").alias("chunks"), F.min("chunk_id").alias("first_chunk"))


# Turns of a made-up transcript for each item: the question, an action, the same action again, another tool, a refusal, an answer.
TURNS_SQL = """SELECT item_id AS conv_id, t.turn::INT AS turn, CASE WHEN t.turn = 1 THEN 'user' ELSE 'assistant' END AS role,
   CASE t.turn WHEN 1 THEN queries WHEN 2 THEN 'Thought: look' || chr(10) || 'Action: search_tree("' || queries[1:30] || '")' WHEN 3 THEN 'Action: Search_Tree("' || queries[1:30] || '")'
     WHEN 4 THEN 'Action: other_tool(''x'')' WHEN 5 THEN 'plain words' WHEN 6 THEN 'Action: no_tool_needed()' WHEN 7 THEN 'দুঃখিত, সরকারি নীতিমালার আওতায় নয়' WHEN 8 THEN 'Action: search_tree("' || queries[1:30] || '")'
     ELSE 'Final Answer: ' || coalesce(expected_answer, 'none') END AS text
   FROM eval_queries, (VALUES (1), (2), (3), (4), (5), (6), (7), (8), (9)) t(turn)"""


def turns(s, d) -> DataFrame:
    start = F.substring("queries", 1, 30)
    texts = F.array(
        F.col("queries"), F.concat(F.lit('Thought: look\nAction: search_tree("'), start, F.lit('")')), F.concat(F.lit('Action: Search_Tree("'), start, F.lit('")')), F.lit("Action: other_tool('x')"), F.lit("plain words"),
        F.lit("Action: no_tool_needed()"), F.lit("দুঃখিত, সরকারি নীতিমালার আওতায় নয়"), F.concat(F.lit('Action: search_tree("'), start, F.lit('")')), F.concat(F.lit("Final Answer: "), F.coalesce("expected_answer", F.lit("none"))),
    )
    e = table(s, d, "eval_queries").select(F.col("item_id").alias("conv_id"), F.posexplode(texts).alias("i", "text"))
    return e.select("conv_id", (F.col("i") + 1).alias("turn"), F.when(F.col("i") == 0, "user").otherwise("assistant").alias("role"), "text")


SAID = "CASE WHEN contains(text, '**উত্তর:**') THEN string_split(text, '**উত্তর:**')[-1] WHEN contains(text, 'Final Answer:') THEN string_split(text, 'Final Answer:')[-1] ELSE text END"


@q(f"SELECT * FROM (SELECT conv_id, turn, role, CASE WHEN role = 'assistant' THEN {crawl.trim(SAID)} ELSE text END AS text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM ({TURNS_SQL})) WHERE r <= 6) WHERE text <> ''")
def history_last6(s, d):
    return transcript.history(turns(s, d)).select("conv_id", "turn", "role", "text")


ACT = r"""regexp_extract(text, 'Action:\s*(\w+)\([''"]?([^\n]*?)[''"]?\)', {0})"""


@q(f"SELECT conv_id, turn, {ACT.format(1)} AS tool, {ACT.format(2)} AS query, lower({ACT.format(0)}) AS action FROM ({TURNS_SQL})")
def action_parse(s, d):
    return transcript.actions(turns(s, d)).select("conv_id", "turn", "tool", "query", "action")


FINAL = r"(?i)\**Final Answer:\**|\**উত্তর:\**"


@q(f"SELECT conv_id, turn, {crawl.trim(f'string_split_regex(text, {chr(39)}{FINAL}{chr(39)})[-1]')} AS answer FROM ({TURNS_SQL}) WHERE regexp_matches(text, '{FINAL}')")
def final_answers(s, d):
    return turns(s, d).select("conv_id", "turn", transcript.final_answer(F.col("text")).alias("answer")).where("answer IS NOT NULL")


def outcome_sql(tools: list[str]) -> str:
    listed = ", ".join(f"'{t}'" for t in tools)
    return f"""CASE WHEN contains(text, 'দুঃখিত, সরকারি নীতিমালার আওতায়') THEN 'guardrail' WHEN regexp_matches(text, '{FINAL}') THEN 'final' WHEN action = '' THEN 'format_error' WHEN r > 1 THEN 'repeated'
        WHEN tool IN ({listed}) THEN 'search' WHEN tool = 'no_tool_needed' THEN 'no_tool' ELSE 'unknown_tool' END"""


@q(f"""SELECT conv_id, turn, {outcome_sql(transcript.TREE_TOOLS)} AS outcome, {outcome_sql(transcript.SEARCH_TOOLS)} AS outcome_search
       FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, action ORDER BY turn) AS r FROM (SELECT conv_id, turn, text, {ACT.format(1)} AS tool, lower({ACT.format(0)}) AS action FROM ({TURNS_SQL})))""")
def turn_outcome(s, d):
    t = turns(s, d)
    one = transcript.outcome(t).withColumnRenamed("outcome", "tree").drop("tool", "query", "action", "repeated")
    return transcript.outcome(one, transcript.SEARCH_TOOLS).select("conv_id", "turn", F.col("tree").alias("outcome"), F.col("outcome").alias("outcome_search"))


@q("""SELECT item_id, CASE WHEN item_id % 3 = 0 THEN 'Tie (Both Failed)' WHEN x > y THEN 'A' WHEN y > x THEN 'B' ELSE 'Tie' END AS winner FROM
      (SELECT item_id, len(list_intersect(qa, aa)) AS x, len(list_intersect(qa, bb)) AS y FROM (SELECT item_id, list_distinct(""" + tok("queries") + """) AS qa,
       list_distinct(""" + tok("coalesce(expected_answer, '') || CASE WHEN item_id % 3 = 0 THEN ' Agent Loop Error' ELSE '' END") + """) AS aa,
       list_distinct(""" + tok("queries[1:40] || CASE WHEN item_id % 3 = 0 THEN ' Agent Loop Error' ELSE '' END") + """) AS bb FROM eval_queries))""")
def judge_pairs(s, d):
    failed = F.when(F.col("item_id") % 3 == 0, " Agent Loop Error").otherwise("")
    e = table(s, d, "eval_queries").select("item_id", F.col("queries").alias("query"), F.concat(F.coalesce("expected_answer", F.lit("")), failed).alias("answer_a"), F.concat(F.substring("queries", 1, 40), failed).alias("answer_b"))
    return transcript.judge(e).select("item_id", "winner")


@q("SELECT item_id, round(CASE WHEN len(r) > 0 THEN len(list_intersect(r, a)) / len(r) ELSE 0 END, 6) AS recall FROM (SELECT item_id, list_distinct(" + tok("coalesce(expected_answer, '')") + ") AS r, list_distinct(" + tok("queries") + ") AS a FROM eval_queries)")
def answer_recall(s, d):
    return table(s, d, "eval_queries").select("item_id", F.round(transcript.overlap(F.col("queries"), F.coalesce("expected_answer", F.lit(""))), 6).alias("recall"))


def words_of(c: str) -> str:
    return "list_distinct(" + tok(f"coalesce({c}, '')") + ")"


def share(a: str, b: str) -> str:
    return f"CASE WHEN len({b}) > 0 THEN len(list_intersect({b}, {a})) / len({b}) ELSE 0 END"


@q(f"WITH w AS (SELECT item_id, expected_answer IS NULL AS none, {words_of('queries')} AS q, {words_of('expected_answer')} AS e, {words_of('queries[1:40]')} AS a FROM eval_queries)"
   f" SELECT item_id, round({share('a', 'q')}, 6) AS relevancy, CASE WHEN NOT none THEN round({share('a', 'e')}, 6) END AS recall, CASE WHEN NOT none THEN {share('a', 'e')} >= 0.7 END AS passed, CASE WHEN none THEN 'JSON_Error' END AS error FROM w")  # fmt: skip
def graded_answers(s, d):
    """One system that answers with the start of the question, graded by the lexical metrics."""
    echo = lambda asked: asked.select("query", F.substring("text", 1, 40).alias("answer"))
    g = transcript.grade(transcript.run_systems(table(s, d, "eval_queries"), {"a": echo}), ["a"])
    return g.select("item_id", F.round("sys_a_relevancy_score", 6).alias("relevancy"), F.round("sys_a_recall_score", 6).alias("recall"), F.col("sys_a_recall_passed").alias("passed"), F.col("sys_a_recall_error").alias("error"))


@q("SELECT item_id AS conv_id, 'final' AS outcome, 'seen ' || length(queries) AS answer, 4::INT AS turns FROM eval_queries")
def agent_loop(s, d):
    """All items answered at once: each asks one search, gets the question's length and closes."""
    questions = table(s, d, "eval_queries").select(F.col("item_id").alias("conv_id"), F.col("queries").alias("text"))
    last = F.element_at("turns", -1)["text"]
    reply = lambda open_: open_.select("conv_id", F.when(F.size("turns") == 1, F.concat(F.lit('Action: hybrid_search("'), F.length(last), F.lit('")'))).otherwise(F.concat(F.lit("Final Answer: "), F.regexp_extract(last, r"Observation: (seen \d+)", 1))).alias("text"))
    found = lambda asked: asked.select("query", F.concat(F.lit("seen "), "text").alias("context"))
    return transcript.run_agent(questions, reply, found).select("conv_id", "outcome", "answer", F.size("turns").alias("turns"))


@q()
def embedded_chunks(s, d):
    """Chunk passages with their vectors, in batches."""
    c = table(s, d, "bd_gov_chunks").select("chunk_id", "passage_for_embedding").distinct()
    return models.embed(c, "passage_for_embedding").select("chunk_id", F.round(F.aggregate("chunk_vector", F.lit(0.0), lambda a, x: a + x * x), 6).alias("norm"))


@q()
def summaries_made(s, d):
    """Summaries and keywords of all texts by the offline stand-in."""
    w = table(s, d, "websites").where("status = 'success'").select("url", "raw_markdown").distinct()
    summary, keywords = llm_fields(F.col("answer"))
    return models.summarise(w, "raw_markdown").select("url", summary.alias("summary"), keywords.alias("keywords"))


@q()
def export_tree(s, d):
    """The nodes of the exported sites, headings as the tree."""
    return tree.markdown_tree(exported(s, d), "url", "markdown")
