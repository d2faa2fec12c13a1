"""Queries of sources, tables, urls, links and cleaning, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shapla import schemas
from shapla.functions import text as X
from shapla.functions import urls as U
from shapla.operators import links, tables
from shapla.session import shared_dir, table
from shapla.streaming.ingest import KeyedTable, index_by_key, ingest

NAMES = ["websites", "website_links", "gov_bd_pages", "banglapedia_pages", "bd_gov_chunks", "documents", "declared_langs", "eval_queries", "lang_samples", "orders", "lineitem", "customer"]
Q, O = {}, {}


def q(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql is not None:
            O[f.__name__] = sql
        return f

    return add


TRIM = r"regexp_replace({0}, '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g')"


def trim(c: str) -> str:
    return TRIM.format(c)


def dom(c: str) -> str:
    host = rf"regexp_replace(split_part(lower(regexp_extract({c}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)), ':', 1), '^www\.', '')"
    return f"CASE WHEN {host} LIKE '%.gov.bd' THEN {host} END"


@q(f"SELECT DISTINCT {trim('url')} AS url FROM websites WHERE {trim('url')} <> ''")
def url_set(s, d):
    return table(s, d, "websites").select(X.trim_ws(F.col("url")).alias("url")).where("url <> ''").distinct()


@q(f"SELECT {trim('target_url')} AS url FROM website_links WHERE {trim('target_url')} <> ''")
def url_list(s, d):
    return table(s, d, "website_links").select(X.trim_ws(F.col("target_url")).alias("url")).where("url <> ''")


@q("SELECT url FROM gov_bd_pages WHERE status = 'pending'")
def pending_scan(s, d):
    return table(s, d, "gov_bd_pages").where("status = 'pending'").select("url")


@q("SELECT DISTINCT url FROM websites WHERE status IN ('success', 'failed_no_content')")
def done_scan(s, d):
    return table(s, d, "websites").where(F.col("status").isin("success", "failed_no_content")).select("url").distinct()


@q("SELECT url, length(raw_markdown) AS n FROM websites WHERE status = 'success' AND raw_markdown IS NOT NULL")
def success_scan(s, d):
    return table(s, d, "websites").where("status = 'success' AND raw_markdown IS NOT NULL").select("url", F.length("raw_markdown").cast("long").alias("n"))


@q("SELECT DISTINCT url FROM (SELECT DISTINCT url FROM websites WHERE url > 'http://k') ORDER BY url LIMIT 500")
def keyset_page(s, d):
    return tables.keyset_page(table(s, d, "websites").select("url").distinct(), "url", "http://k", 500)


@q(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS total_rows FROM {n}" for n in sorted(NAMES)))
def table_profile(s, d):
    return tables.row_counts({n: table(s, d, n) for n in NAMES})


TYPES = "CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END"
LISTED = ", ".join(f"'{n}'" for n in NAMES)


@q(f"SELECT DISTINCT table_name, column_name, {TYPES} AS data_type FROM information_schema.columns WHERE table_name IN ({LISTED})")
def column_profile(s, d):
    return tables.column_list({n: table(s, d, n) for n in NAMES})


@q("SELECT coalesce(status, 'none') AS status, count(*) AS n FROM websites GROUP BY 1")
def status_counts(s, d):
    return table(s, d, "websites").groupBy(F.coalesce("status", F.lit("none")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


LAST = "max(struct_pack(t := processed_at, k := coalesce(keywords, ''), r := coalesce(raw_markdown, ''), s := coalesce(status, ''), m := coalesce(summary, '')))"


@q(f"SELECT url, x.t AS processed_at, x.s AS status, length(x.r) AS n FROM (SELECT url, {LAST} AS x FROM websites GROUP BY url)")
def latest_state(s, d):
    w = table(s, d, "websites").select("url", "processed_at", *[F.coalesce(c, F.lit("")).alias(c) for c in ("keywords", "raw_markdown", "status", "summary")])
    return tables.latest(w, "url", "processed_at").select("url", "processed_at", "status", F.length("raw_markdown").cast("long").alias("n"))


@q("""SELECT url, CASE WHEN b.url2 IS NOT NULL THEN 'pending' ELSE s END AS status FROM
      (SELECT url, max(coalesce(status, '')) AS s FROM websites GROUP BY url) FULL JOIN
      (SELECT DISTINCT target_url AS url2 FROM website_links WHERE target_url IS NOT NULL) b ON url = url2 WHERE url IS NOT NULL
      UNION ALL SELECT target_url, 'pending' FROM (SELECT DISTINCT target_url FROM website_links WHERE target_url IS NOT NULL AND target_url NOT IN (SELECT url FROM websites WHERE url IS NOT NULL))""")
def upsert_latest(s, d):
    old = table(s, d, "websites").select("url", F.coalesce("status", F.lit("")).alias("status"))
    new = table(s, d, "website_links").where("target_url IS NOT NULL").select(F.col("target_url").alias("url"), F.lit("pending").alias("status")).distinct()
    return tables.upsert(old, new, "url")


@q("""SELECT url, status FROM (SELECT DISTINCT url, coalesce(status, '') AS status FROM gov_bd_pages)
      UNION ALL SELECT url, 'pending' FROM (SELECT DISTINCT url FROM websites) WHERE url NOT IN (SELECT url FROM gov_bd_pages)""")
def insert_ignore(s, d):
    old = table(s, d, "gov_bd_pages").select("url", F.coalesce("status", F.lit("")).alias("status")).distinct()
    new = table(s, d, "websites").select("url", F.lit("pending").alias("status"))
    return tables.insert_ignore(old, new, ["url"])


@q("""WITH b AS (SELECT DISTINCT url FROM gov_bd_pages WHERE status = 'pending'), u AS (SELECT url, max(title) AS title FROM gov_bd_pages WHERE status = 'success' GROUP BY url)
      SELECT b.url, u.title, CASE WHEN u.url IS NULL THEN 'pending' ELSE 'success' END AS status FROM b LEFT JOIN u ON b.url = u.url""")
def keyed_update(s, d):
    g = table(s, d, "gov_bd_pages")
    base = g.where("status = 'pending'").select("url", F.lit(None).cast("string").alias("title"), F.lit("pending").alias("status")).distinct()
    updates = g.where("status = 'success'").groupBy("url").agg(F.max("title").alias("title")).withColumn("status", F.lit("success"))
    return tables.keyed_update(base, updates, "url")


@q("SELECT DISTINCT target_url AS url FROM website_links WHERE target_url IS NOT NULL EXCEPT SELECT url FROM websites WHERE status IN ('success', 'failed_no_content')")
def remaining_urls(s, d):
    urls = table(s, d, "website_links").where("target_url IS NOT NULL").select(F.col("target_url").alias("url"))
    return tables.remaining(urls, table(s, d, "websites").where(F.col("status").isin("success", "failed_no_content")))


@q("SELECT l.id, l.target_url FROM website_links l WHERE NOT EXISTS (SELECT 1 FROM websites w WHERE w.url = l.target_url)")
def verified_antijoin(s, d):
    return tables.unverified(table(s, d, "website_links"), table(s, d, "websites").withColumnRenamed("url", "target_url"), "target_url").select("id", "target_url")


@q("""SELECT count(*) AS initial, count(*) FILTER (WHERE v IS NULL) AS final, count(v) AS removed
      FROM website_links l LEFT JOIN (SELECT DISTINCT url AS v FROM websites) ON v = l.target_url""")
def dedupe_counts(s, d):
    c = tables.dedupe_counts(table(s, d, "website_links"), table(s, d, "websites").withColumnRenamed("url", "target_url"), "target_url")
    return c.select(*[F.col(x).cast("long") for x in c.columns])


@q("SELECT DISTINCT l.source_url FROM website_links l WHERE EXISTS (SELECT 1 FROM websites w WHERE w.url = l.source_url)")
def valid_sources(s, d):
    return table(s, d, "website_links").select("source_url").distinct().join(table(s, d, "websites").select(F.col("url").alias("source_url")).distinct(), "source_url", "left_semi")


@q("SELECT DISTINCT url FROM gov_bd_pages UNION SELECT DISTINCT url FROM banglapedia_pages")
def union_distinct(s, d):
    return table(s, d, "gov_bd_pages").select("url").union(table(s, d, "banglapedia_pages").select("url")).distinct()


@q("SELECT url FROM gov_bd_pages UNION ALL SELECT url FROM websites")
def concat_all(s, d):
    return table(s, d, "gov_bd_pages").select("url").unionAll(table(s, d, "websites").select("url"))


@q("SELECT DISTINCT url FROM websites EXCEPT SELECT url FROM gov_bd_pages")
def difference(s, d):
    return table(s, d, "websites").select("url").subtract(table(s, d, "gov_bd_pages").select("url"))


@q("SELECT max(url) AS last_url, count(*) AS n FROM (SELECT DISTINCT url FROM websites ORDER BY url LIMIT 500)")
def checkpoint_key(s, d):
    return tables.keyset_page(table(s, d, "websites").select("url").distinct(), "url", None, 500).agg(F.max("url").alias("last_url"), F.count(F.lit(1)).alias("n"))


@q(f"SELECT DISTINCT url, {dom('url')} AS domain FROM websites")
def domain_extract(s, d):
    return table(s, d, "websites").select("url", U.domain_of(F.col("url")).alias("domain")).distinct()


@q(f"SELECT DISTINCT {dom('target_url')} AS domain FROM website_links WHERE {dom('target_url')} IS NOT NULL")
def domain_discovery(s, d):
    return links.domains(table(s, d, "website_links"), "target_url")


HREFS = [" /a/b ", "c?x=1#f", "//h.example/y", "?q=2", "#t", "mailto:a@b.example", "", "https://z.example/p#q", "../d", "./e/../g"]


@q(r"""WITH u AS (SELECT DISTINCT url, split_part(url, '#', 1) AS b FROM websites), h AS (SELECT unnest(['/a/b', 'c?x=1', '//h.example/y', '?q=2', '', 'mailto:a@b.example', '', 'https://z.example/p', 'd', 'g']) AS h, unnest([1,2,3,4,5,6,7,8,9,10]) AS n),
      p AS (SELECT url, b, n, h, regexp_extract(b, '^[A-Za-z]+://[^/?]*') AS root, split_part(b, '?', 1) AS bare FROM u, h),
      f AS (SELECT *, root || '/' || array_to_string(list_filter(string_split(substring(bare, length(root) + 1), '/')[:-2], lambda x: x <> '') , '/') AS fold FROM p),
      g AS (SELECT *, CASE WHEN fold = root || '/' THEN fold ELSE fold || '/' END AS folder FROM f)
      SELECT DISTINCT url, n::INT AS n, CASE WHEN h = '' THEN b WHEN n IN (6, 8) THEN h WHEN n = 3 THEN split_part(b, ':', 1) || ':' || h WHEN n = 1 THEN root || h WHEN n = 4 THEN bare || h
        WHEN n = 9 AND folder <> root || '/' THEN regexp_replace(folder, '[^/]*/$', '') || h ELSE folder || h END AS link FROM g""")
def href_resolve(s, d):
    hrefs = F.posexplode(F.array(*[F.lit(h) for h in HREFS])).alias("i", "href")
    return table(s, d, "websites").select("url").distinct().select("url", hrefs).select("url", (F.col("i") + 1).alias("n"), U.resolve_href(F.col("url"), F.col("href")).alias("link"))


@q("SELECT DISTINCT source_url, target_url AS href FROM website_links WHERE target_url IS NOT NULL")
def page_links_distinct(s, d):
    """Pages made of the links, escaped, in either kind of quotes and letter case."""
    escaped = F.replace(F.replace(F.replace("target_url", F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;")), F.lit("'"), F.lit("&#39;"))
    double = F.concat(F.lit('<p data-href="no">x</p><a class="l" href="'), escaped, F.lit('">t</a>'))
    single = F.concat(F.lit("<P>x</P><A title='>' HREF = '"), escaped, F.lit("'>t</A>"))
    pages = table(s, d, "website_links").select("source_url", F.when(F.col("id") % 2 == 0, double).otherwise(single).alias("html"))
    return pages.select("source_url", F.explode(U.html_hrefs(F.col("html"))).alias("href")).distinct()


MD = r"""SELECT DISTINCT url AS source_url, t AS target_url FROM (SELECT url, unnest(regexp_extract_all(raw_markdown, '\[[^\n]*?\]\((https?://[^\s\)]+)\)', 1)) AS t FROM websites)
         WHERE t <> url AND NOT starts_with(t, url || '/#')"""


@q(MD)
def markdown_links(s, d):
    return links.markdown_links(table(s, d, "websites"), "url", "raw_markdown")


@q(MD + " AND length(t) <= 2000")
def markdown_links_short(s, d):
    return links.markdown_links(table(s, d, "websites"), "url", "raw_markdown", 2000)


@q(f"SELECT DISTINCT source_url, target_url FROM website_links WHERE target_url IS NOT NULL UNION SELECT * FROM ({MD} AND length(t) <= 2000)")
def link_graph(s, d):
    ok = table(s, d, "websites").where("status = 'success' AND raw_markdown IS NOT NULL")
    known = table(s, d, "website_links").where("target_url IS NOT NULL").select("source_url", "target_url").distinct()
    return tables.insert_ignore(known, links.markdown_links(ok, "url", "raw_markdown", 2000), ["source_url", "target_url"])


@q("""WITH RECURSIVE e AS (SELECT DISTINCT source_url AS a, target_url AS b FROM website_links WHERE target_url IS NOT NULL AND source_url IS NOT NULL),
      r(url, level) USING KEY (url) AS (SELECT DISTINCT url, 0 FROM websites WHERE url LIKE '%/page/%'
        UNION SELECT b, min(level) + 1 FROM r JOIN e ON a = url WHERE b NOT IN (SELECT url FROM recurring.r) GROUP BY b)
      SELECT url, level::INT AS level FROM r""")
def bfs_levels(s, d):
    return links.bfs(table(s, d, "website_links"), table(s, d, "websites").where("url LIKE '%/page/%'").select("url"))


@q("SELECT DISTINCT url, replace(url_decode(replace(list_extract(string_split(url, 'title='), -1), '+', '%2B')), '_', ' ') AS title FROM banglapedia_pages")
def title_decode(s, d):
    return table(s, d, "banglapedia_pages").select("url", U.title_of(F.col("url")).alias("title")).distinct()


@q("SELECT DISTINCT title, 'https://kosh.example/index?title=' || replace(title, ' ', '_') AS url FROM banglapedia_pages WHERE title IS NOT NULL")
def url_of_title(s, d):
    return table(s, d, "banglapedia_pages").where("title IS NOT NULL").select("title", U.url_of_title(F.col("title")).alias("url")).distinct()


@q(f"SELECT domain, p::INT AS priority, CASE p WHEN 0 THEN 'https://' ELSE 'http://' END || domain AS url FROM (SELECT DISTINCT {dom('target_url')} AS domain FROM website_links), (VALUES (0), (1)) v(p) WHERE domain IS NOT NULL")
def scheme_candidates(s, d):
    return links.domains(table(s, d, "website_links"), "target_url").select("domain", F.posexplode(U.candidates(F.col("domain"))).alias("priority", "url"))


@q(f"""SELECT domain, CASE WHEN bool_or(url LIKE 'https:%') THEN 'https' ELSE 'http' END AS scheme FROM
       (SELECT {dom('url')} AS domain, url FROM websites WHERE status = 'success') WHERE domain IS NOT NULL GROUP BY 1""")
def first_alive(s, d):
    alive = table(s, d, "websites").where("status = 'success'").select(U.domain_of(F.col("url")).alias("domain"), F.when(F.col("url").startswith("https:"), 0).otherwise(1).alias("p")).where("domain IS NOT NULL")
    return alive.groupBy("domain").agg(F.min_by(F.when(F.col("p") == 0, "https").otherwise("http"), "p").alias("scheme"))


@q(f"SELECT url, CASE WHEN raw_markdown IS NULL OR length({trim('raw_markdown')}) < 50 THEN 'failed_no_content' ELSE 'success' END AS gate, count(*) AS n FROM websites GROUP BY 1, 2")
def content_gate(s, d):
    return table(s, d, "websites").select("url", X.content_status(F.col("raw_markdown")).alias("gate")).groupBy("url", "gate").agg(F.count(F.lit(1)).alias("n"))


JUNK_SQL = "[" + ", ".join(f"'{w}'" for w in X.JUNK) + "]"
FOOT_SQL = "[" + ", ".join(f"'{w}'" for w in X.FOOTERS) + "]"
RAW = f"(markdown_body || chr(10) || '{X.JUNK[0]}' || chr(10) || chr(10) || chr(10) || chr(10) || 'x' || chr(10) || '{X.FOOTERS[0]}' || chr(10) || 'gone')"


@q(f"""WITH p AS (SELECT DISTINCT url, string_split({RAW}, chr(10)) AS l FROM gov_bd_pages WHERE markdown_body IS NOT NULL),
       c AS (SELECT url, l, list_position(list_transform(l, lambda x: len(list_filter({FOOT_SQL}, lambda w: contains(x, w))) > 0), true) AS stop FROM p)
       SELECT url, {trim("regexp_replace(array_to_string(list_filter(CASE WHEN stop > 0 THEN l[1:stop-1] ELSE l END, lambda x: len(list_filter(" + JUNK_SQL + ", lambda w: contains(x, w))) = 0), chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g')".replace('{{', '{').replace('}}', '}'))} AS body FROM c""")
def clean_lines(s, d):
    tail = f"\n{X.JUNK[0]}\n\n\n\nx\n{X.FOOTERS[0]}\ngone"
    p = table(s, d, "gov_bd_pages").where("markdown_body IS NOT NULL").select("url", F.concat("markdown_body", F.lit(tail)).alias("raw")).distinct()
    return p.select("url", X.clean_lines(F.col("raw")).alias("body"))


@q(rf"""WITH p AS (SELECT DISTINCT url, markdown_body AS b, title FROM banglapedia_pages WHERE markdown_body IS NOT NULL),
       h AS (SELECT url, b, title, CASE WHEN coalesce(strpos(b, '#  ' || title), 0) > 0 THEN strpos(b, '#  ' || title) WHEN regexp_matches(b, '(?m)^#\s') THEN strpos(b, regexp_extract(b, '(?m)^#\s+[^\n]*')) ELSE 1 END AS pos FROM p),
       c AS (SELECT url, title, substring(b, pos) AS body FROM h), e AS (SELECT *, least(nullif(strpos(body, '''[http'), 0), nullif(strpos(body, '{X.ARTICLE_ENDS[1]}'), 0)) AS stop FROM c)
       SELECT url, title, CASE WHEN stop IS NOT NULL THEN {trim('substring(body, 1, stop - 1)')} ELSE body END AS article FROM e""")
def clean_article(s, d):
    p = table(s, d, "banglapedia_pages").where("markdown_body IS NOT NULL").select("url", "markdown_body", "title").distinct()
    return p.select("url", "title", X.clean_article(F.col("markdown_body"), F.col("title")).alias("article"))


@q("SELECT url, CASE WHEN json_valid(keywords) AND json_type(keywords) = 'ARRAY' THEN array_to_string(from_json(keywords, '[\"VARCHAR\"]'), ', ') ELSE keywords END AS csv FROM websites")
def keywords_csv(s, d):
    return table(s, d, "websites").select("url", X.keyword_csv(F.col("keywords")).alias("csv"))


@q("SELECT DISTINCT url, k AS keyword FROM (SELECT url, unnest(from_json(CASE WHEN json_valid(keywords) AND json_type(keywords) = 'ARRAY' THEN keywords ELSE '[]' END, '[\"VARCHAR\"]')) AS k FROM websites)")
def keywords_list(s, d):
    return table(s, d, "websites").select("url", F.explode(X.keyword_list(F.col("keywords"))).alias("keyword")).distinct()


@q(r"SELECT DISTINCT doc_id, coalesce(regexp_replace(chr(1) || text || chr(127) || chr(9), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]', '', 'g'), '') AS clean FROM documents")
def sanitize_control(s, d):
    t = F.concat(F.lit("\x01"), "text", F.lit("\x7f\t"))
    return table(s, d, "documents").select("doc_id", X.sanitize(t).alias("clean")).distinct()


@q("SELECT DISTINCT url, replace(raw_markdown, chr(10) || '# ', chr(10) || '### ') AS md FROM websites WHERE raw_markdown IS NOT NULL")
def header_demote(s, d):
    return table(s, d, "websites").where("raw_markdown IS NOT NULL").select("url", X.demote_headers(F.col("raw_markdown")).alias("md")).distinct()


@q(rf"""SELECT DISTINCT url, {trim("regexp_replace(title || ' & ' || coalesce(status, ''), '[ \\t\\n\\r]+', ' ', 'g')")} AS body FROM gov_bd_pages WHERE title IS NOT NULL""")
def html_to_text(s, d):
    title = F.replace(F.replace(F.replace("title", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    html = F.concat(F.lit('<nav class="m"><a href="/x">menu</a></nav><script>var a = 1;</script><div> '), title, F.lit(" &amp; <b>"), F.coalesce("status", F.lit("")), F.lit("</b></div><footer>end</footer>"))
    return table(s, d, "gov_bd_pages").where("title IS NOT NULL").select("url", X.html_text(html).alias("body")).distinct()


@q("""SELECT DISTINCT url, CASE WHEN status = 'error' THEN 'Error generating summary.' ELSE coalesce(summary, 'No summary generated.') END AS summary,
      CASE WHEN status = 'error' OR summary IS NULL THEN '[]' ELSE to_json(['a', url])::VARCHAR END AS keywords FROM websites""")
def llm_defaults(s, d):
    """Answers of a model: whole ones, some without fields, and broken ones for rows in error."""
    whole = F.to_json(F.struct("summary", F.array(F.lit("a"), "url").alias("keywords")))
    answer = F.when(F.col("status") == "error", F.concat(F.lit('{"summary": '), "url")).when(F.col("summary").isNull(), "{}").otherwise(whole)
    summary, keywords = X.llm_fields(answer)
    return table(s, d, "websites").select("url", summary.alias("summary"), keywords.alias("keywords")).distinct()


@q("""SELECT DISTINCT 'task: search result | query: ' || queries AS query_text, 'সারসংক্ষেপ: ' || coalesce(expected_answer, 'None') AS doc_text, 'title: none | text: ' || queries || ' - ' || coalesce(expected_answer, '') AS passage, '- [' || queries || '](' || queries || ')' AS source FROM eval_queries""")
def text_templates(s, d):
    q_, a = F.col("queries"), F.col("expected_answer")
    return table(s, d, "eval_queries").select(X.query_text(q_).alias("query_text"), X.document_text(a).alias("doc_text"), X.passage_text(q_, F.coalesce(a, F.lit(""))).alias("passage"), X.source_link(q_).alias("source")).distinct()


@q("SELECT DISTINCT url, raw_markdown[1:8000] AS llm_input, summary[1:250] AS preview FROM websites WHERE raw_markdown IS NOT NULL")
def prefix_fields(s, d):
    return table(s, d, "websites").where("raw_markdown IS NOT NULL").select("url", F.substring("raw_markdown", 1, 8000).alias("llm_input"), F.substring("summary", 1, 250).alias("preview")).distinct()


def scratch(s, name: str) -> str:
    return f"{shared_dir(s)}/shapla/{name}-{uuid.uuid4().hex}"


@q("SELECT chunk_id, max(coalesce(chunk_text, '')) AS chunk_text FROM bd_gov_chunks WHERE chunk_id IS NOT NULL GROUP BY chunk_id")
def bulk_index(s, d):
    """Chunks in a keyed index, written twice: the same id doesn't make a second row."""
    c = table(s, d, "bd_gov_chunks").select("chunk_id", F.coalesce("chunk_text", F.lit("")).alias("chunk_text"))
    index = KeyedTable(s, scratch(s, "index"), c.schema, "chunk_id")
    for number in range(2):
        index.write(c, number)
    return index.read()


LAST_SITE = "max(struct_pack(t := processed_at, n := coalesce(length(raw_markdown), 0), s := coalesce(status, '')))"


@q(f"SELECT url, x.t AS processed_at, x.n AS n, x.s AS status FROM (SELECT url, {LAST_SITE} AS x FROM websites WHERE url IS NOT NULL GROUP BY url)")
def site_index(s, d):
    """Sites in a keyed index in three batches of keys, stopped after one and taken up again; the latest row of a url wins."""
    w = table(s, d, "websites").select("url", "processed_at", F.coalesce(F.length("raw_markdown"), F.lit(0)).cast("long").alias("n"), F.coalesce("status", F.lit("")).alias("status"))
    path, size = scratch(s, "sites"), w.select("url").distinct().count() // 3 + 1
    index_by_key(w, path, "url", "processed_at", size, stop_after=1)
    index_by_key(w, path, "url", "processed_at", size)
    return KeyedTable(s, path, w.schema, "url", "processed_at").read()


LAST_PAGE = "max(struct_pack(t := crawled_at, i := coalesce(title, ''), s := coalesce(status, '')))"


@q(f"SELECT url, x.t AS crawled_at, x.i AS title, x.s AS status FROM (SELECT url, {LAST_PAGE} AS x FROM (SELECT * FROM gov_bd_pages WHERE url IS NOT NULL AND (crawled_at, coalesce(markdown_body, ''), coalesce(title, ''), coalesce(status, '')) IS NOT NULL) GROUP BY url)")
def incremental_ingest(s, d):
    """The page queue read as a stream; the row with the latest crawled_at stays."""
    rows = ingest(s, d, "gov_bd_pages.parquet", schemas.PAGES, scratch(s, "ingest"), "url", "crawled_at")
    return rows.select("url", "crawled_at", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("status", F.lit("")).alias("status"))


@q("""SELECT url, CASE WHEN status = 'error' THEN 'error' WHEN raw_markdown IS NULL OR length(""" + trim("raw_markdown") + """) < 50 THEN 'failed_no_content' ELSE 'success' END AS page_status, count(*) AS n FROM websites GROUP BY 1, 2""")
def page_status(s, d):
    error = F.when(F.col("status") == "error", F.lit("raised"))
    return table(s, d, "websites").select("url", X.page_status(F.col("raw_markdown"), error).alias("page_status")).groupBy("url", "page_status").agg(F.count(F.lit(1)).alias("n"))


CODES = {"success": 200, "failed_no_content": 204, "deleted": 404}


@q("""SELECT url, coalesce(bool_or(code = 200), false) AS fetched, coalesce(bool_or(code < 400), false) AS alive FROM
      (SELECT url, CASE status WHEN 'success' THEN 200 WHEN 'failed_no_content' THEN 204 WHEN 'deleted' THEN 404 END AS code FROM websites) GROUP BY url""")
def http_status(s, d):
    """A fetch log made of the states; an error has no code."""
    code = F.lit(None).cast("int")
    for status, n in CODES.items():
        code = F.when(F.col("status") == status, n).otherwise(code)
    log = table(s, d, "websites").select("url", code.alias("code"))
    return log.groupBy("url").agg(F.max(U.fetched(F.col("code"))).alias("fetched"), F.max(U.alive(F.col("code"))).alias("alive"))


@q("SELECT l.source_url, count(*) AS n FROM website_links l WHERE l.source_url IS NULL OR l.source_url NOT IN (SELECT url FROM websites WHERE status = 'deleted' AND url IS NOT NULL) GROUP BY 1")
def cascade_delete(s, d):
    gone = table(s, d, "websites").where("status = 'deleted'").select(F.col("url").alias("source_url"))
    return tables.without_parents(table(s, d, "website_links"), gone, "source_url").groupBy("source_url").agg(F.count(F.lit(1)).alias("n"))


@q("SELECT (SELECT count(DISTINCT url) FROM websites WHERE status = 'success') AS found, (SELECT count(DISTINCT url) FROM websites) AS total, NULL::DOUBLE AS seconds")
def found_of_total(s, d):
    w = table(s, d, "websites")
    return tables.found_of_total(w.where("status = 'success'").select("url").where("url IS NOT NULL").distinct(), w.select("url").where("url IS NOT NULL").distinct())


@q(f"SELECT unnest([0, 1, 2, 3])::INT AS line_no, unnest(['{'-' * 30}', 'TOTAL_ROWS: ' || n, 'LAST_URL: ' || coalesce(u, 'None'), '{'-' * 30}']) AS line FROM (SELECT count(*) AS n, max(url) AS u FROM gov_bd_pages)")
def text_report(s, d):
    return tables.report(table(s, d, "gov_bd_pages").agg(F.count(F.lit(1)).alias("total_rows"), F.max("url").alias("last_url")))


@q()
def storage_sizes(s, d):
    return tables.table_sizes(s, d).select("table_name", "bytes", tables.pretty_size(F.col("bytes")).alias("size"))
