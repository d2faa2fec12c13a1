import json
from urllib.parse import urldefrag, urljoin

import pytest
from pyspark.sql import functions as F

from shapla import schemas, session
from shapla.functions import text as X
from shapla.functions import urls as U
from shapla.operators import links, models, search, tables, transcript, tree
from shapla.sources import files, web
from shapla.streaming.ingest import KeyedTable, index_by_key, published, publish


def test_url_lists(spark, tmp_path):
    (tmp_path / "u.txt").write_bytes(b"http://a/\n\n  http://b/ \nhttp://a/\nbad\xffbyte\n")
    path = str(tmp_path / "u.txt")
    assert {r.url for r in files.url_list(spark, path).collect()} == {"http://a/", "http://b/", "bad�byte"}
    assert files.url_list(spark, path, distinct=False).count() == files.attempted(spark, path) == 4


def test_csv_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"Link,Name\nhttp://a/,x\nhttp://a/,\xffy\n,z\n")
    (tmp_path / "b.csv").write_text('Name,Link\n"two\nlines",http://b/\n')
    (tmp_path / "c.csv").write_text("Other\nhttp://c/\n")
    (tmp_path / "e.csv").write_text("")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv", "c.csv", "e.csv", "missing.csv")]
    assert {r.url for r in files.verified_urls(spark, paths).collect()} == {"http://a/", "http://b/"}
    assert files.verified_urls(spark, paths[2:]).count() == 0
    assert [r.Name for r in files.read_csv(spark, paths[:1], ["Link", "Name"]).orderBy("Name").collect()] == ["x", "z", "�y"]
    files.write_csv(spark.createDataFrame([("a", 'say "x"\nand, y'), ("b", None)], "k string, v string"), str(tmp_path / "out"))
    back = files.read_csv(spark, [str(tmp_path / "out")], ["k", "v"])
    assert {(r.k, r.v) for r in back.collect()} == {("a", 'say "x"\nand, y'), ("b", None)}


def test_eval_queries(spark, tmp_path):
    (tmp_path / "q.csv").write_text('queries\n"a, b"\n')
    (tmp_path / "r.csv").write_text("queries,expected_answer\nq,\nr,s\n")
    assert [tuple(r) for r in files.eval_queries(spark, str(tmp_path / "q.csv")).collect()] == [("a, b", None)]
    assert [tuple(r) for r in files.eval_queries(spark, str(tmp_path / "r.csv")).collect()] == [("q", None), ("r", "s")]
    with pytest.raises(ValueError):
        files.eval_queries(spark, str(tmp_path / "none.csv"))


def test_tree_files(spark, tmp_path):
    node = {"node_id": "1", "title": "t", "nodes": [{"node_id": "2", "heading": "h", "nodes": "no list"}, "not a node"]}
    for n, root in enumerate([[node], {"structure": [node]}, {"nodes": [node]}, {"structure": [], "nodes": [node]}]):
        (tmp_path / f"{n}.json").write_text(json.dumps(root))
        got = [(r.node_id, r.parent_id, r.ordinal, r.title) for r in files.tree_nodes(spark, str(tmp_path / f"{n}.json")).collect()]
        assert got == ([] if n == 3 else [("1", None, 0, "t"), ("2", "1", 0, "h")])
    (tmp_path / "bad.json").write_text("{")
    assert files.tree_nodes(spark, str(tmp_path)).count() == 6


def test_frontier_and_text_sinks(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"visited_urls": ["a", "a"]}))
    visited, queue = files.frontier_state(spark, str(tmp_path / "s.json"))
    assert visited.count() == 1 and queue.count() == 0
    files.save_frontier(visited, spark.createDataFrame([("q",), ("q",)], "url string"), str(tmp_path / "state"))
    visited, queue = files.saved_frontier(spark, str(tmp_path / "state"))
    assert visited.count() == 1 and queue.count() == 2
    urls = spark.createDataFrame([("b",), ("a",), (None,)], "url string")
    files.write_sorted(urls, "url", str(tmp_path / "sorted"))
    lines = "".join(p.read_text() for p in sorted((tmp_path / "sorted").glob("part-*")))
    assert lines.split() == ["a", "b"]
    for _ in range(2):
        files.append_lines(urls.where("url IS NOT NULL"), "url", str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).count() == 4
    doc = tree.document(spark.createDataFrame([("u2", "## u2\n\nx\n\n"), ("u1", "## u1\n\ny\n\n")], "url string, markdown string"), "Root")
    files.write_document(doc, str(tmp_path / "doc"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "doc").glob("part-*")))
    assert text == "# Root\n\n## u1\n\ny\n\n## u2\n\nx\n\n"


def test_index_locks(spark, tmp_path):
    df, path = spark.range(2), str(tmp_path / "index")
    files.write_if_absent(df, path)
    files.write_if_absent(spark.range(5), path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(Exception, match="already exists"):
        files.write_index(df, path)
    files.write_index(spark.range(3), path, overwrite=True)
    assert not files.drop_index(spark, path) and files.drop_index(spark, path, sure=True) and not files.drop_index(spark, path, sure=True)


def test_listing_follows_continuations(spark, tmp_path):
    answers = {"first": {"query": {"allpages": [{"title": "A b"}]}, "continue": {"apcontinue": "x"}}, "x": {"query": {"allpages": [{"title": "C"}]}}}
    for name, a in answers.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(a))
    assert [r.title for r in web.listing(spark, str(tmp_path)).collect()] == ["A b", "C"]


def test_crawl_resumes(spark, tmp_path):
    page = lambda *hrefs: "".join(f"<A HREF='{h}'>x</A>" for h in hrefs)
    pages = [("http://a.gov.bd/", 200, page("x/", "http://o.example/", "#top")), ("http://a.gov.bd/x/", 200, page("../y", "//B.gov.bd/")), ("http://a.gov.bd/y", 404, page("z")), ("http://B.gov.bd/", 200, page("http://a.gov.bd/"))]
    fetch = web.TableFetcher(spark.createDataFrame(pages, "url string, code int, html string"))
    seeds = spark.createDataFrame([("http://a.gov.bd/",), (None,)], "url string")
    state = f"file://{tmp_path}/crawl"
    assert links.crawl(seeds, fetch, state, levels=1).count() == 2
    want = {("http://a.gov.bd/", "a.gov.bd", 0), ("http://a.gov.bd/x/", "a.gov.bd", 1), ("http://a.gov.bd/y", "a.gov.bd", 2), ("http://B.gov.bd/", "b.gov.bd", 2)}
    for _ in range(2):
        assert {tuple(r) for r in links.crawl(seeds, fetch, state).collect()} == want
    md = web.fetch_markdown(spark.createDataFrame([("http://a.gov.bd/x/",), ("http://none/",)], "url string"), fetch)
    assert {r.url: r.raw_markdown for r in md.collect()} == {"http://a.gov.bd/x/": "[x](../y)[x](//B.gov.bd/)", "http://none/": None}


def test_bfs_leaves_visited_alone(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "d")], "source_url string, target_url string")
    seeds = spark.createDataFrame([("a",)], "url string")
    assert {r.url for r in links.bfs(edges, seeds, visited=spark.createDataFrame([("b",)], "url string")).collect()} == {"a", "d"}


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("x")).first()[0]


@pytest.mark.parametrize("base", ["http://h.example/a/b/c?q=1#f", "http://h.example", "http://h.example/a/", "http://h.example/a//b/c"])
def test_href_as_urljoin(spark, base):
    hrefs = ["../x", "./y", "../../../z", "x/../y/", ".", "..", "../", "/p/./q/../r", " g?x=../y ", "//o.example/../k", "#t", "", "?n", "mailto:x@y", "https://z.example/a/../b", "g;x=1/../y"]
    df = spark.createDataFrame([(h,) for h in hrefs], "h string").select("h", U.resolve_href(F.lit(base), F.col("h")).alias("x"))
    assert {r.h: r.x for r in df.collect()} == {h: urldefrag(urljoin(base, h.strip()))[0] for h in hrefs}


def test_html(spark):
    html = """<a class="l" href="/a?x=1&amp;y=2">t</a><A title='>' HREF = 'b"c'>t</A><a href=bare>t</a><p data-href="no"><a data-href="no">n</a><abbr href="no">"""
    assert one(spark, U.html_hrefs(F.col("v")), html) == ["/a?x=1&y=2", 'b"c', "bare"]
    page = "<nav>menu</nav><div id='main'><h2>T &amp; x</h2><p>one two three</p><ul><li>a</li><li><a href='/u'>b</a></li></ul></div>"
    assert one(spark, X.html_markdown(F.col("v")), page) == "## T & x\n\none two three\n\n- a\n\n- [b](/u)"
    assert one(spark, X.html_blocks(F.col("v"), 3), page) == ["T & x", "one two three"]
    assert one(spark, X.html_blocks(F.col("v"), 3), None) == []
    assert one(spark, X.html_element(F.col("v"), "main"), page).startswith("<h2>") and one(spark, X.html_element(F.col("v"), "other"), page) == page


def test_page_states(spark):
    rows = [("x" * 60, None, 200), ("x" * 60, "timeout", None), (" ", None, 399), (None, None, 404)]
    df = spark.createDataFrame(rows, "t string, e string, c int")
    got = df.select(X.page_status(F.col("t"), F.col("e")).alias("s"), U.fetched(F.col("c")).alias("f"), U.alive(F.col("c")).alias("a")).collect()
    assert [tuple(r) for r in got] == [("success", True, True), ("error", False, False), ("failed_no_content", False, True), ("failed_no_content", False, False)]
    assert spark.range(1).select(X.sanitize_list(F.array(F.lit("a\x01"), F.lit(None))).alias("x"), X.sanitize_list(F.lit(None).cast("array<string>")).alias("y")).first() == (["a", ""], [])


def test_upsert_takes_the_latest(spark):
    old = spark.createDataFrame([("a", "old", 9)], "k string, title string, at int")
    new = spark.createDataFrame([("a", "zz old", 1), ("a", "aa new", 2), ("b", "x", None)], "k string, title string, at int")
    assert {tuple(r) for r in tables.upsert(old, new, "k", "at").collect()} == {("a", "aa new", 2), ("b", "x", None)}


def test_keyed_table(spark, tmp_path):
    rows = [(f"k{i:02d}", i, "x") for i in range(10)] + [("k03", 99, "later"), (None, 1, "none")]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    path = f"file://{tmp_path}/t"
    assert index_by_key(df, path, "k", "at", 4, stop_after=1) == 1
    assert index_by_key(df, path, "k", "at", 4) == 2 and index_by_key(df, path, "k", "at", 4) == 0
    table = KeyedTable(spark, path, df.schema, "k", "at")
    want = {(f"k{i:02d}", 99 if i == 3 else i, "later" if i == 3 else "x") for i in range(10)}
    assert {tuple(r) for r in table.read().collect()} == want
    table.compact()
    assert table.numbers("batch") == [] and table.numbers("base") == [2] and {tuple(r) for r in table.read().collect()} == want
    table.write(spark.createDataFrame([("k00", -5, "last batch wins")], df.schema), 3)
    assert table.read().where("k = 'k00'").first() == ("k00", -5, "last batch wins")
    assert not table.drop() and table.drop(sure=True) and table.read().count() == 0


def test_publish_is_atomic(spark, tmp_path):
    path = f"file://{tmp_path}/pair"
    assert published(spark, path, "links") is None
    publish({"sites": spark.range(2), "links": spark.range(5)}, path)
    spark.range(9).write.parquet(f"{path}/version=1/sites")  # a run that stopped half way
    assert published(spark, path, "links").count() == 5 and published(spark, path, "sites").count() == 2
    publish({"sites": spark.range(3), "links": spark.range(6)}, path)
    assert published(spark, path, "sites").count() == 3


def test_catalog_sizes_pages(spark, tmp_path):
    spark.range(7).withColumn("name", F.lit("x")).createOrReplaceTempView("seven")
    assert ("seven", "id", "bigint") in {tuple(r) for r in tables.catalog_columns(spark).collect()}
    for name in ("a", "b"):
        spark.range(100).write.parquet(f"{tmp_path}/{name}.parquet")
    sizes = {r.table_name: r.bytes for r in tables.table_sizes(spark, str(tmp_path)).collect()}
    assert set(sizes) == {"a", "b"} and all(sizes.values())
    got = spark.createDataFrame([(9000,), (20 << 10,), (300 << 20,)], "n long").select(tables.pretty_size(F.col("n")).alias("x")).collect()
    assert [r.x for r in got] == ["9000 bytes", "20 kB", "300 MB"]
    assert [[r.id for r in p] for p in tables.pages_of(spark.range(5), "id", 2)] == [[0, 1], [2, 3], [4]]
    assert tables.numbered_batches(spark.range(100), "id", 30).select("batch").distinct().count() == 4


def test_materialized_tables_are_cleaned(spark):
    df = session.materialize(spark.range(3))
    path = session._made[-1]
    assert df.count() == 3 and session.exists(spark, path)
    session.clean(spark)
    assert not session.exists(spark, path)


def test_models(spark):
    rows = spark.createDataFrame([(1, "one two. Three four! Five"), (2, None), (3, "")], "id long, t string")
    v = {r.id: r.chunk_vector for r in models.embed(rows, "t", batch=1).collect()}
    assert v[2] is None and sum(x * x for x in v[1]) == pytest.approx(1) and not any(v[3])
    assert models.embed(rows, "t").where("id = 1").first().chunk_vector == v[1]
    answers = {r.id: r.answer for r in models.summarise(rows, "t").collect()}
    assert json.loads(answers[1]) == {"summary": "one two. Three four!", "keywords": ["five", "four", "three"]} and answers[2] is None


def test_markdown_tree(spark):
    md = "lost\n# A\nx\n### B\n```\n# no heading\n```\n## C\n# D #"
    got = [tuple(r)[1:] for r in tree.markdown_tree(spark.createDataFrame([("u", md), ("n", None)], "k string, m string"), "k", "m").collect()]
    assert got == [("0001", None, 0, 1, "A", "x"), ("0002", "0001", 1, 2, "B", "```\n# no heading\n```"), ("0003", "0001", 2, 2, "C", ""), ("0004", None, 3, 1, "D", "")]


def test_chunks_keep_their_nodes_fields(spark):
    nodes = spark.createDataFrame([("n", None, 0, "one", "a" * 60, "u1"), ("n", None, 1, "two", "b" * 60, "u2")], schemas.NODES)
    assert {(r.site_title, r.url, r.chunk_text[0]) for r in tree.chunk_records(nodes).collect()} == {("one", "u1", "a"), ("two", "u2", "b")} and tree.chunk_records(nodes).count() == 2


def test_index_is_stored(spark, tmp_path):
    docs = spark.createDataFrame([("a", "x y"), ("b", "x"), ("c", None)], "id string, t string")
    search.Index.build(docs, "id", F.col("t"), f"file://{tmp_path}/index")
    index = search.Index.load(spark, f"file://{tmp_path}/index")
    assert index.n == 3 and {r.term: r.df for r in index.terms.collect()} == {"x": 2, "y": 1}
    terms = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "zz", 1)], "query long, term string, qtf long")
    one_scan = {(r.query, r.key): r.score for r in search.bm25(index, terms, 2, "lucene").collect()}
    old, search.BLOCK_TERMS = search.BLOCK_TERMS, 1
    try:
        assert {(r.query, r.key): r.score for r in search.bm25(index, terms, 2, "lucene").collect()} == one_scan
    finally:
        search.BLOCK_TERMS = old
    assert set(one_scan) == {(1, "a"), (1, "b")}
    pairs = search.pair_scores(index, terms, spark.createDataFrame([(1, "b"), (1, "c")], "query long, key string"))
    assert [(r.key, round(r.score, 9)) for r in pairs.collect()] == [("b", round(one_scan[1, "b"], 9))]
    empty = search.Index.build(docs.limit(0), "id", F.col("t"))
    assert search.bm25(empty, terms, 2).count() == 0


def test_knn_leaves_zero_vectors_out(spark):
    v = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 1.0])], "id long, e array<double>")
    q = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 0.0])], "query long, vector array<double>")
    assert [(r["query"], r.key) for r in search.knn(v, "id", "e", q, 2).collect()] == [(7, 2)]


def test_search_terms_are_analysed(spark):
    docs = spark.createDataFrame([("a", "এবং আইন"), ("b", "ং এব x"), ("c", "আইন")], "id string, t string")
    hit = lambda must, should, n: {r.key for r in search.bool_query(docs, "id", F.col("t"), must, should, n).collect()}
    assert hit(["এবং"], [], 0) == {"a", "b"} and hit(["এবং"], ["আইন"], 1) == {"a"} and hit([], ["আইন"], 3) == set() and hit(["ং"], [], 0) == set()


def test_context_sources(spark):
    rows = [(1, 1, "u", "s", "m"), (1, 2, None, None, None), (1, 3, "u", "s", "m")]
    got = search.context_blocks(spark.createDataFrame(rows, "query long, rank int, url string, summary string, raw_markdown string")).first()
    assert got.sources == ["u"] and got.context.count("Source URL: ") == 3 and "Source URL: #" in got.context


def test_agent_outcomes(spark):
    q = spark.createDataFrame([(i, t) for i, t in enumerate(["final", "refuse", "silent", "loop", "odd"])], "conv_id long, text string")
    first = F.col("turns")[0]["text"]
    n = F.size("turns")
    reply = lambda o: o.where(first != "silent").select("conv_id", F.when(first == "final", F.when(n == 1, 'Action: search("x")').otherwise(F.concat(F.lit("Final Answer: "), F.substring(F.element_at("turns", -1)["text"], 14, 4)))).when(first == "refuse", transcript.REFUSAL).when(first == "odd", F.when(n == 1, "no form").when(n == 3, "Action: strange(1)").otherwise("**Final Answer:** done")).otherwise('Action: search("same")').alias("text"))
    found = lambda a: a.where("text = 'x'").select("query", F.lit("seen").alias("context"))
    got = {r.conv_id: r for r in transcript.run_agent(q, reply, found, rounds=4).collect()}
    assert {k: r.outcome for k, r in got.items()} == {0: "final", 1: "guardrail", 2: "loop_error", 3: "exhausted", 4: "final"}
    assert got[0].answer == "seen" and got[2].answer == transcript.LOOP_ERROR and got[4].answer == "done"
    assert "made before" in got[3].turns[4]["text"] and "not recognized" in got[4].turns[4]["text"]


def test_judge_and_grades(spark):
    class Silent:
        def compare(self, query, a, b):
            return F.when(query == "q", F.lit(None).cast("string")).otherwise("boom")

    rows = spark.createDataFrame([("q", "a", "b"), ("r", "a", "b"), ("s", "Agent Loop Error", "x Agent Loop Error")], "query string, answer_a string, answer_b string")
    assert [r.winner for r in transcript.judge(rows, Silent()).collect()] == ["Judge Error: no verdict", "Judge Error: boom", "Tie (Both Failed)"]
    g = transcript.grade(spark.createDataFrame([("a b", "a b", "a b"), ("a", None, "a"), ("a", "b", None)], "queries string, expected_answer string, sys_x_actual_answer string"), ["x"]).collect()
    assert [(r.sys_x_recall_score, r.sys_x_recall_passed, r.sys_x_recall_error) for r in g] == [(1.0, True, None), (None, None, "JSON_Error"), (None, None, "JSON_Error")]
