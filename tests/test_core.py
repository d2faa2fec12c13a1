from datetime import datetime as D

import pytest
from pyspark.sql import functions as F

from shapla import schemas
from shapla.functions import text as X
from shapla.functions import urls as U
from shapla.operators import links, orphans, search, tables, transcript, tree
from shapla.plans import crawl, retrieve
from shapla.streaming.ingest import ingest


def one(spark, column, value=None):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("x")).first()[0]


def test_tokens_part_at_marks(spark):
    assert one(spark, X.tokens(F.col("v")), "বয়স্ক") == ["বয", "স", "ক"]
    assert one(spark, X.tokens(F.col("v")), "e-Passport_2") == ["e", "passport_2"]
    assert one(spark, X.tokens(F.col("v"))) == []


@pytest.mark.parametrize(
    ("url", "host"),
    [("http://WWW.a.gov.bd:80/x", "a.gov.bd"), ("https://gov.bd", None), ("http://u:p@h.gov.bd/", None), ("a.gov.bd/x", None), (None, None)],
)
def test_domain(spark, url, host):
    assert one(spark, U.domain_of(F.col("v")), url) == host


@pytest.mark.parametrize("url", ["http://www.A.gov.bd:80/x/#t", "https://a.gov.bd/x", "HTTPS://a.gov.bd:443/x//"])
def test_page_key(spark, url):
    assert one(spark, U.page_key(F.col("v")), url) == "a.gov.bd/x"


def test_char_chunks(spark):
    for n, chunks in ((0, 0), (1, 1), (1700, 1), (1701, 2), (2000, 2), (2001, 2), (3400, 2)):
        assert len(one(spark, tree.char_chunks(F.col("v")), "x" * n)) == chunks


def test_word_windows():
    assert tree.word_windows("a" * 50) == []
    assert tree.word_windows("a" * 51) == ["a" * 51]
    words = [f"w{i:03d}" for i in range(700)]
    chunks = tree.word_windows(" ".join(words))
    assert {w for c in chunks for w in c.split()} == set(words)
    assert all(len(c) >= 1499 for c in chunks[:-1])
    assert tree.word_windows("b" * 1600)[0] == "b" * 1600


def test_cleaning(spark):
    raw = f"a\n{X.JUNK[0]}\n\n\n\nb\n{X.FOOTERS[0]}\nc"
    assert one(spark, X.clean_lines(F.col("v")), raw) == "a\n\nb"
    assert one(spark, X.clean_lines(F.col("v"))) == ""
    assert one(spark, X.clean_article(F.col("v"), F.lit("T")), "menu\n#  T\nbody\n'[http://x") == "#  T\nbody"
    assert one(spark, X.clean_article(F.col("v"), F.lit("T")), "menu\n# H\nbody ") == "# H\nbody "
    assert one(spark, X.sanitize(F.col("v")), "a\x01\tb") == "a\tb"


def test_upsert_insert_update(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("b", 4), ("c", 5)], "k string, v int")
    assert sorted(map(tuple, tables.upsert(old, new, "k").collect())) == [("a", 1), ("b", 4), ("c", 5)]
    assert {r.k: r.v for r in tables.insert_ignore(old, new, ["k"]).collect()}["b"] == 2
    upd = spark.createDataFrame([("a", None), ("z", 9)], "k string, v int")
    assert sorted(map(tuple, tables.keyed_update(old, upd, "k").collect()), key=str) == [("a", None), ("b", 2)]


def test_unverified_keeps_nulls_and_repeats(spark):
    main = spark.createDataFrame([(None,), ("a",), ("a",), ("b",)], "Link string")
    seen = spark.createDataFrame([("b",), (None,)], "Link string")
    assert sorted(map(str, (r.Link for r in tables.unverified(main, seen, "Link").collect()))) == ["None", "a", "a"]
    assert tuple(tables.dedupe_counts(main, seen, "Link").first()) == (4, 3, 1)


def test_bfs_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", None)], "source_url string, target_url string")
    seeds = spark.createDataFrame([("a",)], "url string")
    assert {r.url: r.level for r in links.bfs(edges, seeds).collect()} == {"a": 0, "b": 1, "c": 2}


def test_bm25_against_plain_python(spark):
    import math
    from collections import Counter

    docs = {1: "a b a", 2: "b c", 3: "c c d", 4: "b"}
    df = spark.createDataFrame(list(docs.items()), "id long, text string")
    q = spark.createDataFrame([(1, "a b b zz")], "query long, text string")
    got = {r.key: r.score for r in search.bm25(search.Index.build(df, "id", F.col("text")), search.query_terms(q, "query", F.col("text")), 4).collect()}
    toks = {k: v.split() for k, v in docs.items()}
    n, avg = len(docs), sum(map(len, toks.values())) / len(docs)
    dfs = Counter(t for v in toks.values() for t in set(v))
    idf = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in dfs.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {t: v if v >= 0 else 0.25 * mean for t, v in idf.items()}
    for k, v in toks.items():
        s = sum(idf.get(t, 0) * v.count(t) * 2.5 / (v.count(t) + 1.5 * (0.25 + 0.75 * len(v) / avg)) for t in ["a", "b", "b", "zz"])
        assert abs(got.get(k, 0.0) - s) < 1e-9


def test_knn(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, None)], "id long, e array<double>")
    q = spark.createDataFrame([(7, [1.0, 0.0])], "query long, vector array<double>")
    assert [r.key for r in search.knn(v, "id", "e", q, 2).orderBy("rank").collect()] == [1, 2]


def test_outcomes(spark):
    rows = [(1, 1, "assistant", 'Action: search_tree("x")'), (1, 2, "assistant", "action"), (1, 3, "assistant", 'Action: search_tree("x")'), (1, 4, "assistant", transcript.REFUSAL + " Final Answer: y"), (1, 5, "assistant", "Final Answer: y"), (1, 6, "assistant", "no final answer here")]
    t = spark.createDataFrame(rows, schemas.TURNS)
    assert [r.outcome for r in transcript.outcome(t).orderBy("turn").collect()] == ["search", "format_error", "repeated", "guardrail", "final", "format_error"]
    assert transcript.outcome(t, strict=False).orderBy("turn").collect()[5].outcome == "final"


def test_orphans(spark):
    links_ = spark.createDataFrame(
        [(1, "https://a.gov.bd/x", "http://www.A.gov.bd/y#f", D(2024, 1, 5)), (1, "https://a.gov.bd/x", "http://www.A.gov.bd/y#f", D(2024, 1, 5)), (2, "https://a.gov.bd/x", None, D(2024, 1, 20)), (3, "https://o.example/", "https://a.gov.bd/y", D(2024, 3, 1)), (4, None, "https://a.gov.bd/y", None)],
        schemas.WEBSITE_LINKS,
    )
    page = lambda u, s, t: (u, None, None, None, s, t)
    pages = spark.createDataFrame([page("http://a.gov.bd/x", "success", D(2024, 1, 1)), page("http://a.gov.bd/x", "deleted", D(2024, 1, 10)), page("https://a.gov.bd/y/", "error", D(2024, 2, 1)), page(None, "success", D(2024, 1, 1))], schemas.WEBSITES)
    want = {(1, "target"), (2, "source"), (4, "target")}
    assert {(r.id, r.side) for r in orphans.orphan_references(links_, pages).collect()} == want
    before, orphans.HOT_ROWS = orphans.HOT_ROWS, 1
    try:
        assert {(r.id, r.side) for r in orphans.orphan_references(links_, pages).collect()} == want
    finally:
        orphans.HOT_ROWS = before
    assert orphans.orphan_references(links_.limit(0), pages).count() == 0
    assert orphans.orphan_references(links_, pages.limit(0)).count() == 5


def test_ingest_is_idempotent(spark, tmp_path):
    rows = [("u", "t", "b", "success", D(2024, 1, 1)), ("u", "t", "b", "success", D(2024, 1, 1)), (None, "t", "b", "error", None)]
    spark.createDataFrame(rows, schemas.PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    for _ in range(2):
        got = ingest(spark, str(tmp_path), "pages.parquet", schemas.PAGES, f"file://{tmp_path}/out", "url")
        assert [r.url for r in got.collect()] == ["u"]


def test_hybrid_searches_long_query_documents(spark, tmp_path):
    docs = [(50, "alpha beta " * 60), (100, "gamma"), (1, "alpha"), (2, "gamma delta")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(50, [1.0, 0.0]), (7, [0.0, 1.0])], "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r.query, r.key): r.score for r in retrieve.hybrid_topk(spark, str(tmp_path)).collect()}
    assert set(got) == {(50, 50), (50, 1), (50, 7), (100, 100), (100, 2)}
    assert got[50, 50] > 1 and got[50, 1] > 1


def test_bfs_drains_and_limits_raise(spark, tmp_path):
    names = ["s/page/0", *"abcdefg"]
    edges = spark.createDataFrame(list(zip(names, names[1:], strict=False)), "source_url string, target_url string")
    edges.write.parquet(f"{tmp_path}/website_links.parquet")
    spark.createDataFrame([(names[0],)], "url string").write.parquet(f"{tmp_path}/websites.parquet")
    assert {r.url: r.level for r in crawl.bfs_levels(spark, str(tmp_path)).collect()} == {u: i for i, u in enumerate(names)}
    seeds = spark.createDataFrame([(names[0],)], "url string")
    assert links.bfs(edges, seeds, 7).count() == 8
    with pytest.raises(ValueError):
        links.bfs(edges, seeds, 6)
    nodes = spark.createDataFrame([("r", None, 0), ("a", "r", 0), ("b", "a", 0)], "node_id string, parent_id string, ordinal int")
    assert tree.flatten(nodes, 2).count() == 3
    with pytest.raises(ValueError):
        tree.flatten(nodes, 1)
