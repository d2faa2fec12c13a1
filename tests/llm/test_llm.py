import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("shapla.llm")

from shapla.llm import common, language, leakage, line_model, main_content, near_dup, packing, repeated_lines, residue, sentences, splitting  # noqa: E402

PAGES = "tbl string, url string, field string, title string, text string"


def pages(spark, rows):
    return spark.createDataFrame([("websites", u, "raw_markdown", t, x) for u, t, x in rows], PAGES)


def test_line_key():
    key = common.line_key
    assert key("© 2020-২০২১ Office", []) == key("**© 2019-2022  Office**", [])
    assert key("Published by Saar Nolujo, 13 February 2021", []) == key("- Published by Ab Cd, 2020-01-02", [])
    assert key("Home » A Title", ["A Title"]) == key("Home » Other", ["Other"])
    assert key("12 ab", []) == ""


def test_repeated_lines(spark):
    rows = [(f"http://h.example/{i}", None, f"text {chr(97 + i)}own line\nseen {i} times\nseen") for i in range(8)]
    rows += [("https://h.example/0", None, "seen 5 times"), ("http://o.example/1", None, "seen 1 times"), ("http://h.example/1", None, None), (None, None, "seen 1 times"), rows[0]]
    got = {(r.url, r.line_no) for r in repeated_lines.repeated_lines(pages(spark, rows).where("url IS NOT NULL AND text <> ''")).collect()}
    assert got == {(f"http://h.example/{i}", 2) for i in range(8)} | {(f"http://h.example/{i}", 3) for i in range(8)} | {("https://h.example/0", 1)}
    assert repeated_lines.repeated_lines(pages(spark, rows).limit(0)).count() == 0
    whole = pages(spark, rows).where("url IS NOT NULL AND text <> ''")
    want = {(r.url, "\n".join(x for i, x in enumerate(r.text.split("\n"), 1) if (r.url, i) not in got)) for r in whole.collect()}
    assert sorted((r.url, r.text) for r in repeated_lines.cleaned(whole).collect()) == sorted(want)
    old, repeated_lines.BROADCAST_BYTES = repeated_lines.BROADCAST_BYTES, 0  # salted joins
    try:
        assert {(r.url, r.line_no) for r in repeated_lines.repeated_lines(whole).collect()} == got
        assert sorted((r.url, r.text) for r in repeated_lines.cleaned(whole).collect()) == sorted(want)
    finally:
        repeated_lines.BROADCAST_BYTES = old


def test_summary_excludes_in_a_large_source(spark):
    n = 1_200_000  # distinct lines of one source, two a page, besides one that stands on all pages
    keys = spark.range(n // 2).selectExpr("concat('u', id) AS url", "7L AS source", "array(xxhash64(id, 1), xxhash64(id, 2), 5L) AS keys")
    lines = repeated_lines.in_cells(keys)
    kept = repeated_lines.semi_join(lines, repeated_lines.heavy_cells(lines), ["source", "cell"], 48, "u").where("key <> 5").count()
    assert kept < 0.15 * n  # with 65,536 counters all of them would stay
    assert [tuple(r) for r in repeated_lines.confirmed(keys).collect()] == [(5, n // 2)]


def test_line_keys_are_alike_at_any_length():
    for n in (10, 300):
        tail = " word" * n
        assert common.line_key(f"Notice{tail}, author Saar Nolujo, 3 May 2021", []) == common.line_key(f"Notice{tail}, author Ab Cd, 4 May 2020", []) != ""
        assert common.titles_of(None, ["A Notice of Weavers", f"x{tail}: A Notice of Weavers"]) == ["A Notice of Weavers"]


def test_a_byline_is_a_feature_not_a_rule():
    model = line_model.LineModel({"\tbyline0": 4.0, "\tbyline1": -1.0}, -1.0)
    page = "# T\n\nThe author Rahim Uddin, born in 1950 in Pabna.\n\nPublished by Rahim Uddin, 3 May 2021"
    assert main_content.furniture(page, "http://h.example/", None, set(), model) == [5]


def test_slots_are_induced():
    frames = lambda t: [(f, w, q) for f, w, q in residue.pieces(t)]
    assert frames("a {{ name }} `{{name}}` [insert date here]")[:3] == [("{{ \t }}", "name", False), ("{{ \t }}", "name", True), ("[ \t date here ]", "insert", False)]
    assert frames("__USER_NAME__ &lt;x&gt; <%= y %> **bold** [text](url)") == [("__ \t __", "USER_NAME", False), ("&lt; \t &gt;", "x", False), ("<%= \t %>", "y", False)]
    counts = [(f, w, 5) for f in ("{{ \t }}", "%% \t %%", "[ insert \t here ]") for w in ("name", "date", "place")] + [("( \t )", f"w{i}", 2) for i in range(40)] + [("[ \t ]", "no", 90), ("__ \t __", "USER", 4), ("__ \t __", "SITE_URL", 4)]
    slots, names = residue.variables(counts)
    assert slots == {"{{ \t }}", "%% \t %%", "[ insert \t here ]", "__ \t __"} and names == {"name", "date", "place", "user", "site_url"}
    model, lines = residue.ResidueModel(slots, names, {}, set()), line_model.LineModel({}, -1.0)
    found = lambda t: model.residue("markdown_body", "http://h.example/", t, lines)
    assert found("The meeting is on {{ date }} at noon.") and found("Come on [DATE] to [PLACE].") and found("Dear __USER__,") and found("Name: ........\nAge: 7") and found("Signed by ______ today")
    assert not found("Write `{{date}}` for the date.") and not found("He came [no] and went [date].") and not found("______\n\nA rule above.") and not found("Wait..... what?")


def test_whole_page_templates_and_filler(spark):
    usual = [f"The office of place number {i} lends its river meter to all farmers who ask for it in time and pay the fee of the year at the bank." for i in range(60)]
    errors = [f"404 not found. Request {i} failed." for i in range(8)] + ["NOT  FOUND. The request failed.", "Lorem ipsum dolor amet."] * 2
    long_filler = "Ipsum lorem amet dolor. Dolor lorem amet ipsum. " * 30
    rows = [(f"http://h{i % 7}.example/{i}", None, t) for i, t in enumerate([*usual, *errors, long_filler])]
    df = pages(spark, rows)
    lines = line_model.LineModel({}, -1.0)
    model = residue.fit(df, lines)
    got = {r.url for r in residue.residue_fields(df, model, lines).collect()}
    assert got == {u for u, _, t in rows if t not in usual}
    assert not model.residue("markdown_body", "http://h.example/", "A human error was noted by the office of the place.", lines)
    one_line = "404 not found. Request 99 failed. " + "[x](http://h.example/" + "x" * 500 + ")"  # no line is too long to be looked at
    assert model.residue("markdown_body", "http://h.example/", one_line, lines)
    assert residue.residue_fields(df.limit(0), model, lines).count() == 0


def brute_cut(source, sink, edges):
    best, side = None, None
    for bits in range(1 << len(source)):
        s = [bool(bits >> i & 1) for i in range(len(source))]
        cost = sum(source[i] for i in range(len(s)) if not s[i]) + sum(sink[i] for i in range(len(s)) if s[i]) + sum(c for a, b, c in edges if s[a] != s[b])
        if best is None or cost < best - 1e-12:
            best, side = cost, s
    return best


def test_min_cut_is_minimal():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n = int(rng.integers(2, 8))
        source, sink = rng.random(n).round(2).tolist(), rng.random(n).round(2).tolist()
        edges = [(i, j, round(float(rng.random()), 2)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]
        s = main_content.max_flow_side(source, sink, edges)
        cost = sum(source[i] for i in range(n) if not s[i]) + sum(sink[i] for i in range(n) if s[i]) + sum(c for a, b, c in edges if s[a] != s[b])
        assert abs(cost - brute_cut(source, sink, edges)) < 1e-9


def test_long_cuts_are_minimal_and_linear():
    rng = np.random.default_rng(4)
    old = main_content.FLOW_NODES
    for n in (3, 9, 9, 9, 400):
        u = np.where(np.arange(n) % 2, 1.0, -1.0) * rng.random(n)
        source, sink = np.maximum(u, 0).tolist(), np.maximum(-u, 0).tolist()
        edges = [(i - 1, i, 1.5) for i in range(1, n)] + [(i - i % 5, i, 2.0) for i in range(n) if i % 5 > 1]
        value = lambda s: sum(source[i] for i in range(n) if not s[i]) + sum(sink[i] for i in range(n) if s[i]) + sum(c for a, b, c in edges if s[a] != s[b])  # noqa: E731, B023
        try:
            main_content.FLOW_NODES = 10_000
            flow = value(main_content.max_flow_side(source, sink, edges))
            main_content.FLOW_NODES = 0
            assert abs(value(main_content.max_flow_side(source, sink, edges)) - flow) < 1e-9
        finally:
            main_content.FLOW_NODES = old
        if n < 10:
            assert abs(flow - brute_cut(source, sink, edges)) < 1e-9


def test_related_block_goes_with_its_caption():
    model = line_model.LineModel({"related": 4.0}, -0.5)
    text = "# T\n\nlong entry text stands here. It goes on for long.\n\nRelated\n* one two\n- three four\n\nmore entry text. It ends here, at last."
    assert main_content.furniture(text, "http://h.example/", None, set(), model) == [5, 6, 7]


def test_tree_pairs_equal_brute_force():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, (40, 32), dtype=np.uint8)
    near = np.packbits(rng.random((120, 256)) < 0.03, axis=1) ^ base[:1]
    prints = np.concatenate([base, base ^ (1 << rng.integers(0, 8, base.shape)).astype(np.uint8) * (rng.random(base.shape) < 0.3), near])
    prints = np.ascontiguousarray(prints[rng.permutation(len(prints))]).view(np.uint64)
    sizes = rng.integers(40, 200, len(prints))
    near = [(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints)) if int(near_dup.distances(prints[i], prints[j])) <= 60]
    tally = {}
    assert set(near_dup.tree_pairs(prints, radius=60, leaf=8, tally=tally)) == set(near)
    assert tally["split"] > 0  # the cluster is parted from the others
    want = {(i, j) for i, j in near if min(sizes[i], sizes[j]) >= 0.6 * max(sizes[i], sizes[j])}
    assert set(near_dup.tree_pairs(prints, sizes, radius=60, leaf=8)) == want
    order = np.argsort(sizes, kind="stable")
    a, b = near_dup.small_pairs(np.zeros(len(order), np.int64), sizes[order], prints[order], radius=60)
    assert {tuple(sorted((int(order[i]), int(order[j])))) for i, j in zip(a, b, strict=True)} == want


def test_keys_needed():
    assert near_dup.keys_needed(1000, 0) == 23  # 0.4 ** 23 < 1e-9
    assert near_dup.keys_needed(40, 0) == 17  # enough for certain
    assert near_dup.keys_needed(1000, 590) > 300 and near_dup.keys_needed(1000, 600) == 401


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for g in range(12):
        words = [f"w{x}" for x in rng.integers(0, 300, 60)]
        for k in range(3):
            w = list(words)
            for _ in range(int(rng.integers(0, 5))):
                w[int(rng.integers(0, 60))] = f"n{rng.integers(0, 999)}"
            rows.append((f"u{g}-{k}", None, " ".join(w)))
    rows += [("copy", None, rows[0][2]), ("short", None, "a b c"), rows[1]]

    def runs(t):
        w = t.lower().split()
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}

    want = set()
    for a, _, x in rows:
        for b, _, y in rows:
            if a < b and len(x.split()) >= 40 and len(y.split()) >= 40 and len(runs(x) & runs(y)) >= 0.6 * len(runs(x) | runs(y)):
                want.add((a, b))
    df = pages(spark, rows)
    assert {(r.url_a, r.url_b) for r in near_dup.near_duplicates(df).collect()} == want
    old, near_dup.HOT = near_dup.HOT, 2  # most shards are hot: bands and blocks
    try:
        assert {(r.url_a, r.url_b) for r in near_dup.near_duplicates(df).collect()} == want
    finally:
        near_dup.HOT = old
    degree = {(r["url"], r["class"]): (r.copies, r.links) for r in near_dup.near_duplicate_classes(df).collect()}
    assert degree["copy", "copy"] == (2, len({b for a, b in want if a == "copy"} - {"u0-0"})) and degree["u0-0", "copy"] == degree["copy", "copy"]
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_language_codes_and_network():
    assert [language.code_of(x) for x in ("bn-BD", "বাংলা", "bn_Latn", "ENG", "und", "", None)] == ["bn", "bn", "bn-Latn", "en", None, None, None]
    samples = [("en", "the officer said that we must go to the office now and then") for _ in range(3)] + [("hi", "ज़िला कार्यालय में सूचना दी जाती है और फिर से") for _ in range(3)]
    net = language.train(samples, steps=40)
    lab = language.Labeller(net)
    text = "the office is open to all of us and them today. ज़िला कार्यालय में सूचना दी जाती है और फिर से सूचना दी।"
    ids = language.byte_ids(text)
    main, conf, segments = lab.describe(text, ids, lab.probabilities([ids])[0])
    assert {s[2] for s in segments} == {"en", "hi"}


def test_segments_hold_every_letter(spark):
    samples = [("en", "the officer said that we must go to the office now and then") for _ in range(3)] + [("hi", "ज़िला कार्यालय में सूचना दी जाती है और फिर से") for _ in range(3)]
    net = language.train(samples, steps=40)
    texts = ["hi", "go now. सूचना दी।", "सूचना\n\ngo to the office. now", "...", "", None, "the office is open to all of us and them today and then again. " * 40]
    df = pages(spark, [(f"u{i}", None, t) for i, t in enumerate(texts)])
    got = {r.url: r.segments for r in language.labelled(df, net, least_text=0, least=0).collect()}
    for i, t in enumerate(texts):
        inside = "".join(t[x.start : x.end] for x in got.get(f"u{i}", ())) if t else ""
        assert [c for c in inside if c.isalpha()] == [c for c in t or "" if c.isalpha()]
        assert all(a.end <= b.start and a.lang != b.lang for a, b in zip(got.get(f"u{i}", ()), got.get(f"u{i}", ())[1:], strict=False))
    assert set(got) == {"u0", "u1", "u2", "u6"}
    codes = ["bn-BD", "বাংলা", " bn_Latn", "ENG", "en-Latn", "und", "", "  ", "-", "latn", None]
    cols = spark.createDataFrame([(x,) for x in codes], "x string").select(language.code_column(F.col("x")).alias("c")).collect()
    assert [r.c for r in cols] == [language.code_of(x) for x in codes]


@pytest.mark.parametrize("n", [0, 1, 2000, 2001, 9000])
def test_cuts_cover_the_text(n):
    rng = np.random.default_rng(n)
    text = "".join(rng.choice(list("abcde  .\n।"), n))
    c = splitting.cuts(text)
    assert all(0 < e - a <= 2000 for a, e in c)
    assert all(0 <= e - a2 <= 300 and a2 > a for (a, e), (a2, _) in zip(c, c[1:], strict=False))
    assert not n or (c[0][0] == 0 and c[-1][1] == n)
    assert len(splitting.cuts("x" * 5000)) == 3
    old, splitting.STRETCH = splitting.STRETCH, 10  # tables by stretches give the same cuts
    try:
        assert splitting.cuts(text) == c
    finally:
        splitting.STRETCH = old


def test_pieces_never_start_within_a_character():
    text = "কি" * 3000
    assert all(text[a] == "ক" for a, _ in splitting.cuts(text))


def test_range_max():
    v = np.random.default_rng(0).integers(0, 99, 200)
    t = splitting.RangeMax(v, 64)
    assert all(t.query(a, a + w) == v[a : a + w].max() for a in range(130) for w in (1, 2, 3, 31, 64))


def test_packing_plan():
    rng = np.random.default_rng(3)
    sizes = np.minimum(rng.geometric(0.01, 4000), 255).tolist()
    histogram = {int(n): sizes.count(n) for n in set(sizes)}
    plan = packing.Plan(histogram, 256, groups=12)
    load, used = {}, {}
    for n, c in histogram.items():
        for r in range(c):
            s = plan.slot(n, r)
            if s is not None:
                load[s] = load.get(s, 0) + n
    space = {}
    for s in load.values():
        assert s <= 256
        space[256 - s] = space.get(256 - s, 0) + 1
    moves, opened = packing.best_fit(space, plan.left(histogram), 256)
    placed = sum(k for m in moves.values() for _, k, _, _ in m)
    assert placed + sum(1 for n, c in histogram.items() for r in range(c) if plan.slot(n, r) is not None) == len(sizes)
    for n, ms in moves.items():
        for _, k, cls, at in ms:
            for i in range(k):
                used[(cls, at + i)] = used.get((cls, at + i), 0) + n
    assert all(v <= (256 if cls < 0 else cls) for (cls, _), v in used.items())
    assert len(load) + opened <= 1.1 * sum(sizes) / 256 + 2


def test_ranks_by_buckets(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id % 3 AS INT) AS v")
    histogram = {0: 334, 1: 333, 2: 333}
    for rows in (100_000, 40):
        old, packing.BUCKET_ROWS = packing.BUCKET_ROWS, rows
        try:
            got = packing.ranked(df, "v", histogram, "id").collect()
        finally:
            packing.BUCKET_ROWS = old
        for v, n in histogram.items():
            assert sorted(r.rank for r in got if r.v == v) == list(range(n))


def test_leaks(spark):
    words = leakage.Words()
    item = "which papers are needed when the river meter of the old loom store has been lent to a poet"
    index = leakage.ItemIndex([(5, item), (6, "x"), (7, "solar power plant"), (8, "two words")], words)
    hit = "So it goes: WHICH papers, are *needed* when the river metre of the old loom store! And then on."
    miss = "which papers are needed when nobody asks for them in the end"
    assert leakage.leaked([words(hit), words(miss), words(""), words("A solar, power plant."), words("some two"), words("power then solar")], index) == [{5}, set(), set(), {7}, {8}, set()]
    docs = spark.createDataFrame([(1, hit), (2, miss), (3, None), (4, "solar power plant"), (1, hit)], "doc_id long, text string")
    items = spark.createDataFrame([(5, item, None), (7, None, "solar power plant"), (9, "", None)], "item_id long, queries string, expected_answer string")
    want = {(1, 5), (4, 7)}
    for words_a_block, together in ((leakage.BLOCK_WORDS, leakage.BLOCKS_TOGETHER), (1, 1), (1, 2)):
        old = leakage.BLOCK_WORDS, leakage.BLOCKS_TOGETHER
        leakage.BLOCK_WORDS, leakage.BLOCKS_TOGETHER = words_a_block, together
        try:
            assert {(r.doc_id, r.item_id) for r in leakage.leaks(docs, items).collect()} == want and leakage.leaks(docs, items).count() == 2
        finally:
            leakage.BLOCK_WORDS, leakage.BLOCKS_TOGETHER = old
    assert leakage.leaks(docs, items.limit(0)).count() == leakage.leaks(docs.limit(0), items).count() == 0


def test_leaks_reach_the_recall_on_planted_edits():
    rng = np.random.default_rng(9)
    words = leakage.Words()
    items = [" ".join(f"w{x}" for x in rng.integers(0, 800, int(rng.integers(4, 90)))) for _ in range(150)]
    index = leakage.ItemIndex(list(enumerate(items)), words)
    noise = lambda n: words(" ".join(f"n{x}" for x in rng.integers(0, 5000, n)))
    planted = [(k, np.concatenate([noise(40), leakage.edited(words(items[k]), rng), noise(40)])) for k in rng.integers(0, len(items), 1200).tolist()]
    true = [(k, t) for k, t in planted if leakage.held(words(items[k]).tolist(), t.tolist()) >= 0.5 * len(items[k].split())]
    got = leakage.leaked([t for _, t in true], index)
    assert len(true) > 500 and sum(k in g for (k, _), g in zip(true, got, strict=True)) >= 0.99 * len(true)


def test_sentences():
    model = line_model.LineModel(sentences.PRIOR | {"p\tnupper": 2.0, "p\trnever": -8.0, "p\tnlower": -8.0, "p\tndigit": -8.0}, 0.0)
    s = sentences.Splitter(model, {"Dr", "No"})
    cut = lambda t: [t[a:b].strip() for a, b in zip([0, *s.ends(t)], s.ends(t), strict=False)]
    assert cut("We saw Dr. Bemi at No. 7 today. It cost 3.5 taka... or more.") == ["We saw Dr. Bemi at No. 7 today.", "It cost 3.5 taka... or more."]
    assert cut("তিনি বলেন, “এটা হয়। ওটা হয়।” তবে কাজ হলো। শেষ হয়।পরে হলো ।") == ["তিনি বলেন, “এটা হয়। ওটা হয়।” তবে কাজ হলো।", "শেষ হয়।", "পরে হলো ।"]
    assert cut("# Head\n\n1. One. Two\n2) Three\n\nA line\nbroken here") == ["# Head", "1. One. Two", "2) Three", "A line\nbroken here"]
    assert cut("会议（信息。）继续。好！") == ["会议（信息。）继续。", "好！"]
    assert cut("กขค 24 กขค งจฉ") == ["กขค 24 กขค", "งจฉ"]
    assert s.ends("") == [] and s.ends(" \n") == []


def test_residue_beside_long_furniture():
    model = line_model.LineModel({w: 4.0 for w in ("home", "notice", "services", "contact")}, -2.0)
    odds = {w: 2.0 for w in ("forbidden", "permission", "folder", "lorem", "ipsum", "dolor")} | {w: -3.0 for w in ("river", "office", "lends", "its")}
    found = residue.ResidueModel(set(), set(), odds, set())
    menu = " | ".join(["Home", "Notice", "Services", "Contact"] * 10)
    assert 300 < len(menu) < 400
    for n in (1, 20):
        assert found.residue("markdown_body", "http://h.example/1", menu * n + "\n\n# 403 Forbidden\n\nYou have no permission to open this folder.", model)
        assert not found.residue("markdown_body", "http://h.example/2", menu + "\n\n" + "The river office lends its meters. " * n, model)
        assert found.residue("markdown_body", "http://h.example/3", menu + "\n\n" + "Lorem ipsum dolor. " * n, model)


def test_own_title_is_found_on_any_line():
    lines = ["A Notice of Weavers", *[f"plain words {chr(97 + i % 26)}" for i in range(60)], "share: A Notice of Weavers"]
    assert common.titles_of(None, lines) == ["A Notice of Weavers"]


def test_residue_beyond_what_a_task_holds(spark):
    usual = [f"The office of place number {i} lends its river meter to all farmers who ask for it in time and pay the fee of the year at the bank." for i in range(60)]
    errors = [f"404 not found. Request {i} failed." for i in range(8)] + ["Lorem ipsum dolor amet."] * 2 + [f"Quota {i} of page views spent." for i in range(4)]
    slots = [f"{usual[i]} Ask {m % w} there." for i, (m, w) in enumerate((m, w) for m in ("{{ %s }}", "%%%% %s %%%%", "[insert %s here]", "__%s__") for w in ("name", "date", "place", "name", "date"))]
    slots += [f"{usual[0]} [{w}]" for w in ("no", "yes", "perhaps", "so")] * 2
    rows = [(f"http://h{i % 7}.example/{i}", None, t) for i, t in enumerate([*usual, *errors, *slots])]
    df, lines = pages(spark, rows), line_model.LineModel({}, -1.0)
    fitted = residue.fit(df, lines)
    want = {r.url for r in residue.residue_fields(df, fitted, lines).collect()}
    assert len(want) >= 30 and fitted.templates and not fitted.beyond
    ordinary = {u for u, _, _ in rows} - want
    old = residue.MOST_WORDS, residue.MOST_PIECES, residue.MOST_TEMPLATES, residue.BROADCAST_BYTES
    try:
        for bounds in ((3, 1, 0, old[3]), (3, 1, 0, 0), (old[0], 18, *old[2:])):
            residue.MOST_WORDS, residue.MOST_PIECES, residue.MOST_TEMPLATES, residue.BROADCAST_BYTES = bounds
            model = residue.fit(df, lines)
            assert bool(model.beyond) == (bounds[1] != 18) and len(model.words) <= bounds[0] and len(model.templates) <= bounds[2]
            assert {r.url for r in residue.residue_fields(df, model, lines).collect()} == want
            left, test = residue.kept(df, model, lines)
            assert {r.url for r in left.collect() if test(r.tbl, r.url, r.field, r.text)} == ordinary
    finally:
        residue.MOST_WORDS, residue.MOST_PIECES, residue.MOST_TEMPLATES, residue.BROADCAST_BYTES = old


def test_cut_pages_reads_texts_to_their_end(spark):
    model = line_model.LineModel({"related": 6.0, "menu": 6.0}, -0.5)
    entry = "\n\n".join(f"Entry text number {i} stands here. It goes on for long." for i in range(3000))
    df = pages(spark, [("http://h.example/1", None, f"# T\n\n{entry}\n\nrelated menu")])
    fitted = residue.ResidueModel(set(), set(), {"entry": -1.0}, set())
    assert [r.line_no for r in main_content.furniture_lines(df, model, fitted).collect()] == [6003]
    assert main_content.entries(df, model, fitted).first().text == f"# T\n\n{entry}\n"


def test_all_language_samples_train_the_network(spark, tmp_path):
    from shapla.llm import queries

    rows = [(i, "en", "the officer said that we must go to the office") for i in range(2100)] + [(9999, "hi", "ज़िला कार्यालय में सूचना दी जाती है")]
    spark.createDataFrame(rows, "sample_id long, lang string, text string").write.parquet(str(tmp_path / "lang_samples.parquet"))
    assert queries.language_network(spark, str(tmp_path)).langs == ["en", "hi"]
    assert language.steps_for(64_333) == language.STEPS and language.steps_for(10_000_000) * language.DRAWN * language.WINDOW >= 10_000_000


def test_what_steps_share_of_a_page_is_made_once(monkeypatch):
    made = []
    features = line_model.line_features
    monkeypatch.setattr(line_model, "line_features", lambda line, *rest: made.append(line) or features(line, *rest))
    text = "# Title\n\nmenu one\u200b two\n\nPublished\u00a0by Rahim Uddin, 3 মে 2021\n\nSooooo 𝟎x long! An entry. Ἕξω ΣΣΣΣ"
    model = line_model.LineModel({"entry": -2.0}, -0.5)
    assert main_content.furniture(text, "http://h.example/", None, {3}, model) == [3]
    assert made == text.split("\n")[4::2]  # neither the title nor what is repeated needs a score
    page = common.Page("http://h.example/", text)
    assert [page.plain(i) for i in range(1, 8)] == [common.plain(x) for x in page.lines]
    assert [ws for *_, ws in residue.worded(page)] == [residue.tokens(x) for x in page.lines[::2]]
    assert common.line_key(page.lines[4], []) == common.line_key("Published by Ab Cd, 4 May 2020", []) == "Published by,"
    lower = common.Page(None, "One of THEM\n[a](http://b.example/C) Two\nΑΣ")
    assert lower.small() and [ws for *_, ws in residue.worded(lower)] == [residue.tokens(x) for x in lower.lines] == [["one", "of", "them"], ["a", "two"], ["ας"]]


def test_positions_are_those_of_the_trained_network():
    net = language.train([("en", "the officer said that we must go"), ("hi", "ज़िला कार्यालय में सूचना दी जाती है")], steps=5)
    net.p["fe"][:, 0x61] *= 2000  # inputs beyond the range of exp
    ids = np.random.default_rng(3).integers(0, 65536, (language.WINDOW, 7)).astype(np.int32)
    ids[3:9] = ord("a")
    with np.errstate(over="raise", invalid="raise"):
        states = np.concatenate([net.run(ids, d)[0] for d in "fb"], axis=2)
        got = net.positions(ids)
    odds = np.exp(states @ net.p["o"] + net.p["ob"])
    assert np.abs(got - odds / odds.sum(axis=2, keepdims=True)).max() < 1e-5
    sizes = {a.shape for d in "fb" for pair in net.gates(d) for a in pair}
    assert sizes == {(65536, language.HIDDEN), (language.HIDDEN, language.HIDDEN)} and all(a.flags.c_contiguous for d in "fb" for pair in net.gates(d) for a in pair)
