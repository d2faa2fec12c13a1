"""A logistic model of page furniture, trained on lines that repetition within big sources has labelled."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapla.llm.common import HOST, INTRODUCED, NAME, Page, has_any, hash64, host_of, plain
from shapla.llm.repeated_lines import MIN_URLS, page_keys

#: At most about so many pages label the model; everything else runs over all pages.
MIN_HOSTS = 3
TRAIN_PAGES, TRAIN_HOSTS = 6000, 400
#: Spaces one by one, as they are then found in the same table as the marks.
WORD = re.compile(r"[^\W\d_][^%s\d|»>/,:;.!?।()\[\]\"“”]*" % "".join(c for c in map(chr, range(0x3001)) if c.isspace()))
END = re.compile(r"[.!?।۔॥](?=[\s*\"”’)]|$)")
OWN = re.compile(r"\]\((https?://([^/)\s]*)[^)\s]*)\)")


def line_features(line: str, host: str, before_blank: bool, after_blank: bool, rank: int, left: int) -> list[str]:
    """Words and shape of a line; names starting with a tab are shape."""
    s = line.strip()
    bold = s.startswith("**")
    s = s.strip("*").strip()
    kind = "#" if s.startswith("#") else "|" if s.startswith("|") else ">" if s.startswith(">") else "-" if s[:2] in ("- ", "+ ") or line.lstrip()[:2] == "* " else "p"
    feats = []
    links = OWN.findall(s) if "](" in s else []
    if links:
        own = sum(h.lower().removeprefix("www.") == host.removeprefix("www.") for _, h in links)
        feats.append("\town%d" % min(own, 3) if own else "\tfile" if "/file/" in links[0][0] else "\tlink")
        s = OWN.sub("]", s)
    words = WORD.findall(s.lower())
    n, end = len(words), END.search(s)
    ends = 0 if end is None else 1 if END.search(s, end.end()) is None else 2
    size = 0 if n < 3 else 1 if n < 6 else 2 if n < 9 else 3 if n < 15 else 4 if n < 25 else 5
    feats += ["\t%s%d.%d" % (kind, size, ends), "\tblank%d%d" % (before_blank, after_blank), "\ttop%d" % min(rank, 4), "\tleft%d" % min(left, 4)]
    if bold:
        feats.append("\tbold%d" % min(ends, 1))
    if kind != "|" and ("|" in s or "»" in s or " > " in s or " / " in s):
        feats.append("\tpath")
    if "©" in s:
        feats.append("\tcopyright")
    if DIGITS.search(s):
        feats.append("\tdigits%d" % (size > 2))
        if has_any(s, INTRODUCED) and NAME.search(" ".join(s.split())):
            feats.append("\tbyline%d" % min(ends, 1))
    return feats + words


DIGITS = re.compile(r"\d")


class LineModel:
    """Weights by feature; words that the training pages don't have count nothing."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def score(self, feats: list[str]) -> float:
        """Log odds of being furniture."""
        return self.bias + sum(map(self.weights.get, feats, repeat(0.0)))

    def wording(self, feats: list[str]) -> float:
        """The part of the log odds that comes from words."""
        get = self.weights.get
        return sum([get(f, 0.0) for f in feats if f[0] != "\t"])

    def knows(self, feats: list[str]) -> bool:
        """Whether the training pages had most of a line's words."""
        words = [f for f in feats if f[0] != "\t"]
        return sum(f in self.weights for f in words) >= 0.7 * len(words)


def page_lines(text: str, url: str) -> list[tuple[int, str, list[str]]]:
    """(line number, line, features) of each line that isn't blank."""
    return [(no, line, feats()) for no, line, feats in lazy_lines(Page(url, text))]


def lazy_lines(page: Page) -> list[tuple[int, str, Callable[[], list[str]]]]:
    """page_lines with functions that make the features, for callers that need those of few lines; made once a page."""
    if page.rows is not None:
        return page.rows
    lines = page.lines
    full = [bool(x.strip(" \t\r-*_=")) for x in lines]
    total, rank, out = sum(full), 0, []
    for i, line in enumerate(lines):
        if full[i]:
            before = i == 0 or not full[i - 1]
            after = i + 1 == len(lines) or not full[i + 1]
            out.append((i + 1, line, partial(line_features, line, page.host, before, after, rank, total - rank - 1)))
            rank += 1
    page.rows = out
    return out


def train(labelled: list[tuple[list[str], int]], epochs: int = 6, rate: float = 0.3, decay: float = 1e-5, prior: dict[str, float] | None = None) -> LineModel:
    """Logistic regression by Adagrad over binary features, in numpy; deterministic. `prior` holds the weights it starts from."""
    prior = prior or {}
    names = sorted({f for feats, _ in labelled for f in feats} | set(prior))
    index = {f: i for i, f in enumerate(names)}
    rows = [np.array([index[f] for f in set(feats)], np.int64) for feats, _ in labelled]
    y = np.array([v for _, v in labelled], np.float64)
    first = np.array([prior.get(f, 0.0) for f in names])
    w, g, bias, gb = first.copy(), np.full(len(names), 1e-2), 0.0, 1e-2
    order = np.argsort([hash64(str(i)) for i in range(len(rows))])
    for _ in range(epochs):
        for at in range(0, len(order), 256):
            ids = order[at : at + 256]
            sizes = np.array([len(rows[i]) for i in ids])
            cols, of = np.concatenate([rows[i] for i in ids]), np.repeat(np.arange(len(ids)), sizes)
            z = bias + np.bincount(of, w[cols], len(ids))
            err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[ids]
            grad = np.bincount(cols, err[of], len(names))
            hit = np.unique(cols)
            grad = grad[hit] / 16 + decay * (w[hit] - first[hit])
            g[hit] += grad**2
            w[hit] -= rate * grad / np.sqrt(g[hit])
            db = err.sum() / 16
            gb += db * db
            bias -= rate * db / np.sqrt(gb)
    return LineModel({f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-3}, float(bias))


def pointer(line: str) -> str:
    """The words before the colon of a short line that points to something, or ""."""
    head, colon, tail = plain(line).partition(":")
    return head if colon and tail and len(head.split()) <= 3 and len(tail.split()) <= 12 and line.lstrip()[:1] not in "#|>" and not END.search(line) else ""


def surely_entry(feats: list[str]) -> bool:
    """Whether a line that doesn't repeat may label the entry: headings, tables, quotations, long items, paragraphs.

    Short lines without an end and single sentences are left out, as a small source's furniture looks so too.
    """
    shape = next(f for f in feats if f[0] == "\t" and f[1] in "#|>-p" and f[2:3].isdigit())
    kind, size, ends = shape[1], int(shape[2]), int(shape[4])
    return kind in "#|>" or (kind == "-" and size >= 3 and "\town1" not in feats) or (kind == "p" and ends == 2 and size >= 3) or size == 5


def fit(pages: DataFrame, max_pages: int = TRAIN_PAGES) -> LineModel:
    """The model from a bounded sample: whole sources with many pages, at most about `max_pages` pages in all.

    Within the sample the lines that repeat in their source, that several sources share, or that point to something in
    the same words ("see also: ..."), are furniture; of the rest
    those that surely belong to an entry stand for it. Of a source larger
    than a quarter of the bound, pages are drawn by the hash of their url.
    """
    hosts = pages.groupBy("tbl", F.lower(F.regexp_extract("url", HOST.pattern, 1)).alias("host")).agg(F.count(F.lit(1)).alias("n"))
    most = hosts.agg(F.max("n")).first()[0] or 0
    drawn = hosts.where(F.col("n") >= min(40, most)).orderBy(F.xxhash64("tbl", "host")).limit(TRAIN_HOSTS).collect()
    chosen, total = [], 0
    by_table: dict[str, int] = {}
    for r in drawn:
        every = max(1, -(-r.n // (max_pages // 4)))
        if by_table.get(r.tbl, 0) < max_pages // 2 and total < max_pages:
            chosen.append((r.tbl, r.host, every))
            by_table[r.tbl] = by_table.get(r.tbl, 0) + r.n // every
            total += r.n // every
    if not chosen:
        return LineModel({}, -1.0)
    spark = pages.sparkSession
    chosen_df = F.broadcast(spark.createDataFrame(chosen, "tbl string, host string, every int"))
    near = pages.withColumn("host", F.lower(F.regexp_extract("url", HOST.pattern, 1))).join(chosen_df, ["tbl", "host"])
    near = near.where(F.pmod(F.xxhash64("url"), F.col("every")) == 0).select("tbl", "url", "title", "text")
    got = near.distinct().collect()  # bounded by max_pages
    urls: dict[int, set[str]] = {}
    hosts_of: dict[int, set[str]] = {}
    keyed = []
    for r in got:
        host = host_of(r.url)
        nos, keys = page_keys(r.tbl, host, r.title, r.text)
        _, anywhere = page_keys("", "", r.title, r.text)
        keyed.append(dict(zip(nos, zip(keys, anywhere, strict=True), strict=True)))
        for k, a in zip(keys, anywhere, strict=True):
            urls.setdefault(k, set()).add(r.url)
            hosts_of.setdefault(a, set()).add(host)
    pointed: dict[str, set[str]] = {}
    for r in got:
        for line in r.text.split("\n"):
            if p := pointer(line):
                pointed.setdefault(p, set()).add(r.url)
    labelled = []
    for r, keys in zip(got, keyed, strict=True):
        mine = []
        for no, line, feats in page_lines(r.text, r.url):
            if no in keys:
                k, a = keys[no]
                if len(urls[k]) >= MIN_URLS or len(hosts_of[a]) >= MIN_HOSTS or len(pointed.get(pointer(line), ())) >= MIN_URLS:
                    mine.append((feats, 1))
                elif surely_entry(feats):
                    mine.append((feats, 0))
        if any(v == 0 and any(f.startswith("\tp") and f[2:3].isdigit() for f in feats) for feats, v in mine):  # a page without paragraphs, such as an error page, shows nothing of furniture
            labelled += mine
    return train(sorted(labelled))
