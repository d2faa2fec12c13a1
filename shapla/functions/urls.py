"""URL functions as Column expressions (no UDFs, so filters and codegen stay in the JVM)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def domain_of(url: Column, suffix: str = ".gov.bd") -> Column:
    """Host below `suffix`, lower-cased, without port and one leading `www.`; NULL for anything else.

    A user-info part makes the text before the first colon the host, so such urls give NULL.
    """
    host = F.split_part(F.lower(F.regexp_extract(url, AUTHORITY, 1)), F.lit(":"), F.lit(1))
    host = F.regexp_replace(host, r"^www\.", "")
    return F.when(host.endswith(suffix), host)


def page_key(url: Column) -> Column:
    """One key for all spellings of a page: scheme, host case, `www.`, port 80/443, fragment and end slashes dropped."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), r"#[\s\S]*$", ""), r"^(?i)https?://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r"^www\.", "")
    host = F.regexp_replace(host, r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(rest, r"^[^/?]*", ""), r"/+$", "")
    return F.concat(host, path)


def key_host(key: Column) -> Column:
    return F.regexp_extract(key, r"^[^/?]*", 0)


def without_dots(path: Column, inner: bool) -> Column:
    """A path with its `.` and `..` segments resolved; `inner` drops empty segments between the first and the last."""
    segs = F.split(path, "/")
    n = F.size(segs)
    if inner:
        segs = F.filter(segs, lambda x, i: (x != "") | (i == 0) | (i == n - 1))
    last = F.element_at(segs, -1)
    kept = F.aggregate(segs, F.array().cast("array<string>"), lambda acc, x: F.when(x == ".", acc).when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x))))
    out = F.array_join(F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    return F.when(out.startswith("/"), out).otherwise(F.concat(F.lit("/"), out))


def resolve_href(base: Column, href: Column) -> Column:
    """`urljoin(base, strip(href))` without fragment: absolute, `//`, root, `?` and relative references with dot segments."""
    h = F.split_part(F.regexp_replace(href, r"(?U)^\s+|\s+$", ""), F.lit("#"), F.lit(1))
    base = F.split_part(base, F.lit("#"), F.lit(1))
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    root = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", 0)
    bare = F.split_part(base, F.lit("?"), F.lit(1))
    path = F.regexp_replace(F.substring(bare, F.length(root) + 1, F.length(bare)), r"[^/]*$", "")
    hpath, query = F.split_part(h, F.lit("?"), F.lit(1)), F.regexp_extract(h, r"^[^?]*(\?[\s\S]*)$", 1)
    below = F.concat(F.when(path == "", F.lit("/")).otherwise(path), hpath)
    return (
        F.when(h == "", base)
        .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("?"), F.concat(bare, h))
        .when(h.startswith("/"), F.concat(root, without_dots(hpath, False), query))
        .otherwise(F.concat(root, without_dots(below, True), query))
    )


#: The entities that stand in urls and plain text of pages.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def unescape(c: Column) -> Column:
    for a, b in ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def html_hrefs(html: Column) -> Column:
    """Targets of all anchors, in double, single or no quotes, in any letter case, entities resolved."""
    found = F.regexp_extract_all(html, F.lit(r"""(?is)<a\s(?:[^>"']|"[^"]*"|'[^']*')*?(?<=\s)href\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+)"""), F.lit(0))
    quoted = lambda m, q: F.regexp_extract(m, f"(?s){q}([^{q}]*){q}$", 1)
    value = lambda m: F.when(m.endswith('"'), quoted(m, '"')).when(m.endswith("'"), quoted(m, "'")).otherwise(F.regexp_extract(m, r"(?is)href\s*=\s*([^\s>]*)$", 1))
    return F.transform(found, lambda m: unescape(value(m)))


#: Fixed value: a markdown link to an absolute http(s) url; the url ends at white space or the first `)`.
MARKDOWN_LINK = r"\[[^\n]*?\]\((https?://[^\s\)]+)\)"


def markdown_hrefs(markdown: Column) -> Column:
    return F.regexp_extract_all(markdown, F.lit(MARKDOWN_LINK), F.lit(1))


def title_of(url: Column) -> Column:
    """Title after the last `title=`, percent-decoded (a bad escape leaves it as it is), `_` as space."""
    raw = F.replace(F.substring_index(url, "title=", -1), F.lit("+"), F.lit("%2B"))
    return F.replace(F.coalesce(F.try_url_decode(raw), F.substring_index(url, "title=", -1)), F.lit("_"), F.lit(" "))


def url_of_title(title: Column, base: str = "https://kosh.example/index?title=") -> Column:
    return F.concat(F.lit(base), F.replace(title, F.lit(" "), F.lit("_")))


def candidates(domain: Column) -> Column:
    """The https and the http address of a domain, in order of preference."""
    return F.array(F.concat(F.lit("https://"), domain), F.concat(F.lit("http://"), domain))


def fetched(code: Column) -> Column:
    """Whether a page counts as fetched: only with status 200; no answer is no page."""
    return F.coalesce(code == 200, F.lit(False))


def alive(code: Column) -> Column:
    """Whether a host counts as alive: any status below 400."""
    return F.coalesce(code < 400, F.lit(False))
