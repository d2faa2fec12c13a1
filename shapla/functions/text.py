"""Text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapla.functions.urls import unescape

TOKEN = r"[\p{L}\p{N}_]+"
# Lines of a standard page frame, two of which end the page; markers of exported summaries and articles.
JUNK = [
    "অফিসের ধরণ নির্বাচন করুন", "এক্সেসিবিলিটি মেনুতে যান", "বাংলাদেশ জাতীয় তথ্য বাতায়ন", "অফিস স্তর নির্বাচন করুন", "বিভাগ নির্বাচন করুন",
    "জেলা নির্বাচন করুন", "উপজেলা নির্বাচন করুন", "হটলাইন", "মেনু নির্বাচন করুন", "জরুরি সেবা নম্বরসমূহ", "ফন্ট বৃদ্ধি ফন্ট হ্রাস",
    "স্ক্রিন রিডার ডাউনলোড করুন", "© 2026 সর্বস্বত্ব সংরক্ষিত", "পরিকল্পনা এবং বাস্তবায়ন",
]
FOOTERS = ["© 2026 সর্বস্বত্ব সংরক্ষিত", "জরুরি সেবা নম্বরসমূহ"]
SUMMARY_OPENS, SUMMARY_CLOSES = "**সারসংক্ষেপ (Summary):**", "**কিওয়ার্ড"
ARTICLE_ENDS = ["'[http", "লুকানো বিষয়শ্রেণী:"]


def trim_ws(c: Column) -> Column:
    """Strips all Unicode white space."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def tokens(c: Column) -> Column:
    """Lower-cased runs of letters, numbers and underscores; marks part words. NULL gives an empty array."""
    return F.coalesce(F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0)), F.array().cast("array<string>"))


def between(c: Column, opens: str, closes: str) -> Column:
    """Text after the first `opens` up to the next `closes`, trimmed; empty without `opens`."""
    return trim_ws(F.split_part(F.split_part(c, F.lit(opens), F.lit(2)), F.lit(closes), F.lit(1)))


def clean_lines(c: Column, junk: list[str] = JUNK, footers: list[str] = FOOTERS) -> Column:
    """Lines up to the first footer, without junk lines; at most one blank line in a row; NULL gives an empty string."""
    lines = F.split(c, "\n")

    def has(words: list[str]):
        def test(line: Column) -> Column:
            out = line.contains(words[0])
            for w in words[1:]:
                out = out | line.contains(w)
            return out

        return test

    flags = F.transform(lines, has(footers))
    stop = F.array_position(flags, True)
    upto = F.when(stop > 0, F.slice(lines, 1, (stop - 1).cast("int"))).otherwise(lines)
    junky = has(junk)
    kept = F.array_join(F.filter(upto, lambda x: ~junky(x)), "\n")
    return F.coalesce(trim_ws(F.regexp_replace(kept, r"\n{3,}", "\n\n")), F.lit(""))


def clean_article(c: Column, title: Column) -> Column:
    """From the title's heading, else the first heading, up to the first end marker; trimmed only if cut at one."""
    at = F.instr(c, F.concat(F.lit("#  "), title))
    first = F.regexp_instr(c, F.lit(r"(?m)^#\s+[^\n]*"))
    heading = F.when(at > 0, at).when(first > 0, first).otherwise(1)
    body = F.substring(c, heading, F.length(c))
    ends = [F.nullif(F.instr(body, m), F.lit(0)) for m in ARTICLE_ENDS]
    end = F.least(*ends)
    return F.coalesce(F.when(end.isNotNull(), trim_ws(F.substring(body, F.lit(1), end - 1))).otherwise(body), F.lit(""))


def sanitize(c: Column) -> Column:
    """Drops control characters except tab, line feed and carriage return; NULL gives an empty string."""
    return F.coalesce(F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]", ""), F.lit(""))


def demote_headers(c: Column) -> Column:
    return F.replace(c, F.lit("\n# "), F.lit("\n### "))


def keyword_list(c: Column) -> Column:
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


def keyword_csv(c: Column) -> Column:
    """Comma-separated keywords; the raw text where it isn't a JSON list."""
    return F.coalesce(F.array_join(F.from_json(c, "array<string>"), ", "), c)


def llm_fields(c: Column) -> tuple[Column, Column]:
    """Summary and keywords (JSON) of a model's JSON answer, with the defaults of missing fields and of bad JSON."""
    j = F.from_json(c, "summary string, keywords array<string>", {"mode": "PERMISSIVE"})
    bad = F.try_parse_json(c).isNull()
    summary = F.when(bad, "Error generating summary.").otherwise(F.coalesce(j["summary"], F.lit("No summary generated.")))
    return summary, F.when(bad, "[]").otherwise(F.coalesce(F.to_json(j["keywords"]), F.lit("[]")))


BLOCKS = ["nav", "footer", "header", "aside", "form", "script", "style", "noscript"]
BREAKS = "p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|main|blockquote|dd|dt"


def html_text(c: Column) -> Column:
    """Text of a page without furniture elements and tags; the usual entities are resolved."""
    return trim_ws(F.regexp_replace(unescape(F.regexp_replace(without_blocks(c), r"<[^>]*>", " ")), r"[ \t\n\r]+", " "))


def without_blocks(c: Column) -> Column:
    for tag in BLOCKS:
        c = F.regexp_replace(c, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", " ")
    return c


def html_blocks(c: Column, least: int = 20) -> Column:
    """Texts of the blocks of a page with at least `least` words; NULL gives an empty array."""
    parts = F.split(F.regexp_replace(without_blocks(c), rf"(?i)</?(?:{BREAKS})\b[^>]*>", "\x00"), "\x00")
    plain = F.transform(parts, lambda x: trim_ws(F.regexp_replace(unescape(F.regexp_replace(x, r"<[^>]*>", " ")), r"[ \t\n\r]+", " ")))
    return F.coalesce(F.filter(plain, lambda x: (x != "") & (F.size(F.split(x, " ")) >= least)), F.array().cast("array<string>"))


def html_element(c: Column, id_: str) -> Column:
    """From the opening tag with that id to the end of the page; the whole page where there is none."""
    found = F.regexp_extract(c, rf"(?is)<[a-z][^>]*\bid\s*=\s*[\"']{id_}[\"'][^>]*>(.*)$", 1)
    return F.when(found == "", c).otherwise(found)


def html_markdown(c: Column) -> Column:
    """A page without furniture elements as markdown: headings, list items, links and paragraphs."""
    c = without_blocks(c)
    for n in range(1, 7):
        c = F.regexp_replace(c, rf"(?is)<h{n}\b[^>]*>(.*?)</h{n}>", "\n\n" + "#" * n + " $1\n\n")
    c = F.regexp_replace(c, r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>""", "[$2]($1)")
    c = F.regexp_replace(c, r"(?is)<li\b[^>]*>", "\n- ")
    c = F.regexp_replace(F.regexp_replace(c, rf"(?i)</?(?:{BREAKS})\b[^>]*>", "\n\n"), r"<[^>]*>", " ")
    return trim_ws(F.regexp_replace(F.regexp_replace(F.regexp_replace(unescape(c), r"[ \t\r]+", " "), r" ?\n ?", "\n"), r"\n{3,}", "\n\n"))


def content_status(c: Column, least: int = 50) -> Column:
    """failed_no_content below `least` trimmed characters, else success."""
    return F.when(c.isNull() | (F.length(trim_ws(c)) < least), "failed_no_content").otherwise("success")


def page_status(c: Column, error: Column, least: int = 50) -> Column:
    """error where the step raised one, else as `content_status`."""
    return F.when(error.isNotNull(), "error").otherwise(content_status(c, least))


def sanitize_list(c: Column) -> Column:
    """`sanitize` of each item; NULL gives an empty array."""
    return F.coalesce(F.transform(c, sanitize), F.array().cast("array<string>"))


# Texts put around queries, documents, sources and passages.
def query_text(q: Column) -> Column:
    return F.concat(F.lit("task: search result | query: "), q)


def document_text(summary: Column) -> Column:
    return F.concat(F.lit("সারসংক্ষেপ: "), F.coalesce(summary, F.lit("None")))


def passage_text(title: Column, chunk: Column) -> Column:
    return F.concat(F.lit("title: none | text: "), title, F.lit(" - "), chunk)


def source_link(url: Column) -> Column:
    return F.concat(F.lit("- ["), url, F.lit("]("), url, F.lit(")"))


def with_time(df: DataFrame, column: str = "processed_at") -> DataFrame:
    """`df` with the time of writing; one value a query."""
    return df.withColumn(column, F.current_timestamp().cast("timestamp_ntz"))
