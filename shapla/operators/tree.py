"""Document trees as adjacency rows; chunks."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapla.functions.text import SUMMARY_CLOSES, SUMMARY_OPENS, between, demote_headers, keyword_csv, passage_text
from shapla.session import materialize


def flatten(nodes: DataFrame, deepest: int = 100) -> DataFrame:
    """`nodes` (node_id, parent_id, ordinal, ...) with depth and path; ordering by path is the pre-order.

    Roots have no parent. Nodes of a cycle or below a missing parent aren't reachable and are left out. A tree with nodes
    more than `deepest` levels below its roots is an error.
    """
    level = materialize(nodes.where("parent_id IS NULL").select("node_id", F.array("ordinal").alias("path"), F.lit(1).alias("depth")))
    found = level
    for _ in range(deepest):
        children = nodes.select("node_id", "parent_id", "ordinal").join(level.withColumnRenamed("node_id", "parent_id"), "parent_id")
        level = materialize(children.select("node_id", F.concat("path", F.array("ordinal")).alias("path"), (F.col("depth") + 1).alias("depth")))
        if level.isEmpty():
            break
        found = found.unionAll(level)
    else:
        if not nodes.select("parent_id").join(level.select(F.col("node_id").alias("parent_id")), "parent_id").isEmpty():
            raise ValueError(f"nodes lie more than {deepest} levels below the roots")
    return nodes.join(found, "node_id")


def toc(nodes: DataFrame, longest: int = 250) -> DataFrame:
    """(node_id, title, summary): nodes with a summary between its markers, cut to `longest`."""
    summary = F.substring(between(F.coalesce("text", F.lit("")), SUMMARY_OPENS, SUMMARY_CLOSES), 1, longest)
    return nodes.select("node_id", F.coalesce("title", F.lit("Unknown")).alias("title"), summary.alias("summary")).where("summary <> ''")


# The labels of an exported site.
KEYWORDS_LABEL, CONTENT_LABEL, PARTED = "**কিওয়ার্ড (Keywords):**", "**বিস্তারিত তথ্য (Detailed Content):**", "\n\n---\n\n"


def export_markdown(sites: DataFrame) -> DataFrame:
    """(url, markdown): each site's section of the exported document, with its headers moved down."""
    text = F.concat(
        F.lit("## "), "url", F.lit("\n\n" + SUMMARY_OPENS + " "), F.coalesce("summary", F.lit("None")), F.lit(f"\n\n{KEYWORDS_LABEL} "), F.coalesce(keyword_csv(F.col("keywords")), F.lit("None")),
        F.lit(f"\n\n{CONTENT_LABEL}\n"), demote_headers(F.col("raw_markdown")), F.lit(PARTED),
    )
    return sites.select("url", text.alias("markdown"))


def document(sections: DataFrame, title: str) -> DataFrame:
    """(ordinal, markdown): the root heading as ordinal 0, then the sections in order of url, numbered by a ranged sort."""
    placed = sections.select("url", "markdown").orderBy("url", "markdown").withColumn("ordinal", F.monotonically_increasing_id() + 1)
    head = sections.sparkSession.createDataFrame([(0, f"# {title}\n\n")], "ordinal long, markdown string")
    return head.unionByName(placed.select("ordinal", "markdown"))


def markdown_tree(documents: DataFrame, key: str, markdown: str) -> DataFrame:
    """(key, node_id, parent_id, ordinal, depth, title, text) of each document's headings.

    A heading's parent is the last one before it with fewer marks; the text of a node runs to the next heading. Lines before the
    first heading belong to no node; headings within fenced code are text. A null document has no nodes.
    """
    schema = pa.schema([("key", pa.string()), ("node_id", pa.string()), ("parent_id", pa.string()), ("ordinal", pa.int64()), ("depth", pa.int32()), ("title", pa.string()), ("text", pa.string())])

    def run(batches):
        heading = re.compile(r"(#{1,6})\s+(.*?)\s*#*\s*$")
        for b in batches:
            rows: list[list] = []
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                above: list[tuple[int, str]] = []
                mine: list[list] = []
                fenced = False
                for line in (text or "").split("\n"):
                    fenced ^= line.lstrip().startswith("```")
                    m = None if fenced else heading.match(line)
                    if m:
                        level = len(m.group(1))
                        while above and above[-1][0] >= level:
                            above.pop()
                        node = f"{len(mine) + 1:04d}"
                        mine.append([k, node, above[-1][1] if above else None, len(mine), len(above) + 1, m.group(2), []])
                        above.append((level, node))
                    elif mine:
                        mine[-1][6].append(line)
                for r in mine:
                    r[6] = "\n".join(r[6]).strip()
                rows += mine
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return documents.select(F.col(key).cast("string").alias("key"), F.col(markdown).alias("text")).mapInArrow(run, "key string, node_id string, parent_id string, ordinal long, depth int, title string, text string")


def char_chunks(text: Column, size: int = 2000, overlap: int = 300) -> Column:
    """Windows of `size` code points every `size - overlap`; none for an empty text."""
    stride = size - overlap
    starts = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.length(text) - 1, F.lit(stride))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(text, i + 1, F.lit(size)))


def word_windows(text: str, size: int = 1500, overlap: int = 200, least: int = 50) -> list[str]:
    """Chunks of whole words, each closed by the word that brings its length (with spaces) to `size`.

    The next chunk repeats the last words whose length reaches `overlap`; the rest is kept if longer than `least`.
    """
    words = text.split()
    ends = [0]
    for w in words:
        ends.append(ends[-1] + len(w) + 1)
    out, start, e = [], 0, 0
    while e < len(words):
        if ends[e + 1] - ends[start] >= size:
            out.append(" ".join(words[start : e + 1]))
            x = e
            while x >= start and ends[e + 1] - ends[x] < overlap:
                x -= 1
            start = max(x, start)
        e += 1
    if words and start < len(words) and ends[-1] - ends[start] - 1 > least:
        out.append(" ".join(words[start:]))
    return out


def word_chunks(rows: DataFrame, key: str, text: str, size: int = 1500, overlap: int = 200, keep: list[str] | None = None) -> DataFrame:
    """(key, chunk_no, chunk, and the columns `keep`), numbered from 0; the sequential state of overlaps runs in Arrow batches."""
    keep = keep or []

    def run(batches):
        for b in batches:
            at, nos, chunks = [], [], []
            for r, t in enumerate(b.column(1).to_pylist()):
                for i, c in enumerate(word_windows(t or "", size, overlap)):
                    at.append(r)
                    nos.append(i)
                    chunks.append(c)
            of = pa.array(at, pa.int64())
            kept = [b.column(i).take(of) for i in range(2, b.num_columns)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(of), pa.array(nos, pa.int32()), pa.array(chunks, pa.string()), *kept], names=["key", "chunk_no", "chunk", *keep])

    spec = ", ".join(["key string, chunk_no int, chunk string", *(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)])
    return rows.where(F.col(text).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"), *keep).mapInArrow(run, spec)


def chunk_records(nodes: DataFrame, size: int = 1500, overlap: int = 200) -> DataFrame:
    """Chunk rows with their node's url, title and summary, and the passage to embed.

    Two nodes of one id keep their own fields; repeated nodes give repeated rows.
    """
    n = nodes.where("text <> ''").select(
        F.coalesce("node_id", F.lit("unknown_id")).alias("node_id"), F.coalesce("title", F.lit("Unknown")).alias("site_title"), "text", between(F.col("text"), SUMMARY_OPENS, SUMMARY_CLOSES).alias("site_summary"),
        F.coalesce("url", F.concat(F.lit("https://"), F.coalesce("node_id", F.lit("unknown_id")), F.lit(".gov.bd"))).alias("url"),
    )
    c = word_chunks(n, "node_id", "text", size, overlap, ["url", "site_title", "site_summary"])
    return c.select(F.concat_ws("_part_", "key", F.col("chunk_no").cast("string")).alias("chunk_id"), F.col("key").alias("node_id"), "url", "site_title", "site_summary", F.col("chunk").alias("chunk_text"), passage_text(F.col("site_title"), F.col("chunk")).alias("passage_for_embedding"))
