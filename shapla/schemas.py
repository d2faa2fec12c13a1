"""Explicit schemas of all sources and tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, B, N = T.StringType(), T.LongType(), T.TimestampNTZType()


def _of(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


WEBSITES = _of(("url", S), ("summary", S), ("keywords", S), ("raw_markdown", S), ("status", S), ("processed_at", N))
WEBSITE_LINKS = _of(("id", B), ("source_url", S), ("target_url", S), ("created_at", N))
PAGES = _of(("url", S), ("title", S), ("markdown_body", S), ("status", S), ("crawled_at", N))
CHUNKS = _of(("chunk_id", S), ("node_id", S), ("url", S), ("site_title", S), ("site_summary", S), ("chunk_text", S), ("passage_for_embedding", S))
NODES = _of(("node_id", S), ("parent_id", S), ("ordinal", B), ("title", S), ("text", S), ("url", S))
TURNS = _of(("conv_id", B), ("turn", B), ("role", S), ("text", S))
EVAL = _of(("item_id", B), ("queries", S), ("expected_answer", S))
FRONTIER = _of(("url", S), ("level", B))
