"""Calls of models in batches, behind interfaces, with offline stand-ins: embeddings, summaries."""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")


class Embedder(Protocol):
    """Vectors of a batch of texts, in their order."""

    def __call__(self, texts: list[str]) -> list[list[float]]: ...


class HashedWords:
    """Unit vectors of hashed word counts, of the first `longest` words; a text without words has a zero vector."""

    def __init__(self, size: int = 64, longest: int = 512):
        self.size, self.longest = size, longest

    def __call__(self, texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), self.size))
        for row, t in zip(out, texts, strict=True):
            for w in WORD.findall(t.lower())[: self.longest]:
                h = zlib.crc32(w.encode())
                row[h % self.size] += 1 if h >> 31 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norm > 0, norm, 1)).tolist()


def embed(rows: DataFrame, text: str, embedder: Embedder | None = None, batch: int = 128, vector: str = "chunk_vector") -> DataFrame:
    """`rows` with the vector of `text`, made `batch` texts a call; a null text has a null vector. No join: order is kept in place."""
    embedder = embedder or HashedWords()
    at = rows.columns.index(text)

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            some = [i for i, t in enumerate(texts) if t is not None]
            vectors: list[list[float] | None] = [None] * len(texts)
            for k in range(0, len(some), batch):
                ids = some[k : k + batch]
                for i, v in zip(ids, embedder([texts[i] for i in ids]), strict=True):
                    vectors[i] = v
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(vectors, pa.list_(pa.float64()))], names=[*b.schema.names, vector])

    spec = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), f"`{vector}` array<double>"])
    return rows.mapInArrow(run, spec)


class Summariser(Protocol):
    """JSON texts with `summary` and `keywords` for a batch of texts; None where the call fails."""

    def __call__(self, texts: list[str]) -> list[str | None]: ...


class LeadSummary:
    """The first sentences as summary, the most frequent longer words as keywords."""

    def __init__(self, sentences: int = 2, keywords: int = 5):
        self.sentences, self.keywords = sentences, keywords

    def __call__(self, texts: list[str]) -> list[str | None]:
        out: list[str | None] = []
        for t in texts:
            parts = [p.strip() for p in re.split(r"(?<=[.?!।])\s+", t) if p.strip()]
            words = Counter(w for w in WORD.findall(t.lower()) if len(w) > 3)
            top = sorted(words, key=lambda w: (-words[w], w))[: self.keywords]
            out.append(json.dumps({"summary": " ".join(parts[: self.sentences]), "keywords": top}, ensure_ascii=False))
        return out


def summarise(rows: DataFrame, text: str, model: Summariser | None = None, longest: int = 8000, batch: int = 32) -> DataFrame:
    """`rows` with answer: the model's JSON for the first `longest` code points of `text` (see `functions.text.llm_fields`); null where there is none."""
    model = model or LeadSummary()
    spec = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), "answer string"])
    at = len(rows.columns)

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            some = [i for i, t in enumerate(texts) if t]
            answers: list[str | None] = [None] * len(texts)
            for k in range(0, len(some), batch):
                ids = some[k : k + batch]
                for i, a in zip(ids, model([texts[i] for i in ids]), strict=True):
                    answers[i] = a
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(answers, pa.string())], names=[*b.schema.names[:at], "answer"])

    return rows.select("*", F.substring(text, 1, longest).alias("_input")).mapInArrow(run, spec)
