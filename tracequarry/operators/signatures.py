"""Structural signatures of slices: what recall filters and scores by."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracequarry.functions import text


def signatures(slices: DataFrame) -> DataFrame:
    """Slices plus their signature; arrays of tools are sorted."""
    s = F.col("steps")
    blank = F.lit("")
    tools = F.sort_array(F.array_distinct(F.filter(F.transform(s, lambda x: x["tool_call_name"]), lambda x: F.coalesce(x, blank) != "")))
    results = F.transform(
        F.filter(s, lambda x: x["role"] == "tool"),
        lambda x: F.when(F.coalesce(x["tool_result"], blank) != "", x["tool_result"]).otherwise(x["content"]),
    )
    spoken = F.array_join(
        F.transform(F.filter(s, lambda x: x["role"] == "assistant"), lambda x: F.concat(F.coalesce(x["tool_call_args"], blank), F.lit(" "), x["content"])), " "
    )
    everything = F.array_join(
        F.transform(s, lambda x: F.concat_ws(" ", F.coalesce(x["tool_call_args"], blank), F.coalesce(x["tool_result"], blank), x["content"])), " "
    )
    return slices.withColumns(
        {
            "step_count": F.size(s),
            "turn_count": F.size(F.filter(s, lambda x: x["role"] == "user")),
            "tools_used": tools,
            "languages": text.languages(spoken),
            "has_error_pattern": F.exists(results, text.is_error),
            "has_success_pattern": F.exists(results, text.is_success),
            "has_verification_step": F.exists(s, lambda x: text.is_verification(x["tool_call_name"], x["tool_call_args"])),
            "bm25_tokens": text.search_tokens(everything, tools),
            "capability_labels": F.expr("cast(null as array<string>)"),
        }
    )


Embedder = Callable[[list[str]], list[list[float]]]


def with_embeddings(signed: DataFrame, embedder: Embedder, batch: int = 32) -> DataFrame:
    """Signatures plus ``embedding``: the embedder gets texts in batches and must answer each of them."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in signed.schema if f.name != "embedding") + ", embedding array<float>"
    texts = signed.withColumn("__text", text.embedding_text(F.col("steps")))
    names = [f.name for f in signed.schema if f.name != "embedding"]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            said, vectors = frame["__text"].tolist(), []
            for a in range(0, len(said), batch):
                got = embedder(said[a : a + batch])
                if len(got) != len(said[a : a + batch]):
                    raise ValueError(f"embedder returned {len(got)} vectors for {len(said[a : a + batch])} texts")
                vectors += got
            frame = frame[names].copy()
            frame["embedding"] = vectors
            yield frame

    return texts.select(*names, "__text").mapInPandas(work, schema)


def with_query_vectors(problems: DataFrame, embedder: Embedder, texts: str = "hyde_positive") -> DataFrame:
    """Sub-problems plus ``query_vectors``, one for each text of ``texts``; null where there is none."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in problems.schema if f.name != "query_vectors") + ", query_vectors array<array<double>>"
    names = [f.name for f in problems.schema if f.name != "query_vectors"]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            said = [[] if t is None else list(t) for t in frame[texts]]
            flat = [x for t in said for x in t]
            vectors = iter(embedder(flat) if flat else [])
            frame = frame[names].copy()
            frame["query_vectors"] = [[list(map(float, next(vectors))) for _ in t] or None for t in said]
            yield frame

    return problems.select(*names).mapInPandas(work, schema)


def hash_embedder(dim: int = 64) -> Embedder:
    """Deterministic stand-in for a model: a unit vector seeded by the text's hash."""
    import hashlib

    import numpy as np

    def embed(texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = np.random.default_rng(int.from_bytes(hashlib.sha256(t.encode()).digest()[:8], "big")).standard_normal(dim)
            out.append((v / np.linalg.norm(v)).tolist())
        return out

    return embed
