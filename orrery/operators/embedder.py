"""Vectors for texts: the protocol of an embedder, a client of a service, and one that needs no service."""

from __future__ import annotations

import hashlib
import http.client
import json
import math
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

from ..errors import EmbeddingUnavailable, InvalidConfig, InvalidEmbedding, InvalidRequest
from ..sources.web import exchange

#: Requests that a client has under way at once, and bytes of a response, at most.
CONCURRENCY, RESPONSE_BYTES = 10, 8 << 20


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> list[tuple[list[float], int]]:
        """A vector and the number of tokens for each text, in order."""


class HashEmbedder:
    """Words hashed to signed dimensions, of length 1: equal texts have equal vectors, texts with common words near ones."""

    def __init__(self, dimensions: int = 1536):
        self.dimensions = dimensions

    def embed(self, texts: list[str]) -> list[tuple[list[float], int]]:
        out = []
        for text in texts:
            v = [0.0] * self.dimensions
            words = text.lower().split()
            for w in words or [""]:
                h = int.from_bytes(hashlib.sha256(w.encode()).digest()[:8], "big")
                v[h % self.dimensions] += 1.0 if h >> 63 else -1.0
            norm = math.sqrt(sum(x * x for x in v)) or 1.0
            out.append(([x / norm for x in v], max(1, len(words))))
        return out


@dataclass(frozen=True)
class HttpEmbedder:
    """A client of an embedding service with the widespread JSON interface (POST {base_url}/embeddings).

    Each text is a request of its own, so the service's count of tokens is that of the text. At most `concurrency` requests
    are under way; the first error ends the call and cancels those that haven't begun. `timeout_s` is the time of a whole
    request, from connecting to the answer's last byte. Redirects are errors, so the key goes to the given host alone (nor
    are proxies used). Errors never show the service's text or the key. The client can be sent to executors.
    """

    base_url: str
    key: str
    model: str
    dimensions: int = 1536
    timeout_s: float = 30.0
    concurrency: int = CONCURRENCY

    def __post_init__(self) -> None:
        if not self.base_url.strip() or not self.key or not self.model.strip() or self.dimensions < 1 or self.timeout_s <= 0 or not 1 <= self.concurrency <= CONCURRENCY:
            raise InvalidConfig("the embedding client's settings are incomplete")

    def __repr__(self) -> str:
        return f"HttpEmbedder({self.base_url!r}, {self.model!r}, {self.dimensions})"

    def embed(self, texts: list[str]) -> list[tuple[list[float], int]]:
        if not texts or any(not t.strip() for t in texts):
            raise InvalidRequest("there is no text, or a blank one, to embed")
        with ThreadPoolExecutor(min(self.concurrency, len(texts))) as pool:
            return all_or_first_error(pool, self.one, texts)

    def one(self, text: str) -> tuple[list[float], int]:
        body = json.dumps({"model": self.model, "input": [text], "dimensions": self.dimensions, "encoding_format": "float"}).encode()
        key = self.key.reveal() if hasattr(self.key, "reveal") else self.key
        headers = {"Authorization": f"Bearer {key}", "Content-Type": "application/json"}
        try:
            status, _, content = exchange("POST", f"{self.base_url.rstrip('/')}/embeddings", body, headers, self.timeout_s, RESPONSE_BYTES)
        except (OSError, http.client.HTTPException, ValueError):
            raise EmbeddingUnavailable("the embedding request failed") from None
        if not 200 <= status < 300:
            raise EmbeddingUnavailable(f"the embedding request failed with status {status}")
        try:
            if len(content) > RESPONSE_BYTES:
                raise ValueError
            answer = json.loads(content)
            [item] = answer["data"]
            vector, tokens = [float(x) for x in item["embedding"]], int(answer["usage"]["prompt_tokens"])
        except (ValueError, KeyError, TypeError):
            raise InvalidEmbedding("the service's answer isn't an embedding") from None
        return checked([(vector, tokens)], 1, self.dimensions)[0]


def all_or_first_error[A, B](pool: ThreadPoolExecutor, work: Callable[[A], B], items: list[A]) -> list[B]:
    """Results in order; the first error cancels what hasn't begun and is raised."""
    asked = [pool.submit(work, x) for x in items]
    done, waiting = wait(asked, return_when=FIRST_EXCEPTION)
    for f in waiting:
        f.cancel()
    if failed := next((f for f in done if f.exception()), None):
        failed.result()
    return [f.result() for f in asked]


def checked(results: list[tuple[list[float], int]], count: int, dimensions: int) -> list[tuple[list[float], int]]:
    """What an embedder returned: as many results as texts, each with a token, the dimensions and finite 32-bit numbers."""
    right = len(results) == count and all(n >= 1 and len(v) == dimensions and all(abs(x) <= 3.4028234663852886e38 for x in v) for v, n in results)
    if not right:
        raise InvalidEmbedding("the embedder's result doesn't fit its request")
    return results


def embed_inputs(inputs: DataFrame, embedder: Embedder, dimensions: int, tasks: int = 2, batch: int = 64) -> DataFrame:
    """Adds embedding_token_count and embedding.

    An embedder with a `concurrency` is the client of a service, and that is how many requests a run has under way at most:
    the inputs are dealt to at most `tasks` tasks, which share the slots. A task has one pool; each text is a call of its own
    and begins when a slot is free; the first error cancels what hasn't begun and ends the job. (A task that Spark runs twice
    at once, by speculation, has its slots twice.) Other embedders get batches, in as many tasks as the inputs have.
    """
    schema = "chunk_set_id string, chunk_id string, model_key string, embedding_text string, input_sha256 string, embedding_token_count int, embedding array<double>"
    limit = getattr(embedder, "concurrency", None)
    dealt = min(tasks, limit) if limit else 0

    def found(pool: ThreadPoolExecutor, texts: list[str]) -> list[tuple[list[float], int]]:
        parts = [[t] for t in texts] if limit else [texts[i : i + batch] for i in range(0, len(texts), batch)]
        made = all_or_first_error(pool, lambda p: checked(embedder.embed(p), len(p), dimensions), parts)
        return [x for part in made for x in part]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(limit // dealt if limit else 1) as pool:
            for b in frames:
                made = found(pool, b["embedding_text"].tolist())
                yield b.assign(embedding_token_count=[n for _, n in made], embedding=[v for v, _ in made])

    rows = inputs.select("chunk_set_id", "chunk_id", "model_key", "embedding_text", "input_sha256")
    return (rows.repartition(dealt) if limit else rows).mapInPandas(work, schema)
