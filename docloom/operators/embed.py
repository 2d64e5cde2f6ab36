"""Text to vectors: a built-in hashed embedding and a slot for user models."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from docloom.functions.text import PYTHON_WORD

DIM = 64


class HashedEmbedder:
    """Hashed term frequencies at unit length (all zeros for a text without tokens).

    A token's bucket is the first 32 bits of its md5, modulo ``dim``. Words repeat,
    so the buckets seen are kept, up to a bound. Texts are counted a few at a time.
    """

    KEPT, TEXTS_AT_ONCE = 100_000, 1_000

    def __init__(self, dim: int = DIM):
        self.dim = dim
        self.buckets: dict[str, int] = {}

    def bucket(self, token: str) -> int:
        found = self.buckets.get(token)
        if found is None:
            if len(self.buckets) >= self.KEPT:
                self.buckets.clear()
            found = int(hashlib.md5(token.encode("utf-8")).hexdigest()[:8], 16) % self.dim
            self.buckets[token] = found
        return found

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim))
        for lo in range(0, len(texts), self.TEXTS_AT_ONCE):
            out[lo:lo + self.TEXTS_AT_ONCE] = self._some(texts[lo:lo + self.TEXTS_AT_ONCE])
        return out

    def _some(self, texts: list[str]) -> np.ndarray:
        lists = [[self.bucket(t) for t in PYTHON_WORD.findall(text.lower())] for text in texts]
        rows = np.repeat(np.arange(len(texts)), [len(x) for x in lists])
        flat = np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=len(rows))
        counts = np.bincount(rows * self.dim + flat, minlength=len(texts) * self.dim).reshape(-1, self.dim)
        norm = np.sqrt((counts * counts).sum(axis=1).astype(np.float64))
        return counts / np.where(norm == 0, 1.0, norm)[:, None]


def embed(
    df: DataFrame,
    text: str = "content",
    out: str = "embedding",
    embedder: Callable[[list[str]], np.ndarray] | None = None,
    dim: int = DIM,
) -> DataFrame:
    """Add a vector column.

    ``embedder`` maps a list of texts to a 2-d float array. It is called once per
    Arrow batch inside the tasks; an object with an expensive set-up can do that
    on its first call, once per Python worker.
    """
    model = embedder or HashedEmbedder(dim)

    @pandas_udf(T.ArrayType(T.FloatType()))
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            vectors = model(texts.fillna("").tolist())
            yield pd.Series(list(np.asarray(vectors, dtype=np.float32)))

    return df.withColumn(out, apply(F.col(text)))
