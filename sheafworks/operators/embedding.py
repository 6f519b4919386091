"""Text to vectors in batches; the model is loaded once per Python worker."""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P

Model = Callable[[list[str]], np.ndarray]

_TOKENS_REMEMBERED = 500_000


class HashingModel:
    """Word counts hashed into `dim` buckets and scaled to length 1.

    Stands in for a trained model where none is installed; any callable from a list of
    texts to a matrix can take its place.
    """

    def __init__(self, dim: int = P.EMBEDDING_DIM):
        self.dim = dim
        self.known: dict[str, int] = {}

    def bucket(self, token: str) -> int:
        if token not in self.known:
            if len(self.known) >= _TOKENS_REMEMBERED:
                self.known.clear()
            self.known[token] = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % self.dim
        return self.known[token]

    def __call__(self, texts: list[str]) -> np.ndarray:
        out, known = np.zeros((len(texts), self.dim)), self.known
        for row, text in enumerate(texts):
            # Most tokens are known, and a call for each would take most of the time.
            buckets = [known[token] if token in known else self.bucket(token) for token in text.split()]
            if buckets:
                counts = np.bincount(buckets, minlength=self.dim)
                out[row] = counts / np.sqrt(float((counts * counts).sum()))
        return out.astype(np.float32)


def _worker_model(name: str, load: Callable[[], Model]) -> Model:
    """The model kept by this worker process, loaded at its first use."""
    kept = sys.modules.setdefault("_sheafworks_models", types.ModuleType("_sheafworks_models"))
    if not hasattr(kept, name):
        setattr(kept, name, load())
    return getattr(kept, name)


def embed(
    df: DataFrame,
    text: str = "text",
    output: str = "embeddings",
    model_name: str = "hashing",
    load: Callable[[], Model] | None = None,
    batch_size: int = P.EMBEDDING_BATCH,
    dim: int = P.EMBEDDING_DIM,
) -> DataFrame:
    """Adds an array<float> column; all other columns pass by without going to Python."""
    loader = load or (lambda: HashingModel(dim))
    # Workers keep a model for each loader, not only for each name.
    key = f"{model_name}_{dim}_{hashlib.md5(cloudpickle.dumps(loader)).hexdigest()}"

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _worker_model(key, loader)
        for batch in batches:
            texts = batch.fillna("").tolist()
            rows: list[np.ndarray] = []
            for first in range(0, len(texts), batch_size):
                rows.extend(np.asarray(model(texts[first : first + batch_size]), dtype=np.float32))
            yield pd.Series(rows, dtype=object)

    # Marked so that the optimizer never runs the model twice for one row.
    return df.withColumn(output, encode.asNondeterministic()(F.col(text)))
