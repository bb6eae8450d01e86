"""Text to unit vectors. Embedders take the description column and nothing else."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.udfs import once

VECTOR = T.ArrayType(T.FloatType())
TOKEN = r"[\p{L}\p{N}]+"


class Embedder(Protocol):
    """`name` is stored with each vector: vectors of different embedders do not compare."""

    name: str

    def embed(self, description: Column) -> Column: ...


def token_slots(description: Column, dim: int) -> Column:
    """One number in [0, 2*dim) per token: slot // 2 is the bucket, slot % 2 the sign."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(description, F.lit(""))), F.lit(TOKEN), F.lit(0))
    return F.transform(
        tokens, lambda t: F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint") % (2 * dim))


def _slot_vectors(slots: pa.ListArray, dim: int) -> np.ndarray:
    """Signed token counts per bucket, scaled to unit length; all rows of a batch at once."""
    offsets = slots.offsets.to_numpy()
    flat = slots.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    row = np.repeat(np.arange(len(slots)), np.diff(offsets))
    sign = 1.0 - 2.0 * (flat % 2)
    sums = np.bincount(row * dim + flat // 2, weights=sign, minlength=len(slots) * dim)
    vectors = sums.reshape(len(slots), dim)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms == 0, 1.0, norms)


def list_array(matrix: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, matrix.astype(np.float32).ravel())


class HashingEmbedder:
    """Feature hashing: shared words, not meaning. Needs no model and gives the same vector anywhere."""

    def __init__(self, dim: int = 384):
        self.dim = dim
        self.name = f"hash-md5-{dim}"

    def embed(self, description: Column) -> Column:
        dim = self.dim

        @F.arrow_udf(VECTOR)
        def scatter(slots: pa.Array) -> pa.Array:
            return list_array(_slot_vectors(slots, dim))

        return once(scatter)(token_slots(description, dim))


class ModelEmbedder:
    """Any model with `encode(texts) -> (n, dim) array`, got from `load` and kept for a Python worker's life.

    Spark's batch inference keeps it: the tasks a worker runs one after the other share the model.
    """

    def __init__(self, name: str, load: Callable[[], object], batch_rows: int = 1024):
        self.name, self.load, self.batch_rows = name, load, batch_rows
        self.predict = None  # kept, as a worker knows a model by its function

    def embed(self, description: Column) -> Column:
        if self.predict is None:
            load = self.load

            def make() -> Callable[[np.ndarray], np.ndarray]:
                model = load()

                def encode(texts: np.ndarray) -> np.ndarray:
                    vectors = np.asarray(model.encode([t or "" for t in texts.tolist()]), dtype=np.float64)
                    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
                    return (vectors / np.where(norms == 0, 1.0, norms)).astype(np.float32)

                return encode

            self.predict = once(predict_batch_udf(make, return_type=VECTOR, batch_size=self.batch_rows))
        return self.predict(F.coalesce(description, F.lit("")))


def embed_descriptions(df: DataFrame, embedder: Embedder, description: str = "description",
                       out: str = "embedding") -> DataFrame:
    return df.withColumn(out, embedder.embed(F.col(description)))
