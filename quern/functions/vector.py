"""Vectors as arrays: readable forms for single rows; joins use blocked products (operators.similarity)."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalised(a: Column) -> Column:
    """Unit length; a zero vector stays as it is."""
    n = norm(a)
    return F.when(n == 0, a.cast("array<double>")).otherwise(F.transform(a, lambda x: x / n))


def masked_mean(tokens: Column, mask: Column) -> Column:
    """Mean of the token vectors (array of arrays) whose mask is 1; null where none is."""
    kept = F.filter(F.zip_with(tokens, mask, lambda t, m: F.when(m == 1, t)), lambda t: t.isNotNull())
    size = F.size(kept)
    first = F.get(kept, F.lit(0))
    total = F.aggregate(F.slice(kept, 2, F.greatest(size - 1, F.lit(0))), F.transform(first, lambda x: x.cast("double")), lambda s, t: F.zip_with(s, t, lambda a, b: a + b))
    return F.when(size > 0, F.transform(total, lambda x: x / size))


def fragments(text: Column, size: int = 512) -> Column:
    """The text's white-space tokens in fragments of ``size``, rejoined."""
    words = F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
    count = F.size(words)
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), F.floor((count - 1) / size).cast("int")), lambda i: F.array_join(F.slice(words, i * size + 1, F.lit(size)), " "))).otherwise(F.array().cast("array<string>"))


def _hashed(text: str, dim: int) -> np.ndarray:
    v = np.zeros(dim)
    padded = f" {text.lower()} "
    for n in (3, 4):
        for i in range(len(padded) - n + 1):
            h = zlib.crc32(padded[i : i + n].encode("utf-8", "surrogatepass"))
            v[h % dim] += 1.0 if h & 0x80000000 else -1.0
    return v


def embedder(dim: int = 256, size: int = 512):
    """A text-to-vector function in the place of a model: signed hashed character n-grams of each
    fragment, the mean of fragments weighted by their length in characters, unit length."""

    @F.pandas_udf("array<float>")
    def embed(texts: pd.Series) -> pd.Series:
        def one(t):
            words = (t or "").split()
            parts = [" ".join(words[i : i + size]) for i in range(0, len(words), size)] or [""]
            units = [v / (np.linalg.norm(v) or 1.0) for v in (_hashed(p, dim) for p in parts)]
            mean = np.average(units, axis=0, weights=[len(p) or 1 for p in parts])
            return (mean / (np.linalg.norm(mean) or 1.0)).astype(np.float32)

        return texts.map(one)

    return embed
