"""Embedding providers (V2): how texts become vectors, behind one small contract.

(a) ``join_embeddings``: vectors computed elsewhere, stored as a keyed table, joined on the key
    (the default: embedding is a model-side job whose output is persisted like completions).
(b) ``hashing_vectors``: Spark-native HashingTF -> IDF -> L2 Normalizer over word tokens.
(c) ``model_vectors``: a user model called through an iterator pandas UDF; the model is loaded
    once per Python worker and fed Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions.text import tokens


def join_embeddings(df: DataFrame, key: str, table: DataFrame, table_key: str, vec_col: str = "embedding",
                    out: str = "v") -> DataFrame:
    """Attach precomputed vectors by key; rows without a vector are kept with a null vector."""
    vecs = table.select(F.col(table_key).alias(key), F.col(vec_col).alias(out))
    return df.join(vecs, key, "left")


def hashing_vectors(df: DataFrame, text_col: str, num_features: int = 1 << 16, out: str = "features") -> DataFrame:
    """Sparse TF-IDF vectors, L2-normalised, from the library's word tokens."""
    tok = df.withColumn("_tokens", tokens(text_col))
    pipe = Pipeline(stages=[HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
                            IDF(inputCol="_tf", outputCol="_idf"),
                            Normalizer(inputCol="_idf", outputCol=out, p=2.0)])
    return pipe.fit(tok).transform(tok).drop("_tokens", "_tf", "_idf")


def model_vectors(df: DataFrame, text_col: str, load_model: Callable[[], object], dim: int,
                  out: str = "v") -> DataFrame:
    """``load_model()`` returns an object with ``encode(list[str]) -> array (n, dim)``."""

    from feedlens.session import ship_package
    ship_package(df.sparkSession)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for texts in batches:
            arr = np.asarray(model.encode(texts.fillna("").tolist()), dtype=np.float32).reshape(len(texts), dim)
            yield pd.Series(list(arr))

    return df.withColumn(out, encode(F.col(text_col)))


class HashingEncoder:
    """Offline, deterministic encoder for tests and dry runs: token counts hashed into ``dim``
    buckets (stable ``zlib.crc32``), L2-normalised.  Same contract as a sentence model:
    ``encode(list[str]) -> ndarray (n, dim)``."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def encode(self, texts):
        import re
        import zlib
        out = np.zeros((len(texts), self.dim), dtype=np.float64)
        for r, t in enumerate(texts):
            for tok in re.findall(r"\w\w+", (t or "").lower()):
                out[r, zlib.crc32(tok.encode("utf-8")) % self.dim] += 1.0
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)
