"""TF-IDF top terms over a corpus (V1), as joins and grouped aggregates.

tf = raw count of a term in a document; vocabulary = the ``max_features`` most
frequent terms after stop words (ties by term); idf = ln((1 + N) / (1 + df)) + 1;
each document vector is L2-normalised over the vocabulary; a term's score is the
mean normalised weight over all N documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.text import STOP_WORDS, TOKEN_PATTERN, tokens
from feedlens.session import ensure_checkpoint_dir, materialize


def term_frequencies(df: DataFrame, id_col: str, text_col: str, stop_words=None,
                     pattern: str = TOKEN_PATTERN) -> DataFrame:
    """(doc id, term, tf) with stop words removed; partial aggregation before the shuffle."""
    stop = list(STOP_WORDS if stop_words is None else stop_words)
    toks = df.select(F.col(id_col).alias("doc_id"), F.explode(tokens(text_col, pattern)).alias("term"))
    if stop:
        toks = toks.where(~F.col("term").isin(stop))
    return toks.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def top_terms(df: DataFrame, id_col: str, text_col: str, max_features: int = 50, top_n: int = 20,
              stop_words=None) -> DataFrame:
    """Mean L2-normalised TF-IDF weight of the ``max_features`` most frequent terms; the ``top_n`` best.

    Tokenising whole texts is the expensive step, so the (doc, term, tf) table
    is computed once and written as Parquet under the shared checkpoint dir; the
    vocabulary (bounded by ``max_features``) is read from it and broadcast.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_docs = df.select(id_col).count()
    tf = materialize(term_frequencies(df, id_col, text_col, stop_words), "tfidf-tf")
    vocab_rows = (tf.groupBy("term").agg(F.sum("tf").alias("total"), F.count("*").alias("df"))
                  .orderBy(F.desc("total"), "term").limit(max_features).collect())
    vocab = spark.createDataFrame([(r["term"], int(r["total"]), int(r["df"])) for r in vocab_rows],
                                  "term string, total long, df long")
    w = (tf.join(F.broadcast(vocab), "term")
         .withColumn("w", F.col("tf") * (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0)))
    per_doc = Window.partitionBy("doc_id")
    normed = w.withColumn("wn", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(per_doc)))
    scores = normed.groupBy("term").agg((F.sum("wn") / F.lit(float(n_docs))).alias("score"))
    return scores.orderBy(F.desc("score"), "term").limit(top_n)
