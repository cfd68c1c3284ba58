"""Corpus exploration queries over the comment table (documents)."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.functions import binning, text
from feedlens.functions.hashing import seeded_key_sql
from feedlens.operators import profile, sampling, tfidf
from feedlens.plans.registry import query, r6, sql_list

WS_SPLIT = r"len(list_filter(regexp_split_to_array({t}, '\s+'), lambda x: x <> ''))"


def _lexicon_sql(t: str, words) -> str:
    return " + ".join(f"(CASE WHEN instr(lower({t}), '{w.replace(chr(39), chr(39) * 2)}') > 0 THEN 1 ELSE 0 END)"
                      for w in dict.fromkeys(words))


def _polarity_sql(t: str) -> str:
    pos, neg = _lexicon_sql(t, text.POSITIVE_WORDS), _lexicon_sql(t, text.NEGATIVE_WORDS)
    return f"CASE WHEN ({pos}) > ({neg}) THEN 'positive' WHEN ({neg}) > ({pos}) THEN 'negative' ELSE 'neutral' END"


def comments(spark):
    return spark.table("v_comments")


def profiled(spark):
    return profile.profile_text(comments(spark), "comment")


PROFILE_CTE = f"""
WITH p AS (
  SELECT doc_id AS comment_id, text AS comment, length(text) AS length,
         {WS_SPLIT.format(t='text')} AS word_count,
         {_polarity_sql('text')} AS rough_sentiment
  FROM documents
), pb AS (
  SELECT *, {binning.bin_sql('length', *binning.SAMPLE_BINS)} AS length_bin,
         {binning.bin_ordinal_sql('length', binning.SAMPLE_BINS[0])} AS length_bin_ord
  FROM p
)
"""


@query("bin_sentiment", PROFILE_CTE + f"""
SELECT length_bin_ord, length_bin, rough_sentiment, count(*) AS n, {r6('avg(word_count)')} AS avg_words,
       {r6('100.0 * count(*) / sum(count(*)) OVER ()')} AS share_pct
FROM pb GROUP BY length_bin_ord, length_bin, rough_sentiment""")
def q_bin_sentiment(spark, sf_dir):
    """Flagship: length bin x lexicon sentiment -> n, share, mean words."""
    return profile.bin_sentiment_table(profiled(spark))


@query("text_profile", PROFILE_CTE + """
SELECT comment_id, CAST(length AS INT) AS length, CAST(word_count AS INT) AS word_count, length_bin
FROM pb""")
def q_text_profile(spark, sf_dir):
    return profiled(spark).select("comment_id", "length", "word_count", "length_bin")


@query("lexicon_sentiment", PROFILE_CTE + """
SELECT comment_id, rough_sentiment FROM pb""")
def q_lexicon_sentiment(spark, sf_dir):
    return profiled(spark).select("comment_id", "rough_sentiment")


@query("length_bins", f"""
SELECT {binning.bin_ordinal_sql('length(text)', binning.LENGTH_BINS[0])} AS bin_ord,
       {binning.bin_sql('length(text)', *binning.LENGTH_BINS)} AS bin,
       count(*) AS n, {r6('100.0 * count(*) / sum(count(*)) OVER ()')} AS pct
FROM documents GROUP BY 1, 2""")
def q_length_bins(spark, sf_dir):
    df = comments(spark).select(text.char_length("comment").alias("length"))
    return profile.length_bins(df, "length", *binning.LENGTH_BINS)


@query("length_stats", f"""
WITH p AS (SELECT length(text) AS length, {WS_SPLIT.format(t='text')} AS word_count FROM documents),
s AS (
  SELECT 'length' AS metric, count(length) AS n, CAST(min(length) AS DOUBLE) AS min, CAST(max(length) AS DOUBLE) AS max,
         avg(length) AS mean, quantile_cont(length, 0.5) AS median, stddev_samp(length) AS std,
         quantile_cont(length, 0.25) AS p25, quantile_cont(length, 0.75) AS p75 FROM p
  UNION ALL
  SELECT 'word_count', count(word_count), min(word_count), max(word_count), avg(word_count),
         quantile_cont(word_count, 0.5), stddev_samp(word_count), quantile_cont(word_count, 0.25),
         quantile_cont(word_count, 0.75) FROM p)
SELECT metric, n, {r6('min')} AS min, {r6('max')} AS max, {r6('mean')} AS mean, {r6('median')} AS median,
       {r6('std')} AS std, {r6('p25')} AS p25, {r6('p75')} AS p75 FROM s""")
def q_length_stats(spark, sf_dir):
    df = comments(spark).select(text.char_length("comment").alias("length"),
                                text.word_count("comment").alias("word_count"))
    return profile.numeric_profile(df, ["length", "word_count"], sample_std=True)


@query("dup_counts", f"""
SELECT count(*) AS total, count(DISTINCT text) AS unique, count(*) - count(DISTINCT text) AS duplicates,
       {r6('100.0 * (count(*) - count(DISTINCT text)) / count(*)')} AS duplicate_pct
FROM documents""")
def q_dup_counts(spark, sf_dir):
    return profile.dup_counts(comments(spark), "comment")


def hist_sql(values_sql: str, n: int) -> str:
    """DuckDB text of numpy's equal-width histogram over the ``x`` column of ``values_sql``."""
    edge = "(CASE WHEN {i} >= {n} THEN w.hi ELSE {i} * w.step + w.lo END)"
    e = lambda i: edge.format(i=i, n=n)
    return f"""
WITH v AS ({values_sql}),
b AS (SELECT CAST(min(x) AS DOUBLE) AS lo0, CAST(max(x) AS DOUBLE) AS hi0 FROM v WHERE x IS NOT NULL),
w AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi,
             (CASE WHEN lo0 = hi0 THEN 1.0 ELSE hi0 - lo0 END) / {n} AS step FROM b),
f AS (SELECT CAST(v.x AS DOUBLE) AS x, least(CAST(floor((v.x - w.lo) / (w.hi - w.lo) * {float(n)}) AS BIGINT), {n - 1}) AS i
      FROM v, w WHERE v.x IS NOT NULL),
c AS (SELECT CAST(CASE WHEN f.x < {e('f.i')} THEN f.i - 1
                       WHEN f.x >= {e('(f.i + 1)')} AND f.i <> {n - 1} THEN f.i + 1 ELSE f.i END AS INT) AS bin,
             count(*) AS n FROM f, w GROUP BY 1),
r AS (SELECT CAST(range AS INT) AS bin, {e('range')} AS lo, {e('(range + 1)')} AS hi FROM range({n}), w)
SELECT r.bin, {r6('r.lo')} AS lo, {r6('r.hi')} AS hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM r LEFT JOIN c ON r.bin = c.bin"""


@query("histogram", hist_sql("SELECT length(text) AS x FROM documents", 50))
def q_histogram(spark, sf_dir):
    """Comment lengths, 50 equal-width bins (numpy rules)."""
    df = comments(spark).select(text.char_length("comment").alias("length"))
    return profile.equal_width_histogram(df, "length", 50)


@query("word_histogram", hist_sql(f"SELECT {WS_SPLIT.format(t='text')} AS x FROM documents", 50))
def q_word_histogram(spark, sf_dir):
    """Words per comment, 50 equal-width bins."""
    df = comments(spark).select(text.word_count("comment").alias("words"))
    return profile.equal_width_histogram(df, "words", 50)


@query("boxplot", f"""
WITH p AS (SELECT CAST(length(text) AS DOUBLE) AS x FROM documents),
q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM p)
SELECT {r6('q1')} AS q1, {r6('median')} AS median, {r6('q3')} AS q3, {r6('q3 - q1')} AS iqr,
       {r6('min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END)')} AS whisker_lo,
       {r6('max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END)')} AS whisker_hi,
       count(CASE WHEN x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1) THEN 1 END) AS n_outliers,
       count(x) AS n
FROM p, q GROUP BY q1, median, q3""")
def q_boxplot(spark, sf_dir):
    df = comments(spark).select(text.char_length("comment").alias("length"))
    return profile.boxplot_summary(df, "length")


@query("stratified_sample", PROFILE_CTE + f"""
, r AS (SELECT *, row_number() OVER (PARTITION BY length_bin_ord, rough_sentiment
                                     ORDER BY {seeded_key_sql('comment_id', 42)}, comment_id) AS rn FROM pb)
SELECT comment_id, CAST(length AS INT) AS length, CAST(word_count AS INT) AS word_count, rough_sentiment,
       length_bin FROM r WHERE rn <= 3
ORDER BY length_bin_ord, rough_sentiment, rn LIMIT 20""")
def q_stratified_sample(spark, sf_dir):
    """Per (length bin, sentiment) stratum min(n, 20 // 6) rows in seeded order; first 20 in strata order."""
    return sampling.stratified_sample(profiled(spark), ["length_bin_ord", "rough_sentiment"], "comment_id",
                                      per_stratum=max(1, 20 // 6), total=20, seed=42) \
        .select("comment_id", "length", "word_count", "rough_sentiment", "length_bin")


@query("random_sample_hash", f"""
SELECT doc_id AS comment_id FROM documents
ORDER BY {seeded_key_sql('doc_id', 7)}, doc_id
LIMIT (SELECT greatest(50, count(*) // 5) FROM documents)""")
def q_random_sample_hash(spark, sf_dir):
    """Exact-size seeded sample without replacement: max(50, n // 5) rows."""
    df = comments(spark).select("comment_id")
    n = df.count()
    return sampling.hash_sample(df, "comment_id", max(50, n // 5), seed=7)


@query("random_sample")
def q_random_sample(spark, sf_dir):
    """Bernoulli sample (approximate size) with Spark's own sampler."""
    return sampling.bernoulli_sample(comments(spark).select("comment_id"), 0.2, seed=42)


@query("first_n", """
(SELECT 'by_id' AS ordering, doc_id AS comment_id FROM documents ORDER BY doc_id LIMIT 10)
UNION ALL
(SELECT 'by_string_id', doc_id FROM documents ORDER BY CAST(doc_id AS VARCHAR) LIMIT 5)""")
def q_first_n(spark, sf_dir):
    df = comments(spark).select("comment_id")
    return (sampling.first_n(df, "comment_id", 10).select(F.lit("by_id").alias("ordering"), "comment_id")
            .unionByName(sampling.first_n(df, "comment_id", 5, as_string=True)
                         .select(F.lit("by_string_id").alias("ordering"), "comment_id")))


def _tfidf_sql() -> str:
    stop = sql_list(text.STOP_WORDS)
    return f"""
WITH d AS (SELECT doc_id, text FROM documents),
n AS (SELECT count(*) AS n_docs FROM d),
t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM d),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term NOT IN ({stop}) GROUP BY doc_id, term),
vocab AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term ORDER BY total DESC, term LIMIT 50),
w AS (SELECT tf.doc_id, tf.term, tf.tf * (ln((1.0 + n.n_docs) / (1.0 + vocab.df)) + 1.0) AS w
      FROM tf JOIN vocab ON tf.term = vocab.term, n),
nw AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS wn FROM w)
SELECT term, {r6('sum(wn) / max(n.n_docs)')} AS score
FROM nw, n GROUP BY term ORDER BY sum(wn) / max(n.n_docs) DESC, term LIMIT 20"""


@query("tfidf_top_terms", _tfidf_sql())
def q_tfidf_top_terms(spark, sf_dir):
    return tfidf.top_terms(comments(spark), "comment_id", "comment", max_features=50, top_n=20)


@query("data_summary", PROFILE_CTE + f"""
SELECT count(*) AS total_comments, count(DISTINCT comment) AS unique_comments,
       CAST(min(length) AS INT) AS min_length, CAST(max(length) AS INT) AS max_length, {r6('avg(length)')} AS mean_length,
       {r6('quantile_cont(length, 0.5)')} AS median_length,
       CAST(min(word_count) AS INT) AS min_words, CAST(max(word_count) AS INT) AS max_words, {r6('avg(word_count)')} AS mean_words,
       {r6('quantile_cont(word_count, 0.5)')} AS median_words
FROM pb""")
def q_data_summary(spark, sf_dir):
    return profile.data_summary(profiled(spark), "comment")


@query("length_bins_nb", f"""
SELECT {binning.bin_ordinal_sql('length(text)', binning.LENGTH_BINS_NB[0])} AS bin_ord,
       {binning.bin_sql('length(text)', *binning.LENGTH_BINS_NB)} AS bin,
       count(*) AS n, {r6('100.0 * count(*) / sum(count(*)) OVER ()')} AS pct
FROM documents GROUP BY 1, 2""")
def q_length_bins_nb(spark, sf_dir):
    """The notebook's variant: edges 0, 5, 200, 500 with the '<50' label kept as published (Q11)."""
    df = comments(spark).select(text.char_length("comment").alias("length"))
    return profile.length_bins(df, "length", *binning.LENGTH_BINS_NB)
