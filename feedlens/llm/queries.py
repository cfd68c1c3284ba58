"""Registered queries over the driver tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import (decontamination, filter_audit, fingerprints, html_text, lattice_score, line_dedup, merkle,
                          packing, quality, sharding, similarity_join, token_counts, url_filter)
from feedlens.llm.columns import ascii_lower, text_of
from feedlens.session import ensure_checkpoint_dir, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLE[name] = oracle
        return run
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_order_minhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints (sliding units) of every text, of its edited text and their likeness; the next text is likened too."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", text_of(docs, "text").alias("text"))
    docs = fingerprints.with_next(fingerprints.fingerprints(docs, sliding=True), "doc_id",
                                  {"next_text": "text", "next_fingerprint": "fingerprint"}, ["text"])
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    docs = docs.select("doc_id", n.cast("long").alias("n_chars"), "fingerprint", "next_fingerprint",
                       F.concat(F.left("text", n - cut), F.left("next_text", cut)).alias("edited"))
    docs = docs.withColumn("edited_fingerprint", fingerprints.fingerprint(F.col("edited"), sliding=True))
    return docs.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       "fingerprint", "edited_fingerprint",
                       fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       fingerprints.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


OP4_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM docs)),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.keeper AS dropped
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op4_line_dedup", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs, min_docs=5, min_chars=40)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op5_jump_hash_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 15 by jump consistent hashing of doc_id (law ``key``); a null text has the CRC of an empty one."""
    docs = table(spark, sf_dir, "documents")
    text = text_of(docs, "text")
    docs = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    placed = sharding.shard(docs, "doc_id", 16, order=["size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n,
    unnest(list_transform(range(1, len(ws) - least(len(ws), 10) + 2),
      lambda i: array_to_string(ws[i:i + least(len(ws), 10) - 1], ' '))) AS w
  FROM b WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS i,
    unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i + n - 1], ' '))) AS w
  FROM d, sizes WHERE len(ws) >= n),
hits AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.w = bw.w AND dw.n = bw.n),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id
"""


@query("op2_suffix_automaton", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    ids = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@query("op7_bpe_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # only this query and op11 need its files
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id
"""


@query("op3_ngram_jaccard_join", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_join.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


BIN_BYTES = 8192


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in bins of 8192 UTF-8 bytes, an empty one without a bin; near copies are a duplicate cluster."""
    return packing.pack_texts(table(spark, sf_dir, "documents"), BIN_BYTES)


@query("op10_html_block_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return pages.withColumn("n_chars", F.length("text").cast("long"))


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
             ("allow", "org", "/fr/")]


def labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of the pages whose document is labelled (the last number of the path is its doc_id); bad: poor or toxic."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.min((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("b0"),
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("b1"))
    pages = table(spark, sf_dir, "pages").select("url", F.regexp_extract(
        url_filter.path(F.col("url")), r"(\d{1,18})\D*$", 1).alias("number"))
    pages = pages.where("number <> ''").select("url", F.col("number").cast("long").alias("doc_id"))
    return pages.join(labels.where("b0 = b1"), "doc_id").select("url", F.col("b0").alias("bad"))


@query("op8_url_association_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, labelled_urls(spark, sf_dir), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op6_cotraining_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document, and whether it is kept (a score of at least 0.5)."""
    scored = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    return scored.withColumn("kept", F.col("quality_score") >= 0.5)


LATTICE_VOCABULARY = "piece_bpe_32k.model"


@query("op11_subword_lattice")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every text; the texts that are not held out teach the model."""
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lattice_score.score(docs, public_tokenizers.path(LATTICE_VOCABULARY))


@query("op12_merkle_manifest")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of all documents; where 5 divides the CRC of the id, a lower-cased text is verified."""
    docs = table(spark, sf_dir, "documents")
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampers = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select("doc_id", "source", merkle.leaf_digest(*others, F.col("text")).alias("digest"), F.when(
        tampers, merkle.leaf_digest(*others, ascii_lower(F.col("text")))).alias("tampered"))
    proved, root = merkle.manifest(leaves, "source", ["doc_id"])
    folded = merkle.fold(F.coalesce("tampered", "digest"), F.col("path"))
    return proved.select("doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(root).cast("string").alias("root"),
                         merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"),
                         (folded == F.lit(root)).alias("verified"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    min(doc_id) OVER (PARTITION BY text) AS first FROM d),
f AS (
  SELECT doc_id, part, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
    100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(text),
    regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first, false)] AS fails FROM w),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
c AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, fails),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
orders AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
steps AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
applied AS (
  SELECT part, array_to_string(list_transform(o, lambda k: substr('ABCDE', k, 1)), '') AS filter_order, step, o[step] AS k,
    fails[o[step]] AS here, list_bool_or(list_transform(o[1:step - 1], lambda k: fails[k])) AS before,
    len(list_filter(fails, lambda x: x)) AS failing, n, good, toxic FROM c, steps),
counted AS (
  SELECT part, filter_order, step, k, sum(CASE WHEN NOT here AND NOT coalesce(before, false) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN here AND NOT coalesce(before, false) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN here AND coalesce(before, false) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN here AND failing = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN here AND NOT coalesce(before, false) THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN here AND NOT coalesce(before, false) THEN toxic ELSE 0 END) AS toxic_lost
  FROM applied GROUP BY part, filter_order, step, k)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM counted
"""


@query("op13_filter_audit", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes, at each step of all 120 orders, per language."""
    failed = filter_audit.failures(table(spark, sf_dir, "documents"))
    return filter_audit.audit(failed, table(spark, sf_dir, "labels"))
