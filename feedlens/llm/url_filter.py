"""URL filtering by fixed host and path rules and by association rules mined from labels.

A URL is a set of tokens: its scheme, the parts of its host, the words of its path, the keys of its query.
Spark's FP-growth mines the combinations that occur in bad labelled URLs, from all their tokens; tokens that the same
labelled URLs hold are one item there (FP-growth would list every subset of them) and are told apart again
afterwards.  Each combination is then counted anew on all labelled URLs through the index.  A rule is kept if its
support, its count of bad URLs and the lower Wilson bound of its confidence reach their limits, that bound
is above the share of bad URLs among all, and no part of it is a rule.  Count and bound are
the same for tables of any size, so one or two URLs never make a rule.  Rules match by an
inverted index: a rule is filed under its rarest token, so a URL meets only rules whose rarest token it
has, and then all tokens of the rule are looked up among the URL's.

The number of combinations grows with 2 to the number of items that the same bad URLs share without being one
item; this is the price of FP-growth, and there is no cap on it.

Fixed rules come first: of those that fit host (with subdomains) and path, the longest wins.

Defined results: a null URL or one without ``://`` has empty host and path and no tokens, so no rule fits
and it is allowed; labels that are null or contradict each other are not used; without labels of both
kinds nothing is mined and all else is allowed; equal URLs get equal verdicts; an empty table gives an empty
table; columns of the caller are kept, and those named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.columns import ascii_lower
from feedlens.session import materialize

MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.7     # of the lower Wilson bound
MIN_COUNT = 5            # bad labelled URLs that a rule must fit, whatever the size of the table
Z = 1.96                 # of the Wilson bound: 95 %


def host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def tokens(url: Column) -> Column:
    """Distinct tokens; numbers are left out, as they name single pages."""
    words = lambda c, kind, pattern: F.transform(
        F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), lambda w: F.concat(F.lit(kind), w))
    query = F.regexp_extract(_rest(url), r"\?([^#]*)", 1)
    keys = F.transform(F.regexp_extract_all(query, F.lit(r"(?:^|&)([^=&]+)"), F.lit(1)), lambda w: F.concat(F.lit("query:"), w))
    scheme = F.array(F.concat(F.lit("scheme:"), F.lower(F.substring_index(url, "://", 1))))
    lowered = F.lower(path(url))
    every = F.concat(scheme, words(host(url), "host:", r"[^.\-:@]+"), words(lowered, "path:", r"[\p{L}_]+"), keys)
    return F.when(F.instr(url, "://") > 0, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def fixed_rule(h: Column, p: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, host, path) that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, rh, rp in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((h == rh) | h.endswith("." + rh)) & p.startswith(rp)
        name, verdict = F.when(fits, F.lit(rh + rp)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def wilson(hits: Column, n: Column, z: float = Z) -> Column:
    """Lower Wilson bound of the share ``hits / n``."""
    p = hits / n
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _items(rows: DataFrame, floor: int) -> DataFrame:
    """(token, item, n): tokens of at least ``floor`` bad URLs; those that the same labelled URLs hold share an item, the least of them.

    Tokens that all labelled URLs hold say nothing and are left out.
    """
    total = rows.count()
    held = rows.select("bad", F.xxhash64("row").alias("h"), F.explode("tokens").alias("token"))
    sums = held.groupBy("token").agg(F.count("*").alias("n"), F.count_if("bad").alias("bad"), F.bit_xor("h").alias("x"), F.sum(
        F.shiftright("h", 24)).alias("s"))
    kept = sums.where((F.col("bad") >= floor) & (F.col("n") < total))
    least = kept.groupBy("n", "bad", "x", "s").agg(F.min("token").alias("item"))
    return materialize(kept.join(least, ["n", "bad", "x", "s"]).select("token", "item", "n"), "url-items")


def _counted(sets: DataFrame, rows: DataFrame, items: DataFrame) -> DataFrame:
    """(set, n, bad): how many labelled URLs hold all items of a set, by the index on its rarest item."""
    counts = items.where("token = item").select("item", F.col("n").alias("of"))
    filed = sets.select("set", F.explode("set").alias("item")).join(counts, "item").groupBy("set").agg(
        F.min_by("item", F.struct("of", "item")).alias("rarest"))
    met = rows.select("tokens", "bad", F.explode("tokens").alias("rarest")).join(filed, "rarest")
    return met.where(F.forall("set", lambda t: F.array_contains("tokens", t))).groupBy("set").agg(
        F.count("*").alias("n"), F.count_if("bad").alias("bad"))


def mine_rules(labelled: DataFrame, url_col: str, bad_col: str, min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE, min_count: int = MIN_COUNT) -> DataFrame:
    """(antecedent, rarest, confidence, support): rules that make a URL bad.  ``bad_col`` is boolean."""
    spark = labelled.sparkSession
    rows = labelled.select(F.array_sort(tokens(F.col(f"`{url_col}`"))).alias("tokens"),
                           F.col(f"`{bad_col}`").alias("bad")).where("bad is not null and size(tokens) > 0")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "url-labelled")
    n, n_bad = rows.agg(F.count("*"), F.count_if("bad")).first()
    floor = max(min_count, -(-int(min_support * n * 1_000_000) // 1_000_000))
    if not n_bad or n_bad < floor:
        return spark.createDataFrame([], "antecedent array<string>, rarest string, confidence double, support double")
    items = _items(rows, floor)
    baskets = rows.where("bad").select("row", F.explode("tokens").alias("token")).join(
        items.where("token = item"), "token").groupBy("row").agg(F.collect_set("item").alias("items"))
    baskets = materialize(baskets, "url-baskets")  # a basket has at most the tokens of one URL
    n_baskets = baskets.count()
    if not n_baskets:
        return spark.createDataFrame([], "antecedent array<string>, rarest string, confidence double, support double")
    # half a row less, so that the least count is ``floor`` whatever rounding does to the share
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (floor - 0.5) / n_baskets)).setNumPartitions(
        int(spark.conf.get("spark.sql.shuffle.partitions"))).fit(baskets)
    sets = materialize(model.freqItemsets.select(F.array_sort("items").alias("set")), "url-sets")
    bound = wilson(F.col("bad"), F.col("n"))
    is_rule = (F.col("bad") >= floor) & (bound >= min_confidence) & (bound > F.lit(n_bad / n))
    found = materialize(_counted(sets, rows, items).where(is_rule), "url-found")
    counts = items.where("token = item").select("item", F.col("n").alias("of"))
    filed = found.select("set", F.explode("set").alias("item")).join(counts, "item").groupBy("set").agg(
        F.min_by("item", F.struct("of", "item")).alias("rarest"))
    filed = materialize(filed, "url-filed")
    part = filed.select(F.col("set").alias("part"), "rarest")
    longer = found.select("set", F.explode("set").alias("rarest")).join(part, "rarest").where(
        (F.size("part") < F.size("set")) & F.forall("part", lambda t: F.array_contains("set", t))).select("set").distinct()
    least = found.join(longer, "set", "left_anti").join(filed, "set")
    # an item stands for each of its tokens: one rule for each choice
    members = items.groupBy("item").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    placed = least.select("set", "n", "bad", "rarest", F.posexplode("set").alias("at", "item")).join(members, "item")
    choices = placed.groupBy("set", "n", "bad", "rarest").agg(F.sort_array(F.collect_list(F.struct("at", "tokens"))).alias("c"))
    start = F.array(F.array().cast("array<string>"))
    product = F.aggregate("c", start, lambda acc, c: F.flatten(F.transform(acc, lambda a: F.transform(
        c["tokens"], lambda t: F.concat(a, F.array(t))))))
    rules = choices.select("n", "bad", F.array_position("set", F.col("rarest")).cast("int").alias("at"), F.explode(product).alias("rule"))
    return materialize(rules.select(F.array_sort("rule").alias("antecedent"), F.element_at("rule", F.col("at")).alias("rarest"),
                                    (F.col("bad") / F.col("n")).alias("confidence"), (F.col("bad") / n).alias("support")), "url-rules")


def matched_urls(urls: DataFrame, url_col: str, rules: DataFrame) -> DataFrame:
    """(url, confidence) of the distinct URLs that a mined rule matches, by the index on the rarest tokens."""
    distinct = urls.select(F.col(f"`{url_col}`").alias("__url")).where("__url is not null").distinct()
    tokened = distinct.select("__url", tokens(F.col("__url")).alias("tokens"))
    met = tokened.select("__url", "tokens", F.explode("tokens").alias("rarest")).join(rules, "rarest")
    full = F.forall("antecedent", lambda t: F.array_contains("tokens", t))
    return met.where(full).groupBy("__url").agg(F.max("confidence").alias("__confidence"))


def judge(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url",
          bad_col: str = "bad", min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the fixed rule that fits, or null) and ``verdict``.

    ``labelled`` has URLs in ``url_col`` and whether they are bad in ``bad_col``.
    """
    mined = mine_rules(labelled, url_col, bad_col, min_support, min_confidence)
    matched = matched_urls(pages, url_col, mined)
    url = F.col(f"`{url_col}`")
    name, verdict = fixed_rule(host(url), path(url), rules)
    by_method = F.when(F.col("__confidence").isNotNull(), "block").otherwise("allow")
    new = {"host": host(url), "path": path(url), "rule": name, "verdict": F.coalesce(verdict, by_method)}
    joined = pages.join(matched, url == F.col("__url"), "left")
    return joined.select(*[F.col(f"`{c}`") for c in pages.columns if c not in new], *[v.alias(c) for c, v in new.items()])
