"""Insight -> theme mapping and its evaluation.

Scoring against the catalogue works on blocks of insights and blocks of themes
(``operators/similarity.py``), so the catalogue may be of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions import jsonparse, prompts
from feedlens.operators import completion, ranks, responses, similarity

SEMANTIC = "semantic_similarity"


# ---------------------------------------------------------------- catalogue

def nest_themes(flat: DataFrame) -> DataFrame:
    """Flat ``(theme_pos, theme, category)`` -> the nested hierarchy document (one row)."""
    cats = flat.groupBy("category").agg(F.min("theme_pos").alias("first"),
                                        F.sort_array(F.collect_list(F.struct("theme_pos", "theme"))).alias("t"))
    return cats.agg(F.sort_array(F.collect_list(F.struct("first", "category", "t"))).alias("c")).select(
        F.transform("c", lambda x: F.struct(x["category"].alias("category"),
                                            F.transform(x["t"], lambda y: y["theme"]).alias("themes"))).alias("themes"))


def theme_block(flat: DataFrame, header: str = prompts.THEME_BLOCK_HEADER) -> DataFrame:
    """The catalogue rendered for prompts: header, then per category a title and ``  - theme`` lines."""
    cats = flat.groupBy("category").agg(
        F.min("theme_pos").alias("first"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("theme_pos", "theme"))),
                                 lambda x: F.concat(F.lit("  - "), x["theme"], F.lit("\n"))), "").alias("lines"))
    parts = cats.select("first", F.concat(F.lit("\n"), F.col("category"), F.lit(":\n"), F.col("lines")).alias("part"))
    return parts.agg(F.concat(F.lit(header),
                              F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("first", "part"))),
                                                       lambda x: x["part"]), "")).alias("theme_block"))


# ---------------------------------------------------------------- scoring

def theme_scores(items: DataFrame, themes: DataFrame, id_col: str, vec_col: str = "v") -> DataFrame:
    """One row per item and catalogue theme: (id, theme_pos, theme, category, sim)."""
    found = similarity.ranked_themes(items, themes, id_col, None, vec_col)
    return found.select(id_col, F.explode("matches").alias("m")).select(
        id_col, *[F.col("m")[c].alias(c) for c in ("theme_pos", "theme", "category", "sim")])


def top_k(items: DataFrame, themes: DataFrame, id_col: str, k: int = 3, vec_col: str = "v", method: str = SEMANTIC) -> DataFrame:
    """``items`` with ``top_matches``: the k best themes, similarity descending, ties by catalogue position.

    Items without a vector have none and are left out.
    """
    found = similarity.ranked_themes(items, themes, id_col, k, vec_col)
    found = found.select(F.col(id_col).alias("_item"), F.transform("matches", lambda m: F.struct(
        m["theme_pos"].alias("theme_pos"), m["theme"].alias("theme"), m["category"].alias("category"),
        m["sim"].alias("confidence"), F.lit(method).alias("method"))).alias("top_matches"))
    return items.join(found, F.col(id_col).cast("long") == F.col("_item")).drop("_item")


def primary_mapping(ranked: DataFrame, id_col: str = "cluster_id", name_col: str | None = "cluster_name") -> DataFrame:
    """Rank-1 match becomes the mapping; reasoning names both sides."""
    first = F.element_at("top_matches", 1)
    name = F.coalesce(F.col(name_col), F.lit("")) if name_col else F.lit("")
    return ranked.select(
        id_col, first["theme"].alias("primary_theme"), first["category"].alias("primary_category"),
        first["confidence"].alias("primary_confidence"), "top_matches",
        F.format_string(prompts.SEMANTIC_REASONING, name, first["theme"])
        .alias("reasoning"),
        F.lit("success").alias("status"), F.lit(False).alias("validated"))


def margin(ranked: DataFrame) -> Column:
    """Best minus second-best similarity."""
    return F.element_at("top_matches", 1)["confidence"] - F.element_at("top_matches", 2)["confidence"]


# ---------------------------------------------------------------- evaluation

def _ok(m: DataFrame) -> DataFrame:
    return m.where(F.col("status") == "success")


def theme_usage(m: DataFrame) -> DataFrame:
    return _ok(m).groupBy(F.col("primary_theme").alias("theme")).agg(F.count("*").alias("n"))


def category_usage(m: DataFrame) -> DataFrame:
    return _ok(m).groupBy(F.col("primary_category").alias("category")).agg(F.count("*").alias("n"))


def theme_coverage(m: DataFrame, themes: DataFrame) -> DataFrame:
    """Themes used / catalogue size in %, categories used / total."""
    used = _ok(m).select(F.lit(True).alias("_used"), F.col("primary_theme").alias("theme"),
                         F.col("primary_category").alias("category"))
    cat = themes.select(F.lit(False).alias("_used"), "theme", "category")
    u = F.col("_used")
    out = used.unionByName(cat).agg(
        F.countDistinct(F.when(u, F.col("theme"))).alias("themes_used"),
        F.countDistinct(F.when(u, F.col("category"))).alias("categories_used"),
        F.countDistinct(F.when(~u, F.col("theme"))).alias("themes_total"),
        F.countDistinct(F.when(~u, F.col("category"))).alias("categories_total"))
    return out.withColumn("coverage_pct", F.lit(100.0) * F.col("themes_used") / F.col("themes_total"))


def category_balance(m: DataFrame) -> DataFrame:
    """Largest and smallest category share in %, their ratio (0 when the smallest is 0)."""
    pct = category_usage(m).withColumn("pct", F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy()))
    return pct.agg(F.max("pct").alias("max_category_pct"), F.min("pct").alias("min_category_pct")).withColumn(
        "balance_ratio", F.when(F.col("min_category_pct") > 0, F.col("max_category_pct") / F.col("min_category_pct"))
        .otherwise(F.lit(0.0)))


def theme_clusters(m: DataFrame, id_col: str = "cluster_id") -> DataFrame:
    """(theme, cluster) pairs for themes that received more than one cluster."""
    ok = _ok(m).select(F.col("primary_theme").alias("theme"), id_col)
    multi = ok.groupBy("theme").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return ok.join(multi.select("theme"), "theme", "left_semi")


def mapping_consistency(m: DataFrame) -> DataFrame:
    """Themes with more than one cluster / themes used."""
    per = theme_usage(m)
    return per.agg(F.count_if(F.col("n") > 1).alias("themes_with_multiple_clusters"),
                   F.count("*").alias("total_themes_used")).withColumn(
        "consistency_score", F.col("themes_with_multiple_clusters") / F.col("total_themes_used"))


def unused_themes(themes: DataFrame, m: DataFrame) -> DataFrame:
    """Catalogue themes no successful mapping uses."""
    used = _ok(m).select(F.col("primary_theme").alias("theme"))
    return themes.join(used, "theme", "left_anti")


def themes_by_category(themes: DataFrame, m: DataFrame) -> DataFrame:
    """Per category: how many of its themes are used and by how many clusters."""
    usage = theme_usage(m)
    joined = themes.join(usage, "theme", "left")
    return joined.groupBy("category").agg(F.count("n").alias("themes_used"),
                                          F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("clusters"),
                                          F.count("*").alias("themes_total"))


def sample_mappings(m: DataFrame, insights: DataFrame, k: int = 5, id_col: str = "cluster_id") -> DataFrame:
    """The k most confident mappings with the insight name ('N/A' when missing)."""
    top = _ok(m).orderBy(F.desc("primary_confidence"), id_col).limit(k)
    named = top.join(insights.select(id_col, "cluster_name"), id_col, "left")
    return (named.withColumn("cluster_name", F.coalesce("cluster_name", F.lit("N/A")))
            .withColumn("rank", F.row_number().over(Window.orderBy(F.desc("primary_confidence"), id_col))))


def low_confidence(m: DataFrame, threshold: float = 0.35) -> DataFrame:
    return _ok(m).where(F.col("primary_confidence") < threshold)


def tier(col: str = "primary_confidence") -> Column:
    c = F.col(col)
    return F.when(c > 0.5, "high").when(c >= 0.35, "medium").otherwise("low")


def tier_lists(m: DataFrame) -> DataFrame:
    """Each successful mapping with its confidence tier (A7, long form of the three lists)."""
    return _ok(m).withColumn("tier", tier())


def confidence_report(m: DataFrame) -> DataFrame:
    """mean, median, pop std, min, max and tier counts/shares of mapping confidence."""
    c = F.col("primary_confidence")
    n = F.count(c)
    rest = _ok(m).agg(
        F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"),
        F.count_if(c > 0.5).alias("high"), F.count_if((c >= 0.35) & (c <= 0.5)).alias("medium"),
        F.count_if(c < 0.35).alias("low"), (F.lit(100.0) * F.count_if(c > 0.5) / n).alias("high_pct"))
    median = ranks.order_statistics(_ok(m), {"median": ("primary_confidence", 0.5)})
    return ranks.one_row([rest, median]).select("mean", "median", "std", "min", "max", "high", "medium", "low", "high_pct")


def overlay(m: DataFrame, validations: DataFrame, id_col: str = "cluster_id") -> DataFrame:
    """Replace theme, category, confidence and reasoning where a validation exists; set ``validated``."""
    v = validations.select(id_col, F.col("recommended_theme").alias("_t"), F.col("category").alias("_c"),
                           F.col("confidence").alias("_p"), F.col("rationale").alias("_r"))
    j = m.join(v, id_col, "left")
    hit = F.col("_t").isNotNull()
    return (j.withColumn("primary_theme", F.when(hit, F.col("_t")).otherwise(F.col("primary_theme")))
            .withColumn("primary_category", F.when(hit, F.col("_c")).otherwise(F.col("primary_category")))
            .withColumn("primary_confidence", F.when(hit, F.col("_p")).otherwise(F.col("primary_confidence")))
            .withColumn("reasoning", F.when(hit, F.col("_r")).otherwise(F.col("reasoning")))
            .withColumn("validated", hit | F.coalesce(F.col("validated"), F.lit(False)))
            .drop("_t", "_c", "_p", "_r"))


def in_catalogue(m: DataFrame, themes: DataFrame, theme_col: str = "primary_theme",
                 category_col: str = "primary_category") -> DataFrame:
    """Add ``in_catalogue``: whether the (theme, category) a model recommended exists in the catalogue (Q13)."""
    cat = themes.select(F.col("theme").alias("_t"), F.col("category").alias("_c"), F.lit(True).alias("_hit")).distinct()
    j = m.join(cat, (F.col(theme_col) == F.col("_t")) & (F.col(category_col) == F.col("_c")), "left")
    return j.withColumn("in_catalogue", F.coalesce("_hit", F.lit(False))).drop("_t", "_c", "_hit")


# ---------------------------------------------------------------- model-backed mapping

def block_text(block: DataFrame) -> str:
    """The rendered catalogue (one row, catalogue-sized) as a literal for prompt templates."""
    rows = block.select("theme_block").limit(2).collect()
    if len(rows) != 1:
        raise ValueError("theme block must be a single row")
    return rows[0][0]


def suggestion_lines(top_matches: str = "top_matches") -> Column:
    return F.array_join(F.transform(top_matches, lambda m, i: F.format_string(
        prompts.SUGGESTION_LINE, i + 1, m["theme"], m["category"], m["confidence"])), "\n")


def _key_themes(insights: DataFrame) -> Column:
    """The insight's key themes, comma-separated (given as an array or as text; none: empty)."""
    if "key_themes" not in insights.columns:
        return F.lit("")
    c = F.col("key_themes")
    return F.array_join(c, ", ") if insights.schema["key_themes"].dataType.typeName() == "array" else c


def validation_prompts(low: DataFrame, insights: DataFrame, block: DataFrame, model: str = "stub-model",
                       template: str = prompts.VALIDATION_TEMPLATE, id_col: str = "cluster_id") -> DataFrame:
    """Prompt per low-confidence mapping: insight fields, ranked suggestions, catalogue block."""
    j = low.join(insights, id_col, "left").withColumn("theme_block", F.lit(block_text(block)))
    prompt = prompts.render(template, cluster_id=F.col(id_col), cluster_name=F.col("cluster_name"),
                            summary=F.col("summary"), primary_sentiment=F.col("primary_sentiment"),
                            key_themes=_key_themes(j), suggestions=suggestion_lines(), theme_block=F.col("theme_block"))
    return completion.with_request_id(j.select(id_col, prompt.alias("prompt")), "prompt", model)


def full_mapping_prompts(insights: DataFrame, block: DataFrame, model: str = "stub-model",
                         template: str = prompts.FULL_MAPPING_TEMPLATE, id_col: str = "cluster_id") -> DataFrame:
    j = insights.withColumn("theme_block", F.lit(block_text(block)))
    prompt = prompts.render(template, cluster_id=F.col(id_col), cluster_name=F.col("cluster_name"),
                            summary=F.col("summary"), primary_sentiment=F.col("primary_sentiment"),
                            key_themes=_key_themes(j), theme_block=F.col("theme_block"))
    return completion.with_request_id(j.select(id_col, prompt.alias("prompt")), "prompt", model)


def parse_validations(prompts_df: DataFrame, done: DataFrame, id_col: str = "cluster_id") -> DataFrame:
    """Completions -> validation rows; unparseable answers are dropped (mapping stays as it was)."""
    j = prompts_df.select(id_col, "request_id").join(done, "request_id")
    p = responses.parse_responses(j.withColumn("text", F.coalesce("text", F.lit(""))), "text",
                                  schema=jsonparse.VALIDATION_SCHEMA, fence="b", out="v")
    ok = p.where((F.col("status") == "success") & F.col("v.recommended_theme").isNotNull())
    return ok.select(id_col, F.col("v.recommended_theme").alias("recommended_theme"),
                     F.col("v.category").alias("category"),
                     jsonparse.to_double("v.confidence").alias("confidence"), F.col("v.rationale").alias("rationale"))


def parse_full_mappings(prompts_df: DataFrame, done: DataFrame, id_col: str = "cluster_id") -> DataFrame:
    """Completions -> mapping rows; failures and answers without all four keys stay as error rows with the id (L4)."""
    j = prompts_df.select(id_col, "request_id").join(done.drop("status", "error"), "request_id")
    p = responses.parse_responses(j.withColumn("text", F.coalesce("text", F.lit(""))), "text",
                                  schema=jsonparse.FULL_MAPPING_SCHEMA, fence="b", out="m")
    confidence = jsonparse.to_double("m.confidence")
    whole = (F.col("m.theme").isNotNull() & F.col("m.category").isNotNull() & confidence.isNotNull()
             & F.col("m.reasoning").isNotNull())
    ok = (F.col("status") == "success") & F.coalesce(whole, F.lit(False))
    return p.select(id_col, F.when(ok, F.col("m.theme")).alias("primary_theme"),
                    F.when(ok, F.col("m.category")).alias("primary_category"),
                    F.when(ok, confidence).alias("primary_confidence"), F.when(ok, F.col("m.reasoning")).alias("reasoning"),
                    F.when(ok, "success").otherwise("error").alias("status"),
                    F.when(~ok, F.coalesce("error", F.lit(prompts.MISSING_KEY))).alias("error"))
