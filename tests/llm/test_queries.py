"""The registered queries on the smallest tables, and the pipeline stage by stage against brute force."""

import hashlib

import pytest

import __spark_entry__
import corpus_pipeline
from feedlens.llm.queries import ORACLE, QUERIES
from feedlens.plans.compare import compare, type_problems
from tests.conftest import SMOKE
from tests.llm.test_native import reference_lines
from tests.llm.test_python_operators import brute_components, brute_contamination, brute_fixed

#: The columns each contract asks for, with their types.
CONTRACTS = {
    "op1": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double",
    "op2": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op3": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op4": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op5": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op7": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op8": "page_id bigint, host string, path string, rule string, verdict string",
    "op11": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
            "score double, lattice_score double",
    "op12": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    "op13": "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
            "good_lost bigint, toxic_lost bigint, shapley bigint",
    "op10": "page_id bigint, url string, text string, n_chars bigint",
}


def documents(spark):
    return spark.read.parquet(f"{SMOKE}/documents.parquet")


def test_all_are_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(n.split("_")[0] for n in names) == sorted([f"op{i}" for i in range(1, 14)] + ["pipeline"])
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_one_row_per_document_with_the_agreed_columns(spark, name):
    df = QUERIES[name](spark, SMOKE)
    agreed = CONTRACTS.get(name.split("_")[0])
    if agreed:
        assert [f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields] == agreed.split(", ")
    table = "pages" if name.startswith(("op8", "op10")) else "documents"
    expected = spark.read.parquet(f"{SMOKE}/{table}.parquet").count()
    if name.startswith("op13"):  # a row per language, order and step
        expected = 600 * documents(spark).select("lang").distinct().count()
    n = df.count()
    assert n == expected or name.startswith("op9") and n >= expected


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SMOKE)
    cur = duck.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    problems = compare(df.columns, df.collect(), cols, cur.fetchall())
    problems += type_problems(df.schema, duck.execute("DESCRIBE " + ORACLE[name]).fetchall())
    assert not problems, problems


def test_edited_texts(spark):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in documents(spark).collect()), reverse=True)
    got = {r["doc_id"]: r for r in QUERIES["op1_order_minhash"](spark, SMOKE).collect()}
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1], strict=True):
        cut = len(t) // 3
        edited = t[:len(t) - cut] + nxt[:cut]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert sum(r["near_edited"] for r in got.values()) > 5 * sum(r["near_next"] for r in got.values())


def test_url_rules(spark):
    pages = spark.read.parquet(f"{SMOKE}/pages.parquet").select("page_id", "url").collect()
    got = {r["page_id"]: r for r in QUERIES["op8_url_association_rules"](spark, SMOKE).collect()}
    for p in pages:
        host, path, rule, verdict = brute_fixed(p["url"])
        r = got[p["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert rule is None or r["verdict"] == verdict


def test_pipeline_stages_against_brute_force(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = documents(spark)
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, SMOKE).collect() or [], stage(spark, docs, SMOKE).schema)
        rows = docs.collect()
        kept[name] = rows
        if name == "best_fit_packing":
            continue
        assert docs.columns == columns
        after = {r["doc_id"]: r for r in rows}
        assert set(after) <= set(before)
        if name == "quality_classifier":
            labels = spark.read.parquet(f"{SMOKE}/labels.parquet").collect()
            wrong = sum((r["doc_id"] in after) != (r["quality"] == 1) for r in labels)
            assert wrong <= 0.05 * len(labels) and all(after[i] == before[i] for i in after)
        elif name == "line_dedup":
            want = {i: t for i, _, _, t in reference_lines([(i, r["text"]) for i, r in before.items()])}
            assert {i: r["text"] for i, r in after.items()} == want
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        elif name == "ngram_jaccard_join":
            assert set(after) == {c for _, _, c in brute_components([(i, r["text"]) for i, r in before.items()])}
        else:
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
            for i, r in before.items():
                n, hit, _ = brute_contamination(r["text"], items, 10)
                assert (i in after) == (len(hit) <= 0.8 * n)
                assert i not in after or hit or after[i]["text"] == r["text"]
    texts = {r["doc_id"]: r for r in kept["benchmark_decontamination"]}
    assert sum(r["piece_length"] for r in kept["best_fit_packing"]) == sum(len(r["text"].encode()) for r in texts.values())
    bins = {}
    for r in kept["best_fit_packing"]:
        bins.setdefault(r["bin"], []).append(r)
    for b in bins.values():
        assert sum(r["piece_length"] for r in b) <= corpus_pipeline.BIN_BYTES
        assert len({texts[r["doc_id"]]["source"] for r in b}) == len(b)
