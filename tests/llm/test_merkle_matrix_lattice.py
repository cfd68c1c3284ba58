"""Merkle manifest, filter audit and lattice scores against brute force, with the cases that each docstring defines."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.llm import filter_audit, lattice_score, merkle, term_matrix
from feedlens.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture
def tables(spark, tmp_path):
    """Writes documents and labels and gives the folder."""
    def write(docs, labels=(), schema=DOCS):
        spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        return str(tmp_path)
    return write


# ---------------------------------------------------------------- Merkle manifest

def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def lowered(x):
    return None if x is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in x)


def brute_tree(digests):
    """(root, siblings of each leaf by level as (left, right))."""
    paths = [[] for _ in digests]
    below = [[k] for k in range(len(digests))]
    while len(digests) > 1:
        up, under = [], []
        for at in range(0, len(digests), 16):
            run = digests[at:at + 16]
            for j in range(len(run)):
                for leaf in below[at + j]:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(sha("".join(run)))
            under.append([leaf for b in below[at:at + 16] for leaf in b])
        digests, below = up, under
    return digests[0], paths


def brute_manifest(docs):
    leaf = [sha("".join(field(x) for x in (d, s, lang, n, t))) for d, t, lang, s, n in docs]
    bad = [sha("".join(field(x) for x in (d, s, lang, n, lowered(t)))) for d, t, lang, s, n in docs]
    groups = {}
    for k, d in enumerate(docs):
        groups.setdefault(d[3], []).append(k)
    names = sorted(groups, key=lambda s: b"" if s is None else b"=" + s.encode())
    first = lambda k: (docs[k][0] is not None, docs[k][0] or 0, leaf[k])
    trees = []
    for s in names:
        order = sorted(groups[s], key=first)
        trees.append((order, *brute_tree([leaf[k] for k in order])))
    root, above = brute_tree([t[1] for t in trees])
    rows = []
    for (order, subroot, paths), up in zip(trees, above):
        for k, path in zip(order, paths):
            path = path + up
            tampered = docs[k][0] is not None and zlib.crc32(str(docs[k][0]).encode()) % 5 == 0
            folded = bad[k] if tampered else leaf[k]
            for left, right in path:
                folded = sha(left + folded + right)
            rows.append((docs[k][0], leaf[k], subroot, root, sha("".join(a + b for a, b in path)), folded, folded == root))
    return sorted(rows, key=repr)


MERKLE_CASES = {
    "one": [(7, "A", "en", "s", 1)],
    "nulls_ties_repeats": [(1, None, None, None, None), (1, "x", "en", None, 1), (None, "Y", "en", "a", 1), (2, "", "de", "a", 0),
                           *[(5, "Same", "en", "a", 4)] * 3, (5, "other", "en", "a", 4), (3, "z\U0001F600é", "fr", "", 3)],
    "levels": [(k, f"Text {k}", "en", "big" if k % 9 else f"s{k % 41}", k) for k in range(700)],
    "exact_powers": [(k, "t" * (k % 3), "en", "p16" if k < 16 else "p256" if k < 272 else "p17" if k < 289 else "p257", 1)
                     for k in range(546)],
    "many_sources": [(k, "T", "en", f"ü{k}", 1) for k in range(40)],
}


@pytest.mark.parametrize("case", sorted(MERKLE_CASES))
def test_manifest_is_the_brute_force_one(spark, tables, case):
    got = QUERIES["op12_merkle_manifest"](spark, tables(MERKLE_CASES[case]))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_manifest(MERKLE_CASES[case])


def test_manifest_of_an_empty_table(spark, tables):
    assert QUERIES["op12_merkle_manifest"](spark, tables([])).count() == 0


def test_manifest_with_more_partitions_than_runs_goes_on_in_rounds(spark, tables):
    """Bounds of partitions cut runs and trees; the queue of the next round mends them."""
    docs = [(k, f"T{k}", "en", f"s{k % 3 and 1}", k) for k in range(3000)]
    folder = tables(docs)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        leaves = spark.createDataFrame([("a", sha(str(k)), k) for k in range(3000)], "g string, digest string, k bigint")
        assert len(merkle.forward(merkle.numbered(leaves, ["k"]))) > 1
        got = QUERIES["op12_merkle_manifest"](spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((tuple(r) for r in got), key=repr) == brute_manifest(docs)


def test_manifest_keeps_columns_of_clashing_names(spark):
    rows = [(k, "s", sha(str(k)), f"v{k}") for k in range(20)]
    leaves = spark.createDataFrame(rows, "id bigint, source string, digest string, extra string")
    proved, root = merkle.manifest(leaves, "source", ["id"])
    assert proved.columns == ["id", "source", "digest", "extra", "subroot", "path"]
    assert {r["root"] for r in proved.select(merkle.fold(F.col("digest"), F.col("path")).alias("root")).collect()} == {root}


# ---------------------------------------------------------------- filter audit

def brute_failures(docs):
    first = {}
    for d, t, *_ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    out = []
    for d, t, lang, *_ in docs:
        t = t or ""
        words = WORDS.findall(t)
        fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 bool(re.search(r"[#$%&*|]", t)), d is not None and t in first and d > first[t]]
        out.append((d, lang or "", fails, len(words), len(set(words))))
    return out


def brute_audit(docs, labels):
    good, toxic = ({d for d, *x in labels if x[k] == 1} for k in (0, 1))
    rows = []
    failed = brute_failures(docs)
    for part in {f[1] for f in failed}:
        mine = [f for f in failed if f[1] == part]
        removed = {}
        for order in itertools.permutations(range(5)):
            left = mine
            for step, k in enumerate(order):
                here = [f for f in left if f[2][k]]
                removed[order, step] = here
                left = [f for f in left if not f[2][k]]
                rows.append([part, "".join("ABCDE"[x] for x in order), step + 1, len(left), len(here),
                             sum(f[2][k] for f in mine) - len(here), sum(f[2][k] and sum(f[2]) == 1 for f in mine),
                             sum(f[0] in good for f in here), sum(f[0] in toxic for f in here)])
        total = Counter()
        for r in rows:
            if r[0] == part:
                total[r[1][r[2] - 1]] += r[4]
        for r in rows:
            if r[0] == part:
                r.append(total[r[1][r[2] - 1]])
    return sorted(map(tuple, rows))


LONG = " ".join(f"w{k}" for k in range(250))
AUDIT = [(1, LONG, "en", "s", 1), (2, LONG, "en", "s", 1), (2, LONG, "de", "s", 1), (3, None, None, "s", 1), (4, "", "", "s", 1),
         (5, "  \t\n", "en", "s", 1), (6, "A B C #", "en", "s", 1), (7, " ".join(["x"] * 300), "en", "s", 1),
         (8, " ".join(["x", "y"] * 300) + " é\xa0\x85\x1cü", "de", "s", 1), (9, "Ab cd " * 400 + "&", "de", "s", 1), (None, LONG, "en", "s", 1),
         (10, LONG.upper(), "en", "s", 1), (11, "a\x0bb\x0cc", "en", "s", 1), (12, "# " + LONG, "fr", "s", 1), (13, "x" * 300000, "fr", "s", 1)]
AUDIT_LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, None), (3, None, 1), (6, 1, 1), (9, 1, 0), (None, 1, 1), (13, 0, 1)]


@pytest.mark.parametrize("block", [40, 1 << 20])
def test_audit_is_the_brute_force_one(spark, tables, monkeypatch, block):
    monkeypatch.setattr(term_matrix, "ENTRIES", 50 if block == 40 else 400_000)
    folder = tables(AUDIT, AUDIT_LABELS)
    failed = filter_audit.failures(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    expected = [(d, part, sum(f << k for k, f in enumerate(fails)), n, m) for d, part, fails, n, m in brute_failures(AUDIT)]
    assert sorted(map(tuple, failed), key=repr) == sorted(expected, key=repr)
    got = QUERIES["op13_filter_audit"](spark, folder)
    assert sorted(map(tuple, got.collect())) == brute_audit(AUDIT, AUDIT_LABELS)


def test_audit_of_an_empty_table(spark, tables):
    assert QUERIES["op13_filter_audit"](spark, tables([])).count() == 0


def test_blocks_cover_all_rows_and_words_have_one_number(spark, monkeypatch):
    column = pa.array(["a b", None, "c" * 50, "", "b b"])
    monkeypatch.setattr(term_matrix, "BLOCK_BYTES", 8)
    assert list(term_matrix._blocks(column)) == [(0, 2), (2, 3), (3, 5)]
    monkeypatch.undo()
    rows = spark.createDataFrame([(k, f"w{k % 7} é x{k}") for k in range(60)], "id int, text string").repartition(5)
    found = term_matrix.document_term_matrix(term_matrix.term_shards(rows, "text")).collect()
    number = {}
    assert len(found) > 1
    for shard in found:
        indptr, columns, counts = (term_matrix.unpack(shard[c]) for c in ("indptr", "columns", "counts"))
        for k, r in enumerate(shard["rows"]):
            mine = columns[indptr[k]:indptr[k + 1]]
            assert len(set(mine)) == 3 and (counts[indptr[k]:indptr[k + 1]] == 1).all()
            number.setdefault(f"w{r['id'] % 7}", []).append(set(mine.tolist()))
    common = {w: set.intersection(*sets) for w, sets in number.items()}
    assert all(len(c) == 2 for c in common.values()) and len(set.union(*common.values())) == 8


# ---------------------------------------------------------------- lattice scores

def brute_probability(lattice, pieces, word):
    """The sum over all segmentations, one by one."""
    text = lattice_score.MARK + word
    total = 0.0

    def go(at, p):
        nonlocal total
        if at == len(text):
            total += p
            return
        if text[at:at + 1] not in pieces or (text[at] == lattice_score.MARK and at):
            parts = lattice.bytes_of[list(text[at].encode())]
            go(at + 1, p * math.exp(lattice.log_weight[parts].sum()))
        for to in range(at + 1, min(len(text), at + lattice.depth) + 1):
            if (at == 0 or lattice_score.MARK not in text[at:to]) and lattice_score.MARK not in text[at + 1:to] and text[at:to] in pieces:
                go(to, p * math.exp(lattice.log_weight[pieces[text[at:to]]]))
    go(0, 1.0)
    return total


@pytest.fixture(scope="module")
def lattice():
    return lattice_score.Lattice.load(VOCABULARY)


@pytest.fixture(scope="module")
def pieces():
    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    return {model.id_to_piece(i): i for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}


def test_forward_sums_all_segmentations(lattice, pieces):
    words = ["the", "unhappily", "x", "été", "日本語", "a▁b", "\U0001F600k", "zzzz", "ﷺ", "the"]
    got = lattice.log_probabilities(words)
    for w, g in zip(words, got, strict=True):
        assert math.isclose(g, math.log(brute_probability(lattice, pieces, w)), rel_tol=1e-9), w
    assert np.isclose(np.exp(lattice.log_weight).sum(), 1)


def test_windows_do_not_change_a_word(lattice, monkeypatch):
    words = ["abc" * 400 + "é", "the"]
    whole, uses = lattice.log_probabilities(words), lattice.expected(words)
    monkeypatch.setattr(lattice_score, "WINDOW", 256)
    assert np.allclose(lattice.log_probabilities(words), whole, rtol=1e-12)
    assert np.allclose(lattice.expected(words), uses, rtol=1e-9, atol=1e-9)


def test_expected_uses_are_the_gradient(lattice):
    """d log P / d log w is the expected number of uses of a piece."""
    word, step = "unhappily", 1e-5
    uses = lattice.expected([word])
    assert set(np.flatnonzero(uses > 1e-12)) and uses.sum() > 1
    for piece in np.flatnonzero(uses > 1e-6):
        more = lattice_score.Lattice(**{**lattice.__dict__, "log_weight": lattice.log_weight.copy()})
        more.log_weight[piece] += step
        slope = (more.log_probabilities([word])[0] - lattice.log_probabilities([word])[0]) / step
        assert math.isclose(slope, uses[piece], rel_tol=1e-3, abs_tol=1e-6)


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 5 == 1


def test_scores_are_those_of_the_definition(spark, tables, lattice):
    docs = [(k, text, "en", "s", 1) for k, text in enumerate(
        ["The cat sat", "the CAT  sat\ton", None, "", "new words été", "the the the", "日本語 cat", "\xa0odd\x85 \x1c", "on the mat " * 50,
         "antidisestablishmentarianism", "the cat sat", "x" * 2000] * 2)] + [(None, "no id", "en", "s", 1), (3, "the cat", "en", "s", 1)]
    got = QUERIES["op11_subword_lattice"](spark, tables(docs)).collect()
    tokens = [[lowered(w) for w in WORDS.findall(t or "")] for _, t, *_ in docs]
    train = [t for t, d in zip(tokens, docs) if not held(d[0])]
    c = Counter(w for t in train for w in t)
    n, v, ends = sum(c.values()) + len(train), len(c) + 1, len(train)
    a = max(1, sum(x == 1 for x in c.values()))
    refined = lattice.refined(lattice.expected(sorted(c)))
    words = sorted({w for t in tokens for w in t})
    log_p = dict(zip(words, refined.log_probabilities(words)))
    expected = []
    for t, (d, *_) in zip(tokens, docs):
        base = sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in t) + math.log10((ends + .5) / (n + .5 * (v + 1)))
        own = sum((math.log(c[w] + a * .99 * math.exp(log_p[w])) if c[w] else math.log(a * .99) + log_p[w]) / math.log(10)
                  - math.log10(n + a) for w in t) + math.log10((ends + a * .01) / (n + a))
        pure = sum((log_p[w] + math.log1p(-ends / n)) / math.log(10) for w in t) + math.log10(ends / n)
        expected.append((d, held(d), len(t) + 1, sum(c[w] > 0 for w in t) + 1, n, base, own, pure))
    key = lambda r: (repr(r[0]), r[2], round(r[5], 6))
    for g, e in zip(sorted(map(tuple, got), key=key), sorted(expected, key=key), strict=True):
        assert g[:5] == e[:5] and g[5:] == pytest.approx(e[5:], rel=1e-6), (g, e)


def test_equal_texts_score_alike_and_learning_helps_on_held_out_texts(spark):
    rows = QUERIES["op11_subword_lattice"](spark, "/root/testdata/sf0.01").collect()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    by_text = {}
    for r in rows:
        by_text.setdefault(text[r["doc_id"]], set()).add((r["score"], r["base_score"], r["lattice_score"]))
    assert all(len(s) == 1 for s in by_text.values())
    out = [r for r in rows if r["held_out"]]
    learned, pure = (sum(r[c] for r in out) for c in ("score", "lattice_score"))
    plain = lattice_score.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), VOCABULARY, rounds=0)
    unrefined = plain.where("held_out").agg(F.sum("lattice_score")).first()[0]
    assert learned > pure > unrefined


@pytest.mark.parametrize("docs", [[], [(next(k for k in range(99) if held(k)), "only held out", "en", "s", 1)]])
def test_scores_without_training_rows(spark, tables, docs):
    rows = QUERIES["op11_subword_lattice"](spark, tables(docs)).collect()
    assert len(rows) == len(docs) and all(math.isfinite(r["score"]) and math.isfinite(r["lattice_score"]) for r in rows)


def test_rows_struct_takes_odd_types(spark):
    rows = spark.createDataFrame([(1, "a b", [1, 2], None)], T.StructType.fromDDL("id int, text string, l array<int>, m map<string,int>"))
    assert term_matrix.term_shards(rows, "text").first()["rows"][0]["l"] == [1, 2]
