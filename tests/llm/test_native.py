"""Order MinHash, line dedup and sharding against brute force, with awkward rows."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from feedlens.llm import fingerprints, line_dedup, sharding

LONG = "the quick brown fox jumps over the lazy dog again and again"
SCHEMA = "doc_id long, text string, n_lines string, shard string"


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", "y") for i, t in zip(ids, texts, strict=True)], SCHEMA)


# ---------------------------------------------------------------- order minhash

def reference_fingerprint(text):
    """The definition, word for word, without shared sorting."""
    import re
    units = [u for w in re.findall(r"[^ \t\n\x0b\f\r]+", text) for u in [w[i:i + 8] for i in range(0, len(w), 8)]]

    def xx(values):
        seed = 42
        for v in values:
            raw = v.encode() if isinstance(v, str) else (v & (1 << 64) - 1).to_bytes(8, "little")
            seed = xxhash.xxh64_intdigest(raw, seed)
        return seed
    k, top = fingerprints.K, 63 - fingerprints.SIGNATURE_BITS
    kmers = [xx(units[i:i + k]) for i in range(max(len(units) - k, 0) + 1)] if units else []
    seen, numbered = {}, []
    for p, h in enumerate(kmers):
        n = seen.get(h >> 27, 0)
        seen[h >> 27] = n + 1
        seed = xxhash.xxh64_intdigest((h >> 27).to_bytes(8, "little"), 42)
        numbered.append(((xxhash.xxh64_intdigest(n.to_bytes(4, "little"), seed) >> 27) << 26 | p, p))
    out = []
    for c in range(fingerprints.SIGNATURES):
        least = sorted(x ^ c << top for x, _ in numbered)[:fingerprints.L]
        places = sorted(x & (1 << 26) - 1 for x in least)
        out.append(f"{xx([kmers[p] for p in places]):016x}"[-8:])
    return "".join(out)


def test_fingerprint_is_the_definition(spark):
    rng = random.Random(3)
    words = ["ab", "cd", "internationalisation", "é" * 9, "x"]
    texts = ["", " \n\t", "one", "one two", "a b c d", "z" * 50_000, "same " * 3000] + [
        " ".join(rng.choice(words) for _ in range(rng.randint(1, 400))) for _ in range(30)] + [
        " ".join(str(rng.random()) for _ in range(n)) for n in (3, 40, 400, 5000)]
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert got[i] == reference_fingerprint(t), t[:60]


def test_likeness_falls_with_edits_and_order(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(600)]
    base = " ".join(words)
    one = " ".join(words[:300] + ["new"] + words[301:])
    blocks = [words[i:i + 30] for i in range(0, 600, 30)]
    rng.shuffle(blocks)
    moved = " ".join(w for b in blocks for w in b)
    df = frame(spark, [base, base, one, moved, ""])
    fp = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(df).collect()}
    pairs = spark.createDataFrame([(i, fp[0], fp[i]) for i in range(5)], "i int, a string, b string")
    like = {r["i"]: r["l"] for r in pairs.select("i", fingerprints.likeness(F.col("a"), F.col("b")).alias("l")).collect()}
    assert like[1] == 1.0 and like[4] == 0.0
    assert like[2] > 0.9 > like[3] > 0.2  # the same words in another order are less alike


def test_sliding_units_follow_an_edit_in_a_text_without_blanks(spark):
    rng = random.Random(11)
    base = "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(4000))
    lines = [base[i:i + 200] for i in range(0, 4000, 200)]
    # runs of up to 8 characters are one unit in both ways, so short words have equal fingerprints
    texts = [base, "\u4e00" + base, "\n".join(lines), "\n".join("\u4e00" * (i % 5 == 0) + x for i, x in enumerate(lines)),
             "", "a bb 12345678 \U0001f600x"]
    df = frame(spark, texts)
    fp = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(df, sliding=True).collect()}
    old = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(df).collect()}
    same = lambda a, b: sum(a[i:i + 8] == b[i:i + 8] for i in range(0, len(a), 8)) / fingerprints.SIGNATURES
    assert same(fp[0], fp[1]) >= 0.9 and same(fp[2], fp[3]) >= 0.7
    assert same(old[0], old[1]) == 0
    assert fp[4] == old[4] and fp[5] == old[5]
    units = df.select(F.regexp_extract_all("text", F.lit(fingerprints.SLIDING), F.lit(1)).alias("u")).where("doc_id = 1").first()["u"]
    assert units == [texts[1][i:i + 8] for i in range(4001 - 7)]


def test_op1_has_sliding_units(spark, tmp_path):
    from feedlens.llm.queries import QUERIES
    rng = random.Random(12)
    texts = ["".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(300))]
    texts.append("\u4e00" + texts[0])
    df = frame(spark, texts)
    df.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op1_order_minhash"](spark, str(tmp_path)).collect()}
    assert got[0]["near_next"] == got[1]["near_next"] >= 0.7


@pytest.mark.parametrize("ids", [list(range(50)), [7 * i % 50 for i in range(50)], [3] * 5, [None, None, 2, 1, None],
                                 [5], [None], []])
def test_next_in_descending_order(spark, ids):
    texts = [f"text {i}" for i in range(len(ids))]
    df = fingerprints.with_next(frame(spark, texts, ids), "doc_id", {"next_text": "text"}, ["text"])
    got = sorted((r["doc_id"] is None, -(r["doc_id"] or 0), r["text"], r["next_text"]) for r in df.collect())
    assert len(got) == len(ids)
    # every text is someone's next exactly once, and ids fall along the chain
    assert sorted(g[3] for g in got) == sorted(texts)
    id_of = dict(zip(texts, ids, strict=True))
    wraps = 0
    for _, _, text, nxt in got:
        a, b = id_of[text], id_of[nxt]
        wraps += not (b is None or (a is not None and b <= a))
    assert wraps <= 1


def test_null_text_and_clashing_columns(spark):
    df = fingerprints.fingerprints(frame(spark, [None, ""]), out_col="shard")
    rows = df.collect()
    assert df.columns == ["doc_id", "text", "n_lines", "shard"]
    assert rows[0]["shard"] == rows[1]["shard"]


# ---------------------------------------------------------------- lines

def reference_lines(rows, min_docs=5, min_chars=40):
    blanks = "\t\n\x0b\x0c\r "
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(line.strip(blanks).translate(lower), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            key = line.strip(blanks).translate(lower)
            ids = holders[key]
            if len(key) >= min_chars and len(ids) >= min_docs:
                keeper = max((x for x in ids if x is not None), default=None)
                if i != keeper:
                    continue
            kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(1)
    pool = [LONG, "  " + LONG.upper() + "\t\r", "É" + LONG, "é" + LONG, "x" * 39, "y" * 40, "short", "", "   ", LONG + "\xa0",
            "ß" * 40, "Z" * 40, "z" * 40]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, ("many lines %s\n" % LONG) * 3000), (None, LONG), (None, LONG)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    got = line_dedup.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "n_lines", "shard", "n_dropped"]
    found = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()), key=repr)
    assert found == sorted(reference_lines(rows), key=repr)


def test_repeated_rows_count_once(spark):
    rows = [(1, LONG)] * 9 + [(2, LONG)]
    got = line_dedup.dedup_lines(spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)).collect()
    assert len(got) == 10 and all(r["n_dropped"] == 0 for r in got)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert line_dedup.dedup_lines(empty).count() == 0
    assert fingerprints.fingerprints(empty).count() == 0
    assert sharding.shard(empty, "doc_id", 16).count() == 0


# ---------------------------------------------------------------- shards

def reference_jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 16, 17, 1000])
def test_jump_hash_is_the_published_function(spark, n):
    keys = [0, 1, -1, 2 ** 63 - 1, -2 ** 63, *(random.Random(n * 1000 + i).randint(-2 ** 62, 2 ** 62) for i in range(100))]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r["k"]: r["s"] for r in df.select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()}
    assert got == {k: reference_jump(k, n) for k in keys}


def test_shards_are_stable_gapless_and_grow_by_one(spark):
    ids = [None, None, 5, 5, *range(1000)]
    df = sharding.shard(frame(spark, [hashlib.md5(str(i).encode()).hexdigest() for i in ids], ids), "doc_id", 16, ["text"])
    rows = df.collect()
    assert df.columns[:4] == ["doc_id", "text", "n_lines", "shard"] and len(rows) == len(ids)
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) == set(range(16))
    moved = sum(r["grown_shard"] == 16 for r in rows)
    assert 20 < moved < 120
    assert {r["shard"] for r in rows if r["doc_id"] is None} == {r["shard"] for r in rows if r["doc_id"] is None}
