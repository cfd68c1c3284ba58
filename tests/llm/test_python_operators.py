"""Decontamination, similarity join, token counts, URL rules, packing, extraction and quality against brute force."""

import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from feedlens.llm import (components, decontamination, html_text, packing, quality, similarity_join, token_counts,
                          url_filter, words)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "mine", 7) for i, t in rows], "doc_id long, text string, spans string, n_words int")


# ---------------------------------------------------------------- words

def test_word_hashes_do_not_depend_on_place_or_piece(monkeypatch):
    import pyarrow as pa
    texts = ["a bb a", "", None, " bb\tccc\n", "Ä ä A", "x" * 3000 + " a bb", " ".join(f"w{i}" for i in range(2000))]

    def all_words():
        out = {}
        for first, bounds, h, s, e in words.word_groups(pa.array(texts), words.NOT_BLANK):
            for d in range(len(bounds) - 1):
                raw = (texts[first + d] or "").encode()
                out[first + d] = [(raw[x:y].decode().translate(LOWER), int(v)) for v, x, y in zip(
                    h[bounds[d]:bounds[d + 1]], s[bounds[d]:bounds[d + 1]], e[bounds[d]:bounds[d + 1]], strict=True)]
        return out
    whole = all_words()
    monkeypatch.setattr(words, "CHUNK", 64)
    assert all_words() == whole
    names = {}
    for i, t in enumerate(texts):
        assert [w for w, _ in whole[i]] == re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        for w, v in whole[i]:
            assert names.setdefault(w, v) == v
    assert len(set(names.values())) == len(names)


# ---------------------------------------------------------------- decontamination

def brute_contamination(text, items, window):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    ws, hit, found = find(text), set(), set()
    for i, t in items:
        iw = find(t)
        n = min(window, len(iw))
        wins = {tuple(iw[a:a + n]) for a in range(len(iw) - n + 1)} if iw else set()
        for a in range(len(ws) - n + 1):
            if tuple(ws[a:a + n]) in wins:
                hit |= set(range(a, a + n))
                found.add(i)
    return len(ws), hit, found


def random_case(seed):
    rng = random.Random(seed)
    vocab = ["a", "B", "c", "Ä", "9", "dd", "e-f"][:rng.randint(2, 7)]
    item = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(n))
    items = [(k, item(rng.choice([0, 1, 2, 3, 4, 5, 6, 9]))) for k in range(rng.randint(1, 6))]
    items += [(items[0][0], None), (90, items[-1][1]), (91, "")]
    texts = [item(rng.randint(0, 60)) + rng.choice(["", " zz "]) + (rng.choice(items)[1] or "") for _ in range(15)]
    return items, [*texts, None, "", "zz " * 300]


@pytest.mark.parametrize("seed", range(40))
def test_automaton_against_brute_force(seed):
    import pyarrow as pa
    items, texts = random_case(seed)
    items = [x for x in items if x[1] is not None]
    for window in (3, 5):
        index = decontamination.Index(items, window)
        n_words, runs, found = index.find(pa.array(texts))
        for k, t in enumerate(texts):
            n, hit, which = brute_contamination(t, items, window)
            assert n_words[k] == n and found[k] == which
            assert {w for a, b, _, _ in runs[k] for w in range(a, b)} == hit


def test_blocks_add_up_and_columns_survive(spark, monkeypatch):
    items, texts = random_case(7)
    rows = list(enumerate(texts))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs_frame(spark, rows)
    one = decontamination.find_contamination(df, bench, window=4, with_text=True)
    assert one.columns == ["doc_id", "text", "n_words", "n_hit", "spans", "item_ids", "clean_text"]
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 16)
    many = decontamination.find_contamination(df, bench, window=4, with_text=True)
    a, b = (sorted(x.collect(), key=lambda r: r["doc_id"]) for x in (one, many))
    assert [(r["n_words"], r["n_hit"], r["item_ids"], r["clean_text"]) for r in a] == [
        (r["n_words"], r["n_hit"], r["item_ids"], r["clean_text"]) for r in b]
    for r in a:
        n, hit, which = brute_contamination(r["text"], [x for x in items if x[1]], 4)
        assert (r["n_words"], r["n_hit"], r["item_ids"]) == (n, len(hit), sorted(which))


def test_spans_go_and_clean_documents_stay(spark):
    passage = " ".join(f"Secret{i}" for i in range(14))
    rows = [(1, f"Before, é {passage}. And much after it"), (2, passage), (3, "clean text"), (4, None), (5, "")]
    bench = spark.createDataFrame([(1, passage), (None, "clean")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.decontaminate(docs_frame(spark, rows), bench).collect()}
    assert got[1]["text"] == "Before, é . And much after it" and got[1]["spans"] == "mine" and got[1]["n_words"] == 7
    assert 2 not in got and got[3]["text"] == " text" and got[4]["text"] is None and got[5]["text"] == ""
    none = decontamination.decontaminate(docs_frame(spark, rows), bench.where("false"))
    assert {r["doc_id"]: r["text"] for r in none.collect()} == dict(rows)
    assert decontamination.decontaminate(docs_frame(spark, []), bench).count() == 0


# ---------------------------------------------------------------- similarity join

def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[a:a + 5]) for a in range(max(len(w) - 4, 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {(i, len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("seed", range(3))
def test_join_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "one\rTWO"), (5, "one two three four five"),
            (6, "same " * 40), (7, "same " * 90), (8, "x" * 5000)]
    passage = [f"p{i}" for i in range(60)]
    for _ in range(12):  # groups of near copies at many distances, exact copies, and a passage in unlike documents
        base = [f"v{rng.randint(0, 400)}" for _ in range(rng.randint(8, 150))]
        for _ in range(rng.randint(1, 16)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 7])):
                copy[rng.randrange(len(copy))] = f"n{rng.random()}"
            if rng.random() < 0.3:
                copy = copy[:rng.randint(len(copy) * 3 // 4, len(copy))]
            rows.append((len(rows), " ".join(copy)))
    for k in range(30):
        rows.append((len(rows), " ".join(passage + [f"u{k}.{i}" for i in range(rng.randint(2, 40))])))
    rng.shuffle(rows)
    got = similarity_join.jaccard_components(docs_frame(spark, rows).repartition(5))
    assert {tuple(r) for r in got.collect()} == brute_components(rows)


def test_join_on_awkward_tables(spark):
    assert similarity_join.jaccard_components(docs_frame(spark, [])).count() == 0
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "A b c d e f")]
    got = sorted(map(tuple, similarity_join.jaccard_components(docs_frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(5, 2, 5), (5, 2, 5), (None, 2, 5), (7, 2, 5)], key=repr)


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300), (1, None)]
    got = {r["node"]: r["root"] for r in components.connected_components(
        spark.createDataFrame(links, "x long, y long"), "x", "y").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
    assert components.connected_components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


# ---------------------------------------------------------------- token counts

def test_counts_equal_the_library(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(2)
    odd = ["", None, " ", "a", "don't  stop\n\n\n", "x<|endoftext|> y<|endoftext|>", "ab" * 20_000, "\x1c\x1d\x85\xa0 \u3000z",
           "é" * 300, "日本語テキスト 123 ४५", "\U0001f600\u200d", "   ", "a\r\n b", "1234567 8 9", "<|endoftext"]
    odd += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x300, 0xD7FF), rng.randint(0x10000, 0x1FFFF)]))
                    for _ in range(200)) for _ in range(50)]
    rows = list(enumerate(odd))
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(docs_frame(spark, rows), path).collect()}
    for i, t in rows:
        assert got[i] == (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)), t
    assert token_counts.count_tokens(docs_frame(spark, []), path).columns == [
        "doc_id", "text", "spans", "n_words", "n_bytes", "n_tokens"]


def test_counter_table_is_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED", 10)
    counter = token_counts.PairCounter(public_tokenizers.path("byte_bpe_50k.json"))
    counter.count(" ".join(f"w{i}" for i in range(1000)))
    assert len(counter) <= 11


# ---------------------------------------------------------------- URLs

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
URLS = ["http://A.Example.NET/en/1", "http://example.net/fr/1?x=/en/", "https://example.net", "https://net/", "http://xnet/",
        "http://x.example.com/de/9#a", "http://example.com/DE/9", "http://a.org/fr/", "http://org/fr/x", None, "", "no scheme",
        "a://b://c/d", "http://notexample.net/en/", "http://h?q=1", "http://h#f/x", "http:///fr/", "http://É.ORG/fr/ü"]


def brute_fixed(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group().translate(LOWER)
    path = re.match(r"[^?#]*", rest[re.match(r"[^/?#]*", rest).end():]).group()
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_fixed_rules_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    empty = spark.createDataFrame([], "url string, bad boolean")
    got = url_filter.judge(pages, empty, RULES)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()} == {
        i: brute_fixed(u) for i, u in enumerate(URLS)}


def test_mined_rules_against_counting(spark):
    rng = random.Random(4)
    urls = []
    for i in range(600):
        h, p = rng.choice(["good", "casino", "blog"]), rng.choice(["win", "news", "shop"])
        bad = h == "casino" and p == "win" and rng.random() < 0.95 or rng.random() < 0.03
        urls.append((f"http://{h}.site.example/{p}/{i}?{rng.choice(['a', 'b'])}=1", bad))
    urls += [("http://rare.example/x/1", True), (None, True), ("nothing", True), ("http://casino.site.example/win/5", None)]
    labelled = spark.createDataFrame(urls, "url string, bad boolean")
    mined = url_filter.mine_rules(labelled, "url", "bad", 0.02, 0.7).collect()
    assert [r["antecedent"] for r in mined] == [["host:casino", "path:win"]]
    both = [bad for u, bad in urls if u and "casino" in u and "/win/" in u and bad is not None]
    assert abs(mined[0]["confidence"] - sum(both) / len(both)) < 1e-9
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, labelled, [], "url", "bad", 0.02, 0.7).collect()}
    assert got == {i: "block" if u and "casino" in u and "/win/" in u else "allow" for i, (u, _) in enumerate(urls)}


@pytest.mark.parametrize("copies", [1, 20])
def test_coincidences_make_no_rule_at_any_size(spark, copies):
    urls = [(f"http://w{i}.example/{'abcdefghijklmnopqrst'[i % 20]}/{c}", i % 3 == 0) for c in range(copies) for i in range(60)]
    urls += [("http://once.example/x/1", True), ("http://twice.example/y/1", True), ("http://twice.example/y/2", True),
             ("http://four.example/z/1", True), ("http://four.example/z/2", True), ("http://four.example/z/3", True),
             ("http://four.example/z/4", True)]
    urls += [(f"http://casino.example/v/{i}", True) for i in range(40)]
    labelled = spark.createDataFrame(urls, "url string, bad boolean")
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, labelled, []).collect()}
    for i, (u, _) in enumerate(urls):
        if any(x in u for x in ("once", "twice", "four")):
            assert got[i] == "allow", u
        elif "casino" in u:
            assert got[i] == "block"


def test_wilson_bound(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2), (8, 8), (9, 9), (67, 70)], "k int, n int")
    got = [round(r["w"], 3) for r in rows.select(url_filter.wilson(F.col("k"), F.col("n")).alias("w")).collect()]
    assert got == [0.207, 0.342, 0.676, 0.701, 0.881]


def test_all_tokens_of_long_urls_are_mined(spark):
    from itertools import combinations
    rng = random.Random(8)
    slug = "/".join(f"{a}{b}" for a in "abcd" for b in "abcde")          # 20 tokens that all bad URLs share
    urls = [(f"http://m.example/{slug}/win/big/{'xyz'[i % 3]}?k=1", True) for i in range(60)]
    urls += [(f"http://m.example/{slug}/{rng.choice(['win', 'big', 'no'])}/{'xyz'[i % 3]}?k=1", False) for i in range(60)]
    urls += [(f"http://n.example/{rng.choice(['win', 'big', 'no'])}/{rng.choice('xyz')}", False) for _ in range(400)]
    urls += [(f"http://n.example/{rng.choice('xyz')}/win/big", rng.random() < 0.5) for _ in range(20)]
    labelled = spark.createDataFrame(urls, "url string, bad boolean")
    mined = {tuple(r["antecedent"]): r["confidence"] for r in url_filter.mine_rules(labelled, "url", "bad").collect()}
    assert len(mined) == len(set(mined))
    names = ["path:win", "path:big", "path:aa", "path:x", "host:m", "host:n", "query:k"]
    has = [({t for t in names if t.split(":")[1] in re.split(r"[/.?=]", u)}, b) for u, b in urls]
    bound = lambda k, m: (k / m + 1.96 ** 2 / 2 / m - 1.96 * (k / m * (1 - k / m) / m + (1.96 / 2 / m) ** 2) ** 0.5) / (
        1 + 1.96 ** 2 / m)
    base = sum(b for _, b in urls) / len(urls)
    want = {}
    for size in (1, 2, 3):
        for s in combinations(sorted(names), size):
            if any(set(w) < set(s) for w in want):
                continue
            rows = [b for t, b in has if t >= set(s)]
            if rows and sum(rows) >= 5 and bound(sum(rows), len(rows)) >= 0.7 and bound(sum(rows), len(rows)) > base:
                want[s] = sum(rows) / len(rows)
    found = {a: c for a, c in mined.items() if set(a) <= set(names)}
    assert want and set(found) == set(want) and all(abs(found[a] - want[a]) < 1e-9 for a in want)
    pages = spark.createDataFrame([(0, f"http://m.example/{slug}/win/big/q?k=1"), (1, f"http://m.example/{slug}/no/q?k=1")],
                                  "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, labelled, []).collect()}
    assert got == {0: "block", 1: "allow"}


# ---------------------------------------------------------------- packing

@pytest.mark.parametrize("seed", range(30))
def test_best_fit_takes_the_tightest_compatible_bin(seed):
    rng = random.Random(seed)
    n = rng.randint(0, 80)
    lengths = [rng.randint(1, 20) for _ in range(n)]
    sources, clusters = ([rng.choice([None, *range(k)]) for _ in range(n)] for k in (rng.randint(1, 6), 30))
    bins = []
    want = []
    for x, s, c in zip(lengths, sources, clusters, strict=True):
        fit = [(b["left"], k) for k, b in enumerate(bins) if b["left"] >= x and (s is None or s not in b["s"]) and (
            c is None or c not in b["c"])]
        if fit:
            k = min(fit)[1]
        else:
            k = len(bins)
            bins.append({"left": 20, "s": set(), "c": set()})
        want.append((k, 20 - bins[k]["left"]))
        bins[k]["left"] -= x
        bins[k]["s"].add(s)
        bins[k]["c"].add(c)
    assert packing.best_fit(lengths, sources, clusters, 20) == want


def test_every_byte_is_packed_once(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    rng = random.Random(9)
    rows = [(i, rng.choice([0, 1, 5, 99, 100, 101, 350]), rng.choice(["hot", "hot", "a", "b", None]), rng.randint(0, 40))
            for i in range(400)] + [(None, 30, "a", None), (3, 5, None, None), (3, 5, None, None), (7, None, "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, size int, source string, cluster long")
    got = packing.pack(df, "doc_id", "size", "source", "cluster", 100).collect()
    assert sum(r["piece_length"] for r in got) == sum(n or 0 for _, n, _, _ in rows)
    of = {}
    for i, n, s, c in rows:
        of.setdefault(i, (n, s, c))
    bins = {}
    for r in got:
        assert r["piece_start"] == 100 * r["piece"] and 0 < r["piece_length"] <= 100
        bins.setdefault(r["bin"], []).append(r)
    for b in bins.values():
        b.sort(key=lambda r: r["bin_start"])
        assert b[0]["bin_start"] == 0 and all(y["bin_start"] == x["bin_start"] + x["piece_length"] for x, y in zip(b, b[1:]))
        assert b[-1]["bin_start"] + b[-1]["piece_length"] <= 100
        for k in (1, 2):
            held = [of[r["doc_id"]][k] for r in b if r["doc_id"] not in (3, 7, None) and of[r["doc_id"]][k] is not None]
            assert len(held) == len(set(held))
    assert packing.pack(df.where("false"), "doc_id", "size", "source", "cluster", 100).count() == 0


def test_near_copies_share_no_bin_and_empty_texts_stay(spark):
    ws = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*ws, f"end{i}"]), f"s{i}") for i in range(12)] + [
        (20, None, "a"), (21, "", "b"), (22, "   ", "c"), (23, "   ", "d"), (24, "alone here", None), (24, "alone here", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack_texts(df, 8192).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    assert len({r["bin"] for r in got if r["doc_id"] < 12}) == 12
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert all(by[i][0]["bin"] is None and by[i][0]["piece_length"] == 0 for i in (20, 21))
    assert by[22][0]["bin"] != by[23][0]["bin"] and by[24][0]["bin"] != by[24][1]["bin"]


# ---------------------------------------------------------------- pages

PROSE = "the river is long and it runs to the sea with all of the rain that falls in the hills"


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("   ", ""), ("<p>", ""), (f"<p>{PROSE}", PROSE),
    (f"<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{PROSE}</p><p>Yes.</p></article><footer>&copy; me</footer>",
     f"Title\n{PROSE}\nYes."),
    (f'<div class="ad">{PROSE}</div><article><p><b>Bold<br><p>{PROSE}&amp;&nbsp;  more</article>', f"Bold\n{PROSE}& more"),
    (f'<script>var t="</p>";</script><style>p{{}}</style><article><p>{PROSE}</p><!-- {PROSE} --></article>', PROSE),
    (f"<p>{PROSE}</p><ul><li><a href=a>{PROSE}</a></li></ul><div id=comments><p>{PROSE}</p></div>", PROSE),
    (f"<aside><p>{PROSE}</p></aside><form><p>{PROSE}</p></form><p>{PROSE}</p>", PROSE),
    (f"<div><p>{PROSE}</p><p>Short one</p></div>", f"{PROSE}\nShort one"),
    (f"<p>{PROSE}<br><br>{PROSE}<br>x</p>", f"{PROSE}\n{PROSE} x"),
    (f"<article>{'<div>' * 3000}<p>{PROSE}", PROSE),
])
def test_main_text(html, text):
    assert html_text.main_text(html or "") == text


def test_extraction_keeps_columns(spark):
    df = spark.createDataFrame([(1, "u", "old", f"<p>{PROSE}"), (2, None, None, None)], "page_id long, url string, text string, html string")
    got = html_text.extract_text(df)
    assert got.columns == ["page_id", "url", "html", "text"]
    assert {r["page_id"]: r["text"] for r in got.collect()} == {1: PROSE, 2: ""}


# ---------------------------------------------------------------- quality

def quality_rows(n):
    rng = random.Random(n)
    names = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.6
        ws = [rng.choice(names) for _ in range(rng.randint(5, 120))]
        text = " ".join(ws) if good else "".join(w + rng.choice(["###", "%%%"]) + " " for w in ws)
        source = rng.choice(["s1", "s2"] if good == (rng.random() < 0.8) else ["s3", None])
        docs.append((i, text, "en", source, len(text) if i % 9 else None))
        if i % 3 == 0:
            labels.append((i, int(good)))
    return docs, labels


def test_held_out_accuracy_and_awkward_rows(spark):
    docs, labels = quality_rows(600)
    truth = {i: "###" not in t and "%%%" not in t for i, t, *_ in docs}
    docs += [(10_000, None, None, None, None), (10_001, "", "en", "s1", 0), (0, docs[0][1], "en", "s1", 3)]
    labels += [(1, 0), (1, 1), (2, None), (99_999, 1), (None, 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(docs, schema).withColumn("text_score", F.lit("clash"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    scored = quality.score(df, lab)
    assert scored.columns == ["doc_id", "text", "lang", "source", "n_chars", *quality.RESULTS]
    rows = scored.collect()
    assert len(rows) == len(docs) and all(0 <= r[c] <= 1 for r in rows for c in quality.RESULTS)
    held = [r for r in rows if r["doc_id"] in truth and r["doc_id"] % 3]
    right = sum((r["quality_score"] >= 0.5) == truth[r["doc_id"]] for r in held)
    assert right >= 0.98 * len(held)
    again = quality.score(df.repartition(7), lab).collect()
    assert {(r["doc_id"], r["text"], round(r["quality_score"], 9)) for r in again} == {
        (r["doc_id"], r["text"], round(r["quality_score"], 9)) for r in rows}


def test_no_labels_rejects_nothing(spark):
    docs, _ = quality_rows(20)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r["quality_score"] == 1.0 for r in quality.score(df, none).collect())
    assert quality.score(df.where("false"), none).count() == 0


def test_weak_view_learns_from_the_strong_one():
    import numpy as np
    rng = np.random.default_rng(0)
    y = (rng.random(1500) < 0.5).astype(float)
    strong = np.stack([y + rng.normal(0, 0.1, 1500), rng.normal(size=1500)], 1)
    weak = np.hstack([(y * 2 - 1)[:, None] * 0.4 + rng.normal(size=(1500, 1)), rng.normal(size=(1500, 40))])
    few = slice(0, 60)
    rest = slice(60, 1000)
    accuracy = []
    for rounds in (0, 5):
        model = quality.co_train([strong[few], weak[few]], y[few], lambda t: quality.confident_sums(t, [strong[rest], weak[rest]]), rounds)
        accuracy.append((((model.views[1].logit(weak[1000:]) > 0) == y[1000:]).mean()))
    assert accuracy[1] > accuracy[0] + 0.03


def test_join_cuts_each_text_once(spark):
    """One pass gives the set names of all documents, ids of any type, and the shared shingles."""
    docs = spark.createDataFrame([((i, "s"), t) for i, t in enumerate(["a b c d e f", "A b c d e f", "x y", None, "q r s t u v"])],
                                 "key struct<id:bigint,s:string>, text string")
    rows = similarity_join.shingled(docs, "key", "text", 5, 4).collect()
    named = {r["id"]["id"]: (r["node"], r["n"]) for r in rows if r["id"] is not None}
    assert [named[i][1] for i in range(5)] == [2, 2, 1, 0, 2] and named[3][0] is None and named[0] == named[1]
    assert all(r["shingle"] is None for r in rows)  # equal texts are one set, so no shingle is shared
    got = {r["key"]["id"]: r["component_id"]["id"] for r in similarity_join.jaccard_components(docs, "key", "text").collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}
