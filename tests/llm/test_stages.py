"""Edge cases of the five pipeline stages, rules mined through the query, and pages whose main text earlier rules lost."""

import random

import pytest

import corpus_pipeline
from feedlens.llm import html_text
from feedlens.llm.queries import QUERIES
from tests.conftest import SMOKE

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, `key` int"
PROSE = " ".join(f"word{i}" for i in range(60))
ROWS = [(1, PROSE, "en", "a", 1, "r1", 1), (5, PROSE, "en", "b", 1, "r2", 2), (5, "another text of a few words only", "en", "b", 1, "r3", 3),
        (7, "another text of a few words only", "en", "c", 1, "r4", 4), (7, "another text of a few words only", "en", "c", 1, "r4", 4),
        (None, None, None, None, None, None, None), (None, PROSE, None, None, None, "r5", 5), (8, "", "de", "a", 0, "r6", 6), (9, None, "de", "a", None, "r7", 7),
        (10, "x" * 200_000, "de", "a", 3, "r8", 8), (11, PROSE + " tail", "fr", "d", 2, "r9", 9)]


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_empty_tables(spark, name):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    out = stage(name)(spark, docs, SMOKE)
    rows = out.collect()
    assert stage(name)(spark, docs.limit(0), SMOKE).count() == 0
    if name != "best_fit_packing":
        assert out.columns == docs.columns
        assert {r["row"] for r in rows} <= {r[5] for r in ROWS}
    got = sorted(map(tuple, rows), key=repr)
    if name in ("line_dedup", "benchmark_decontamination"):
        assert [(r["doc_id"], r["text"] or "") for r in rows if r["doc_id"] == 10] == [(10, "x" * 200_000)]
        assert len(rows) == len(ROWS)
    elif name == "ngram_jaccard_join":
        # of the copies of PROSE the null id comes first; of the other text id 5 stays; rows without words stay
        first = {5: "r3"}
        kept = [r for r in got if r[1] and len(r[1]) < 1000]
        assert sorted(((r[0], r[5]) for r in kept), key=repr) == sorted([(None, "r5"), (5, first[5])], key=repr)
        assert sum(not r[1] for r in got) == 3 and any(r[0] == 10 for r in got)
    elif name == "best_fit_packing":
        assert sum(r["piece_length"] for r in rows) == sum(len((r[1] or "").encode()) for r in ROWS)
        assert sum(r["bin"] is None for r in rows) == 3


def test_no_text_is_lost_with_repeated_ids(spark):
    """Rows of one id are documents of their own, and each group of near copies keeps one."""
    docs = spark.createDataFrame([(1, PROSE), (5, PROSE), (5, "B " + PROSE[::-1]), (7, "B " + PROSE[::-1] + " x"), (7, "B " + PROSE[::-1] + " x")],
                                 "doc_id bigint, text string")
    kept = sorted((r["doc_id"], r["text"][:1]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SMOKE).collect())
    assert kept == [(1, "w"), (5, "B")]


def test_mined_rule_blocks_its_pages_through_the_query(spark, tmp_path):
    """A combination of tokens that goes with bad documents is planted; neither of its parts is bad alone."""
    rng = random.Random(3)
    pages, labels = [], []
    for i in range(400):
        word, key = rng.choice(["casino", "garden"]), rng.choice(["ref", "page"])
        pages.append((i, f"https://site{i % 7}.example.edu/{word}/{i}?{key}=1", ""))
        if i < 300:
            labels.append((i, 0 if word == "casino" and key == "ref" else 1, 0))
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["page_id"]: r for r in QUERIES["op8_url_association_rules"](spark, str(tmp_path)).collect()}
    # the page's number is the last one of its path
    for i, url, _ in pages:
        assert got[i]["rule"] is None and got[i]["verdict"] == ("block" if "casino" in url and "ref=" in url else "allow")
    assert sum(r["verdict"] == "block" for i, r in got.items() if i >= 300) > 10


ZH = "人工智能正在改变世界。许多公司都在投资这项技术，希望能够提高效率，并且降低成本。" * 3
RU = "Учёные обнаружили новый вид рыб, который живёт на большой глубине. Эта находка важна для науки, потому что она меняет представления."
EN = "The committee met on Monday to talk about the plan, and it was clear to all of them that more time is needed."


@pytest.mark.parametrize("page,text", [
    (f"<body><p>{ZH}</p><p>{ZH}</p></body>", f"{ZH}\n{ZH}"),
    (f"<body><div><p>{RU}</p><p>{RU}</p></div></body>", f"{RU}\n{RU}"),
    ("<body><p>One two three.</p><p>Four five.</p></body>", "One two three.\nFour five."),
    (f"<body><div id='comments-enabled'><p>{EN}</p></div></body>", EN),
    (f"<body><article><div class='post-header'><h1>A title</h1></div><p>{EN}</p></article></body>", f"A title\n{EN}"),
    (f"<body><article><p class='notice-board'>{EN}</p><p>{RU}</p></article></body>", f"{EN}\n{RU}"),
    (f"<body><article><p>{EN}</p><p class='notice'>Sign up now</p></article></body>", EN),
    (f"<body><article><p>{EN}</p></article><div class='comments'><div class='comment'><p>{EN}</p></div></div></body>", EN),
    (f"<body><div class='sidebar-left'><p>{EN}</p></div><div class='site-footer'><p>{RU}</p></div><div><p>{ZH}</p></div></body>", ZH),
    ("<body><ul><li><a href='x'>Home</a></li><li>About us</li></ul></body>", ""),
    (f"<body><article><p>{EN}</p><p>Short.</p><div><a href='x'>{EN}</a></div></article></body>", f"{EN}\nShort.")])
def test_main_text_of_pages_in_any_script(page, text):
    assert html_text.main_text(page) == text


def brute_labels(blocks):
    """Each open block looks at every decided block of its container."""
    first = [b.decided() for b in blocks]
    out = []
    for i, b in enumerate(blocks):
        near = [(abs(i - j), j) for j, o in enumerate(blocks) if first[j] is not None and not o.boiler and o.container == b.container]
        least = min(near, default=(0, 0))[0]
        if first[i] is not None:
            out.append(first[i])
        elif near:
            out.append(any(first[j] for d, j in near if d == least))
        else:
            out.append(b.in_main or not any(o.in_main for o in blocks) and b.is_sentence())
    return out


@pytest.mark.parametrize("seed", range(20))
def test_second_pass_equals_brute_force(seed):
    rng = random.Random(seed)
    body = "".join(rng.choice([f"<p>{EN}</p>", "<p>Short.</p>", "<p>short</p>", "<p class='notice'>say</p>", "<article>", "</article>", f"<div>{RU}</div>",
                               f"<p><a href='x'>{EN}</a></p>", "<nav>menu</nav>", f"<h2>{ZH[:8]}</h2>", "<div class='comments'>", "</div>"]) for _ in range(40))
    reader = html_text.PageReader()
    reader.feed(f"<body>{body}</body>")
    blocks = reader.finished()
    assert html_text._labels(blocks) == brute_labels(blocks)
