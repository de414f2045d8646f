"""Rows without an id or with a repeated one, large groups, and pages of other markup."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import orderlake.llm.near_dedup as near_dedup
from orderlake.llm.html_text import main_lines, main_text, page_lines
from orderlake.llm.near_dedup import near_copies

DOCS = "doc_id long, text string"


def words(name, n=40):
    return [f"{name}{i}" for i in range(n)]


def test_near_copies_without_id(spark):
    """Texts without an id are nodes of their own: each finds its own copy, and they are not joined with each other."""
    rows = []
    for name, i in (("a", 1), ("b", 2), ("c", 3)):
        rows += [(None, " ".join(words(name))), (i, " ".join(words(name)[:-1] + ["end"]))]
    rows += [(7, " ".join(words("d"))), (7, " ".join(words("e"))), (8, " ".join(words("e")[:-1] + ["end"])), (9, " ".join(words("f")))]
    got = near_copies(spark.createDataFrame(rows, DOCS), words=2).collect()
    of = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert of == {1: None, 2: None, 3: None, 7: 7, 8: 7, 9: 9} and len(got) == len(rows)


def test_stages_keep_rows_without_id_apart(spark, tmp_path):
    passage = "some benchmark text that is nowhere else at all"
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    hit = f"x {passage} y"
    rows = [(None, hit), (None, "clean one"), (None, "clean two"), (4, hit), (4, "clean three"), (5, "clean four"), (None, None), (6, hit)]
    left = corpus_pipeline.decontaminate(spark, spark.createDataFrame(rows, DOCS), str(tmp_path)).collect()
    assert sorted(map(str, left)) == sorted(str(r) for r in spark.createDataFrame([r for r in rows if r[1] != hit], DOCS).collect())

    near = lambda name: [" ".join(words(name)), " ".join(words(name)[:-1] + ["end"])]
    rows = [(None, t) for t in near("a") + near("b")] + [(4, t) for t in near("c") + ["other words here"]] + [(5, near("c")[0]), (5, "alone"), (5, "alone"), (None, None), (None, "")]
    left = [tuple(r) for r in corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, DOCS), str(tmp_path)).collect()]
    for name, i in (("a", None), ("b", None), ("c", 4)):
        assert sum((i, t) in left for t in near(name)) == 1
    assert len(left) == 7 and {(4, "other words here"), (5, "alone"), (None, None), (None, "")} <= set(left)


def text_of(page):
    return main_lines(page_lines(page))[0]


def test_words_in_classes_of_pages():
    body = '<h2 id="related-work">Related work</h2><section id="share-prices"><p class="notice-period">Notice period</p></section><h3 id="comments">Comments</h3>'
    want = ["Story", "Related work", "Notice period", "Comments"]
    for around in ('div class="content has-sidebar"', 'div id="page" class="site no-banner"', 'div class="sidebar"', 'form id="all"'):
        assert text_of(f"<body><{around}><div class='ad'>Buy</div><article><p>Story</p>{body}<div class='share'>Share</div></article></{around.split()[0]}></body>") == want
    assert text_of('<div class="social newsletter">Follow us</div><p>Story</p><div id="comments">nice</div>') == ["Story"]


def test_articles_beside_the_story():
    story, teasers = "<p>" + "Story goes on. " * 20 + "</p>", "<article>Teaser one</article><article>Teaser two</article>"
    want = ("Story goes on. " * 20).strip()
    assert main_lines(page_lines(f"<body><div>{story}</div>{teasers}</body>")) == ([want, "Teaser one", "Teaser two"], True)
    assert main_lines(page_lines(f"<body><div>{story}</div><aside><article>Teaser</article></aside></body>")) == ([want], True)
    assert main_lines(page_lines(f"<body><div>Menu</div><main>{story}{teasers}</main></body>")) == ([want, "Teaser one", "Teaser two"], False)
    assert main_lines(page_lines(f"<body><div>Menu</div><article>{story}</article></body>")) == ([want], False)


def plain_page(story, date=""):
    return f"<body><div>Menu line</div><p>{story} begins</p><p>{story} goes on and on</p><p>{story} ends</p>{date and f'<p>Read {date} times</p>'}<div>Legal line</div></body>"


def story_lines(story, date=""):
    return [f"{story} begins", f"{story} goes on and on", f"{story} ends", *([f"Read {date} times"] if date else [])]


@pytest.mark.parametrize("partitions", [1, 40])
def test_near_copies_of_pages(spark, partitions):
    """Stories under several URLs, and equal pages side by side or on another host, in one range and in many."""
    rows = [(0, "http://h/a/0", plain_page("First"))]
    rows += [(i, f"http://h/b/{i:02}", plain_page("Second", i)) for i in range(1, 31)]
    rows += [(40, "http://h/c/0", plain_page("Third")), (41, "http://other/0", plain_page("Second", 7))]
    rows += [(i, f"http://k/b/{i}", plain_page("Fourth")) for i in range(50, 55)] + [(60, "http://k/z", plain_page("Fifth"))]
    rows += [(i, f"http://m/{i}", plain_page("Alone", i)) for i in range(70, 73)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.page_id: r.text.split("\n\n") for r in main_text(pages).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    want = {0: story_lines("First"), 40: story_lines("Third"), 41: story_lines("Second", 7), 60: story_lines("Fifth")}
    want |= {i: story_lines("Second", i) for i in range(1, 31)} | {i: story_lines("Fourth") for i in range(50, 55)}
    # nothing but near copies on the host: nothing is lost
    want |= {i: ["Menu line", *story_lines("Alone", i), "Legal line"] for i in range(70, 73)}
    assert got == want


def test_large_group_of_near_copies_costs_rows_per_member(spark, monkeypatch):
    """1,500 distinct near copies and a pair that shares words with them: no row for each member and block."""
    base = words("base", 60)
    rows = [(i, " ".join([*base[: i % 60], f"own{i}", *base[i % 60 + 1 :]])) for i in range(1500)]
    rows += [(2000, " ".join(words("pair"))), (2001, " ".join([*words("pair")[:-1], "end"])), (2002, " ".join(words("alone")))]
    made = []
    for name in ("_cells", "_asking"):
        if hasattr(near_dedup, name):

            def counted(*args, was=getattr(near_dedup, name), **more):
                cells = was(*args, **more)
                made.append((args[0].count(), cells.count()))
                return cells

            monkeypatch.setattr(near_dedup, name, counted)
    got = {r.doc_id: r.component_id for r in near_copies(spark.createDataFrame(rows, DOCS), words=2).collect()}
    assert got == {**dict.fromkeys(range(1500), 0), 2000: 2000, 2001: 2000, 2002: 2002}
    assert made and all(cells <= 1.5 * before for before, cells in made)


def test_blocks_of_long_lists_find_all(spark, monkeypatch):
    """With blocks of two members every list is a long one: the same groups as in one block."""
    rows = [(10 * g + i, " ".join([f"common{j}" for j in range(45)] + [f"g{g}_{j}" for j in range(15)] + [f"own{g}_{i}"])) for g in range(6) for i in range(3)]
    docs = spark.createDataFrame(rows, DOCS)
    want = sorted(map(tuple, near_copies(docs, words=2).collect()))
    was = near_dedup._plausible
    monkeypatch.setattr(near_dedup, "_plausible", lambda *args: was(*args, block=2))
    assert sorted(map(tuple, near_copies(docs, words=2).collect())) == want
    assert {r[0]: r[2] for r in want} == {i: i // 10 * 10 for i, _ in rows}
