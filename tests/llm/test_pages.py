"""Odd pages: bad markup of any length, long alignments, many kinds of pages in a row."""

import random
import time
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderlake.llm import html_text
from orderlake.llm.html_text import common_lines, main_text, page_lines


@pytest.mark.parametrize(
    "piece", ["<a ", '<a "', "<div></span>", "<script></script ", "<!", "<p class='", "</", "<div>", "<title>x", '<b "x>', "<a '\"'> "]
)
def test_parsing_is_linear(piece):
    times = []
    for n in (20_000, 80_000):
        start = time.process_time()
        page_lines("<p>one</p>" + piece * n)
        times.append(time.process_time() - start)
    assert times[1] < 12 * max(times[0], 0.02), times


def test_text_behind_the_last_tag():
    text = lambda page: [x for x, _ in page_lines(page)]
    assert text("<p>a</p>b < c") == ["a", "b < c"]
    assert text("<p>a</p>b <!-- c") == ["a", "b"]
    assert text("a <b") == ["a <b"] and text("") == []
    assert text("<div><b>x</i></b>y</div></p>z") == ["xy", "z"]


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@pytest.mark.parametrize("cells", [1 << 26, 200, 1])
def test_alignment_against_the_whole_table(monkeypatch, cells):
    monkeypatch.setattr(html_text, "WHOLE_TABLE", cells)
    rng = random.Random(cells)
    for _ in range(60):
        a, b = ([rng.randint(0, 12) for _ in range(rng.randint(0, 40))] for _ in range(2))
        found = common_lines(a, b)
        assert found == sorted(set(found)) and len(found) == longest(a, b)
        rest = iter(b)
        assert all(any(x == y for y in rest) for x in (a[i] for i in found))


def test_alignment_of_long_pages():
    a = list(range(30_000))
    b = [x for x in a if x % 3] + a[:100]
    start = time.process_time()
    assert len(common_lines(a, b)) == 20_000
    assert time.process_time() - start < 60


@pytest.mark.parametrize("n", [6, 13, 16])
def test_no_kind_is_forgotten(spark, n):
    """Pages that each hold the former one's lines twice over, and then one other page: the menu goes from all."""
    menu = "<div>the menu of the site</div><div>all rights are reserved here</div>"
    rows, story = [], []
    for i in range(n):
        story += [f"<div>story line {i} {j} {'long ' * 2 * int(1.6 ** i)}</div>" for j in range(2)]
        rows.append((i, f"http://a.org/{i:03d}", menu + "".join(story)))
    rows.append((n, f"http://a.org/{n:03d}", menu + "<div>" + "quite another story " * 9000 + "</div>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r.page_id: r.text for r in main_text(pages).select("page_id", F.substring("text", 1, 60).alias("text")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [i for i, text in got.items() if "menu of the site" in text] == []
    assert all(got[i].startswith("story line 0 0") for i in range(n))


def given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html", F.col("page_id").alias("t1"), F.lit(0).cast("long").alias("t2"))
    return pa.RecordBatch.from_pandas(rows.fillna("", "html").toPandas(), preserve_index=False)


def test_each_given_page_is_differenced(spark):
    """Pages that mark their article too: each that has another page on its host is aligned with one."""
    lined = pa.Table.from_batches(html_text._hashes([given_pages(spark)])).sort_by([(x, "ascending") for x in ("host", "path", "page_id")])
    lined = lined.add_column(0, "part", pa.array([0] * len(lined), pa.int32()))
    found = [row for batch in html_text._beside(lined.to_batches(50)) for row in batch.to_pylist()]
    of_host = Counter(lined["host"].to_pylist())
    want = [i for i, host in zip(lined["t1"].to_pylist(), lined["host"].to_pylist()) if of_host[host] > 1]
    assert {r["t1"] for r in found if r["state"] == html_text.DECIDED} == set(want) and len(want) > 100


@pytest.mark.parametrize("partitions", [1, 40])
def test_differencing_tells_which_article_is_the_text(spark, partitions):
    """An article that all pages of a host share is the site's; one that a page has for itself is its text, with shared lines in it."""
    notice = "<article><p>This site would like you to accept what it stores on your machine, and some more.</p></article>"
    story = lambda i: [f"Story {i} begins with {i * 'quite '}some words", f"Story {i} then goes on and on", f"Story {i} ends"]
    inner = lambda i: "".join(f"<p>{x}</p>" for x in story(i))
    rows = [(i, f"http://n/{i}", f"<body><div>Menu line</div>{notice}<div>{inner(i)}</div></body>") for i in range(4)]
    marked = "<body><nav>Home</nav><div>Menu line</div><article>{}<p>Read on</p></article><div>Legal line {}</div></body>"
    rows += [(i, f"http://s/{i}", marked.format(inner(i), i)) for i in range(4, 8)]
    # all of the article stands in the other page's menu and little is left: nothing tells it but the markup
    rows += [(8, "http://t/1", "<nav>Away</nav><article><p>Home</p></article><div>9</div>"), (9, "http://t/2", "<nav>Home</nav><article><p>Quite another text</p></article>")]
    # alone on its host: the markup alone tells
    rows += [(10, "http://u/1", f"<body>{notice}<div>{inner(1)}</div></body>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.page_id: r.text.split("\n\n") for r in main_text(pages).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    want = {i: story(i) for i in range(4)} | {i: [*story(i), "Read on"] for i in range(4, 8)}
    want |= {8: ["Home"], 9: ["Quite another text"], 10: [notice[12:-14]]}
    assert got == want
