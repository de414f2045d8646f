"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import struct
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from orderlake.llm.bpe import decode_ids, encode_digests, encode_texts
from orderlake.llm.components import components
from orderlake.llm.fragments import FragmentEncoder
from orderlake.llm.html_text import common_lines, main_text, page_lines
from orderlake.llm.line_dedup import drop_common_lines
from orderlake.llm.near_dedup import near_copies
from orderlake.llm.perfect_hash import PerfectHash
from orderlake.llm.positional_index import PositionalIndex
from orderlake.llm.quality import fit_quality, score_quality
from orderlake.llm.queries import vocabulary
from orderlake.llm.shared import shared_folder
from orderlake.llm.sharding import range_shards
from orderlake.llm.token_store import TokenStore
from orderlake.llm.top_k import top_k
from orderlake.llm.warc import Archive, LoserTree, url_key

LONG = "word another " * 20_000
SHARED = "this line is shared by at least five documents of the table"
ROWS = [
    (1, "Hello  world"), (2, None), (3, ""), (4, LONG), (5, "Hello  world"), (5, "Hello  world"), (None, "no id here"),
    (6, f"a\n{SHARED}\nb"), (7, f"  {SHARED.upper()}\t\nc"), (8, SHARED), (9, f"{SHARED}\n{SHARED}"), (10, f"x\n{SHARED}"), (11, "\n"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """With columns that operators use for themselves."""
    rows = [(i, t, "k", 7, "s", 1.5, 3) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, pos int, part string, score double, n_lines int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary())


def texts(i):
    return [t or "" for j, t in ROWS if j == i]


def test_token_store(spark, docs, empty, tokenizer):
    store = TokenStore.write(docs, shared_folder(spark, "t"), vocabulary(), 2, shard_ids=10, bucket_keys=3)
    rows = store.fetch(docs, "doc_id", ids=True).collect()
    assert len(rows) == len(ROWS)
    start = 0
    for r in sorted(rows, key=lambda r: r.start):
        want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts(r.key)]
        assert r.ids in want and (r.start, r.n_tokens) == (start, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(b"".join(struct.pack("<I", i) for i in r.ids))
        start += r.n_tokens
    keys = [r.key for r in sorted(rows, key=lambda r: r.start)]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])
    assert store.manifest.count() > 3 and store.index_files.count() > 1
    unknown = spark.createDataFrame([(5,), (5,), (404,)], "k long")
    assert [r.key for r in store.fetch(unknown, "k").collect()] == [5, 5]
    store = TokenStore.write(empty, shared_folder(spark, "t"), vocabulary(), 2)
    assert store.fetch(docs, "doc_id").count() == 0


def test_perfect_hash():
    import numpy as np

    keys = np.random.default_rng(1).integers(0, 2**63, 20_000, dtype=np.uint64)
    made = PerfectHash.build(np.unique(keys))
    again = PerfectHash.from_arrays(made.to_arrays())
    assert sorted(again.slots(np.unique(keys))) == list(range(len(np.unique(keys)))) and PerfectHash.build(keys[:0]).size == 0


def test_fragments_equal_whole_texts(tokenizer):
    import random

    draw = random.Random(3)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'s", "'", "'ll", "é", "à ", " ", "　", "!", "..", "23", "<|endoftext|>", "日本", "\U0001f600", "\r\n", "\x1c", "\x85", "S"]
    encoder = FragmentEncoder(vocabulary(), list, keep=50)
    for _ in range(5000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 9)))
        assert [i for p in encoder.encode(text) for i in p] == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert encoder.fragments("word,next") == ["word", ",next"] or len(encoder.fragments("word,next")) > 1


def test_bpe(docs, empty, tokenizer):
    rows = decode_ids(encode_texts(docs, vocabulary()).withColumnRenamed("decoded", "first"), vocabulary()).collect()
    for r in rows:
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts(r.doc_id)]
        assert r.ids in want and r.ids_text == ",".join(map(str, r.ids)) and r.n_tokens == len(r.ids)
        assert r.decoded == r.first and r.decoded in texts(r.doc_id)
    assert len(rows) == len(ROWS) and encode_digests(empty, vocabulary()).count() == 0


def test_lines(docs, empty):
    rows = drop_common_lines(docs).collect()
    kept = {(r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in rows}
    assert len(rows) == len(ROWS) and rows[0].key == "k"
    assert {(6, "a\nb", 3, 1), (7, "c", 2, 1), (8, "", 1, 1), (9, "", 2, 2), (10, f"x\n{SHARED}", 2, 0)} <= kept
    assert {(2, "", 1, 0), (3, "", 1, 0), (11, "\n", 2, 0), (None, "no id here", 1, 0), (4, LONG, 1, 0)} <= kept
    assert drop_common_lines(empty).count() == 0
    # 4 documents only: rows of one document count once
    fewer = docs.filter("doc_id in (6, 7, 8, 9)").unionByName(docs.filter("doc_id = 9"))
    assert all(r.n_dropped == 0 for r in drop_common_lines(fewer).collect())


def test_near(spark, docs, empty):
    rows = near_copies(docs, words=2).collect()
    of = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in rows}
    assert len(rows) == len(ROWS) and of[(1, 1)] == (1, True) and of[(5, 1)] == (1, False)
    assert of[(2, 0)] == (2, True) and of[(3, 0)] == (3, True) and of[(11, 0)] == (11, True) and of[(4, 2)] == (4, True)
    assert of[(None, 2)] == (None, True)
    assert near_copies(empty).count() == 0
    # a chain: neighbours are linked, the ends are not; a tie at exactly 80 % counts
    base = [f"w{i}" for i in range(60)]
    chain = [(100 - i, " ".join([f"v{i}_{j}" if j < 4 * i else w for j, w in enumerate(base)])) for i in range(4)]
    chain += [(200, "a b c d e"), (201, "a b c d e f")]
    rows = near_copies(spark.createDataFrame(chain, "doc_id long, text string"), words=2, match=30).collect()
    groups = {r.doc_id: r.component_id for r in rows}
    assert {groups[i] for i in (100, 99)} == {99} or groups[100] == groups[99]
    assert groups[200] == groups[201] == 200


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(7, 7), (100, 90), (100, 90)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), shared_folder(spark, "c")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90}
    assert components(spark.createDataFrame([], "a long, b long"), shared_folder(spark, "c")).count() == 0


def test_positions(spark, docs, empty):
    long_item = " ".join(f"t{i}" for i in range(20))
    items = spark.createDataFrame([(1, long_item), (1, long_item), (2, None), (3, "?!"), (4, "Short item"), (10, "t0 t1 t2 t3 t4 t5 t6 t7 t8 t9 t10 t11 t12")], "item_id long, text string")
    more = [(20, f"x {long_item} y"), (21, "short ITEM. " * 3), (22, " ".join(long_item.split()[:12])), (23, f"{long_item} {long_item} " + "z " * 5000), (24, "t3 t1 t2")]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    index = PositionalIndex(both, items)
    rows = index.contamination().collect()
    of = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows}
    assert len(rows) == len(ROWS) + len(more)
    assert of[20] == (22, 20, "1,10", True) and of[21] == (6, 6, "4", True) and of[22] == (12, 0, "", False)
    assert of[23] == (5040, 40, "1,10", False) and of[2] == of[3] == (0, 0, "", False) and of[4] == (40_000, 0, "", False)
    near = {(r.doc_id, r.item): r.span for r in index.proximity(5).collect()}
    assert near[(21, "4")] == 2 and (20, "1") in near
    assert PositionalIndex(empty, items).contamination().count() == 0
    assert all(r.n_hit == 0 for r in PositionalIndex(docs, items.limit(0)).contamination().collect())


def test_warc(spark):
    same, other = "<p>" + "é" * 600, "<p>" + "b" * 1200
    rows = [(1, "http://www.b.org/x?Q=1#f", same), (2, "https://a.org/", same), (9, None, same), (3, "a.org/\r\nZ", other), (None, "http://c.org", other), (4, "http://a.org/y", None), (4, "http://a.org/y", None), (5, "u", "tiny"), (6, "u", "tiny")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, archive string")
    archive = Archive.write(pages, shared_folder(spark, "w"), archive_rows=2, fan_in=2, parts=3)
    got = archive.records().collect()
    assert len(got) == len(rows)
    of = {r.page_id: r for r in got}
    assert (of[1].record_type, of[1].refers_to, of[1].payload) == ("revisit", 9, None) and of[2].refers_to == 9
    assert of[9].record_type == "response" and bytes(of[9].payload).decode() == same and of[9].url is None
    assert of[1].payload_digest == hashlib.sha1(same.encode()).hexdigest() and of[1].payload_bytes == len(same.encode())
    assert {of[i].record_type for i in (3, 4, 5, 6, None)} == {"response"} and of[4].payload_bytes == 0 and of[3].url == "a.org/%0D%0AZ"
    index = [(r.url_key, r.time, r.page_id or -1) for r in archive.index.orderBy("part").collect()]
    assert len(index) == len(rows) and index == sorted(index)
    assert Archive.write(pages.limit(0), shared_folder(spark, "w")).digests().count() == 0
    assert url_key("http://User@www.Example.org:80/A?b=C#d") == "org,example)/a?b=c" and url_key(None) == ")/"
    assert list(LoserTree([[1, 4], [], [2, 2, 9]])) == [1, 2, 2, 4, 9] and list(LoserTree([])) == []


def test_quality(spark, docs, empty):
    good = [(i, f"The quiet river number {i} ran past the old mill and the village of {i % 7} houses.") for i in range(60)]
    bad = [(i, f"BUY NOW!!! {i} WIN WIN WIN $$$ " * 4) for i in range(60, 120)]
    texts = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60), None) for i in range(120)] + [(5, None, 1), (None, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    model = fit_quality(texts, labels)
    got = score_quality(texts, model).collect()
    assert sum((r.score >= 0.5) == (r.doc_id < 60) for r in got) >= 114
    scored = score_quality(docs, model)
    assert scored.columns == ["doc_id", "text", "key", "pos", "part", "n_lines", "score"]
    rows = scored.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert score_quality(empty, model).count() == 0
    assert {r.score for r in score_quality(docs, fit_quality(docs, labels.limit(0))).collect()} == {0.5}
    one_sided = fit_quality(texts, labels.filter("quality = 1"))
    assert all(r.score > 0.9 for r in score_quality(docs, one_sided).collect())


def test_shards(spark, docs, empty):
    rows = range_shards(docs, 4, carry={"key": F.col("key")}).collect()
    sizes = sorted(r["size"] for r in rows)
    assert sizes == sorted(len((t or "").encode()) + 16 for _, t in ROWS) and {r.key for r in rows} == {"k"}
    assert range_shards(empty, 4).count() == 0
    # a third of all rows are equal, ids too: they are cut all the same
    copies = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    rows = range_shards(copies, 7, part_bytes=2000).groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("b"), F.min("slot").alias("low"), F.max("slot").alias("high"), F.countDistinct("slot").alias("d")).collect()
    assert len(rows) == 7 and all((r.low, r.high, r.d) == (0, r.n - 1, r.n) for r in rows)
    assert max(r.b for r in rows) - min(r.b for r in rows) <= 60


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.1]), (2, [0.5, 0.1]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (8, []), (None, [9.0, 9.0]), (9, [-0.001, 0.0]), (50, [0.0, 1.0]), (2, [0.5, 0.1])]
    vectors = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, shard int, block string")
    got = [tuple(r) for r in top_k(vectors, F.col("vec_id") % 50 == 0, k=4, shard_rows=3, block_rows=1, leaf_rows=1).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 32768), (0, 2, 2, 32768), (0, 3, 2, 32768), (0, 4, 50, 0), (50, 1, 1, 6400), (50, 2, 2, 6400), (50, 3, 2, 6400), (50, 4, 0, 0)]
    assert top_k(vectors.limit(0), F.col("vec_id") >= 0).count() == 0
    assert top_k(vectors, F.lit(False)).count() == 0


def test_pages(spark):
    marked = '<html><body><nav><a>Home</a></nav><main><article><header><h1>T&amp;x</h1></header><p>One <b>bold</b>\n two<p>Three<br>four<div class="ad">Buy</div><script>if(a<b)"</p>"</script><section class="comments"><p>nice</p></section></article></main><footer>f</footer></body></html>'
    plain = "<body><div>Menu line</div><p>Story {0} begins</p><p>Story {0} ends</p><div>Legal line</div></body>"
    rows = [(1, "http://h/1", marked), (2, "http://h/a/1", plain.format(1)), (3, "http://h/a/2", plain.format(2)), (4, "http://z/a", plain.format(3)), (5, None, None), (6, "", ""), (7, "http://c/1", plain.format(4)), (8, "http://c/1", plain.format(4)), (None, "x", "text only"), (3, "http://h/a/2", plain.format(2)), (9, "http://q/", "<p>" + LONG)]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, host int")
    got = main_text(pages).collect()
    of = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and of[1] == "T&x\n\nOne bold two\n\nThree four"
    assert of[2] == "Story 1 begins\n\nStory 1 ends" and of[3] == "Story 2 begins\n\nStory 2 ends"
    assert of[4].split("\n\n") == ["Menu line", "Story 3 begins", "Story 3 ends", "Legal line"]
    # copies of one page: their neighbour has nothing of its own to tell apart
    assert of[7] == of[8] == "Menu line\n\nStory 4 begins\n\nStory 4 ends\n\nLegal line"
    assert of[5] == of[6] == "" and of[None] == "text only" and of[9] == LONG.strip()
    assert all(r.n_chars == len(r.text) for r in got) and main_text(pages.limit(0)).count() == 0
    assert common_lines([1, 2, 3, 4], [2, 9, 4]) == [1, 3] and common_lines([], [1]) == []
    assert [x for x, _ in page_lines("<td>a<td>b</tr><!-- <p>no --><p>c &lt;&nbsp;d")] == ["a", "b", "c < d"]


def test_stages_on_odd_rows(spark, docs, empty, tmp_path):
    spark.createDataFrame([(1, "some benchmark text that is nowhere else at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    shaped = docs.select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.col("key").alias("source"), F.length("text").cast("long").alias("n_chars"))
    for start in (shaped, shaped.limit(0)):
        df = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            df = stage(spark, df, str(tmp_path))
            assert df.columns == columns
        n = corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path)).count()
        assert (n > 0) == (start is shaped)
