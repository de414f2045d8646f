"""Ranked search against a plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from orderlake.llm.lexical import LexicalIndex, ShardList, best_of_shard, pack, unpack
from orderlake.llm.shared import shared_folder

WORDS = [f"w{i}" for i in range(60)]


def terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found]


def plain(docs, items, k):
    cut = [(i, Counter(terms(t))) for i, t in docs]
    cut = [(i, c, sum(c.values())) for i, c in cut if c]
    n, total = len(cut), sum(x[2] for x in cut)
    df = Counter(w for _, c, _ in cut for w in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c, length in cut:
            m = 100 - 25 + (25 * length * n) // total
            score = 0
            for w in terms(text):
                if c[w]:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 12 * m))
            if score > 0:
                scored.append((doc, score))
        scored.sort(key=lambda x: (-x[1], x[0] is not None, x[0]))
        out += [(item, r, d, s) for r, (d, s) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def texts(rng, n, most):
    weights = [1 / (i + 1) for i in range(len(WORDS))]
    return [" ".join(rng.choices(WORDS, weights, k=rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("seed, shard_docs, shard_words", [(1, 1000, 10**6), (2, 37, 10**6), (3, 1000, 50)])
def test_against_plain_scores(spark, seed, shard_docs, shard_words):
    rng = random.Random(seed)
    docs = list(enumerate(texts(rng, 300, 40)))
    docs += [(1000, docs[5][1]), (1001, docs[5][1]), (5, docs[5][1])]  # ties, and a repeated row
    items = list(enumerate(texts(rng, 6, 12)))
    folder = shared_folder(spark, "t")
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    LexicalIndex.write(frame, f"{folder}/i", shard_docs=shard_docs, shard_words=shard_words)
    index = LexicalIndex(spark, f"{folder}/i")  # opened again
    got = index.search(spark.createDataFrame(items, "item_id long, text string"), f"{folder}/s", 20)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(docs, items, 20)
    again = index.search(spark.createDataFrame(items[:2], "item_id long, text string"), f"{folder}/s2", 3)
    assert sorted((tuple(r) for r in again.collect()), key=str) == plain(docs, items[:2], 3)


def test_odd_rows(spark):
    long = "Rare " + "w1 w2 " * 300_000
    docs = [(1, None), (2, ""), (3, " .;"), (None, "rare ÄÖ"), (4, long), (5, "Rare"), (5, "Rare"), (6, "äö Äö"), (None, "w1")]
    items = [("a", "RARE, rare äö"), (None, "w1 w1"), ("c", None), ("d", "unknown"), ("a", "w2")]
    rows = [(i, t, 1, "x", 2) for i, t in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n int, term string, shard int")
    asked = spark.createDataFrame([(i, t, 9, 8) for i, t in items], "item_id string, text string, query int, block int")
    folder = shared_folder(spark, "t")
    index = LexicalIndex.write(frame, f"{folder}/i")
    got = index.search(asked, f"{folder}/s")
    assert got.columns == ["item", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(docs, items, 20)
    assert index.search(asked.limit(0), f"{folder}/s2").count() == 0
    none = LexicalIndex.write(frame.limit(0), f"{folder}/i2")
    assert none.statistics() == (0, 0) and none.search(asked, f"{folder}/s3").count() == 0


def test_numbers_as_bytes():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**28, 2**31 - 1])
    data, ends = pack(values)
    assert unpack(data.tobytes()).tolist() == values.tolist() and ends[-1] == len(data)
    assert len(pack(np.empty(0, np.int64))[0]) == 0


def test_block_maxima_keep_blocks_closed():
    """A frequent term's blocks stay packed where no document can get into the result."""
    n = 64 * 200
    mass = np.full(n, 100)

    def posting_list(docs, tfs):
        data, ends = pack(np.stack([np.diff(docs, prepend=-1) - 1, tfs - 1], 1).ravel())
        ends = np.append(0, ends[1::2])
        first = np.arange(0, len(docs), 64)
        last = [int(docs[min(i + 64, len(docs)) - 1]) for i in first]
        top = [int(tfs[i : i + 64].max()) for i in first]
        row = {"n": len(docs), "postings": data.tobytes(), "last": last, "at": ends[first].tolist(), "top_tf": top, "least_length": [100] * len(first)}
        return ShardList(row, mass, n, n * 100)

    frequent = posting_list(np.arange(n), np.where(np.arange(n) % 6400 == 0, 9, 1))
    rare = posting_list(np.arange(0, n, 32), np.where(np.arange(0, n, 32) % 6400 == 0, 9, 1))
    best, scores = best_of_shard([(frequent, 100), (rare, 5000)], n, n - np.arange(n), 1, doc_range=512)
    assert best.tolist() == [6400] and len(scores) == 1  # the later one of two equal scores, by the order given
    assert 0 < frequent.open.sum() < len(frequent.last) / 4
