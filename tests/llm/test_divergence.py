"""Source audit against plain counts, also where digests collide."""

import random
import re
from collections import Counter, defaultdict

import pytest

from orderlake.llm.divergence import SourceAudit, share
from pyspark.sql import functions as F

WORDS = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(150)]


def plain(rows, least, top):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        docs[lang].update(set(words))
        counts[lang, source].update(words)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [w for w, d in docs[lang].items() if d >= least]
        v, mine = len(kept), sorted(g for g in groups if g[0] == lang)
        of = lambda c: {w: 1 + 1_000_000_000 * (c[w] + 5) // (sum(c[x] for x in kept) + 5 * v) for w in kept}
        p = {g[1]: of(counts[g]) for g in mine}
        q = of(sum((counts[g] for g in mine), Counter()))
        for _, s in mine:
            pairs = [(o, sum(abs(p[s][w] - p[o][w]) for w in kept)) for o in p if o != s]
            terms = [(w, p[s][w] - q[w]) for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, x, r) for r, (i, x) in enumerate(found[:most], 1)]
    return sorted(out)


def table(rng, n):
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "", None, "d"])
        few = rng.sample(WORDS, 40) if source == "a" else WORDS
        rows.append((lang, source, " ".join(rng.choices(few, k=rng.randint(0, 30)))))
    return rows


@pytest.mark.parametrize("bits", [64, 3, 5])
def test_against_plain_counts(spark, bits):
    rows = table(random.Random(bits), 400)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string").repartition(3)
    audit = SourceAudit(docs, least_docs=12, run_words=500, digest_bits=bits)
    assert sorted(tuple(r) for r in audit.report(20).collect()) == plain(rows, 12, 20)
    assert (audit.kept.filter("variant > 0").count() > 0) == (bits < 64)


def test_blocks_of_sources_and_terms(spark):
    rng = random.Random(3)
    rows = [("x", f"s{i % 23}", " ".join(rng.choices(WORDS, k=20))) for i in range(300)]
    audit = SourceAudit(spark.createDataFrame(rows, "lang string, source string, text string"), least_docs=5)
    got = sorted(tuple(r) for r in audit.distances(source_block=4, term_chunk=16).collect())
    assert got == sorted((l, s, i, v) for l, s, part, i, v, _ in plain(rows, 5, 1) if part == "pair")


def test_odd_rows(spark):
    long = "Ö Wort " * 200_000
    rows = [("a", "s", None), ("a", "t", ""), (None, None, "12 34"), ("a", "s", "Wort wort"), ("a", "s", "Wort wort"), ("b", "s", long), ("b", "t", "ö wort"), ("a", "u", "wort")]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "lang string, source string, text string, term string, digest string, docs int")
    audit = SourceAudit(docs, least_docs=2)
    assert sorted(tuple(r) for r in audit.report().collect()) == plain(rows, 2, 50)
    nothing = SourceAudit(docs, least_docs=30).report().collect()
    assert sorted(tuple(r) for r in nothing) == plain(rows, 30, 50) and {r.value for r in nothing} == {0}
    assert SourceAudit(docs.limit(0)).report().count() == 0


def test_share_is_exact_beyond_a_long(spark):
    count, total = 7 * 10**15 + 1, 9 * 10**15 + 7
    got = spark.range(1).select(share(F.lit(count), F.lit(total)).alias("p")).first().p
    assert got == 1 + 10**9 * (count + 5) // total
