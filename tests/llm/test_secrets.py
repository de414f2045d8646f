"""Secret scan against a plain scan that counts every window anew."""

import hashlib
import math
import random
import re
import string
from collections import Counter

import pytest

from orderlake.llm.secret_scan import CLASSES, Scanner, find_secrets, hot_spans, secret_digests

RANDOM = random.Random(7)
B64 = string.ascii_letters + string.digits + "+/_-"


def noise(letters, n):
    return "".join(RANDOM.choice(letters) for _ in range(n))


def entropy(window):
    return -sum(c / len(window) * math.log2(c / len(window)) for c in Counter(window).values())


def plain_spans(text, size, bits):
    hot = [i for i in range(len(text) - size + 1) if entropy(text[i : i + size]) >= bits]
    out = []
    for i in hot:
        if out and i <= out[-1][1]:
            out[-1] = out[-1][0], i + size
        else:
            out.append((i, i + size))
    return out


@pytest.mark.parametrize("one", CLASSES)
def test_windows_against_entropy_counted_anew(one):
    for letters in (B64, "0123456789abcdef", "abcdef", "ab", "αβγδ" + B64):
        for n in (0, 1, 23, 24, 25, 60, 200):
            text = noise(letters, n)
            assert hot_spans(text, one.window, one.limit) == plain_spans(text, one.window, one.bits)


def test_hot_stretch_inside_a_cold_candidate():
    key = noise(B64.replace("+", "").replace("/", "").replace("_", "").replace("-", ""), 40)
    text = "z" * 100 + key + "y" * 100
    (kind, start, end), *more = Scanner().spans(text)
    assert (kind, more) == ("base64_entropy", [])
    assert [(start, end)] == plain_spans(text, 24, 4.0) and 76 < start < 116 and 124 < end < 164


def test_known_shapes():
    hexes = noise("0123456789abcdef", 32)
    text = f"é password: 'abcdefgh' token: token:abcdefgh API_KEY=short AKIA{'X' * 12} AKIAX {hexes} {hexes[:31]} api-key=zzzzzzzzz"
    at = text.index
    want = [
        ("assign", at("password"), at("' token")),
        ("access", at("AKIAXXX"), at("AKIAXXX") + 16),
        ("hex", at(hexes), at(hexes) + 32),
    ]
    assert [s for s in Scanner().spans(text) if not s[0].endswith("entropy")] == want
    assert Scanner().spans("K APIKEY=abcdefghij") == []  # letters beyond ASCII are no letters of a keyword


def test_allow_list():
    key, digits = noise(B64[:62], 40), noise("0123456789abcdef", 40)
    scan = Scanner().spans
    assert [k for k, _, _ in scan(f"see {key}")] == ["base64_entropy"]
    for text in (f"https://a.org/{key}", f"sha256-{key}", f"data:x/y;base64,{key}", f"EXAMPLE{key}", f"abcdefghij{key}"):
        assert [s for s in scan(text) if s[0] != "hex"] == [], text
    assert scan("550e8400-e29b-41d4-a716-446655440000") == []
    assert scan("a-long_name/of-many_words/and-another-quick_brown_fox") == []
    assert [k for k, _, _ in scan(noise("0123456789", 60))] == ["hex"]
    assert Scanner(whole=(), inside=(), before=(), start=()).spans(f"https://a.org/{key}")
    upper = digits.upper()
    assert [k for k, _, _ in scan(upper)][:1] == ["hex_entropy"]  # not of the lower-case shape
    assert [k for k, _, _ in scan(digits)] == ["hex"]  # the shape has the span already


def test_rows(spark):
    key = noise(B64[:62], 40)
    long = "word " * 200_000 + f"token={key} " + "ab" * 500_000
    texts = [None, "", "plain words", f"token={key}", f"x {key} y", long, f"token={key}"]
    rows = [(i if i != 2 else None, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, start int").repartition(3)
    got = find_secrets(docs)
    assert got.columns == ["doc_id", "spans"]
    want = sorted((str(i if i != 2 else None), Scanner().spans(t or "")) for i, t in enumerate(texts))
    assert sorted((str(r.doc_id), [(s.kind, s.start, s.end) for s in r.spans]) for r in got.collect()) == want
    for r in got.collect():
        assert all(s.text == texts[r.doc_id][s.start : s.end] for s in r.spans)
    digest = {r.doc_id: r for r in secret_digests(got).collect()}
    assert digest[3].base_sha256 == hashlib.sha256(f"assign:0:{6 + len(key)}".encode()).hexdigest()
    assert (digest[3].n_assign, digest[3].n_hex, digest[3].spans) == (1, 0, f"assign:0:{6 + len(key)}")
    assert digest[4].n_assign == 0 and re.fullmatch(r"base64_entropy:\d+:\d+", digest[4].spans)
    assert digest[0].base_sha256 == hashlib.sha256(b"").hexdigest() and digest[0].spans == ""
    assert find_secrets(docs.limit(0)).count() == 0
