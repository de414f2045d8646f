"""Ids of fragments put together equal those of whole texts, kept packed or not."""

import random
import struct

import pytest

from orderlake.llm.fragments import FragmentEncoder
from orderlake.llm.queries import vocabulary


@pytest.mark.parametrize("join", [None, b"".join])
def test_random_mixtures(join):
    from tokenizers import Tokenizer

    draw, whole = random.Random(7), Tokenizer.from_file(vocabulary())
    bits = [" ", "  ", "\n", "\t", "'s", "'", "don't", "word", "Antidis", "123", "4", "٣", "Ⅷ", "ª", "é", "日", "-", "...", "\U0001f600", "Ġ", "x" * 70]
    texts = ["", *["".join(draw.choices(bits, k=draw.randrange(1, 14))) for _ in range(4000)]]
    encoder = FragmentEncoder(vocabulary(), lambda ids: struct.pack(f"<{len(ids)}I", *ids), keep=500, join=join)
    for text, packed in zip(texts, encoder.encode_all(texts, group_chars=2000)):
        data = b"".join(packed)
        assert list(struct.unpack(f"<{len(data) // 4}I", data)) == whole.encode(text, add_special_tokens=False).ids, text


def test_packed_texts():
    """Texts put together in Arrow equal those put together piece by piece, also in a group without plain texts."""
    draw = random.Random(8)
    bits = [" ", " ", " ", "\n", "'s", "don't", "word", "Antidis", "123", "\u0663", "é", "日", "...", "\U0001f600", "<|endoftext|>", "\t", "\u00a0", "x" * 70]
    texts = ["", " ", "", *["".join(draw.choices(bits, k=draw.randrange(1, 14))) for _ in range(4000)], "one", "", "two three", "\u3000"]
    make = lambda: FragmentEncoder(vocabulary(), lambda ids: struct.pack(f"<{len(ids)}I", *ids), keep=500, join=b"".join)
    expected = [b"".join(packed) for packed in make().encode_all(texts)]
    texts += list(make().added)
    expected += [struct.pack("<I", i) for i in make().added.values()]
    for size in (1, 50, 2000, 10**9):
        assert list(make().encode_packed(texts, group_chars=size)) == expected
    assert list(make().encode_packed(["", " ", "  "])) == [b"".join(make().encode(x)) for x in ("", " ", "  ")]
    assert list(make().encode_packed([])) == []
