"""Byte-level BPE over fragments between certain cuts.

The tokenizer's file says which bytes occur side by side inside any token. A
pair that never does is a certain cut: no merge can span it, so the two sides
can be encoded apart and their ids put together. Where the pre-tokenizer's own
splits might come out differently on the two sides (within white space, before
an apostrophe, beside characters beyond ASCII), no cut is made.

Fragments repeat far more than texts do, so each worker keeps the ids of those
it has met; new ones go through the tokenizers library. Texts are taken in
groups: the new words of a group are cut at once, in arrays.
"""

from __future__ import annotations

import gc
import json
import re
from array import array

#: Characters of Unicode's White_Space beside the blank and the line feed: the
#: pre-tokenizer treats a blank beside them otherwise.
_OTHER_SPACE = re.compile("[\t\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _is_odd(text: str) -> bool:
    """Whether some blank of the text does not stand between two characters that are no white space."""
    if "  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " ":
        return True
    if text.isascii():
        return "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text
    return _OTHER_SPACE.search(text) is not None


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, free = {b: chr(b) for b in seen}, 256
    for b in range(256):
        if b not in letters:
            letters[b], free = chr(free), free + 1
    return [letters[b] for b in range(256)]


class FragmentEncoder:
    """Ids of texts as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    ``pack`` turns the ids of a piece into what is kept of it. Where packed parts
    can be put together, ``join`` does so for a list of them, and fragments are kept
    packed; else they are kept as ids and each piece is packed as a whole. Pieces and
    fragments are kept in two generations: once the younger one has ``keep`` of
    them it becomes the older one, and what is met again is taken over from there.
    So memory is bounded, some 300 bytes for each of at most twice ``keep`` and
    those of a group, and frequent words are never learned again.
    """

    def __init__(self, path: str, pack, keep: int = 700_000, join=None):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        pre, model = told["pre_tokenizer"] or {}, told["model"]
        if told["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
            raise ValueError("a byte-level tokenizer without normalizer or prefix space is needed")
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("a BPE model without dropout is needed")
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._pre, self._model = self._tokenizer.pre_tokenizer, self._tokenizer.model
        back = {letter: b for b, letter in enumerate(byte_letters())}
        self.added = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.token_bytes = {
            i: bytes(back[c] for c in token) for token, i in model["vocab"].items() if token not in self.added
        } | {i: content.encode() for content, i in self.added.items()}
        self._added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.cuts = self._certain_cuts(t for i, t in self.token_bytes.items() if i not in self.added.values())
        self._pack, self._keep, self._join = pack, keep, join
        self._letters = dict(enumerate(byte_letters()))
        # young and old: of pieces, of what follows a blank, of fragments
        self._kept: dict[str, tuple[dict, dict]] = {kind: ({}, {}) for kind in ("", " ", "fragment")}

    @staticmethod
    def _certain_cuts(tokens) -> bytearray:
        """1 at ``left * 256 + right`` where the pair of bytes is a certain cut."""
        cuts = bytearray(65536)
        for left in range(33, 127):
            for right in [9, 10, 11, 12, 13, *range(32, 127), *range(0xC2, 0xF5)]:
                # a text may go on with 's or 'll only where the left side ends a word
                cuts[left * 256 + right] = right != 39 or chr(left).isalnum()
        for token in tokens:
            for left, right in zip(token, token[1:]):
                cuts[left * 256 + right] = 0
        return cuts

    def fragments(self, piece: str) -> list[str]:
        """``piece`` divided at its certain cuts."""
        data = piece.encode("utf-8")
        cuts, at, out = self.cuts, 0, []
        for i in range(1, len(data)):
            if cuts[data[i - 1] * 256 + data[i]]:
                out.append(data[at:i].decode("utf-8"))
                at = i
        out.append(data[at:].decode("utf-8"))
        return out

    def _cut(self, pieces: list[bytes]):
        """All pieces in one, where each of their fragments begins, the end, and the number of the first fragment of each."""
        import numpy as np

        joined = b"".join(pieces)
        data = np.frombuffer(joined, np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        bounds = np.zeros(len(data) + 1, bool)
        bounds[1:-1] = np.frombuffer(self.cuts, np.uint8)[data[:-1].astype(np.int32) * 256 + data[1:]]
        bounds[0] = bounds[ends] = True
        places = np.flatnonzero(bounds)
        return joined, places, np.r_[0, np.searchsorted(places, ends)]

    def _fragment_ids(self, fragment: bytes) -> list[int]:
        # letters or digits alone, after a blank or not, are one word whose bytes are written as they are
        rest = fragment[1:] if fragment[0] == 32 else fragment
        if rest.isalpha() or rest.isdigit():
            word = rest.decode("ascii")
            return [t.id for t in self._model.tokenize(word if rest is fragment else self._letters[32] + word)]
        text = fragment.decode("utf-8")
        word = text[1:] if text[0] == " " else text
        if word.isalpha() and (word.isascii() or max(word) < "\u0250"):  # one word to the pre-tokenizer
            return [t.id for t in self._model.tokenize(fragment.decode("latin-1").translate(self._letters))]
        return [t.id for part, _ in self._pre.pre_tokenize_str(text) for t in self._model.tokenize(part)]

    def _found_all(self, kind: str, wanted: list, learn) -> list:
        """What is kept of each of ``wanted``, all different; ``learn`` gives it for a list of new ones. Long ones are not kept on."""
        young, old = self._kept[kind]
        out = list(map(young.get, wanted))
        missing = [i for i, known in enumerate(out) if known is None]
        new = []
        for i in missing:
            x = wanted[i]
            out[i] = known = old.get(x)
            if known is None:
                new.append(i)
            else:
                young[x] = known
        for i, known in zip(new, learn([wanted[i] for i in new])):
            out[i] = known
            if len(wanted[i]) < 64:
                young[wanted[i]] = known
        return out

    def _found(self, kind: str, wanted: set, learn) -> dict:
        listed = list(wanted)
        return dict(zip(listed, self._found_all(kind, listed, learn)))

    def _learn(self, pieces: list[str]) -> list:
        if not pieces:
            return []
        joined, places, starts = self._cut([p.encode("utf-8") for p in pieces])
        if self._join is not None:
            return self._learn_packed(joined, places, starts)
        cut = places.tolist()
        fragments = [joined[a:b] for a, b in zip(cut, cut[1:])]
        ids = self._found("fragment", set(fragments), lambda new: [array("I", self._fragment_ids(x)).tobytes() for x in new])
        out = []
        starts = starts.tolist()
        for a, b in zip(starts, starts[1:]):
            out.append(self._pack(array("I", ids[fragments[a]] if b == a + 1 else b"".join([ids[x] for x in fragments[a:b]]))))
        return out

    def _learn_packed(self, joined: bytes, places, starts) -> list[bytes]:
        """Packed bytes of each piece: those of its fragments, put together in Arrow."""
        import pyarrow as pa

        fragments = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places.astype("<i8")), pa.py_buffer(joined)])
        coded = fragments.dictionary_encode()
        packed = self._found_all("fragment", coded.dictionary.to_pylist(), lambda new: [self._pack(self._fragment_ids(x)) for x in new])
        data, ends = put_together(pa.array(packed, pa.large_binary()), coded.indices)
        cut = ends[starts].tolist()
        return [data[a:b] for a, b in zip(cut, cut[1:])]

    def _age(self) -> None:
        for kind, (young, _) in self._kept.items():
            if len(young) >= self._keep:
                self._kept[kind] = {}, young

    def _has_added(self, text: str) -> bool:
        return any(token in text for token in self.added)

    def _group(self, texts: list[str]) -> list[list]:
        self._age()
        out, pieces, words = [], set(), set()
        gaps: list[tuple[list, int, bool, str]] = []  # what is to be filled in: by a piece, or by words after blanks
        known, whole = self._kept[" "][0].get, self._kept[""][0].get
        for text in texts:
            kept: list = []
            for part in self._added.split(text) if self._has_added(text) else [text]:
                if part in self.added:
                    kept.append(self._pack([self.added[part]]))
                    continue
                if not part:
                    continue
                # where each blank stands between two other characters, a word begins there in any context
                first, *rest = [part] if _is_odd(part) else part.split(" ")
                found = whole(first)
                if found is None:
                    pieces.add(first)
                    gaps.append((kept, len(kept), True, first))
                kept.append(found)
                at = len(kept)
                kept += map(known, rest)
                if None in kept[at:]:
                    new = [(i, x) for i, x in enumerate(rest, at) if kept[i] is None]
                    words.update([x for _, x in new])
                    gaps += [(kept, i, False, x) for i, x in new]
            out.append(kept)
        first_of = self._found("", pieces, self._learn)
        after = self._found(" ", words, lambda new: self._learn([" " + x for x in new]))
        for kept, i, first, x in gaps:
            kept[i] = first_of[x] if first else after[x]
        return out

    def _group_packed(self, texts: list[str]) -> list[bytes]:
        """The packed bytes of each text. Words of plain texts are told apart and put together in Arrow, not one by one."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        is_plain = [bool(text) and not _is_odd(text) and not self._has_added(text) for text in texts]
        others = iter(self._group([text for text, yes in zip(texts, is_plain) if not yes]))
        plain = [text for text, yes in zip(texts, is_plain) if yes]
        words = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        starts = words.offsets.to_numpy()
        coded = words.values.dictionary_encode()
        # the first word of a text has no blank before it
        firsts = [text.partition(" ")[0] for text in plain]
        packed = self._found_all(" ", coded.dictionary.to_pylist(), lambda new: self._learn([" " + x for x in new]))
        first_of = self._found("", set(firsts), self._learn)
        index = coded.indices.to_numpy().copy()
        index[starts[:-1]] = len(packed) + np.arange(len(plain))
        parts = pa.array(packed + [first_of[x] for x in firsts], pa.large_binary())
        data, ends = put_together(parts, pa.array(index))
        cut = iter(ends[starts].tolist())
        at, out = next(cut), []
        for yes in is_plain:
            if yes:
                end = next(cut)
                out.append(data[at:end])
                at = end
            else:
                out.append(self._join(next(others)))
        return out

    def encode(self, text: str) -> list:
        """What is kept of the pieces of ``text``, in order."""
        return self._group([text])[0]

    def encode_all(self, texts, group_chars: int = 8_000_000):
        """As ``encode`` for each of ``texts``; new words of a group of them are learned together."""
        return self._in_groups(texts, group_chars, self._group)

    def encode_packed(self, texts, group_chars: int = 12_000_000):
        """The packed bytes of each of ``texts``; for an encoder whose ``pack`` gives bytes and whose ``join`` joins them."""
        return self._in_groups(texts, group_chars, self._group_packed)

    def _in_groups(self, texts, group_chars: int, run):
        group, chars = [], 0
        for text in texts:
            group.append(text)
            chars += len(text)
            if chars >= group_chars:
                yield from self._uncollected(run, group)
                group, chars = [], 0
        yield from self._uncollected(run, group)

    def _uncollected(self, run, texts: list[str]) -> list:
        """A group without garbage collection: it makes no cycles, and walking over all that is kept costs a third of the time."""
        was_on = gc.isenabled()
        gc.disable()
        try:
            return run(texts)
        finally:
            if was_on:
                gc.enable()


def put_together(parts, index):
    """The bytes of ``parts[i]`` for each i of an Arrow array, one after the other, and where each begins, with the end."""
    import numpy as np

    taken = parts.take(index)
    ends = np.frombuffer(taken.buffers()[1], "<i8")[: len(taken) + 1]
    return taken.buffers()[2].to_pybytes() if len(taken) else b"", ends
