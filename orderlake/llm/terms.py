"""Terms of texts inside tasks, numbered and counted in arrays."""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np


def term_table(inside: str = "") -> bytes:
    """For ``bytes.translate``: A-Z in lower case, every other ASCII byte but a-z and ``inside`` a blank.

    Bytes beyond ASCII stay, so that terms can be cut from UTF-8 without decoding.
    """
    table = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        table[b] = ord(c.lower()) if c.isalpha() else b if c in inside else 32
    return bytes(table)


class TermCounts:
    """Occurrences of terms by document, for as many documents as a caller holds at once.

    A text of any length is cut in pieces of ``piece`` bytes at blanks, so that
    only the numbers of its words are held, four bytes each.
    """

    def __init__(self, table: bytes, piece: int = 4_000_000):
        self._table, self._piece = table, piece
        self._numbers: dict[bytes, int] = defaultdict(count().__next__)
        self._ids: list[np.ndarray] = []
        self.lengths: list[int] = []
        self.words = 0

    def add(self, text: bytes) -> int:
        """Counts the next document; returns its number of words."""
        data, at, n = text.translate(self._table), 0, 0
        while at < len(data):
            end = at + self._piece
            if end < len(data):
                end = data.find(b" ", end)
                end = len(data) if end < 0 else end
            words = data[at:end].split()
            self._ids.append(np.fromiter(map(self._numbers.__getitem__, words), np.int32, len(words)))
            at, n = end, n + len(words)
        self.lengths.append(n)
        self.words += n
        return n

    def terms(self) -> list[bytes]:
        """The terms in the order of their numbers."""
        return list(self._numbers)

    def counted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Term, document and number of occurrences, in order of term and document."""
        docs = np.repeat(np.arange(len(self.lengths), dtype=np.int64), self.lengths)
        terms = np.concatenate([*self._ids, np.empty(0, np.int32)])
        keys, times = np.unique(terms.astype(np.int64) * max(1, len(self.lengths)) + docs, return_counts=True)
        return keys // max(1, len(self.lengths)), keys % max(1, len(self.lengths)), times


def starts_of(keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted ``keys``."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
