"""Sets of word shingles as sorted arrays of 64-bit hashes, made with numpy for many texts at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from metrivane.llm.common import text_slices
from metrivane.llm.tokens import mixed, span_hashes

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = np.uint64(0x9FB21C651E98DF25)


def _joined(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words."""
    n = len(words) - k + 1
    h = np.full(n, k, np.uint64)
    for j in range(k):
        h = mixed(h * _STEP + words[j : j + n])
    return h


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct hashes of the ``k``-word shingles of each text.

    Words are runs of anything but the six ASCII white-space bytes, A-Z in lower case.  A text with
    fewer words has its whole sequence as one shingle, one without words none.
    """
    data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    ends_of = np.cumsum([len(t) + 1 for t in texts])
    space = _SPACE[data]
    change = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = change[::2], change[1::2]
    words = span_hashes(data, starts, ends)
    upto = np.searchsorted(starts, ends_of)
    whole = _joined(words, k) if len(words) >= k else np.zeros(0, np.uint64)
    out, first = [], 0
    for last in upto.tolist():
        n = last - first
        if n >= k:
            h = np.sort(whole[first : last - k + 1])
            out.append(h[np.concatenate([[True], h[1:] != h[:-1]])])
        else:
            out.append(_joined(words[first:last], n) if n else np.zeros(0, np.uint64))
        first = last
    return out


def column_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    out = []
    for _, rows in text_slices(texts):
        out += shingle_sets(rows, k)
    return out
