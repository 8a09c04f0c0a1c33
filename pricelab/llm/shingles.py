"""Hashed word shingles of many texts at once, in numpy.

Words are what white space separates, in lower case. A shingle is five words in a row; a
text of one to four words is a single shingle, an empty one has none.
"""

from __future__ import annotations

import hashlib

import numpy as np

from pricelab.llm.characters import STEP, code_points, mixed, window_hashes

WORDS = 5

#: Odd base of the rolling hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: Which code points below this limit are white space; there are none above.
_LAST_SPACE = 0x3001
_IS_SPACE = np.array([chr(i).isspace() for i in range(_LAST_SPACE)] + [False])


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n + 1, np.uint64(base), np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and the place of the text it belongs to."""
    points, bounds = code_points([text.lower() + " " for text in texts])
    space = _IS_SPACE[np.minimum(points, _LAST_SPACE)]
    edge = np.diff(np.concatenate(([1], space.astype(np.int8), [1])))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.concatenate(
        (
            np.zeros(1, np.uint64),
            np.cumsum(
                mixed(points.astype(np.uint64) + STEP) * _powers(BASE, len(points))[:-1],
                dtype=np.uint64,
            ),
        )
    )
    hashes = mixed((sums[ends] - sums[starts]) * _powers(INVERSE, len(points))[starts])
    return hashes, np.searchsorted(bounds, starts, side="right") - 1


def shingle_sets(
    texts: list[str], words: int = WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, hash, count) of each text's different shingles, sorted by owner, then hash."""
    hashes, owner = word_hashes(texts)
    runs = window_hashes(hashes, words)
    whole = owner[: len(runs)] == owner[words - 1 :] if len(runs) else np.zeros(0, bool)
    found, of = runs[whole], owner[: len(runs)][whole]
    sizes = np.bincount(owner, minlength=len(texts))
    short = np.flatnonzero((sizes > 0) & (sizes < words))
    if len(short):
        first = np.cumsum(sizes) - sizes
        alone = [window_hashes(hashes[first[i] : first[i] + sizes[i]], sizes[i])[0] for i in short]
        found, of = np.concatenate((found, alone)), np.concatenate((of, short))
    order = np.lexsort((found, of))
    found, of = found[order], of[order]
    new = np.concatenate(([True], (found[1:] != found[:-1]) | (of[1:] != of[:-1])))
    at = np.flatnonzero(new[: len(found)])
    counts = np.diff(np.concatenate((at, [len(found)])))
    return of[at], found[at].astype(np.uint64), counts


def content_hash(text: str) -> tuple[int, int]:
    """Two signed 64-bit hashes of the text's words."""
    words = " ".join(text.lower().split()).encode("utf-8", "surrogatepass")
    digest = hashlib.blake2b(words, digest_size=16).digest()
    return (
        int.from_bytes(digest[:8], "little", signed=True),
        int.from_bytes(digest[8:], "little", signed=True),
    )
