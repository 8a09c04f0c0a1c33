"""Rolling hashes over the characters of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

#: Odd multipliers of a well-mixing 64-bit finaliser; fixed so that hashes agree everywhere.
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points one after the other, and where each text begins and the last ends."""
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    ends = np.cumsum([len(text) for text in texts], dtype=np.int64)
    return np.frombuffer(joined, "<u4"), np.concatenate(([0], ends)).astype(np.int64)


def window_hashes(values: np.ndarray, width: int, salt: int = 1) -> np.ndarray:
    """Hash of each run of ``width`` values; fewer runs than values by ``width - 1``."""
    runs = max(0, len(values) - width + 1)
    total = np.full(runs, np.uint64(salt), np.uint64)
    for i in range(width):
        total *= STEP
        total += values[i : i + runs]
    return mixed(total)
