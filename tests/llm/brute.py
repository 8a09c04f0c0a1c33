"""Plain Python forms of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def next_texts(rows: list[tuple]) -> list[str]:
    """For (id, text) rows in descending order, NULL ids last: the text after each."""
    return [rows[(i + 1) % len(rows)][1] for i in range(len(rows))]


def descending(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))


def syncmers(text: str, k: int, s: int, order) -> list[int]:
    """Places of the k-mers whose least s-mer, by ``order``, is at an edge."""
    found = []
    for i in range(len(text) - k + 1):
        inner = [order(text[j : j + s]) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            found.append(i)
    return found


def passes_luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(values)) % 10 == 0


def pii_spans(text: str) -> list[tuple[int, int, int]]:
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and passes_luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = (
    "(" + "|".join(map(either_case, ["password", "passwd", "secret", "token"]))
    + "|" + either_case("api") + "_?" + either_case("key") + ")"
    + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secret_spans(text: str) -> list[tuple[int, int, int]]:
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def as_text(spans: list[tuple[int, int, int]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)


def shingles(text: str) -> Counter:
    words = text.lower().split()
    found = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    return Counter(found or ([tuple(words)] if words else []))


def near_classes(texts: list[str], least: float = 0.8) -> list[int]:
    """The least place of each text's class."""
    sets, holders = [shingles(text) for text in texts], defaultdict(list)
    parent = list(range(len(texts)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    empty = [i for i, s in enumerate(sets) if not s]
    for i in empty:
        parent[i] = empty[0]
    for i, own in enumerate(sets):
        shared = Counter()
        for shingle, n in own.items():
            for j in holders[shingle]:
                shared[j] += min(n, sets[j][shingle])
            holders[shingle].append(i)
        for j, n in shared.items():
            if n / (own.total() + sets[j].total() - n) >= least:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))]


def one_apart(a, b) -> bool:
    """Whether two lists of words, or two texts, are at edit distance 1 at most."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def line_units(line: str):
    """Words of a line with 8 or more, else its characters if 24 or more, else None."""
    plain = re.sub(r"[\t\x0b\f\r]", " ", line)
    words = plain.split(" ")
    return words if len(words) >= 8 else plain if len(plain) >= 24 else None


def kept_lines(texts: list[str]) -> list[str]:
    """Texts, in order, without the lines that repeat an earlier one."""
    seen: list = []
    whole: set[str] = set()
    result = []
    for text in texts:
        kept = []
        for line in text.split("\n"):
            if not line.strip(" \t\x0b\f\r"):
                kept.append(line)
                continue
            units = line_units(line)
            repeats = line in whole or units is not None and any(
                type(other) is type(units) and one_apart(units, other) for other in seen
            )
            if not repeats:
                kept.append(line)
            if line not in whole:
                whole.add(line)
                if units is not None:
                    seen.append(units)
        result.append("\n".join(kept))
    return result


def mix_targets(sizes: dict, share: float = 1.5, most: float = 2.0) -> dict:
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    weight = {name: (5, 2, 1)[i % 3] for i, name in enumerate(names)}
    left, open_names, target = share * sum(sizes.values()), set(names), {}
    while open_names:
        level = left / sum(weight[n] for n in open_names)
        over = {n for n in open_names if weight[n] * level >= most * sizes[n]}
        if not over:
            return target | {n: weight[n] * level for n in open_names}
        target |= {n: most * sizes[n] for n in over}
        left -= sum(target[n] for n in over)
        open_names -= over
    return target


def quality_features(text: str) -> list[float]:
    """Log length, root share of each ASCII mark and of five more classes, shares of words."""

    def kind(c: str) -> str:
        if "!" <= c <= "~" and not c.isalnum():
            return c
        if ord(c) >= 0x3000:
            return "lower"
        if c.isalpha():
            return "capital" if c.isupper() else "lower"
        return "digit" if c.isdigit() else "blank" if c.isspace() else "other"

    kinds = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    kinds += ["lower", "capital", "digit", "blank", "other"]
    seen = Counter(map(kind, text))
    shares = [math.sqrt(seen[k] / len(text)) if text else 0.0 for k in kinds]
    words, lines = text.split(), text.split("\n")
    if not words:
        return [math.log(1 + len(text)), *shares, *[0.0] * 7]
    n = len(words)
    triples = {tuple(words[i : i + 3]) for i in range(n - 2)}
    return [
        math.log(1 + len(text)),
        *shares,
        math.log(1 + n),
        len(set(words)) / n,
        sum(words[i] == words[i + 1] for i in range(n - 1)) / n,
        len(triples) / max(1, n - 2),
        len(set(lines)) / len(lines),
        math.log(1 + n / len(lines)),
        len(text) / n / 10,
    ]


def balanced_hits(scores: list[float], good: list[bool], cut: float) -> float:
    """How many good texts score at least the cut, and bad ones less: sum of both shares."""
    n_good = sum(good)
    kept = sum(g and s >= cut for s, g in zip(scores, good))
    left = sum(not g and s < cut for s, g in zip(scores, good))
    return kept / n_good + left / (len(good) - n_good)
