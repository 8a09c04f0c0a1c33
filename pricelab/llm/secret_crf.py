"""Secrets by a linear-chain conditional random field over the words of a line.

Base patterns find assignments, access keys and long hexadecimal runs. On a bounded sample
of documents their values are the labels from which the field learns to tag words as
begin, inside or outside of a secret, by the word's shape, the words and shapes beside it,
and what its document is like. Viterbi decoding of every line of every document then
finds secrets that the base patterns miss.

Most lines need no decoding: where every word is for "outside" by more than any change of
tag could win, the best path has no other tag. The bound is exact.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelab.llm.inputs import chunks, for_pandas, restored, schema_of, small_batches, whole_text
from pricelab.plans.staging import stage

KINDS = ("assign", "access", "hex")

#: Documents the fit looks at, about, and different word windows it learns from, at most:
#: half of them with a value, half without. Both are parameters of ``fit_on_base``.
FIT_DOCUMENTS = 20_000
FIT_WINDOWS = 6_000
WINDOW = 12
#: Steps of the fit, at most, and the largest slope at which it ends before.
STEPS = 150
FLAT = 2e-4
RIDGE = 1e-4

ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
WORD = re.compile(r"\S+")
DIGIT = re.compile(r"\d")
NAME = re.compile(r"^[\"']?[A-Za-z_]+[\"']?[:=]+[\"']?")
EDGES = ".,;:!?\"'()[]{}<>|*#$%&"

OUTSIDE, BEGIN, INSIDE = range(3)
#: A word's code has its length, its signs, how they alternate, and its hashed name.
LENGTHS, SIGNS, TURNS, NAMES, FILES = 8, 32, 4, 1 << 11, 6
SHAPES = LENGTHS * SIGNS * TURNS
ASSIGNS = 8  # the sign of words with ``=`` or ``:`` inside
END_SHAPE, END_NAME = SHAPES, NAMES


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, place in ``KINDS``, end, where the value starts), by start, then kind."""
    spans = [
        (m.start(), 0, m.end(), m.start(1))
        for m in ASSIGN.finditer(text)
        if m.end() - m.start(1) >= 6
    ]
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= 20:
            spans.append((m.start(), 1, m.end(), m.start()))
    spans += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(spans)


def shape(word: str) -> int:
    """Length, which of lower case, capitals, digits and signs occur, how these alternate.

    Quotes and punctuation around the word do not count, nor does a name before ``=``.
    """
    word = word.strip(EDGES)
    named = NAME.match(word)
    value = word[named.end() :] if named and named.end() < len(word) else word
    signs, changes, last = ASSIGNS if value != word else 0, 0, ""
    for c in value:
        if c.isdigit():
            kind, sign = "d", 4
        elif c.isalpha():
            kind, sign = "a", 2 if c.isupper() else 1
        else:
            kind, sign = "s", 16
        signs |= sign
        changes += kind != last and last != ""
        last = kind
    length = min(LENGTHS - 1, len(value) // 4)
    turns = 0 if changes == 0 else 1 if changes <= 2 else 2 if changes <= 5 else 3
    return (length * SIGNS + signs) * TURNS + turns


class Codes(dict):
    """Word to shape and hashed name in one number; starts over when large."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 400_000:
            self.clear()
        name = re.split("[=:]", word.strip(EDGES).lower(), maxsplit=1)[0].strip(EDGES)
        hashed = zlib.crc32(name.encode("utf-8", "surrogatepass")) % NAMES
        code = self[word] = shape(word) * (NAMES + 1) + hashed
        return code


END = END_SHAPE * (NAMES + 1) + END_NAME


def file_feature(text: str) -> int:
    """How much of a document is code or settings rather than prose."""
    signs = sum(map(text.count, "={};_"))
    return min(FILES - 1, int(np.log2(1 + 2000 * signs / max(1, len(text)))))


def shifted(x: np.ndarray, by: int, fill: int) -> np.ndarray:
    """``x`` as seen from ``by`` places further on, along the last axis."""
    out = np.full_like(x, fill)
    if by > 0:
        out[..., by:] = x[..., :-by]
    else:
        out[..., :by] = x[..., -by:]
    return out


def places_of(codes: np.ndarray) -> dict[str, list[np.ndarray]]:
    """Per table of weights, which entries count at each place.

    ``codes`` has an END between lines. A name counts alike wherever it is near: in the word
    itself before ``=``, one or two words before.
    """
    shapes, names = codes // (NAMES + 1), codes % (NAMES + 1)
    own = np.minimum(shapes, SHAPES - 1)
    signs = np.where(shapes == END_SHAPE, SIGNS, own // TURNS % SIGNS)
    before = shifted(names, 1, END_NAME)
    return {
        "length": [own // (TURNS * SIGNS)],
        "sign": [signs],
        "turn": [own % TURNS],
        "before": [shifted(signs, 1, SIGNS)],
        "after": [shifted(signs, -1, SIGNS)],
        "near": [
            np.where(signs & ASSIGNS > 0, names, END_NAME),
            before,
            np.where(before == END_NAME, END_NAME, shifted(before, 1, END_NAME)),
        ],
    }


@dataclass(frozen=True)
class Field:
    """Weights per feature and tag, and of going from tag to tag."""

    tables: dict[str, np.ndarray]
    steps: np.ndarray

    def emissions(self, codes: np.ndarray, files: np.ndarray) -> np.ndarray:
        """Scores (place, tag)."""
        scores = self.tables["file"][files]
        for name, places in places_of(codes).items():
            for at in places:
                scores = scores + self.tables[name][at]
        return scores

    def viterbi(self, scores: np.ndarray) -> list[int]:
        """The best tags of one line; INSIDE never follows OUTSIDE or a line's start."""
        best, back = scores[0].copy(), []
        best[INSIDE] = -np.inf
        for row in scores[1:]:
            ways = best[:, None] + self.steps
            ways[OUTSIDE, INSIDE] = -np.inf
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + row
        tags = [int(best.argmax())]
        for choices in reversed(back):
            tags.append(int(choices[tags[-1]]))
        return tags[::-1]

    def surely_outside(self, scores: np.ndarray) -> np.ndarray:
        """Places where no path can win by another tag, whatever its neighbours are."""
        gain = max(0.0, float(self.steps.max() - self.steps[OUTSIDE, OUTSIDE]))
        return scores[:, OUTSIDE] - scores[:, BEGIN:].max(axis=1) > 2 * gain


def tags_of(words: list[re.Match], spans: list[tuple[int, int]]) -> list[int]:
    """Tags of words, given value spans of the same line."""
    tags, open_span = [], None
    for word in words:
        hit = next((s for s in spans if s[0] < word.end() and word.start() < s[1]), None)
        tags.append(OUTSIDE if hit is None else INSIDE if hit == open_span else BEGIN)
        open_span = hit
    return tags


def windows(text: str) -> Iterator[tuple[list[str], list[int]]]:
    """Words and tags around values and words with digits, and of the first line.

    Values are found in the whole text first; lines with neither are not split into words.
    """
    at = 0
    values = [(value, end) for _, _, end, value in base_spans(text)]
    for line in text.split("\n"):
        own = [(s - at, e - at) for s, e in values if at <= s <= at + len(line)]
        if at == 0 or own or DIGIT.search(line):
            words = list(WORD.finditer(line))
            tags = tags_of(words, own) if own else [OUTSIDE] * len(words)
            marked = [i for i, w in enumerate(words) if tags[i] or DIGIT.search(w[0])]
            if at == 0 and words:
                marked.append(0)
            last = -1
            for i in marked:
                if i > last:
                    start, last = max(0, i - WINDOW), min(len(words), i + WINDOW)
                    yield [w[0] for w in words[start:last]], tags[start:last]
        at += len(line) + 1


def fit(
    examples: list[tuple[list[str], list[int], int]],
    times: list[float] | None = None,
    steps: int = STEPS,
) -> Field:
    """Gradient ascent (Adam) on the penalised likelihood of all windows together.

    ``times`` weighs the windows. It ends when no slope is above ``FLAT``. Without any tagged
    word the field tags everything as outside.
    """
    sizes = {
        "length": LENGTHS, "sign": SIGNS + 1, "turn": TURNS, "before": SIGNS + 1,
        "after": SIGNS + 1, "near": NAMES + 1, "file": FILES, "steps": 3,
    }
    weights = {name: np.zeros((size, 3)) for name, size in sizes.items()}
    if not any(any(tags) for _, tags, _ in examples):
        weights["sign"][:, OUTSIDE] = 100.0
        return Field(weights, weights.pop("steps"))
    known = Codes()
    n, longest = len(examples), max(len(words) for words, _, _ in examples)
    codes, gold = np.full((n, longest), END), np.zeros((n, longest), int)
    for i, (words, tags, _) in enumerate(examples):
        codes[i, : len(words)] = [known[word] for word in words]
        gold[i, : len(tags)] = tags
    share = np.ones(n) if times is None else np.asarray(times, float)
    share = share / share.sum()
    real = codes != END
    file = np.broadcast_to(np.array([x for _, _, x in examples])[:, None], real.shape)
    at = places_of(codes) | {"file": [file]}
    counted = real * share[:, None]
    truth = np.eye(3)[gold] * counted[..., None]
    pairs = real[:, 1:] & real[:, :-1]
    pair_share = pairs * share[:, None]
    true_steps = np.einsum("ita,itb->ab", np.eye(3)[gold[:, :-1]] * pair_share[..., None], np.eye(3)[gold[:, 1:]])

    mean = {name: np.zeros_like(w) for name, w in weights.items()}
    square = {name: np.zeros_like(w) for name, w in weights.items()}
    for step in range(1, steps + 1):
        scores = sum(weights[name][x] for name, places in at.items() for x in places)
        # Forward and backward in plain numbers, scaled to 1 at each place.
        local = np.exp(scores - scores.max(axis=2, keepdims=True))
        local[:, 0, INSIDE] = 0.0
        moves = np.exp(weights["steps"])
        moves[OUTSIDE, INSIDE] = 0.0
        ahead, behind = np.empty_like(local), np.empty_like(local)
        ahead[:, 0] = local[:, 0] / local[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, longest):
            new = (ahead[:, t - 1] @ moves) * local[:, t]
            new /= new.sum(axis=1, keepdims=True)
            ahead[:, t] = np.where(real[:, t, None], new, ahead[:, t - 1])
        behind[:, -1] = 1.0
        for t in range(longest - 1, 0, -1):
            new = (local[:, t] * behind[:, t]) @ moves.T
            new /= new.sum(axis=1, keepdims=True)
            behind[:, t - 1] = np.where(real[:, t, None], new, behind[:, t])
        likely = ahead * behind
        likely *= (counted / likely.sum(axis=2))[..., None]
        onward = local[:, 1:] * behind[:, 1:]
        whole = ((ahead[:, :-1] @ moves) * onward).sum(axis=2)
        seen = pair_share / np.where(pairs, whole, 1.0)
        both = moves * np.einsum("ita,itb->ab", ahead[:, :-1] * seen[..., None], onward)
        off = truth - likely
        steepest = 0.0
        for name, w in weights.items():
            if name == "steps":
                gradient = true_steps - both
            else:
                gradient = sum(
                    np.column_stack(
                        [
                            np.bincount(x.ravel(), off[..., tag].ravel(), len(w))
                            for tag in (OUTSIDE, BEGIN, INSIDE)
                        ]
                    )
                    for x in at[name]
                )
            gradient = gradient - RIDGE * w
            steepest = max(steepest, float(np.abs(gradient).max()))
            mean[name] = 0.9 * mean[name] + 0.1 * gradient
            square[name] = 0.999 * square[name] + 0.001 * gradient**2
            unbiased = mean[name] / (1 - 0.9**step)
            w += 0.1 * unbiased / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
        if steepest < FLAT:
            break
    return Field(weights, weights.pop("steps"))


def fit_on_base(
    docs: DataFrame,
    text_column: str = "text",
    documents: int = FIT_DOCUMENTS,
    most_windows: int = FIT_WINDOWS,
) -> Field:
    """Fit on windows of about ``documents`` documents chosen by a hash of their text.

    Equal texts are looked at once, and equal windows count once, with a weight that grows with
    the logarithm of how often they occur. The driver gets at most ``most_windows`` different
    ones, of a few words each, half of them with a tag if there are so many.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(whole_text(text_column).alias("text"))
    draw = F.pmod(F.xxhash64(F.lit("fit"), "text"), F.lit(1 << 30))
    share = min(1.0, documents / max(1, docs.count()))
    drawn = rows.where(draw < int(share * (1 << 30))).groupBy("text").agg(F.count("*").alias("n"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in chunks(batches):
            found = [
                (words, tags, file_feature(text), n)
                for text, n in zip(batch["text"], batch["n"])
                for words, tags in windows(text)
            ]
            yield pd.DataFrame(found, columns=["words", "tags", "file", "n"])

    found = drawn.mapInPandas(run, "words array<string>, tags array<int>, file int, n long")
    found = stage(found.groupBy("words", "tags", "file").agg(F.sum("n").alias("n")), "secret-windows")
    tagged = F.array_max("tags") > 0
    halves = [
        found.where(kind).orderBy(F.xxhash64("words"), "words", "tags", "file").limit(most_windows // 2).collect()
        for kind in (tagged, ~tagged)
    ]
    chosen = [row for half in halves for row in half]
    examples = [(row["words"], row["tags"], row["file"]) for row in chosen]
    return fit(examples, [1 + math.log(row["n"]) for row in chosen])


def value_span(line: str, words: list[re.Match]) -> tuple[int, int]:
    """The span of tagged words without a name before it, quotes and punctuation."""
    start, end = words[0].start(), words[-1].end()
    named = NAME.match(words[0][0])
    start += named.end() if named and named.end() < len(words[0][0]) else 0
    text = line[start:end]
    end = start + len(text.rstrip(EDGES))
    return min(end, start + len(text) - len(text.lstrip(EDGES))), end


def kind_of(value: str) -> int:
    """Which kind a found value is reported as."""
    if value.startswith("AKIA"):
        return 1
    return 2 if re.fullmatch(r"[0-9a-fA-F]+", value) else 0


def found_in(text: str, field: Field, known: Codes, base: list, doubtful: list[int]) -> list[tuple]:
    """Spans that decoding adds in the lines with the given numbers."""
    added, lines, starts, file = [], text.split("\n"), [0], file_feature(text)
    for line in lines:
        starts.append(starts[-1] + len(line) + 1)
    for number in doubtful:
        line = lines[number]
        words = list(WORD.finditer(line))
        codes = np.array([known[word[0]] for word in words])
        tags = field.viterbi(field.emissions(codes, np.full(len(codes), file)))
        i = 0
        while i < len(words):
            j = i + 1
            if tags[i] == BEGIN:
                while j < len(words) and tags[j] == INSIDE:
                    j += 1
                start, end = (x + starts[number] for x in value_span(line, words[i:j]))
                apart = all(e <= start or end <= s for s, _, e, _ in base)
                if end - start >= 6 and apart:
                    added.append((start, kind_of(text[start:end]), end))
            i = j
    return added


def scanned(batches: Iterator[pd.DataFrame], field: Field) -> Iterator[pd.DataFrame]:
    known = Codes()
    for batch in chunks(batches, "_text"):
        texts = batch.pop("_text").tolist()
        codes, lines, files = [], [], []  # lines: (text, line) of every code
        for i, text in enumerate(texts):
            before = len(codes)
            for number, line in enumerate(text.split("\n")):
                words = line.split()
                codes.extend(map(known.__getitem__, words))
                codes.append(END)
                lines.append((i, number, len(words) + 1))
            files.append((file_feature(text), len(codes) - before))
        file = np.repeat([f for f, _ in files], [n for _, n in files]).astype(int)
        every = np.array(codes)
        doubt = ~field.surely_outside(field.emissions(every, file)) & (every != END)
        ends = np.cumsum([n for _, _, n in lines])
        of_line = np.searchsorted(ends, np.flatnonzero(doubt), side="right")
        doubtful: dict[int, list[int]] = {}
        for at in np.unique(of_line):
            i, number, _ = lines[at]
            doubtful.setdefault(i, []).append(number)
        base, added = [], []
        for i, text in enumerate(texts):
            own = base_spans(text)
            base.append([{"start": s, "kind": k, "end": e} for s, k, e, _ in own])
            more = found_in(text, field, known, own, doubtful[i]) if i in doubtful else []
            added.append([{"start": s, "kind": k, "end": e} for s, k, e in more])
        yield batch.assign(base=base, added=added)


def secrets(
    docs: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id, base, added: arrays of (start, kind, end), sorted.

    ``kind`` is a place in ``KINDS``; places are code points, ends exclusive. Spans that the
    field adds touch no base span and cover only the value. NULL texts are empty and have
    none; repeated rows and NULL ids stay; columns not named are not read; an empty table
    gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), whole_text(text_column).alias("_text"))
    safe, span = for_pandas(rows), "array<struct<start:int,kind:int,end:int>>"
    found = safe.mapInPandas(
        lambda it: scanned(it, field),
        schema_of(safe, f"base {span}", f"added {span}", without="_text"),
    )
    return restored(found, rows)
