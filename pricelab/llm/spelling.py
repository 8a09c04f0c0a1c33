"""Spelling variants: pairs of words one edit apart, by finite-state composition.

The vocabulary is an acceptor; composed with a transducer that makes one edit (a code point
inserted, deleted or replaced) and with the acceptor again it accepts just the near pairs.

No acceptor of all words is built. Words are dealt by initial states: of a near pair whose
shorter word has n code points, both share the first n div 2 code points, or the last ones
from there. So each word joins the state that its first half leads to, and in an acceptor
of reversed words the one that its last half leads to, once for its own length and once for
a word shorter by one. From each state the minimised acceptor of what follows is composed
with the transducer; pairs of equal remainders are found once however many words lead there.
A pair is taken from the front where its first halves are equal, else from the back, so
every pair comes once.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelab.llm.inputs import arrow_batches, chunks, for_pandas, small_batches, whole_text
from pricelab.plans.staging import stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Misspelling drill: where this divides a run's hash, one code point is deleted.
DRILL = 97
FEWEST_CODE_POINTS = 5
FEWEST_OCCURRENCES = 3
#: How many times as frequent as a variant its form is, at least.
FORM_TIMES = 2

#: Counted words that a task holds before it hands them on.
KEPT_WORDS = 200_000
#: Rows of a batch of dealt words.
BATCH_ROWS = 20_000

ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def run_counts(text: str, prefix: int) -> Iterator[tuple[str, int]]:
    """The words of a text, as often as they occur; ``prefix`` is the crc32 of ``<doc_id>:``."""
    lowered = text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).decode("utf-8", "surrogatepass")
    for run, n in Counter(RUN.findall(lowered)).items():
        h = zlib.crc32(run.encode(), prefix)
        if h % DRILL == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= FEWEST_CODE_POINTS:
            yield run, n


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """word, n: distinct words of at least ``FEWEST_OCCURRENCES`` occurrences, counted per task first."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("string").alias("_id"), whole_text(text_column).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found() -> Iterator[pd.DataFrame]:
            if total:  # a frame without rows has no types
                yield pd.DataFrame({"word": list(total), "n": list(total.values())})
                total.clear()

        total: Counter[str] = Counter()
        for batch in chunks(batches):
            for doc_id, text in zip(batch["_id"], batch["text"]):
                prefix = zlib.crc32(f"{'' if pd.isna(doc_id) else doc_id}:".encode())
                for word, n in run_counts(text, prefix):
                    total[word] += n
            if len(total) >= KEPT_WORDS:
                yield from found()
        yield from found()

    counted = for_pandas(rows).mapInPandas(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= FEWEST_OCCURRENCES)


class Acceptor:
    """A minimised acyclic acceptor; a state is a number, equal remainders have one state."""

    def __init__(self, words: list[str]) -> None:
        self.final: list[bool] = []
        self.steps: list[dict[str, int]] = []
        self.known: dict[tuple, int] = {}
        self.languages: dict[int, list[str]] = {}
        self.shared: dict[tuple[int, int], list[str]] = {}
        # One level per letter: plain Python calls need no stack of their own.
        deepest = 2 * max(map(len, words), default=0) + 1_000
        sys.setrecursionlimit(max(sys.getrecursionlimit(), deepest))
        self.start = self.minimised(sorted(set(words)), 0)

    def minimised(self, words: list[str], depth: int) -> int:
        """The state for sorted words that agree up to ``depth``; remainders first."""
        final, steps, at = bool(words) and len(words[0]) == depth, {}, 0
        at = int(final)
        while at < len(words):
            letter, end = words[at][depth], at + 1
            while end < len(words) and words[end][depth] == letter:
                end += 1
            steps[letter] = self.minimised(words[at:end], depth + 1)
            at = end
        key = (final, *steps.items())
        if key not in self.known:
            self.known[key] = len(self.final)
            self.final.append(final)
            self.steps.append(steps)
        return self.known[key]

    def language(self, state: int) -> list[str]:
        """All remainders that a state accepts."""
        if state not in self.languages:
            found = [""] if self.final[state] else []
            for letter, to in self.steps[state].items():
                found += [letter + rest for rest in self.language(to)]
            self.languages[state] = found
        return self.languages[state]

    def common(self, a: int, b: int) -> list[str]:
        """The remainders that both states accept: what follows an edit."""
        if a == b:
            return self.language(a)
        a, b = min(a, b), max(a, b)
        if (a, b) not in self.shared:
            found = [""] if self.final[a] and self.final[b] else []
            other = self.steps[b]
            for letter, to in self.steps[a].items():
                if letter in other:
                    found += [letter + rest for rest in self.common(to, other[letter])]
            self.shared[a, b] = found
        return self.shared[a, b]

    def near_pairs(self) -> set[tuple[str, str]]:
        """Accepted pairs one edit apart, the shorter or smaller first."""
        found: dict[int, set[tuple[str, str]]] = {}

        def of(state: int) -> set[tuple[str, str]]:
            if state in found:
                return found[state]
            pairs, steps = set(), list(self.steps[state].items())
            for i, (one, to) in enumerate(steps):
                pairs |= {(one + a, one + b) for a, b in of(to)}  # copied; the edit comes later
                for rest in self.common(state, to):  # ``one`` is inserted here
                    pairs.add((rest, one + rest))
                for other, beside in steps[i + 1 :]:  # ``one`` is replaced by ``other``
                    for rest in self.common(to, beside):
                        pairs.add((one + rest, other + rest))
            found[state] = pairs
            return pairs

        return of(self.start)


def dealt(words: DataFrame) -> DataFrame:
    """(word, n) to rows _side, _length, _half, word, n: the initial states of each word.

    Rows of states that only one word leads to are left out.
    """
    half, size = "(_length div 2)", "char_length(word)"
    sides = (
        f"array(named_struct('_side', 0, '_half', left(word, cast({half} AS int))),"
        f" named_struct('_side', 1, '_half', right(word, cast(_length - {half} AS int))))"
    )
    rows = words.selectExpr(
        "word", "n", f"explode(array({size}, {size} - 1)) AS _length"
    ).selectExpr("word", "n", "_length", f"inline({sides})")
    state = ["_side", "_length", "_half"]
    several = rows.groupBy(*state).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return rows.join(several, state).select(*state, "word", "n")


def state_pairs(side: int, length: int, half: str, words: list[str]) -> Iterator[tuple[str, str]]:
    """Near pairs whose shorter word has ``length`` code points, of the words of one state."""
    cut = len(half)
    rests = [word[cut:] if side == 0 else word[: len(word) - cut][::-1] for word in words]
    first = length // 2
    for a, b in Acceptor(rests).near_pairs():
        if side:
            a, b = a[::-1], b[::-1]
            if a[:first] == b[:first]:
                continue  # found from the front
        one, two = (half + a, half + b) if side == 0 else (a + half, b + half)
        if min(len(one), len(two)) == length:
            yield one, two


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n) to both directions of every near pair: word, near, near_n."""
    state = ["_side", "_length", "_half"]
    rows = dealt(words).repartition(*state).sortWithinPartitions(*state)

    def compose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, {}

        def found() -> list[tuple]:
            if len(held) < 2:
                return []
            pairs = list(state_pairs(*key, list(held)))
            return [(a, b, held[b]) for a, b in pairs] + [(b, a, held[a]) for a, b in pairs]

        for batch in batches:
            done = []
            for side, length, half, word, n in zip(*(batch[name] for name in (*state, "word", "n"))):
                if key != (side, length, half):
                    done += found()
                    key, held = (side, length, half), {}
                held[word] = n
            yield pd.DataFrame(done, columns=["word", "near", "near_n"])
        yield pd.DataFrame(found(), columns=["word", "near", "near_n"])

    return rows.mapInPandas(compose, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) of words with a form to (word, root): the last of the forms that follow.

    A form is more frequent than its word, so chains end; each round doubles how far a word
    looks, and is written.
    """
    reached = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = reached.join(further, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
        )
        step = stage(step, "spelling-roots")
        reached = step.select("word", "root")
        if step.where("_moved").isEmpty():
            return reached


def spelling_variants(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per word of the vocabulary: word, form, root, n, n_near, form_n.

    * NULL and empty texts have no words; a NULL id hashes like an empty one. Repeated rows
      count again; a word of equally frequent near ones takes the smallest in code-point order.
    * A long text is counted as a whole in one task, which holds its distinct words.
    * Columns not named are not read; an empty table gives no rows.
    """
    words = stage(vocabulary(docs, id_column, text_column), "vocabulary")
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        pairs = stage(near_pairs(words), "near-words")
    near = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("_best"),
    )
    best = F.when(-F.col("_best.less") >= FORM_TIMES * F.col("n"), F.col("_best"))
    found = stage(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            best["near"].alias("form"),
            (-best["less"]).alias("form_n"),
        ),
        "forms",
    )
    last = roots(found.where("form IS NOT NULL"))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
