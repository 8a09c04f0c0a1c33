"""Document quality by Bradley-Terry pairwise ranking.

From labelled documents pairs are drawn, one of each label; a linear score is fitted by
logistic loss on the differences of their features, so it learns what makes one document
better than another. Which score is good enough is a quantile of scores: the one that parts
the labels best.

The fit takes a bounded sample of labelled rows; scoring covers every whole text.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelab.llm.characters import code_points
from pricelab.llm.inputs import (
    chunks,
    for_pandas,
    matched,
    restored,
    schema_of,
    small_batches,
    whole_text,
)
from pricelab.plans.staging import stage

#: Labelled rows the fit takes at most, about, and the pairs drawn from them.
FIT_ROWS = 20_000
FIT_PAIRS = 40_000
RIDGE = 1e-3
THRESHOLD = 0.3
FOLDS = 5

#: Each ASCII punctuation mark is a class; then letters, capitals, digits, blanks, others.
MARKS = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
LOWER, CAPITAL, DIGIT, BLANK, OTHER = range(len(MARKS), len(MARKS) + 5)
CLASSES = len(MARKS) + 5
_TABLE_SIZE = 0x3000


def _class_of(c: str) -> int:
    if c in MARKS:
        return MARKS.index(c)
    if c.isalpha():
        return CAPITAL if c.isupper() else LOWER
    return DIGIT if c.isdigit() else BLANK if c.isspace() else OTHER


_CLASS = np.array([_class_of(chr(i)) for i in range(_TABLE_SIZE)] + [LOWER])


def word_features(text: str) -> tuple[float, ...]:
    """Shares that tell repetition and layout; all 0 for an empty text."""
    words, lines = text.split(), text.split("\n")
    n = len(words)
    if not n:
        return (0.0,) * 7
    again = sum(map(operator.eq, words, words[1:]))
    thirds = len(set(zip(words, words[1:], words[2:])))
    return (
        np.log1p(n),
        len(set(words)) / n,
        again / n,
        thirds / max(1, n - 2),
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        len(text) / n / 10,
    )


def features(texts: list[str]) -> np.ndarray:
    """One row per text: log length, share of each character class, ``word_features``."""
    points, bounds = code_points(texts)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(texts)), sizes)
    classes = _CLASS[np.minimum(points, _TABLE_SIZE)]
    counts = np.bincount(owner * CLASSES + classes, minlength=len(texts) * CLASSES)
    shares = counts.reshape(-1, CLASSES) / np.maximum(sizes, 1)[:, None]
    words = np.array([word_features(text) for text in texts]).reshape(len(texts), -1)
    # A few marks tell as much as many more: square roots spread small shares.
    return np.column_stack((np.log1p(sizes), np.sqrt(shares), words))


@dataclass(frozen=True)
class Ranking:
    """Weights of centred, scaled features, and the score from which a text is kept."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        # Beyond what the fit has seen, a feature says no more than the extreme seen.
        return np.clip((x - self.centre) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; ``THRESHOLD`` exactly at the cut."""
        odds = self.raw(x) - self.cut + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(x: np.ndarray, good: np.ndarray, pairs: int = FIT_PAIRS, seed: int = 42) -> Ranking:
    """Newton steps on the pairs' logistic loss. Without both labels all scores are 0.5."""
    width = x.shape[1]
    if not good.any() or good.all():
        even = float(np.log(THRESHOLD / (1 - THRESHOLD)))
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), even)
    scale = x.std(axis=0)
    model = Ranking(x.mean(axis=0), np.where(scale > 1e-9, scale, 1.0), np.zeros(width), 0.0)
    z = np.clip((x - model.centre) / model.scale, -8, 8)
    draw = np.random.default_rng(seed)
    better = draw.choice(np.flatnonzero(good), pairs)
    worse = draw.choice(np.flatnonzero(~good), pairs)
    d = z[better] - z[worse]
    w = np.zeros(width)
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))  # how wrong each pair is
        gradient = d.T @ p / pairs - RIDGE * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / pairs + RIDGE * np.eye(width)
        step = np.linalg.solve(curve, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Ranking(model.centre, model.scale, w, best_cut(z @ w, good))


def best_cut(scores: np.ndarray, good: np.ndarray) -> float:
    """The score quantile that parts the labels best: most right per label, on average.

    Of several equally good ones the middle is taken, halfway between two scores.
    """
    order = np.argsort(scores, kind="stable")
    ranked, is_good = scores[order], good[order]
    below = np.cumsum(~is_good) / (~good).sum() - np.cumsum(is_good) / good.sum()
    below[:-1][ranked[:-1] == ranked[1:]] = -1  # equal scores stay together
    best = np.flatnonzero(np.isclose(below[:-1], below[:-1].max())) if len(below) > 1 else [0]
    at = int(best[len(best) // 2])
    return float(ranked[at : at + 2].mean())


def held_out(doc_id: str | Column) -> Column:
    """Rows whose labels are never learnt from; a NULL id is one of them."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    return F.pmod(F.crc32(text), F.lit(FOLDS)) == 0


def fit_on_labels(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    rows: int = FIT_ROWS,
) -> Ranking:
    """Fit on about ``rows`` labelled rows, or on all if there are fewer.

    Which ones goes by a hash of the id. Rows of the held-out fold, and rows with a NULL id
    or label, are not used. Of documents that share an id the text with the least hash is
    learned from, however many there are; an id with both labels counts for both. The driver
    gets their features, a few dozen numbers each, so at most two rows for each id drawn.
    """
    positive = (F.col(label_column).cast("double") > 0).cast("int")
    known = (
        labels.select(F.col(id_column).alias("_id"), positive.alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & ~held_out("_id"))
        .distinct()
    )
    share = min(1.0, rows / max(1, known.count()))
    draw = F.pmod(F.xxhash64(F.lit("fit"), "_id"), F.lit(1 << 30))
    sample = stage(known.where(draw < int(share * (1 << 30))), "labels")
    texts = docs.select(
        F.col(id_column).alias("_id"),
        whole_text(text_column).alias("text"),
        F.xxhash64(whole_text(text_column)).alias("_hash"),
    )
    labelled = matched(texts, sample.select("_id").distinct(), ["_id"], "left_semi")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in chunks(batches):
            yield batch.drop(columns="text").assign(_x=list(features(batch["text"].tolist())))

    safe = for_pandas(labelled)
    measured = safe.mapInPandas(measure, schema_of(safe, "_x array<double>", without="text"))
    one_each = restored(measured, labelled).groupBy("_id").agg(F.min_by("_x", "_hash").alias("_x"))
    table = one_each.join(sample, "_id").orderBy("_id", "_label").toPandas()
    if table.empty:
        return fit(np.zeros((0, features([""]).shape[1])), np.zeros(0, bool))
    return fit(np.stack(table["_x"].to_numpy()), table["_label"].to_numpy() > 0)


def quality_scores(
    docs: DataFrame,
    model: Ranking,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted, then text and ``keep``.

    Only the text is scored; NULL counts as empty. Equal texts have equal scores, repeated
    rows stay. Columns not named are not read; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).alias("_id"),
        whole_text(text_column).alias("text"),
        *[F.col(f"`{name}`").alias(f"_keep_{i}") for i, name in enumerate(keep)],
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in chunks(batches):
            scored = batch.assign(_score=model.score(features(batch["text"].tolist())))
            yield scored if keep else scored.drop(columns="text")

    safe = for_pandas(rows)
    columns = schema_of(safe, "_score double", without="" if keep else "text")
    scored = restored(safe.mapInPandas(run, columns), rows)
    return scored.select(
        F.col("_id").alias("doc_id"),
        held_out("_id").alias("held_out"),
        F.col("_score").alias("score"),
        F.when(F.col("_score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
        *(["text"] if keep else []),
        *[F.col(f"_keep_{i}").alias(name) for i, name in enumerate(keep)],
    )
