"""Near-duplicates by DartMinHash signatures and banded joins.

Each weighted element owns a region: its weight wide, unbounded in rank. Darts fall into
all regions at unit density; where they fall is a hash of element, cell and count, so equal
elements get equal darts in all documents. A dart counts for a document if it fell below
the element's weight there, and belongs to one of ``k`` coordinates; per coordinate the
earliest dart is the signature's value. Two documents agree on a coordinate with the
probability of their weighted Jaccard similarity.

Cells double in width and height, and cells are filled only up to the rank at which a
document is expected to have a dart on each coordinate, about ``k ln k + 2k`` darts in all,
whatever its number of elements.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelab.llm.characters import STEP, mixed
from pricelab.llm.components import components
from pricelab.llm.inputs import (
    chunks,
    for_pandas,
    matched,
    restored,
    schema_of,
    small_batches,
    whole_text,
)
from pricelab.llm.shingles import content_hash, shingle_sets
from pricelab.plans.staging import stage

SIMILARITY = 0.8
#: At 0.8 two documents share none of 32 bands of 5 coordinates in 3 of a million cases.
BANDS = 32
BAND_ROWS = 5
#: Characters of a bucket that one task holds against as many others.
BLOCK_CHARS = 500_000
#: Characters sketched or compared at once: each takes some hundred bytes meanwhile.
SKETCH_CHARS = 250_000


@lru_cache(maxsize=64)
def poisson_steps(log_area: int) -> np.ndarray:
    """Cumulative Poisson probabilities for a cell of area ``2 ** log_area``."""
    area = 2.0**log_area
    counts = np.arange(int(area + 12 * area**0.5 + 30))
    logs = counts * np.log(area) - area - np.concatenate(([0], np.cumsum(np.log(counts[1:]))))
    return np.minimum(np.cumsum(np.exp(logs)), 1.0)


def unit(hashes: np.ndarray) -> np.ndarray:
    """Uniform in [0, 1)."""
    return (hashes >> np.uint64(11)).astype(np.float64) * 2.0**-53


def strip(index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the strips [0,1), [1,2), [2,4), [4,8) ... begin, and the log of their width."""
    return np.where(index > 0, 2.0 ** (index - 1), 0.0), np.maximum(index - 1, 0)


def repeated(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place i ``counts[i]`` times, and the number of each repetition from 0."""
    places = np.repeat(np.arange(len(counts)), counts)
    return places, np.arange(len(places)) - np.repeat(np.cumsum(counts) - counts, counts)


def signatures(
    owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, k: int
) -> dict[int, np.ndarray]:
    """Owner to the ``k`` earliest darts (64-bit names) of its weighted elements."""
    done: dict[int, np.ndarray] = {}
    wanted = k * np.log(k) + 2 * k
    while len(owner):
        owners, local = np.unique(owner, return_inverse=True)
        total = np.bincount(local, weights=weights)
        ranks = 1 + np.ceil(np.log2(np.maximum(wanted / total, 1.0))).astype(np.int64)
        widths = 1 + np.ceil(np.log2(np.maximum(weights, 1.0))).astype(np.int64)
        element, cell = repeated(widths * ranks[local])
        in_width, in_rank = cell % widths[element], cell // widths[element]
        low, log_width = strip(in_width)
        early, log_height = strip(in_rank)
        name = mixed(
            elements[element] + (in_width * 64 + in_rank + 1).astype(np.uint64) * STEP
        )
        chance = unit(mixed(name + np.uint64(1)))
        darts = np.zeros(len(name), np.int64)
        log_area = log_width + log_height
        for area in np.unique(log_area):
            at = log_area == area
            darts[at] = np.searchsorted(poisson_steps(int(area)), chance[at], side="right")
        of, number = repeated(darts)
        dart = mixed(name[of] + (number + 2).astype(np.uint64) * STEP)
        weight = low[of] + unit(mixed(dart + np.uint64(1))) * 2.0 ** log_width[of]
        hit = weight < weights[element[of]]
        of, dart = of[hit], dart[hit]
        rank = early[of] + unit(mixed(dart + np.uint64(2))) * 2.0 ** log_height[of]
        place = local[element[of]] * k + (dart % np.uint64(k)).astype(np.int64)
        latest_first = np.argsort(-rank, kind="stable")
        best = np.zeros(len(owners) * k, np.uint64)
        filled = np.zeros(len(owners) * k, bool)
        best[place[latest_first]] = dart[latest_first]  # the last one written is the earliest
        filled[place] = True
        complete = filled.reshape(-1, k).all(axis=1)
        for i in np.flatnonzero(complete):
            done[int(owners[i])] = best[i * k : (i + 1) * k]
        again = ~complete[local]
        owner, elements, weights = owner[again], elements[again], weights[again]
        wanted *= 2
    return done


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit key per band of ``rows`` coordinates."""
    parts = signature.reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        key = mixed(key * STEP + parts[:, i])
    return key.astype(np.int64)


def sketched(batches: Iterator[pd.DataFrame], bands: int, rows: int) -> Iterator[pd.DataFrame]:
    for batch in chunks(batches, "_text", SKETCH_CHARS):
        texts = batch["_text"].tolist()
        owner, elements, counts = shingle_sets(texts)
        found = signatures(owner, elements, counts.astype(np.float64), bands * rows)
        contents = [content_hash(text) for text in texts]
        yield batch.assign(
            _c1=[c[0] for c in contents],
            _c2=[c[1] for c in contents],
            _bands=[
                band_keys(found[i], bands, rows) if i in found else None for i in range(len(texts))
            ],
        )


def similarities(a: list[str], b: list[str]) -> np.ndarray:
    """Weighted Jaccard similarity of shingle counts, pair by pair."""
    owner, elements, counts = shingle_sets(a + b)
    cuts = np.searchsorted(owner, np.arange(len(a) + len(b) + 1))
    found = np.zeros(len(a))
    for i in range(len(a)):
        x, y = (slice(cuts[j], cuts[j + 1]) for j in (i, len(a) + i))
        _, p, q = np.intersect1d(elements[x], elements[y], assume_unique=True, return_indices=True)
        shared = np.minimum(counts[x][p], counts[y][q]).sum()
        both = counts[x].sum() + counts[y].sum() - shared
        found[i] = shared / both if both else 1.0
    return found


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (_a, _b) of rows whose texts are at least that similar."""
    involved = pairs.select(F.explode(F.array("_a", "_b")).alias("_row")).distinct()
    some = stage(matched(texts, stage(involved, "near-involved"), ["_row"], "left_semi"), "near-texts")

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in chunks(batches, "_x", SKETCH_CHARS):
            alike = similarities(batch["_x"].tolist(), batch["_y"].tolist()) >= least
            yield batch.loc[alike, ["_a", "_b"]]

    with_texts = pairs.join(
        some.select(F.col("_row").alias("_a"), F.col("_text").alias("_x")), "_a"
    ).join(some.select(F.col("_row").alias("_b"), F.col("_text").alias("_y")), "_b")
    return with_texts.select("_a", "_b", "_x", "_y").mapInPandas(keep, "_a long, _b long")


def star_pairs(members: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's least row; no pairs among the others."""
    centres = members.groupBy("_key").agg(F.min("_row").alias("_a"))
    return (
        members.join(centres, "_key")
        .where("_row != _a")
        .select("_a", F.col("_row").alias("_b"))
        .distinct()
    )


def linked(part: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links between texts of different classes, as many as join the classes they join.

    With members of a bucket's main class in the part, only theirs with the others: the
    others meet among each other in parts of their own.
    """
    part = part.sort_values("_main", ascending=False, kind="stable")
    rows, classes = part["_row"].tolist(), part["_class"].tolist()
    n_main = int(part["_main"].sum())
    if n_main == len(rows):
        return pd.DataFrame([], columns=["_a", "_b"], dtype="int64")
    owner, elements, counts = shingle_sets(part["_text"].tolist())
    n_met = n_main or len(rows)
    met = np.flatnonzero(owner < n_met)
    order = met[np.argsort(elements[met], kind="stable")]
    of, shared, times = owner[order], elements[order], counts[order]
    first = np.searchsorted(shared, elements, side="left")
    holders = np.searchsorted(shared, elements, side="right") - first
    total = np.bincount(owner, weights=counts, minlength=len(rows))
    cuts = np.searchsorted(owner, np.arange(len(rows) + 1))
    label = {c: c for c in classes}

    def root(c: int) -> int:
        while label[c] != c:
            label[c] = c = label[label[c]]
        return c

    found = []
    for i in range(n_main, len(rows)):
        own = slice(cuts[i], cuts[i + 1])
        before = min(i, n_met)
        element, step = repeated(holders[own])
        at = first[own][element] + step
        both = np.bincount(
            of[at], weights=np.minimum(times[at], counts[own][element]), minlength=len(rows)
        )[:before]
        near = both >= least * (total[i] + total[:before] - both)
        for j in np.flatnonzero(near & (both > 0)):
            a, b = root(classes[i]), root(classes[j])
            if a != b:
                label[max(a, b)] = min(a, b)
                found.append((min(rows[i], rows[j]), max(rows[i], rows[j])))
    return pd.DataFrame(found, columns=["_a", "_b"], dtype="int64")


def dealt_members(left: DataFrame) -> DataFrame:
    """Members (_key, _row, _class, _chars) to parts (_key, _i, _j) in which to hold them together.

    A bucket of up to ``BLOCK_CHARS`` is one part. In a larger one the class with most text
    is the main class (_main): its members are of one class already and need not meet. They
    and the others are cut into blocks apart; each block of the main class meets each of the
    others', and each two blocks of the others meet. So a bucket with few others is copied
    once, however large it is.
    """
    of_class = left.groupBy("_key", "_class").agg(F.sum("_chars").alias("_chars"))
    cut = (
        of_class.groupBy("_key")
        .agg(F.max(F.struct("_chars", "_class")).alias("_most"), F.sum("_chars").alias("_all"))
        .selectExpr(
            "_key",
            f"if(_all > {BLOCK_CHARS}, _most._class, NULL) AS _main_class",
            f"cast(greatest(1, ceil(_most._chars / {BLOCK_CHARS})) AS int) AS _mains",
            f"cast(greatest(1, ceil((_all - _most._chars) / {BLOCK_CHARS})) AS int) AS _others",
        )
    )
    block = "cast(pmod(xxhash64(_row, _key), if(_main, _mains, _others)) AS int)"
    parts = """
        CASE WHEN _main_class IS NULL THEN array(struct(0 AS _i, 0 AS _j))
             WHEN _main THEN transform(sequence(0, _others - 1), o -> struct(_block AS _i, o AS _j))
             ELSE concat(
                 transform(sequence(0, _mains - 1), m -> struct(m AS _i, _block AS _j)),
                 transform(sequence(0, _others - 1),
                           o -> struct(-1 - least(o, _block) AS _i, greatest(o, _block) AS _j)))
        END
    """
    return (
        left.join(cut, "_key")
        .selectExpr("*", "coalesce(_class = _main_class, false) AS _main")
        .selectExpr("*", f"{block} AS _block")
        .selectExpr("_key", "_row", "_class", "_main", f"inline({parts})")
    )


def links_in_buckets(members: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links in the buckets whose members (_key, _row, _class, _chars) are of several classes.

    Two members are a pair, which may meet in several buckets and is verified once. More are
    held against each other inside a task, by the shingles that they share, and only links
    come out. How large buckets are cut is told at ``dealt_members``.
    """
    several = (
        members.groupBy("_key")
        .agg(
            F.min("_class").alias("_c"),
            F.max("_class").alias("_d"),
            F.count("*").alias("_n"),
            F.min("_row").alias("_a"),
            F.max("_row").alias("_b"),
        )
        .where("_c < _d")
    )
    several = stage(several, "near-several")
    in_pairs = verified(several.where("_n = 2").select("_a", "_b").distinct(), texts, least)
    larger = several.where("_n > 2").select("_key")
    left = stage(members.join(larger, "_key"), "near-left")
    involved = stage(left.select("_row").distinct(), "near-involved")
    some = matched(texts, involved, ["_row"], "left_semi")
    groups = dealt_members(left).join(some, "_row")
    in_blocks = groups.groupBy("_key", "_i", "_j").applyInPandas(
        lambda part: linked(part, least), "_a long, _b long"
    )
    return in_pairs.unionByName(in_blocks)


def labelled_rows(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    least: float,
    bands: int,
    rows: int,
    keep: list[str] | tuple[str, ...],
) -> tuple[DataFrame, DataFrame]:
    """The rows, numbered (_row, _id, _text, _keep_0...), and (_row, _id, _label) of each."""
    small_batches(docs.sparkSession)
    plain = docs.select(
        F.col(id_column).cast("long").alias("_id"),
        whole_text(text_column).alias("_text"),
        *[F.col(f"`{name}`").alias(f"_keep_{i}") for i, name in enumerate(keep)],
    ).withColumn("_row", F.monotonically_increasing_id())
    safe = for_pandas(plain)
    sketches = safe.mapInPandas(
        lambda it: sketched(it, bands, rows),
        schema_of(safe, "_c1 long", "_c2 long", "_bands array<long>"),
    )
    sketches = stage(restored(sketches, plain), "near-sketches")
    contents = stage(
        sketches.groupBy("_c1", "_c2").agg(F.min("_row").alias("_node")), "near-contents"
    )
    first = contents.select(F.col("_node").alias("_row"))
    members = (
        sketches.select("_row", F.char_length("_text").alias("_chars"), "_bands")
        .join(first, "_row", "left_semi")
        .select("_row", "_chars", F.explode("_bands").alias("_key"))
    )
    sizes = members.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1").select("_key")
    members = stage(members.join(sizes, "_key", "left_semi"), "near-buckets")
    texts = sketches.select("_row", "_text")

    edges = stage(verified(star_pairs(members), texts, least), "near-links")
    classes = components(edges)
    own = classes.select("_row", F.col("_label").alias("_known"))
    labelled = members.join(own, "_row", "left").withColumn("_class", F.coalesce("_known", "_row"))
    more = stage(links_in_buckets(labelled, texts, least), "near-links")
    if not more.isEmpty():
        classes = components(edges.unionByName(more))

    placed = sketches.select("_row", "_id", "_c1", "_c2").join(contents, ["_c1", "_c2"])
    known = classes.select(F.col("_row").alias("_node"), F.col("_label").alias("_known"))
    placed = placed.join(known, "_node", "left")
    return sketches, stage(
        placed.select("_row", "_id", F.coalesce("_known", "_node").alias("_label")), "near"
    )


def class_heads(labels: DataFrame) -> DataFrame:
    """Per _label: _head (n, _id, _row of the row that stays), _size."""
    return labels.groupBy("_label").agg(
        F.min(F.struct(F.col("_id").isNull().alias("n"), "_id", "_row")).alias("_head"),
        F.count("*").alias("_size"),
    )


def near_classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept.

    A class is a connected component of "at least ``least`` similar" by counted five-word
    shingles; its id is its smallest doc_id (negative if all its ids are NULL), and exactly
    one row of it, with that id, has ``kept``.

    * Rows whose words are equal are one text from the start and never compared.
    * NULL and empty texts, and texts of blanks only, form one class.
    * Texts of one to four words are near only to equal ones.
    * Other texts are compared if they share a band. In a bucket all are compared with its
      least row; where classes remain apart then, all of them with each other, in blocks
      inside tasks. Every link is verified on the shingles.
    * Columns not named are not read; an empty table gives no rows.
    """
    _, labels = labelled_rows(docs, id_column, text_column, least, bands, rows, ())
    return labels.join(class_heads(labels), "_label").select(
        F.col("_id").alias("doc_id"),
        F.coalesce("_head._id", -F.col("_head._row") - 1).alias("class_id"),
        F.col("_size").alias("class_size"),
        (F.col("_row") == F.col("_head._row")).alias("kept"),
    )


def without_near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
    keep: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, text and ``keep`` of the rows that ``near_classes`` keeps."""
    numbered, labels = labelled_rows(docs, id_column, text_column, least, bands, rows, keep)
    heads = class_heads(labels).select("_label", F.col("_head._row").alias("_stays"))
    gone = labels.join(heads, "_label").where("_row != _stays").select("_row")
    rest = matched(numbered, stage(gone, "near-gone"), ["_row"], "left_anti")
    return rest.select(
        F.col("_id").alias("doc_id"),
        F.col("_text").alias("text"),
        *[F.col(f"_keep_{i}").alias(name) for i, name in enumerate(keep)],
    )
