"""Document fingerprints of closed syncmers.

Of a text's runs of ``k`` characters those are kept as anchors whose least inner run of
``s`` characters, by hash, is its first or its last. Whether a run is an anchor depends on
the run alone, so equal passages have equal anchors at equal distances whatever is around
them, and every stretch of ``2k - s`` characters or so has one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelab.llm.characters import STEP, code_points, mixed, window_hashes
from pricelab.llm.inputs import chunks, for_pandas, restored, schema_of, small_batches, whole_text

K = 20
S = 5
#: Documents a bucket of the order by id has about, and the most buckets there are.
BUCKET_ROWS = 2_000
MOST_BUCKETS = 50_000


def anchors(texts: list[str], k: int = K, s: int = S) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: anchor hashes (32 bits) and their places, in order of place.

    An empty text has none. A text shorter than ``k``, or without any anchor, has one: at
    place 0, the hash of the whole text.
    """
    points, bounds = code_points(texts)
    values = mixed(points.astype(np.uint64) + STEP)
    inner = window_hashes(values, s)
    places = max(0, len(values) - k + 1)
    least = inner
    width = 1
    while width < k - s + 1:  # least of a window from two that overlap
        step = min(width, k - s + 1 - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    least = least[:places]
    closed = (inner[:places] == least) | (inner[k - s : k - s + places] == least)
    starts = np.flatnonzero(closed)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    inside = starts + k <= bounds[owner + 1]
    starts, owner = starts[inside], owner[inside]
    total = np.zeros(len(starts), np.uint64)
    for at in [*range(0, k - s, s), k - s]:
        total = mixed(total * STEP + inner[starts + at])
    hashes = (total >> np.uint64(32)).astype(np.uint32)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    found = []
    for i, text in enumerate(texts):
        own = slice(cuts[i], cuts[i + 1])
        if cuts[i] < cuts[i + 1]:
            found.append((hashes[own], starts[own] - bounds[i]))
        elif text:
            digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=4)
            found.append((np.frombuffer(digest.digest(), ">u4").astype(np.uint32), np.zeros(1, int)))
        else:
            found.append((np.zeros(0, np.uint32), np.zeros(0, int)))
    return found


def as_text(hashes: np.ndarray) -> str:
    """Eight hexadecimal digits per anchor, in order of place."""
    return hashes.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared anchors, repeats counted, over all anchors of both; 1 for two empty texts."""
    if not len(a) and not len(b):
        return 1.0
    both = np.sort(np.concatenate((a.astype(np.uint64) << np.uint64(1), (b.astype(np.uint64) << np.uint64(1)) | np.uint64(1))))
    keys = both >> np.uint64(1)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    in_b = np.add.reduceat(both & np.uint64(1), starts).astype(np.int64)
    in_a = np.diff(np.concatenate((starts, [len(keys)]))) - in_b
    return float(np.minimum(in_a, in_b).sum() / np.maximum(in_a, in_b).sum())


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = K, s: int = S
) -> DataFrame:
    """Per row of ``docs``: doc_id, hashes (array<long>), places (array<int>), in text order.

    NULL counts as empty and has no anchors; equal texts have equal ones. Repeated rows
    and NULL ids stay; columns not named are not read; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), whole_text(text_column).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in chunks(batches):
            found = anchors(batch["text"].tolist(), k, s)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "hashes": [h.astype("int64") for h, _ in found],
                    "places": [p.astype("int32") for _, p in found],
                }
            )

    safe = for_pandas(rows)
    columns = schema_of(safe, "hashes array<long>", "places array<int>", without="text")
    return restored(safe.mapInPandas(run, columns), rows)


def shared_passages(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int = K
) -> list[tuple[int, int, int]]:
    """(place in a, place in b, length) of runs of anchors that match at one offset."""
    where: dict[int, list[int]] = {}
    for h, p in zip(b[0].tolist(), b[1].tolist()):
        where.setdefault(h, []).append(p)
    found: list[tuple[int, int, int]] = []
    open_at: dict[int, tuple[int, int]] = {}
    for h, p in zip(a[0].tolist(), a[1].tolist()):
        ahead: dict[int, tuple[int, int]] = {}
        for q in where.get(h, ()):
            start, _ = open_at.pop(p - q, (p, q))
            ahead[p - q] = (start, p + k)
        found += [(start, start - offset, end - start) for offset, (start, end) in open_at.items()]
        open_at = ahead
    found += [(start, start - offset, end - start) for offset, (start, end) in open_at.items()]
    return sorted(found)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many first characters of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def with_next(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, int]:
    """Rows dealt to buckets of descending ids; each bucket ends with the next one's first.

    Columns: _id, _text, _bucket, _tail (a copy that only closes the bucket). Bucket heads
    are ids of the table, found by a sketch of the id column; the driver holds at most
    ``MOST_BUCKETS`` of them.
    """
    lowest = -(1 << 63)
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(lowest)).alias("_id"),
        whole_text(text_column).alias("_text"),
    )
    n, top = rows.agg(F.count("*"), F.max("_id")).first()
    buckets = max(1, min(MOST_BUCKETS, n // BUCKET_ROWS))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = rows.agg(F.percentile_approx("_id", shares, 10 * buckets)).first()[0] if shares else []
    heads = np.array(sorted({*(cuts or []), *([top] if n else [])}), "int64")  # ascending

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def slots(ids: pd.Series) -> pd.Series:
        values = ids.to_numpy()
        own = np.searchsorted(heads, values)  # least head that is not below the id
        last = len(heads) - 1
        closes = np.where(own == last, 0, own + 1)  # the bucket before this one in the order
        return pd.Series(
            [
                [int(b), int(-c - 1)] if is_head else [int(b)]
                for b, c, is_head in zip(own, closes, heads[np.minimum(own, last)] == values)
            ]
        )

    dealt = rows.select("_id", "_text", F.explode(slots("_id")).alias("_slot")).select(
        "_id",
        "_text",
        (F.col("_slot") < 0).alias("_tail"),
        F.when(F.col("_slot") < 0, -F.col("_slot") - 1).otherwise(F.col("_slot")).alias("_bucket"),
    )
    return dealt, lowest


def fingerprint_pairs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = K, s: int = S
) -> DataFrame:
    """Fingerprints of each text and of its edited form, and how alike they are.

    Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. "Next" goes by descending id, NULL ids last, then by text; after
    the last comes the first. Ties of id go by text; a table of one row is its own next.
    NULL texts are empty; columns not named are not read; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    dealt, lowest = with_next(docs, id_column, text_column)
    ordered = dealt.repartition("_bucket").sortWithinPartitions(
        "_bucket", "_tail", F.col("_id").desc(), "_text"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the row whose next is still to come
        for batch in chunks(batches, "_text"):
            rows = list(zip(batch["_id"], batch["_text"], batch["_bucket"], batch["_tail"]))
            own = [h for h, _ in anchors(batch["_text"].tolist(), k, s)]
            pairs = []
            for row, found in zip(rows, own):
                # Of copies that close a bucket, only the first is anyone's next.
                if held is not None and held[0][2] == row[2] and not held[0][3]:
                    pairs.append((*held, row[1], found))
                held = (row, found)
            changed = [edited(row[1], following) for row, _, following, _ in pairs]
            yield pd.DataFrame(
                [
                    (
                        row[0],
                        len(row[1]),
                        hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
                        as_text(found),
                        as_text(after),
                        likeness(found, after),
                        likeness(found, beside),
                    )
                    for (row, found, _, beside), text, (after, _) in zip(
                        pairs, changed, anchors(changed, k, s)
                    )
                ],
                columns=["_id", *names],
            )

    names = (
        "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )
    schema = (
        "_id long, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )
    doc_id = F.when(F.col("_id") != lowest, F.col("_id")).alias("doc_id")
    return ordered.mapInPandas(run, schema).select(doc_id, *names)
