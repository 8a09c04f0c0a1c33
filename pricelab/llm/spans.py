"""Spans as text, and their digest."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def of_kind(at: int) -> Callable[[Column], Column]:
    """Whether a span is of the kind at this place. One parameter: a second would be the index."""
    return lambda span: span["kind"] == at


def joined(spans: Column, kinds: Sequence[str]) -> Column:
    """``kind:start:end`` of (start, kind, end), comma-joined in the given order."""
    names = F.array(*[F.lit(kind) for kind in kinds])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


def digests(found: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """doc_id, number of base spans per kind, digest of these, and all spans as text."""
    every = F.array_sort(F.concat("base", "added"))
    return found.select(
        "doc_id",
        *[
            F.size(F.filter("base", of_kind(at))).cast("long").alias(f"n_{kind}")
            for at, kind in enumerate(kinds)
        ],
        F.sha2(joined(F.col("base"), kinds), 256).alias("base_sha256"),
        joined(every, kinds).alias("spans"),
    )
