"""Joins of things that overlap: spans of time, boxes on a map.

Both sides have a span (low, high), ends included, along one or more directions. Every row
has a level: the power of ``BASE`` that its longest span fits in. On the grid of that level it
touches two cells at most in each direction. Rows of unlike sizes meet on the grid of the
larger one's level: the smaller lists itself there too, for each level that the other side has
in use. So a long span is listed in a few coarse cells, never in every day or small cell it
covers, and there are no cross joins.

A pair that shares several cells is taken from one of them, the cell of the larger of both
low ends, and the overlap itself is checked on exact values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Grid g has cells of this size to the power of g.
BASE = 4.0

Spans = Sequence[tuple[Column, Column]]


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_spans: Spans,
    right_spans: Spans,
    least: float = 1.0,
) -> DataFrame:
    """Rows of both sides with equal ``keys`` whose spans overlap in every direction.

    Spans are numbers; ``least`` is the finest cell worth having. A span without an end (NULL,
    NaN, infinite) or with its ends in the wrong order overlaps nothing. NULL keys match
    nothing. Columns other than the keys must have different names on both sides. Each side is
    read once more beforehand, to see which levels it uses, so stage what is dear to compute.
    """
    if len(left_spans) != len(right_spans):
        raise ValueError("both sides need a span for each direction")
    both = set(left.columns) & set(right.columns) - set(keys)
    if both:
        raise ValueError(f"columns on both sides: {', '.join(sorted(both))}")
    ways = range(len(left_spans))
    left = _sized(left, "_l", left_spans, least)
    right = _sized(right, "_r", right_spans, least)
    of_left, of_right = _levels(left, "_l"), _levels(right, "_r")
    listed = _listed(
        left,
        "_l",
        ways,
        # Up to larger rows of the other side and to those of its level; down to smaller ones.
        up=f"filter({_array(of_right)}, g -> g >= _l_level)",
        down=f"if(_l_level > {min(of_right, default=0)}, array(_l_level), {_array([])})",
    )
    met = listed.join(
        _listed(
            right,
            "_r",
            ways,
            up="array(_r_level)",
            down=f"filter({_array(of_left)}, g -> g > _r_level)",
        ),
        [*keys, "_up", "_level", *[f"_cell{w}" for w in ways]],
    )
    for w in ways:
        met = met.where(f"_l_low{w} <= _r_high{w} AND _r_low{w} <= _l_high{w}")
        met = met.where(f"_cell{w} = {_cell(f'greatest(_l_low{w}, _r_low{w})')}")
    ends = [f"{side}_{end}{w}" for side in ("_l", "_r") for end in ("low", "high") for w in ways]
    return met.drop("_up", "_level", "_l_level", "_r_level", *ends, *[f"_cell{w}" for w in ways])


def _array(levels: Sequence[int]) -> str:
    return f"cast(array({', '.join(map(str, levels))}) AS array<int>)"


def _cell(value: str) -> str:
    return f"floor({value} / pow({BASE}, _level))"


def _sized(df: DataFrame, side: str, spans: Spans, least: float) -> DataFrame:
    """The rows with proper spans, their ends in doubles and their level."""
    for w, (low, high) in enumerate(spans):
        df = df.withColumn(f"{side}_low{w}", low.cast("double"))
        df = df.withColumn(f"{side}_high{w}", high.cast("double"))
        # NaN is above infinity.
        df = df.where(f"{side}_low{w} > double('-Infinity') AND {side}_low{w} <= {side}_high{w}")
        df = df.where(f"{side}_high{w} < double('Infinity')")
    longest = ", ".join(f"{side}_high{w} - {side}_low{w}" for w in range(len(spans)))
    level = f"cast(ceil(log({BASE}, greatest({longest}, double({least})))) AS int)"
    return df.withColumn(f"{side}_level", F.expr(level))


def _levels(df: DataFrame, side: str) -> list[int]:
    """Levels in use: as many at most as powers of the base fit between two doubles."""
    return sorted(df.agg(F.collect_set(f"{side}_level")).first()[0])


def _listed(df: DataFrame, side: str, ways: range, up: str, down: str) -> DataFrame:
    places = f"""
        concat(transform({up}, g -> struct(true AS _up, g AS _level)),
               transform({down}, g -> struct(false AS _up, g AS _level)))
    """
    df = df.select("*", F.expr(f"inline({places})"))
    for w in ways:
        cells = f"sequence({_cell(f'{side}_low{w}')}, {_cell(f'{side}_high{w}')})"
        df = df.select("*", F.expr(f"explode({cells})").alias(f"_cell{w}"))
    return df
