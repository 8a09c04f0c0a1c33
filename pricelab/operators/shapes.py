"""How much of an area lies in a perimeter, and which perimeter is nearest to a place.

Rings are arrays of (x, y) vertices; the last leads back to the first. Rings, edges
and places meet by ``overlap_join`` on their boxes; common areas are cut out of many pairs
of rings at once in numpy, all other geometry is in array expressions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelab.operators.overlaps import overlap_join
from pricelab.operators.perimeters import points_in_perimeters
from pricelab.plans.staging import stage

RING = "array<struct<x: double, y: double>>"

#: The finest cell on which shapes meet, in the units of their coordinates.
FINEST = 1e-6

#: Coordinates that are worked on at once when rings are clipped.
CELLS = 1 << 20

#: Times that a search for the nearest perimeter doubles its reach, up to the distance asked for.
DOUBLINGS = 4


def turned(ring: str) -> str:
    """SQL: the ring from its second vertex on."""
    return f"concat(slice({ring}, 2, size({ring})), slice({ring}, 1, 1))"


def signed_area(ring: str) -> str:
    """SQL: the area of a ring, negative if it runs clockwise."""
    # From the first vertex, so that places far from the origin lose no digits.
    x, y = f"{ring}[0].x", f"{ring}[0].y"
    cross = f"(a.x - {x}) * (b.y - {y}) - (b.x - {x}) * (a.y - {y})"
    crosses = f"zip_with({ring}, {turned(ring)}, (a, b) -> {cross})"
    return f"(if(size({ring}) = 0, 0D, aggregate({crosses}, 0D, (s, c) -> s + c) / 2))"


def ring_vertices(rings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x and y, a row per ring, filled up by its first vertex, which adds no area; and sizes."""
    flat = rings.flatten()
    sizes = pc.list_value_length(rings).to_numpy(zero_copy_only=False).astype("int64")
    starts = np.cumsum(sizes) - sizes
    at = np.arange(sizes.max())
    at = starts[:, None] + np.where(at < sizes[:, None], at, 0)
    x, y = (flat.field(way).to_numpy(zero_copy_only=False) for way in ("x", "y"))
    return x[at], y[at], sizes


def clipped(x: np.ndarray, y: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rings (a row each) without what is to the right of ``edge`` (ax, ay, bx, by, a row each).

    Every vertex gives two places: itself if it stays, and where the way on to the next
    crosses the edge. Places without use repeat a neighbour. Where a ring falls into pieces
    they stay linked by edges of no width, which add nothing to the area.
    """
    ax, ay, bx, by = (edge[:, i, None] for i in range(4))
    side = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
    following = np.roll(side, -1, axis=1)
    stays, crosses = side >= 0, (side >= 0) != (following >= 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(crosses, side / (side - following), 0.0)
    both, used = [], np.stack([stays, crosses], axis=2).reshape(len(x), -1)
    for way in (x, y):
        met = way + (np.roll(way, -1, axis=1) - way) * share
        both.append(np.stack([way, met], axis=2).reshape(len(x), -1))
    # Used places first, in order; behind them the first one again.
    n = used.sum(axis=1)
    order = np.argsort(~used, axis=1, kind="stable")[:, : max(1, int(n.max(initial=0)))]
    order = np.where(np.arange(order.shape[1]) < n[:, None], order, order[:, :1])
    x, y = (np.take_along_axis(way, order, axis=1) for way in both)
    return np.where(n[:, None] > 0, x, 0.0), np.where(n[:, None] > 0, y, 0.0)


def common_areas(areas: pa.Array, by: pa.Array) -> np.ndarray:
    """The area of each ring of ``areas`` inside the convex, counterclockwise one beside it."""
    out = np.zeros(len(areas))
    sizes = pc.list_value_length(by).to_numpy(zero_copy_only=False)
    # Pairs with as many edges to cut by go together, some cells at once.
    for n_edges in np.unique(sizes):
        alike = np.flatnonzero(sizes == n_edges)
        widest = int(pc.max(pc.list_value_length(areas.take(pa.array(alike)))).as_py()) + int(n_edges)
        step = max(1, CELLS // widest)
        for at in range(0, len(alike), step):
            rows = alike[at : at + step]
            x, y, _ = ring_vertices(areas.take(pa.array(rows)))
            cx, cy, _ = ring_vertices(by.take(pa.array(rows)))
            for i in range(int(n_edges)):
                j = (i + 1) % int(n_edges)
                x, y = clipped(x, y, np.stack([cx[:, i], cy[:, i], cx[:, j], cy[:, j]], axis=1))
            # From the first vertex, so that places far from the origin lose no digits.
            x, y = x - x[:, :1], y - y[:, :1]
            crosses = x * np.roll(y, -1, axis=1) - np.roll(x, -1, axis=1) * y
            out[rows] = np.abs(crosses.sum(axis=1)) / 2
    return out


def covered_area(ring: str, by: str) -> Column:
    """The area of ``ring`` inside ``by``, of many pairs at once, each clipped once."""

    @F.arrow_udf("double")
    def area(rings: pa.Array, others: pa.Array) -> pa.Array:
        return pa.array(common_areas(rings, others))

    # As if by chance, so that a filter on the area does not compute it a second time.
    return area.asNondeterministic()(F.col(ring), F.col(by))


def with_box(df: DataFrame, ring: str, side: str) -> DataFrame:
    for way in ("x", "y"):
        along = F.expr(f"transform({ring}, v -> v.{way})")
        df = df.withColumn(f"{side}{way}0", F.array_min(along)).withColumn(f"{side}{way}1", F.array_max(along))
    return df


def box(side: str) -> list[tuple[Column, Column]]:
    return [(F.col(f"{side}{way}0"), F.col(f"{side}{way}1")) for way in ("x", "y")]


def area_overlaps(areas: DataFrame, perimeters: DataFrame) -> DataFrame:
    """Areas with the perimeters that cover a part of them, and which ``share`` of the area.

    ``areas`` has area_ring and others, ``perimeters`` has ring and others, under other names.
    A perimeter has to be convex; an area may be any ring that does not cross itself. Either
    may run both ways round. Rings of less than three vertices, without area or with an
    unknown coordinate cover nothing and are covered by nothing; touching is no overlap.
    """
    unknown = "size(ring) < 3 OR exists(ring, v -> v IS NULL OR isnull(v.x) OR isnull(v.y))"
    left = areas.withColumn("_area", F.col("area_ring").cast(RING))
    left = left.where(f"NOT ({unknown.replace('ring', '_area')})")
    left = left.withColumn("_whole", F.expr(f"abs({signed_area('_area')})")).where("_whole > 0")
    right = perimeters.withColumn("_by", F.col("ring").cast(RING))
    right = right.where(f"NOT ({unknown.replace('ring', '_by')})")
    right = right.withColumn("_turn", F.expr(signed_area("_by"))).where("_turn != 0")
    right = right.withColumn("_by", F.expr("if(_turn < 0, reverse(_by), _by)")).drop("_turn")
    left, right = with_box(left, "_area", "_l"), with_box(right, "_by", "_r")
    # Boxes that only touch have no area in common.
    met = overlap_join(left, right, [], box("_l"), box("_r"), FINEST).where(
        "_lx0 < _rx1 AND _rx0 < _lx1 AND _ly0 < _ry1 AND _ry0 < _ly1"
    )
    found = met.withColumn("share", covered_area("_area", "_by") / F.col("_whole"))
    boxes = [f"{side}{way}{end}" for side in ("_l", "_r") for way in ("x", "y") for end in (0, 1)]
    return found.where("share > 0").drop("_area", "_whole", "_by", *boxes)


def edge_rows(perimeters: DataFrame, perimeter: str) -> DataFrame:
    """(``perimeter``, ax, ay, bx, by) of every edge with known ends."""
    ring = perimeters.select(perimeter, F.col("ring").cast(RING).alias("_ring")).where("size(_ring) > 0")
    edges = f"""
        zip_with(_ring, {turned('_ring')}, (a, b) ->
            struct(a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by))
    """
    return ring.select(perimeter, F.expr(f"inline({edges})")).dropna()


def distance_to_edge() -> str:
    """SQL: from (x, y) to the edge (ax, ay, bx, by), which may be a single place."""
    long = "((bx - ax) * (bx - ax) + (by - ay) * (by - ay))"
    along = "((x - ax) * (bx - ax) + (y - ay) * (by - ay))"
    share = f"coalesce(greatest(0D, least(1D, try_divide({along}, {long}))), 0D)"
    dx, dy = f"(ax + {share} * (bx - ax) - x)", f"(ay + {share} * (by - ay) - y)"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def nearest_perimeters(
    points: DataFrame,
    perimeters: DataFrame,
    point: str,
    perimeter: str,
    distance: float,
    doublings: int = DOUBLINGS,
) -> DataFrame:
    """(``point``, ``perimeter``, distance): of each point the nearest perimeter, at most ``distance`` away.

    ``points`` has x, y and the id ``point``; ``perimeters`` has ring and the id ``perimeter``.
    Inside a perimeter the distance is 0. Of equally near ones the smallest id wins. Points
    with none so near, or without coordinates, have no row; a ring of one or two vertices is a
    place or a line. Rows that repeat a point's id are one point if their places are the same.

    The search reaches ``distance`` / 2^``doublings`` at first and twice as far in each round.
    All edges whose box comes within reach are seen, so that a perimeter found within reach is
    nearest and the point is done; the others go on. So in crowded places few edges are
    measured, and the rounds are bounded whatever the data.
    """
    places = stage(
        points.select(point, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
        .where(f"`{point}` IS NOT NULL")
        .distinct(),
        "places",
    )
    known = perimeters.where(f"`{perimeter}` IS NOT NULL").select(
        perimeter, F.col("ring").cast(RING).alias("ring")
    )
    known = known.where("NOT exists(ring, v -> v IS NULL OR isnull(v.x) OR isnull(v.y))")
    edges = stage(edge_rows(known, perimeter), "edges")
    best = F.min(F.expr(f"struct(_d, `{perimeter}` AS _p)")).alias("_best")
    key = [point, "x", "y"]
    inside = points_in_perimeters(places, known).withColumn("_d", F.lit(0.0))
    done = stage(inside.groupBy(*key).agg(best), "inside")
    found = done
    left = places.join(done, key, "left_anti")
    for halvings in range(doublings, -1, -1):
        reach = distance / 2**halvings
        left = stage(left, "places-left")
        near = overlap_join(
            left,
            edges,
            [],
            [(F.col(way) - reach, F.col(way) + reach) for way in ("x", "y")],
            [(F.least(f"a{way}", f"b{way}"), F.greatest(f"a{way}", f"b{way}")) for way in ("x", "y")],
            FINEST,
        ).withColumn("_d", F.expr(distance_to_edge()))
        done = stage(near.where(F.col("_d") <= reach).groupBy(*key).agg(best), "places-done")
        found = found.unionByName(done)
        left = left.join(done, key, "left_anti")
    return found.select(point, F.col("_best._p").alias(perimeter), F.col("_best._d").alias("distance"))
