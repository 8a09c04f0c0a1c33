"""Which points lie in which hazard perimeters.

A perimeter is a ring of (x, y) vertices. Points and perimeters meet on the
cells of a grid: a perimeter is listed in every cell its bounding box touches, on
the one of several grids whose cells are about as large as that box, which keeps
it to a few cells. Points are looked up on the grids that are in use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelab.plans.staging import stage

#: Grid g has cells of this size to the power of g.
GRID_BASE = 4.0

#: Most vertices of all listed perimeters together that may be broadcast.
BROADCAST_VERTICES = 500_000


def ring_edges(ring: Column) -> Column:
    """The edges of a ring, from each vertex to the next and from the last to the first.

    Level edges are left out: no test line crosses them.
    """
    following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    edges = F.zip_with(
        ring,
        following,
        lambda a, b: F.struct(
            a["x"].alias("x0"),
            a["y"].alias("y0"),
            b["y"].alias("y1"),
            F.try_divide(b["x"] - a["x"], b["y"] - a["y"]).alias("slope"),
        ),
    )
    return F.filter(edges, lambda e: e["y0"] != e["y1"])


def inside_edges(x: Column, y: Column, edges: Column) -> Column:
    """Crossing-number test: an odd number of edges lies to the right of the point."""
    crossed = F.filter(
        edges,
        lambda e: ((e["y0"] > y) != (e["y1"] > y)) & (x < e["x0"] + (y - e["y0"]) * e["slope"]),
    )
    return F.size(crossed) % 2 == 1


def points_in_perimeters(
    points: DataFrame, perimeters: DataFrame, broadcast_vertices: int = BROADCAST_VERTICES
) -> DataFrame:
    """Points (with columns x, y) joined to the perimeters (ring, ...) they lie in."""
    numbered = stage(perimeters.withColumn("_perimeter", F.monotonically_increasing_id()), "perimeters")
    listed, grids, n_vertices = _list_in_cells(numbered.select("_perimeter", "ring"))
    if not grids:  # no perimeter: the join is empty on any grid
        grids = [0]
    if n_vertices <= broadcast_vertices:
        listed = F.broadcast(listed)
    located = points.withColumn("_grid", F.explode(F.array(*[F.lit(g) for g in grids])))
    located = located.withColumn("_cx", _cell("x")).withColumn("_cy", _cell("y"))
    near = located.join(listed, list(_CELL)).where(
        F.col("x").between(F.col("_x0"), F.col("_x1")) & F.col("y").between(F.col("_y0"), F.col("_y1"))
    )
    found = near.where(inside_edges(F.col("x"), F.col("y"), F.col("_edges")))
    # Other columns of a perimeter join by its number: they may be large.
    others = numbered.drop("ring")
    return found.drop("_edges", *_BOX, *_CELL).join(others, "_perimeter").drop("_perimeter")


_BOX = ("_x0", "_x1", "_y0", "_y1")
_CELL = ("_grid", "_cx", "_cy")


def _cell(name: str) -> Column:
    return F.floor(F.col(name) / F.pow(F.lit(GRID_BASE), F.col("_grid")))


def _list_in_cells(perimeters: DataFrame) -> tuple[DataFrame, list[int], int]:
    def along(side: str, pick) -> Column:
        return pick(F.transform("ring", lambda v: v[side]))

    boxed = (
        perimeters.where(F.size("ring") > 2)
        .withColumn("_x0", along("x", F.array_min))
        .withColumn("_x1", along("x", F.array_max))
        .withColumn("_y0", along("y", F.array_min))
        .withColumn("_y1", along("y", F.array_max))
    )
    extent = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"), F.lit(1e-9))
    boxed = boxed.withColumn("_edges", ring_edges(F.col("ring")))
    sized = boxed.withColumn("_grid", F.ceil(F.log(GRID_BASE, extent)).cast("int"))
    listed = (
        sized.drop("ring")
        .withColumn("_cx", F.explode(F.sequence(_cell("_x0"), _cell("_x1"))))
        .withColumn("_cy", F.explode(F.sequence(_cell("_y0"), _cell("_y1"))))
    )
    # At most 4 cells each, and as many grids as powers of the base fit between
    # the smallest and the largest perimeter.
    use = sized.agg(
        F.collect_set("_grid").alias("grids"), F.sum(F.size("ring")).alias("vertices")
    ).first()
    return listed, sorted(use.grids), 4 * (use.vertices or 0)
