"""Tables laid out by place and time, so that a query for a box reads few files.

Each row has a Morton key: the bits of its cell numbers along x, y and time, taken in turn.
Rows near each other in all three have near keys. The leading bits name a tile, which is a
folder: a filter on a box lists the tiles it touches, and only their files are opened. Inside,
rows are in order of the key, so that the statistics of row groups leave out most of a
tile as well.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The folder of rows without a place or time, which no box holds.
NOWHERE = -1


@dataclass(frozen=True)
class Layout:
    """Columns x, y, day and the range of each; values outside count to the outermost cells.

    ``bits`` per direction of the key, and ``tile_bits`` of them for the tile: a table has
    at most 8^tile_bits tiles.
    """

    x: str
    y: str
    day: str
    x_range: tuple[float, float]
    y_range: tuple[float, float]
    day_range: tuple[date, date]
    bits: int = 12
    tile_bits: int = 3

    def __post_init__(self) -> None:
        if not 0 < self.tile_bits <= self.bits <= 20:
            raise ValueError("bits: from tile_bits to 20")
        if any(low >= high for low, high in (self.x_range, self.y_range, self.day_range)):
            raise ValueError("each range needs a lower and a higher end")

    def cells(self) -> list[Column]:
        """Cell numbers along x, y and day, from 0 to 2^bits - 1."""
        (x0, x1), (y0, y1) = self.x_range, self.y_range
        d0, d1 = (day.toordinal() for day in self.day_range)
        since = F.datediff(self.day, F.lit(self.day_range[0]))
        return [
            self._cell((F.col(self.x) - x0) / (x1 - x0)),
            self._cell((F.col(self.y) - y0) / (y1 - y0)),
            self._cell(since / (d1 - d0)),
        ]

    def _cell(self, share: Column) -> Column:
        last = 2**self.bits - 1
        return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(float(last)), share * 2**self.bits)))

    def key(self) -> Column:
        """The Morton key; NULL without a place or time."""
        known = [F.col(self.x), F.col(self.y), F.col(self.day)]
        bits = [
            F.shiftleft(F.shiftright(cell, b).bitwiseAND(F.lit(1).cast("long")), 3 * b + way)
            for way, cell in enumerate(self.cells())
            for b in range(self.bits)
        ]
        whole = bits[0]
        for bit in bits[1:]:
            whole = whole.bitwiseOR(bit)
        missing = known[0].isNull() | known[1].isNull() | known[2].isNull()
        return F.when(~(missing | F.isnan(self.x) | F.isnan(self.y)), whole)

    def tiles(self, box: Box) -> list[int]:
        """Tiles that a box touches."""
        ranges = [
            (box.x, self.x_range),
            (box.y, self.y_range),
            tuple(tuple(d.toordinal() for d in ends) for ends in (box.days, self.day_range)),
        ]
        places = []
        for (low, high), (least, most) in ranges:
            if low > high:
                return []
            first, last = (self._tile_of((end - least) / (most - least)) for end in (low, high))
            places.append(range(first, last + 1))
        return sorted(
            sum((place >> b & 1) << (3 * b + way) for way, place in enumerate(at) for b in range(self.tile_bits))
            for at in product(*places)
        )

    def _tile_of(self, share: float) -> int:
        cell = int(max(0.0, min(2**self.bits - 1, share * 2**self.bits)))
        return cell >> (self.bits - self.tile_bits)


@dataclass(frozen=True)
class Box:
    """Ends included."""

    x: tuple[float, float]
    y: tuple[float, float]
    days: tuple[date, date]


def write_layout(df: DataFrame, layout: Layout, path: str, files: int | None = None, mode: str = "errorifexists") -> None:
    """Write ``df`` in order of its keys, in about ``files`` ranges of equal rows.

    Rows of one cell, however many, may be split: a hash of the row follows the key.
    """
    above = 3 * (layout.bits - layout.tile_bits)
    tile = F.coalesce(F.shiftright("morton", above), F.lit(NOWHERE)).cast("int")
    keyed = (
        df.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
        .withColumn("morton", layout.key())
        .withColumn("tile", tile)
    )
    ends = ["tile", "morton", "_salt"]
    dealt = keyed.repartitionByRange(files, *ends) if files else keyed.repartitionByRange(*ends)
    dealt = dealt.sortWithinPartitions("tile", "morton").drop("_salt")
    dealt.write.partitionBy("tile").mode(mode).parquet(path)


def read_box(spark: SparkSession, path: str, layout: Layout, box: Box) -> DataFrame:
    """The rows of a laid-out table in a box, from the files of the tiles it touches."""
    inside = (
        F.col(layout.x).between(*box.x) & F.col(layout.y).between(*box.y)
        & F.col(layout.day).between(*[F.lit(d) for d in box.days])
    )
    tiles = F.col("tile").isin(layout.tiles(box))
    return spark.read.parquet(path).where(tiles & inside).drop("tile", "morton")
