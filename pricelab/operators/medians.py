"""Medians per group, approximate and exact.

``approx_medians`` keeps a sketch of bounded size per group, so one pass with
map-side merging is safe whatever the group sizes are.

``exact_medians`` returns the lower median, the value at rank ``ceil(n / 2)``.
An exact median needs all values of a group, so groups are told apart by size:

* Groups of at most ``hot_rows`` rows: one shuffle on the group key, then one
  sorted array per group and measure, whose length the group size bounds.
* Larger groups ("hot"): their rows are never brought together. A quantile sketch per
  group, merged map-side, gives two values between which the wanted rank must lie; one
  more pass counts the rows below and, per value, those between, which are few. Whether
  the rank lies between is checked; if it does not, the same is done on that side. The
  number of passes depends neither on how values are spread nor on how many measures of a
  type there are, and ranks are exact. Long integers have a sketch of their own, as
  doubles cannot tell wide ones apart; decimals of more than 15 digits go through doubles.

Values keep their type. NULL is no value; NaN is one, above all others, unless the
measure leaves it out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelab.plans.staging import stage

#: Largest group whose values may meet in one task.
HOT_ROWS = 100_000

#: Most hot keys, or value ranges of hot groups, that may be broadcast.
BROADCAST_ROWS = 10_000

#: Accuracy of the sketch: ranks it gives are off by at most one in so many.
SKETCH_ACCURACY = 10_000

#: Size of the sketch of long integers, and what its ranks are hardly ever off by.
LONG_SKETCH_SIZE = 8_192
LONG_SKETCH_ERROR = 0.0008


@dataclass(frozen=True)
class Measure:
    """A value to take the median of, over the rows where ``where`` holds."""

    name: str
    value: Column
    where: Column | None = None
    #: Treat NaN like NULL. Only for floating point values.
    without_nan: bool = False

    def column(self) -> Column:
        """The value in its own type; NULL where the row does not count."""
        value = F.nanvl(self.value, F.lit(None)) if self.without_nan else self.value
        return value if self.where is None else F.when(self.where, value)


def approx_medians(
    rows: DataFrame, keys: Sequence[str], measures: Sequence[Measure], accuracy: int = 100
) -> DataFrame:
    """One row per group: keys and one approximate median per measure."""
    medians = [F.approx_percentile(m.column(), 0.5, accuracy).alias(m.name) for m in measures]
    return rows.groupBy(*keys).agg(*medians)


def exact_medians(
    rows: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Measure],
    *,
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    staged: bool = False,
) -> DataFrame:
    """One row per group: keys and one exact median per measure.

    Jobs run while the frame is built: the rows are read once to count the groups, the
    rows of hot groups are written and read again, and the others are read when the result
    is, so they must not change from one reading to the next.
    With ``staged`` they are written to shared storage first; worth it where
    they come from a join or from parsing. They should then have no columns but
    those in use.
    """
    if staged:
        rows = stage(rows, "rows")
    keys = list(keys)
    columns = [m.column().alias(f"_v_{i}") for i, m in enumerate(measures)]
    names = [m.name for m in measures]

    def valued(df: DataFrame) -> DataFrame:
        """Keys, and one value column per measure."""
        return df.select(*keys, *columns)

    sizes = rows.groupBy(*keys).agg(F.expr("count(*) AS _rows"))
    hot = sizes.where(f"_rows > {hot_rows}").drop("_rows")
    known = hot.limit(broadcast_rows + 1).collect()
    # Values differ from row to row, so combining before the shuffle would only
    # add work: the bare columns are shuffled, then aggregated in place.
    if not known:
        return _small_group_medians(valued(rows.repartition(*keys)), keys, names)
    if len(known) <= broadcast_rows:
        schema = T.StructType([T.StructField("_g", T.LongType()), *hot.schema.fields])
        numbered = [(g, *row) for g, row in enumerate(known)]
        hot = F.broadcast(rows.sparkSession.createDataFrame(numbered, schema))
    else:
        hot = stage(hot.withColumn("_g", F.monotonically_increasing_id()), "hot-groups")
    others = _match(rows, hot.select(*keys), keys, "left_anti")
    small = _small_group_medians(valued(others.repartition(*keys)), keys, names)
    hot_values = stage(_match(valued(rows), hot, keys, "inner").drop(*keys), "hot-values")
    large = hot.select("_g", *keys)
    for kind in sorted({hot_values.schema[f"_v_{i}"].dataType.simpleString() for i in range(len(names))}):
        places = [i for i in range(len(names)) if hot_values.schema[f"_v_{i}"].dataType.simpleString() == kind]
        entries = ", ".join(f"struct({i} AS _m, _v_{i} AS _v)" for i in places)
        values = hot_values.select("_g", F.expr(f"inline(array({entries}))"))
        found = stage(_hot_medians(values, broadcast_rows), "hot-medians")
        for i in places:
            of_measure = found.where(f"_m = {i}").select("_g", F.col("_v").alias(names[i]))
            large = large.join(of_measure, "_g", "left")
    large = large.select("_g", *keys, *names)
    return small.unionByName(large.drop("_g"))


def series(medians: DataFrame, keys: Sequence[str], labels: dict[str, dict[str, str]]) -> DataFrame:
    """Wide medians to one row per group and measure, without the NULL medians.

    ``labels`` gives, per measure column, the label columns of its rows.
    """
    entries = [
        "struct("
        + "".join(f"{_text(text)} AS {_name(label)}, " for label, text in labels[measure].items())
        + f"cast({_name(measure)} AS double) AS price)"
        for measure in labels
    ]
    rows = medians.select(*keys, F.expr(f"inline(array({', '.join(entries)}))"))
    return rows.where("price IS NOT NULL")


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _small_group_medians(values: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    places = range(len(names))
    lists = [F.expr(f"sort_array(collect_list(_v_{i})) AS _v_{i}") for i in places]
    middles = [
        F.expr(f"get(_v_{i}, cast((size(_v_{i}) - 1) div 2 AS int)) AS {_name(names[i])}")
        for i in places
    ]
    return values.groupBy(*keys).agg(*lists).select(*keys, *middles)


def _ends(kind: T.DataType) -> tuple[str, str, str]:
    """SQL: sketch of _v, the values around its middle, and one of those in the type of _v.

    An end at infinity, or outside the type, leaves that side open.
    """
    if isinstance(kind, T.LongType):
        shares = f"array({0.5 - LONG_SKETCH_ERROR}D, {0.5 + LONG_SKETCH_ERROR}D)"
        sketch = f"kll_sketch_agg_bigint(_v, {LONG_SKETCH_SIZE})"
        return sketch, f"kll_sketch_get_quantile_bigint(_sketch, {shares})", "{end}"
    number = "cast(_v AS double)"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        number = f"if(isnan(_v), double('Infinity'), {number})"  # the sketch cannot order NaN
    slack = 2.0 / SKETCH_ACCURACY
    sketch = f"approx_percentile({number}, array({0.5 - slack}, {0.5 + slack}), {SKETCH_ACCURACY})"
    return sketch, "_sketch", f"if(abs({{end}}) < 'Infinity', try_cast({{end}} AS {kind.simpleString()}), NULL)"


def _hot_medians(values: DataFrame, broadcast_rows: int) -> DataFrame:
    """(_g, _m, _v) to the median _v of each group and measure, in two passes unless a sketch was off."""
    values = values.where("_v IS NOT NULL")
    sketch, ends, end = _ends(values.schema["_v"].dataType)
    counted = values.groupBy("_g", "_m").agg(
        F.expr("(count(*) + 1) div 2 AS _rank"), F.expr(f"{sketch} AS _sketch")
    )
    ranges = counted.selectExpr("_g", "_m", "_rank", f"{ends} AS _ends").selectExpr(
        "_g",
        "_m",
        "_rank",
        f"{end.format(end='_ends[0]')} AS _lo",
        f"{end.format(end='_ends[1]')} AS _hi",
    )
    medians = None
    while True:
        ranges = stage(ranges, "hot-ranges")
        n_ranges = ranges.count()
        if not n_ranges and medians is not None:
            return medians
        counts = (
            values.join(small_side(ranges, n_ranges, broadcast_rows), ["_g", "_m"])
            .select("_g", "_m", "_rank", "_lo", "_hi", "_v", F.expr("coalesce(_v < _lo, false) AS _below"))
            .where("_below OR _hi IS NULL OR _v <= _hi")
            .select("_g", "_m", "_rank", "_lo", "_hi", "_below", F.expr("if(_below, NULL, _v) AS _v"))
            .groupBy("_g", "_m", "_rank", "_lo", "_hi", "_below", "_v")
            .agg(F.expr("count(*) AS _n"))
        )
        through = "sum(_n) OVER (PARTITION BY _g, _m ORDER BY _below DESC, _v) AS _through"
        whole = "sum(_n) OVER (PARTITION BY _g, _m) AS _seen"
        placed = stage(counts.selectExpr("*", through, whole), "hot-counts")
        at_rank = placed.where("_through >= _rank AND _through - _n < _rank AND NOT _below")
        found = at_rank.select("_g", "_m", "_v")
        medians = found if medians is None else medians.unionByName(found)
        # The rank lies below the range, or above: open that side.
        ranges = (
            placed.groupBy("_g", "_m", "_rank", "_lo", "_hi")
            .agg(
                F.expr("sum(if(_below, _n, 0)) AS _n_below"), F.expr("max(_seen) AS _through")
            )
            .where("_rank <= _n_below OR _rank > _through")
            .selectExpr(
                "_g",
                "_m",
                "_rank",
                "if(_rank <= _n_below, NULL, _hi) AS _lo",
                "if(_rank <= _n_below, _lo, NULL) AS _hi",
            )
        )


def small_side(df: DataFrame, n_rows: int, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows allow one."""
    return F.broadcast(df) if n_rows <= broadcast_rows else df


def _match(rows: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys that may be NULL, keeping one copy of them."""
    renamed = other.select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
        *[c for c in other.columns if c not in keys],
    )
    same = " AND ".join(f"{_name(k)} <=> _key_{i}" for i, k in enumerate(keys))
    return rows.join(renamed, F.expr(same), how).drop(*[f"_key_{i}" for i in range(len(keys))])
