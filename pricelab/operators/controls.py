"""The effect of an event against an area that had none.

Each event's area is set beside the unaffected area whose price level before the event is
nearest, and the change of the one is taken less the change of the other (difference in
differences). Levels are mean prices of whole cents, so that they do not depend on the order
of summing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelab.functions import month_start
from pricelab.operators.impact import EVENT, area_events
from pricelab.plans.staging import stage


def month_number(date: Column) -> Column:
    """Months from January 1970 to that of a date."""
    return (F.year(date) - 1970) * 12 + F.month(date) - 1


def levels_around(sales: DataFrame, events: DataFrame, months: int) -> DataFrame:
    """(zip_code, event_month, level_before, level_after, _told, _affected) of every area around.

    Of months with an event, for areas with sales or an event of their own in the window:
    ``_told`` is an event in that month, ``_affected`` one whose window reaches it. ``events``
    has a row per area and month.

    Sales are summed by area and month first. Only these sums and the events are dealt by
    area, and there listed for the months that their window reaches: the lists stay where
    they are made.
    """
    monthly = (
        sales.withColumn("_price", F.expr("try_cast(round(price * 100) AS bigint)"))
        .where("_price IS NOT NULL AND date IS NOT NULL AND zip_code IS NOT NULL")
        .groupBy("zip_code", month_start(F.col("date")).alias("date"))
        .agg(F.sum("_price").alias("_cents"), F.count("*").alias("_n"))
    )
    reached = F.sequence(F.lit(1 - months), F.lit(months))
    own = events.select("zip_code", F.col("event_month").alias("date"))
    # By number, so that parts are not merged: a row is short here, but soon listed for many months.
    parts = int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # As many as the calendar has months. Their numbers are quicker to shift than dates.
    of_events = F.broadcast(events.select(month_number(F.col("event_month")).alias("_at")).distinct())
    placed = (
        monthly.unionByName(own, allowMissingColumns=True)
        .select("zip_code", "_cents", "_n", month_number(F.col("date")).alias("_month"))
        .repartition(parts, "zip_code")
        .select("*", F.explode(reached).alias("_off"))
        .withColumn("_at", F.col("_month") + F.col("_off"))
        .join(of_events, "_at", "left_semi")
    )

    def level(where: str) -> str:
        return f"try_divide(sum(_cents) FILTER (WHERE {where}), sum(_n) FILTER (WHERE {where})) / 100"

    around = placed.groupBy("zip_code", "_at").agg(
        F.expr(level("_off > 0")).alias("level_before"),
        F.expr(level("_off <= 0")).alias("level_after"),
        F.expr("bool_or(_n IS NULL AND _off = 0)").alias("_told"),
        F.expr("bool_or(_n IS NULL)").alias("_affected"),
    )
    return around.withColumn("event_month", F.expr("add_months(DATE'1970-01-01', _at)")).drop("_at")


def event_difference(sales: DataFrame, events: DataFrame, months: int = 6) -> DataFrame:
    """Per event: levels in the ``months`` before and from it on, those of its control, effect.

    A control has sales before and after, and no event in the window of the event's months.
    Of controls equally near the lower level wins, then the smaller code. Every event of an
    area and month keeps a row; without sales or a control the rest is NULL.

    The sides meet by sorts on the level within an event's month, one upwards and one downwards,
    where the nearest control so far is carried along: no pairs are made, and no row looks at
    the rows after it, which Spark would read again for each. A month has one row per area.
    """
    told = stage(area_events(events).where("zip_code IS NOT NULL AND event_month IS NOT NULL"), "area-events")
    is_control = "NOT _affected AND level_before > 0 AND level_after IS NOT NULL"
    both = (
        levels_around(sales, told, months)
        .where(f"_told OR {is_control}")
        .repartition("event_month")  # before the rows get longer
        .withColumn("_control", F.expr("if(_told, NULL, struct(level_before, zip_code, level_after))"))
    )

    def nearest(level: Column) -> Column:
        # Of controls at a level the smallest code comes last, and then the events at it.
        of_month = Window.partitionBy("event_month").orderBy(level, "_told", F.desc("zip_code"))
        so_far = of_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.last("_control", ignorenulls=True).over(so_far)

    placed = (
        both.withColumn("_below", F.when(F.col("_told"), nearest(F.asc("level_before"))))
        .withColumn("_above", nearest(F.desc("level_before")))
        .where("_told")
    )
    nearer_above = F.expr(
        "_below IS NULL OR _above.level_before - level_before < level_before - _below.level_before"
    )
    found = placed.withColumn("_c", F.when(nearer_above, F.col("_above")).otherwise(F.col("_below")))
    found = found.withColumn("_c", F.when(F.col("level_before").isNotNull(), F.col("_c")))
    change = "try_divide(level_after - level_before, level_before)"
    of_control = "try_divide(_c.level_after - _c.level_before, _c.level_before)"
    return found.select(
        *EVENT,
        "level_before",
        "level_after",
        F.expr("_c.zip_code").alias("control"),
        F.expr("_c.level_before").alias("control_before"),
        F.expr("_c.level_after").alias("control_after"),
        F.expr(f"{change} - {of_control}").alias("effect"),
    )

