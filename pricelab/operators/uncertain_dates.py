"""Sales around events of which only a span of days is known.

An event has an earliest and a latest day, a sale a first and a last one (the same for a known
day; a month's ends where only the month is known). Each day of a span is as likely as
another, so a sale lies in the days before or after an event with a chance, a ratio of counts
of pairs of days. Counts are whole numbers; no span is written out day by day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelab.operators.overlaps import overlap_join
from pricelab.plans.staging import stage


def pairs_up_to(most: str) -> str:
    """SQL: of all pairs of an event's day and a sale's day, those where sale - event <= ``most``.

    Over columns _a, _b (event) and _c, _d (sale), numbers of days. For a sale's day s, event
    days from s - most on count: between none and all. Summed over s that is a difference of
    triangular numbers.
    """

    def triangle(n: str) -> str:
        return f"(greatest({n}, 0L) * (greatest({n}, 0L) + 1) div 2)"

    def through(n: str) -> str:
        return f"({triangle(n)} - {triangle(f'({n}) - (_b - _a + 1)')})"

    return f"({through(f'_b + ({most}) - _c + 1')} - {through(f'_b + ({most}) - _d')})"


def sales_with_chances(sales: DataFrame, events: DataFrame, days: int) -> DataFrame:
    """Sales that may lie within ``days`` before or after an event of their area.

    ``sales`` has zip_code, first_day, last_day and others; ``events`` zip_code, earliest,
    latest and others. Adds chance_before (the ``days`` days before the event's day) and
    chance_after (its day and those after it, ``days`` in all). A missing last or latest day
    is the first or earliest one. Spans without a first day, or with their days in the wrong
    order, meet nothing.
    """
    sales = sales.withColumn("last_day", F.coalesce("last_day", "first_day"))
    events = events.withColumn("latest", F.coalesce("latest", "earliest"))
    near = overlap_join(
        sales,
        events,
        ["zip_code"],
        [(F.unix_date("first_day"), F.unix_date("last_day"))],
        [(F.unix_date("earliest") - days, F.unix_date("latest") + days - 1)],
    )
    numbers = {"_a": "earliest", "_b": "latest", "_c": "first_day", "_d": "last_day"}
    for name, day in numbers.items():
        near = near.withColumn(name, F.unix_date(day).cast("long"))
    near = near.where("_a <= _b")  # the days around it may hide the wrong order
    pairs = "((_b - _a + 1) * (_d - _c + 1))"
    before = f"({pairs_up_to('-1')} - {pairs_up_to(str(-days - 1))}) / {pairs}"
    after = f"({pairs_up_to(str(days - 1))} - {pairs_up_to('-1')}) / {pairs}"
    return near.selectExpr("*", f"{before} AS chance_before", f"{after} AS chance_after").drop(*numbers)


def uncertain_impact(
    sales: DataFrame, events: DataFrame, event_columns: list[str], days: int = 90
) -> DataFrame:
    """Per event: sales that may be near, those expected before and after it, mean prices.

    Means weigh each sale by its chance, NULL without one. Events, told apart by
    ``event_columns``, keep a row each, those without sales too.

    A chance depends on both spans of days alone. So sales are summed per area and span and
    events are told apart by area and span before they meet: there are as many pairs as the
    calendar has, however many sales and events share them.
    """
    spans = stage(
        sales.where("price IS NOT NULL")
        .groupBy("zip_code", "first_day", F.coalesce("last_day", "first_day").alias("last_day"))
        .agg(F.count("*").alias("_n"), F.sum(F.col("price").cast("double")).alias("_price")),
        "sale-spans",
    )
    key = ["zip_code", "earliest", "latest"]
    told = events.select(*key, *event_columns).distinct()
    told = stage(told.withColumn("latest", F.coalesce("latest", "earliest")), "events-told")
    near = sales_with_chances(spans, told.select(*key).distinct(), days)
    sums = near.groupBy(*key).agg(
        F.sum("_n").alias("n_possible"),
        F.expr("sum(if(chance_before = 1 OR chance_after = 1, _n, 0L))").alias("n_certain"),
        *[F.expr(f"sum(chance_{w} * _n)").alias(f"expected_{w}") for w in ("before", "after")],
        *[F.expr(f"sum(chance_{w} * _price)").alias(f"_{w}") for w in ("before", "after")],
    )
    # An event that is told with its latest day and without it counts its sales for both rows.
    times = F.count("*").over(Window.partitionBy(*key, *event_columns))
    told = told.withColumn("_times", times)
    same = F.lit(True)
    for name in key:
        same = same & told[name].eqNullSafe(sums[name])
    return told.join(sums, same, "left").select(
        *[told[name] for name in [*key, *event_columns]],
        *[(F.coalesce(n, F.lit(0)) * F.col("_times")).cast("long").alias(n) for n in ("n_possible", "n_certain")],
        *[(F.coalesce(n, F.lit(0.0)) * F.col("_times")).alias(n) for n in ("expected_before", "expected_after")],
        F.try_divide("_before", "expected_before").alias("price_before"),
        F.try_divide("_after", "expected_after").alias("price_after"),
    )
