"""What an event did to the prices of an area, and how long recovery took.

Events are rows (zip_code, event_month, ...); any day of a month stands for that month, and
events of one area and month are one event. Every event keeps a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelab.functions import month_start
from pricelab.operators.medians import Measure, exact_medians

EVENT = ("zip_code", "event_month")


def area_events(events: DataFrame) -> DataFrame:
    """One row per area and month with an event."""
    month = month_start(F.col("event_month")).alias("event_month")
    return events.select("zip_code", month).distinct()


def sales_around_events(
    sales: DataFrame, events: DataFrame, months_before: int, months_after: int
) -> DataFrame:
    """Sales in the months around each event of their area.

    Every event is spread over the months of its window, so that sales meet it
    by an equality on area and month and a busy area spreads over its months.
    """
    window = F.sequence(
        F.add_months("event_month", -months_before),
        F.add_months("event_month", months_after),
        F.expr("interval 1 month"),
    )
    months = area_events(events).select(*EVENT, F.explode(window).alias("date"))
    monthly = sales.withColumn("date", month_start(F.col("date")))
    return monthly.join(months, ["zip_code", "date"])


def event_impact(sales: DataFrame, events: DataFrame, months: int = 6, **options) -> DataFrame:
    """Median price in the ``months`` before each event and from it on, and the change.

    Medians without sales are NULL.
    """
    near = sales_around_events(sales, events, months, months - 1).select(*EVENT, "date", "price")
    before = F.col("date") < F.col("event_month")
    medians = exact_medians(
        near,
        EVENT,
        [Measure("price_before", F.col("price"), before), Measure("price_after", F.col("price"), ~before)],
        **options,
    )
    change = F.try_divide(F.col("price_after") - F.col("price_before"), F.col("price_before"))
    return area_events(events).join(medians, list(EVENT), "left").withColumn("change", change)


def recovery_months(
    sales: DataFrame,
    monthly: DataFrame,
    events: DataFrame,
    baseline_months: int = 6,
    **options,
) -> DataFrame:
    """Months from each event until the area's monthly median is back at the baseline.

    The baseline is the median of the sales in the ``baseline_months`` before the
    event, NULL without any. ``monthly`` has one row per area and month, so an area's
    months, a few hundred, make one list, which each of its events looks through.
    """
    near = sales_around_events(sales, events, baseline_months, -1).select(*EVENT, "price")
    baseline = exact_medians(near, EVENT, [Measure("baseline", F.col("price"))], **options)
    months = monthly.groupBy("zip_code").agg(
        F.sort_array(
            F.collect_list(F.struct(month_start(F.col("date")).alias("date"), "price"))
        ).alias("months")
    )
    recovered = F.filter(
        "months",
        lambda m: (m["date"] > F.col("event_month")) & (m["price"] >= F.col("baseline")),
    )
    found = (
        area_events(events)
        .join(baseline, list(EVENT), "left")
        .join(months, "zip_code", "left")
        .select(*EVENT, "baseline", F.get(recovered, F.lit(0))["date"].alias("recovered"))
    )
    wait = F.months_between("recovered", "event_month").cast("int")
    return found.withColumn("n_months", wait)
