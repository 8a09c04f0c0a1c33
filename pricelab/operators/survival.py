"""How many areas have not recovered after so many months.

The product-limit curve: an event that is not over when its area's last month is known counts
as long as it was watched, and then leaves without counting as recovered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelab.functions import month_start


def watched_months(recoveries: DataFrame, monthly: DataFrame) -> DataFrame:
    """Events with months (until recovery, or the area's last known month) and recovered.

    ``recoveries`` as from ``impact.recovery_months``; ``monthly`` has zip_code and date. Events
    without a baseline, or in areas not known after their month, were never watched and go.
    """
    last = monthly.groupBy("zip_code").agg(F.max(month_start(F.col("date"))).alias("_last"))
    until = F.coalesce("recovered", "_last")
    return (
        recoveries.where("baseline IS NOT NULL")
        .join(last, "zip_code")
        .withColumn("months", F.months_between(until, "event_month").cast("int"))
        .withColumn("recovered", F.col("recovered").isNotNull())
        .where("months > 0")
        .drop("_last", "n_months")
    )


def survival_curve(
    watched: DataFrame,
    groups: Sequence[str] = (),
    months: Column | str = "months",
    recovered: Column | str = "recovered",
) -> DataFrame:
    """Per group and month with a recovery or a last watch: the curve after that month.

    Returns the groups, month, n_at_risk, n_recovered, n_censored, not_recovered (the share,
    by the product-limit rule) and variance (Greenwood's, NULL once the share is 0). Who leaves
    in a month is still at risk in it. Rows without months are left out, an unknown outcome is
    none. Events are counted by group and month before they are brought together, so that a
    group has one row per month whatever its size. NULL is a group.
    """
    months = F.col(months) if isinstance(months, str) else months
    recovered = F.col(recovered) if isinstance(recovered, str) else recovered
    counts = (
        watched.select(*groups, months.alias("month"), F.coalesce(recovered, F.lit(False)).alias("_over"))
        .where("month IS NOT NULL")
        .groupBy(*groups, "month")
        .agg(
            F.count_if("_over").alias("n_recovered"),
            F.count_if(~F.col("_over")).alias("n_censored"),
        )
    )
    of_group = Window.partitionBy(*groups).orderBy("month")
    onward = of_group.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    so_far = of_group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_risk = F.sum(F.col("n_recovered") + F.col("n_censored")).over(onward)
    curve = counts.withColumn("n_at_risk", at_risk)
    stays = F.expr("(n_at_risk - n_recovered) / n_at_risk")
    spread = F.expr("try_divide(n_recovered, n_at_risk * (n_at_risk - n_recovered))")
    curve = (
        curve.withColumn("not_recovered", F.product(stays).over(so_far))
        .withColumn("_spread", F.sum(spread).over(so_far))
        .withColumn("variance", F.expr("if(not_recovered > 0, not_recovered * not_recovered * _spread, NULL)"))
    )
    return curve.select(
        *groups, "month", "n_at_risk", "n_recovered", "n_censored", "not_recovered", "variance"
    )


def median_months(curve: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Per group the first month after which at most half have not recovered; NULL if none."""
    half = F.min(F.expr("if(not_recovered <= 0.5, month, NULL)")).alias("median_months")
    return curve.groupBy(*groups).agg(half)
