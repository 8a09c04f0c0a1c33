"""One pass against one query per table, and one scan against three, at $BENCH_SF_DIR.

Each pair gives the same rows; the second form is how such scripts are often
written. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from pricelab import catalog  # noqa: E402
from pricelab.catalog.medians import AREA_MONTH, type_segments  # noqa: E402
from pricelab.catalog.registry import part_sales, table  # noqa: E402
from pricelab.operators.segments import segment_medians  # noqa: E402
from pricelab.plans.staging import release_staged  # noqa: E402
from pricelab.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def one_pass(spark, method: str) -> DataFrame:
    sales = part_sales(spark, SF_DIR)
    options = {"staged": True} if method == "exact" else {}
    return segment_medians(sales, type_segments(F.col("p_type")), method=method, **options)


def a_query_per_table(spark, aggregate: str) -> DataFrame:
    parts = []
    for segment, where in type_segments(F.col("p_type")).items():
        for measure in ("price", "price_sf"):
            chosen = part_sales(spark, SF_DIR).where(where)
            median = F.expr(aggregate.format(measure)).alias("price")
            parts.append(
                chosen.groupBy(*AREA_MONTH)
                .agg(median)
                .where("price IS NOT NULL")
                .select(*AREA_MONTH, F.lit(segment).alias("segment"), F.lit(measure).alias("measure"), "price")
            )
    return reduce(DataFrame.union, parts)


def three_scans(spark) -> DataFrame:
    orders = table(spark, SF_DIR, "orders")
    day, price = F.col("o_orderdate").cast("date"), F.col("o_totalprice")
    third = F.when(F.col("o_orderstatus") != "F", F.date_add(day, 800))
    parts = [
        orders.select("o_orderkey", F.trunc(d, "MM").alias("date"), p.alias("price"))
        for d, p in ((day, price), (F.date_add(day, 400), price * 0.5), (third, price * 0.25))
    ]
    return reduce(DataFrame.union, parts).where("price >= 2000 AND date IS NOT NULL")


def main() -> None:
    spark = build_session(
        "pricelab-compare",
        master=f"local[{CPUS}]",
        settings={
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    disc = "percentile_disc(0.5) WITHIN GROUP (ORDER BY {})"
    forms = {
        "segments exact, one pass": lambda: one_pass(spark, "exact"),
        "segments exact, six queries": lambda: a_query_per_table(spark, disc),
        "segments approximate, one pass": lambda: one_pass(spark, "approx"),
        "segments approximate, six queries": lambda: a_query_per_table(
            spark, "approx_percentile({}, 0.5, 100)"
        ),
        "unpivot, one scan": lambda: catalog.queries()["wide_sales_unpivot"](spark, SF_DIR),
        "unpivot, three scans": lambda: three_scans(spark),
    }
    times = {}
    for name, form in forms.items():
        best = float("inf")
        for _ in range(3):
            start = time.perf_counter()
            form().write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
        release_staged(spark)
    print(json.dumps({"sf_dir": SF_DIR, "seconds": times}))
    spark.stop()


if __name__ == "__main__":
    main()
