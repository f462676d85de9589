"""Time the headline queries; prints one JSON line.

Shared models are built and written once, each timed by itself (`build_*`),
as a nightly build would; the queries then read them.  A query is run once to
warm up and then three times into the `noop` sink; its time is the median.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from leasewise.plans.bindings import TestWarehouse
from leasewise.plans.catalog import CATALOG

SHARED = ("idmap", "lines", "membership_orders", "orders", "ledger", "special", "rentals", "items", "order_baskets",
          "rental_baskets", "members", "sessioned", "web", "kpis", "member_agg")
HEADLINE = ("sessionize_30m", "sessionize_6h", "attribution_multi_touch", "attribution_by_channel", "json_unnest", "payment_agg",
            "repeat_lines", "daily_revenue", "daily_revenue_totals", "depreciation", "sku_agg", "cohort_month", "kpi_unpivot",
            "channel_daily", "upsert", "topn_latest", "order_sequence", "revenue_rank")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false").config("spark.log.level", "ERROR")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    times: dict[str, float] = {}
    warehouse = TestWarehouse(spark, sf_dir)
    warehouse.table("lineitem").agg({"l_quantity": "sum"}).collect()  # start the executors
    for name in SHARED:
        start = time.perf_counter()
        getattr(warehouse, name)
        times[f"build_{name}"] = round(time.perf_counter() - start, 3)

    def once(name: str) -> float:
        start = time.perf_counter()
        CATALOG[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in HEADLINE:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(3)), 3)
    print(json.dumps({"metric": "headline queries, total seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
