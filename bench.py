"""Time the headline queries; prints one JSON line.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``. A query's time
covers planning and a full run into a sink that drops the rows. Models shared by later queries
are stored when first needed, so a fact's first reader pays for building it.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from tallyhouse.workload import REGISTRY

HEADLINE = (
    "daily_sales_direct", "line_revenue_by_brand", "latest_line_per_part", "customer_order_gaps", "price_at_shipment",
    "kpi_active_customers", "kpi_new_repeat_customers", "upsert_orders", "dq_given_tables", "dq_duplicate_keys",
    "stg_orders", "stg_order_line_items", "stg_refunds", "stg_web_events", "web_sessions", "fx_convert_lines",
    "customer_identity", "dim_product", "fact_orders", "fact_order_lines", "fact_refunds", "fact_inventory_movements",
    "fact_customer_state_daily", "fact_inventory_snapshot", "fact_marketing_spend", "fact_web_sessions",
    "fact_email_engagement", "mart_sales", "mart_customer", "mart_inventory", "dq_fact_orders", "kpi_revenue_growth",
    "rule_reconciliation",
)


def session(cpus: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    settings = {
        "spark.driver.memory": "10g",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
