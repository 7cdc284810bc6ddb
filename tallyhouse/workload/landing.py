"""Queries for landing files, customer links and movements by refund line."""

from __future__ import annotations

import uuid
from dataclasses import fields, replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.stored import shared_folder
from tallyhouse.params import EARLIER_READINGS, Params
from tallyhouse.plans import facts
from tallyhouse.plans.warehouse import MODELS, Inputs, Movements, Warehouse, shared_saver
from tallyhouse.sources.csv import land, load_all, scan_csv, scan_csv_inferred, scan_csv_positional, with_sync_columns
from tallyhouse.sources.registry import RawTable
from tallyhouse.streaming.late_upsert import drain_folder
from tallyhouse.workload.raw import PARAMS
from tallyhouse.workload.registry import Lab, register


def _schema(w: Lab, ddl: str):
    return w.spark.createDataFrame([], ddl).schema


def _files(w: Lab) -> str:
    """The suppliers as CSV files whose headers name the columns in two orders."""
    path = f"{shared_folder(w.spark).rstrip('/')}/landing/{uuid.uuid4().hex}"
    rows = w.table("supplier").select("s_suppkey", "s_name", "s_acctbal")
    half = F.col("s_suppkey") % 2 == 0
    rows.filter(half).write.option("header", True).csv(f"{path}/a")
    rows.filter(~half).select("s_acctbal", "s_suppkey", "s_name").write.option("header", True).csv(f"{path}/b")
    return path


SUPPLIER = "s_suppkey bigint, s_name string, s_acctbal double"
LAYOUT = "s_suppkey l, s_name s, s_acctbal d"


register("landed_by_name", "SRC-1 SRC-3", LAYOUT, lambda w: scan_csv(w.spark, f"{_files(w)}/*", _schema(w, SUPPLIER)), "supplier")


def _positional(w: Lab) -> DataFrame:
    """Both layouts by position, under other names and with trimmed values."""
    path = _files(w)
    one = scan_csv_positional(w.spark, f"{path}/a", _schema(w, "number bigint, label string, balance double"))
    return one.unionByName(scan_csv_positional(w.spark, f"{path}/b", _schema(w, "balance double, number bigint, label string")))


register("landed_by_position", "SRC-2", "number l=s_suppkey, label s=s_name, balance d=s_acctbal", _positional, "supplier")


def _inferred(w: Lab) -> DataFrame:
    path = f"{shared_folder(w.spark).rstrip('/')}/landing/{uuid.uuid4().hex}"
    stamped = w.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("ordered_at"), "o_totalprice")
    stamped.write.option("header", True).csv(path)
    return scan_csv_inferred(w.spark, path)


register("landed_inferred", "SRC-4", "o_orderkey l, ordered_at t=o_orderdate::date::timestamp, o_totalprice d", _inferred, "orders")


def _appended(w: Lab) -> DataFrame:
    """Replace, then append: the table holds the second load twice."""
    name, rows = f"landed_{uuid.uuid4().hex}", w.table("supplier").select("s_suppkey", "s_name", "s_acctbal")
    land(rows.limit(1), name)
    land(rows, name)
    land(rows, name, "append")
    return w.spark.table(name).groupBy("s_suppkey").agg(F.count("*").alias("copies"), F.min("s_acctbal").alias("s_acctbal"))


register("landed_twice", "SRC-7", "s_suppkey l, copies l=2, s_acctbal d", _appended, "supplier")


def _reported(w: Lab) -> DataFrame:
    """One good file set and one table whose files do not exist: the first lands, the second is reported."""
    database = f"landing_{uuid.uuid4().hex}"
    w.spark.sql(f"create database {database}")
    schema = _schema(w, SUPPLIER)
    tables = {n: RawTable(n, schema, "_synced_at", 24, 48, False) for n in ("erp.suppliers", "erp.missing")}
    report = load_all(w.spark, {"erp.suppliers": f"{_files(w)}/*", "erp.missing": "/no/such/file"}, tables, database, datetime(2026, 1, 1))
    landed = w.spark.table(f"{database}.erp__suppliers")
    return landed.withColumns({"failed": F.lit(",".join(sorted(report.errors))), "synced": F.col("_synced_at")})


register("landed_report", "SRC-9 SRC-8", LAYOUT + ", failed s='erp.missing', synced t=timestamp '2026-01-01'", _reported, "supplier")
register("landed_sync_columns", "SRC-8", LAYOUT + ", _deleted b=false", lambda w: with_sync_columns(w.table("supplier"), datetime(2026, 1, 1)), "supplier")

register(
    "customer_links", "INT-1", "source_system s=src, source_id s=sid, customer_id s=cid, tier l",
    lambda w: MODELS["int_customer_links"](w.warehouse()), "o_links",
)


def _linked_orders(w: Lab) -> DataFrame:
    """The order fact with customers found through all merged storefront ids."""
    house = w.warehouse()
    return facts.fact_orders(
        w["int_orders_enriched"], w["stg_shopify__refunds"], w["stg_stripe__charges"], dim_customer=w["dim_customer"],
        dim_channel=w["dim_channel"], dim_geography=w["dim_geography"], dim_payment_method=w["dim_payment_method"],
        fx_rates=house.seeds["fx_rates"], channel_mapping=house.seeds["channel_mapping"], params=PARAMS, links=MODELS["int_customer_links"](house),
    )


register(
    "fact_orders_linked", "INT-1 FCT-1 JN-3", "order_id s, customer_id s, customer_sk s", _linked_orders,
    """select o.order_id, c.customer_id, c.customer_sk from o_orders o left join o_links l on l.src = 'shopify' and l.sid = o.shopify_customer_id
       left join o_dim_customer c on c.customer_id = l.cid and o.order_timestamp >= c.valid_from""",
)
register(
    "movements_by_refund_line", "FCT-9 JN-2",
    "movement_id s, product_sk s, sku s, movement_date D=day, movement_type s=kind, quantity_change d=change, reference_order_id s=order_id",
    lambda w: Movements(w.warehouse()).fact(replace(PARAMS, sale_quantity="gross", return_units="refund_line")),
    """select 'sale_' || l.line_item_id as movement_id, l.product_sk, l.sku, o.order_date as day, 'sale' as kind, -l.quantity as change, l.order_id
       from o_fact_lines l join o_fact_orders o using (order_id) where o.order_status <> 'cancelled' and l.quantity <> 0
       union all
       select 'return_' || r.refund_id || '_' || l.line_item_id, l.product_sk, l.sku, r.refund_date, 'return', r.units, l.order_id
       from (select order_id, refund_id, line_item_id, refund_date, sum(units) as units from o_fact_refunds where has_lines group by all) r
       join o_fact_lines l using (order_id, line_item_id)""",
)


def _default_house(w: Lab) -> Warehouse:
    """The warehouse under the library's default readings, on the same sources and product history."""
    params = replace(PARAMS, **{f.name: f.default for f in fields(Params) if f.name in EARLIER_READINGS})
    house = Warehouse(w.spark, w.raw, w.seeds(), params, save=shared_saver())
    house.history = w.warehouse().history
    return house


# Staging takes an id of 0 for none, so lines of part 0 have no variant to be found by.
_BY_VARIANT = "if(sku = 'SKU-0'; null; product_sk)"
_SALES_NET = "select movement_id, product_sk, sku, day, kind, change, order_id from o_movements where kind = 'sale'"
_RETURNS = """select 'return_' || r.refund_id || '_' || l.line_item_id, l.product_sk, l.sku, r.refund_date, 'return', r.units, l.order_id
       from (select order_id, refund_id, line_item_id, refund_date, sum(units) as units from o_fact_refunds where has_lines group by all) r
       join o_fact_lines l using (order_id, line_item_id)"""
register(
    "default_order_lines", "FCT-2 JN-4 INT-1", "line_item_id s, order_id s, product_sk s=" + _BY_VARIANT + ", quantity d, unit_cost d, line_gross_margin d=margin4",
    lambda w: MODELS["fact_order_lines"](Inputs(_default_house(w))), "o_fact_lines",
)
register(
    "default_inventory_movements", "FCT-9 JN-2 SET-2",
    "movement_id s, product_sk s=" + _BY_VARIANT + ", sku s, movement_date D=day, movement_type s=kind, quantity_change d=change, reference_order_id s=order_id",
    lambda w: Movements(_default_house(w)).fact(), f"{_SALES_NET} union all {_RETURNS}",
)


def _drained(w: Lab) -> DataFrame:
    """Orders that arrive as files in two rounds, the first round's file a second time and some orders changed, landed by a stream."""
    path, name = f"{shared_folder(w.spark).rstrip('/')}/landing/{uuid.uuid4().hex}", f"drained_{uuid.uuid4().hex}"
    rows = w.table("orders").select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("changed_at"), F.date_format("o_orderdate", "yyyy").alias("year"), F.col("o_totalprice").alias("total"))
    first = rows.filter("o_orderkey % 2 = 0")
    later = rows.filter("o_orderkey % 2 <> 0").unionByName(first.filter("o_orderkey % 6 = 0").withColumns({"total": F.col("total") + 1, "changed_at": F.col("changed_at") + F.expr("interval 1 day")}))
    schema = rows.schema
    for batch in (first, first, later):
        batch.write.mode("append").option("header", True).csv(f"{path}/in")
        drain_folder(w.spark, f"{path}/in", schema, name, ["o_orderkey"], version="changed_at", partition="year", checkpoint=f"{path}/log", late_by="10000 days").awaitTermination()
    w.spark.catalog.refreshTable(name)
    return w.spark.table(name)


register(
    "landed_by_stream", "STR-2 SRC-7 SNK-6",
    "o_orderkey l, changed_at t=if(o_orderkey % 6 = 0; o_orderdate + interval 1 day; o_orderdate), total d=if(o_orderkey % 6 = 0; o_totalprice + 1; o_totalprice)",
    _drained, "orders",
)
