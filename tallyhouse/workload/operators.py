"""Queries for single operators: joins, windows, history, upsert, quality, KPIs, rules."""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import classify as C
from tallyhouse.functions.json_ops import json_items, pivot_items, sum_items, text_at
from tallyhouse.functions.keys import surrogate_key
from tallyhouse.functions.pii import pii_hash
from tallyhouse.operators import quality as Q
from tallyhouse.operators import rolling
from tallyhouse.operators.dedup import first_per_key, latest_per_key
from tallyhouse.operators.fx import rate_intervals, with_fx_rate
from tallyhouse.operators.intervals import overlapping_versions, point_in_time_join, point_in_time_join_large, to_intervals_skewed
from tallyhouse.operators.lookup import lookup_with_wildcard, override_channels
from tallyhouse.operators.scd2 import rebuild_history, scd2_merge, scd2_start
from tallyhouse.operators.snapshots import snapshot_days, trailing_totals
from tallyhouse.operators.stored import shared_folder, stored
from tallyhouse.operators.upsert import since_cutoff, upsert
from tallyhouse.plans import facts, kpis, rules
from tallyhouse.plans.checks import model_checks
from tallyhouse.plans.identity import apply_erasure, erase_orders
from tallyhouse.plans.marts import daily_sales
from tallyhouse.plans.sessions import without_bots
from tallyhouse.sources.csv import json_column, row_counts
from tallyhouse.sources.mapping import TableMapping, apply_mapping, source_col
from tallyhouse.sources.registry import raw_tables
from tallyhouse.sources.seeds import channel_rows, small_table, with_channel_overrides
from tallyhouse.workload.oracle import TODAY
from tallyhouse.workload.raw import PARAMS
from tallyhouse.workload.registry import REGISTRY, Lab, register

# ---- Direct on the given tables -----------------------------------------------------------
def money(col: str):
    return F.col(col).cast("decimal(18,4)")


register(
    "daily_sales_direct", "AGG-1 AGG-2 KPI-1 KPI-3 KPI-12 KPI-13 WIN-5",
    "order_date D=day, channel s, nation l, gmv d, order_count l=n, new_customers l=fresh, repeat_customers l=loyal, unique_customers l=people",
    lambda w: _direct_sales(w),
    """select o_orderdate::date as day, o_orderpriority as channel, c_nationkey as nation, sum(o_totalprice::decimal(18,4)) as gmv, count(distinct o_orderkey) as n,
        count(distinct if(r = 1, o_custkey, null)) as fresh, count(distinct if(r > 1, o_custkey, null)) as loyal, count(distinct o_custkey) as people
       from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as r from orders) join customer on c_custkey = o_custkey group by all""",
)


def _direct_sales(w: Lab) -> DataFrame:
    orders = w.table("orders")
    first = first_per_key(
        orders.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"],
        [F.col("o_orderdate").asc_nulls_last(), F.col("o_orderkey").asc()],
    ).select("o_orderkey", F.lit(True).alias("_first"))
    zero = F.lit(0).cast("decimal(18,4)")
    enriched = (
        orders.join(first, "o_orderkey", "left")
        .join(w.table("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation")), "o_custkey")
        .select(
            F.col("o_orderdate").cast("date").alias("order_date"), F.col("o_orderpriority").alias("channel"), "nation",
            F.col("o_custkey").alias("customer_sk"), F.lit("paid").alias("order_status"), F.lit(False).alias("is_test_order"),
            money("o_totalprice").alias("gross_amount"),
            *[zero.alias(c) for c in ("discount_amount", "refunded_amount", "tax_amount", "shipping_amount")],
            F.coalesce("_first", F.lit(False)).alias("is_first_order"), F.col("_first").isNull().alias("is_repeat_order"),
        )
    )
    return daily_sales(enriched, ("order_date", "channel", "nation"))


register(
    "line_revenue_by_brand", "JN-1 AGG-1 PRJ-15",
    "brand s=p_brand, units l=q, revenue d=r, margin d=m",
    lambda w: w.table("lineitem").select("l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    .join(w.table("part").select("p_partkey", F.col("p_brand").alias("brand"), "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    .groupBy("brand").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("units"),
        F.sum(money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("revenue"),
        F.sum(money("l_extendedprice") - F.col("l_quantity").cast("decimal(10,0)") * F.col("p_retailprice").cast("decimal(18,2)")).alias("margin"),
    ),
    """select p_brand, sum(l_quantity::bigint) as q, sum(l_extendedprice::decimal(18,4) * (1 - l_discount::decimal(4,2))) as r,
       sum(l_extendedprice::decimal(18,4) - l_quantity::decimal(10,0) * p_retailprice::decimal(18,2)) as m from lineitem join part on p_partkey = l_partkey group by p_brand""",
)
register(
    "orders_in_window", "PRJ-13 SNK-5",
    "order_id l=o_orderkey, order_date D=o_orderdate, total d=o_totalprice",
    lambda w: w.table("orders").filter(F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-03-31").cast("timestamp_ntz")))
    .select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("total")),
    "select * from orders where o_orderdate between timestamp '1996-01-01' and timestamp '1996-03-31'",
)
register(
    "refunded_orders", "JN-10",
    "order_id l=o_orderkey, customer_id l=o_custkey",
    lambda w: w.table("orders").join(
        w.table("lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi"
    ).select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")),
    "select * from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')",
)
register(
    "latest_line_per_part", "WIN-2 WIN-3",
    "part_key l=l_partkey, order_key l=l_orderkey, line_number l=l_linenumber, supplier_key l=l_suppkey, shipped D=l_shipdate",
    lambda w: latest_per_key(
        w.table("lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"), ["l_partkey"], "l_shipdate",
        F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_suppkey"),
    ).select(F.col("l_partkey").alias("part_key"), F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_number"),
             F.col("l_suppkey").alias("supplier_key"), F.col("l_shipdate").alias("shipped")),
    "select * from lineitem qualify row_number() over (partition by l_partkey order by l_shipdate desc, l_orderkey, l_linenumber, l_suppkey) = 1",
)
register(
    "customer_order_gaps", "WIN-1 WIN-7",
    "order_key l=o_orderkey, customer_key l=o_custkey, valid_from D=o_orderdate, valid_to D=nxt",
    lambda w: to_intervals_skewed(w.table("orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], "o_orderdate", ["o_orderkey"]).select(
        F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer_key"), "valid_from", "valid_to"),
    "select *, lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as nxt from orders",
)
register(
    "event_log_history", "SCD-1 WIN-7",
    "user_id l, event_type s, valid_from t=ts, valid_to t=nxt, is_current b=nxt is null",
    lambda w: to_intervals_skewed(w.table("events").select("user_id", "event_id", "event_type", "ts"), ["user_id"], "ts", ["event_id"], bucket="day")
    .withColumn("is_current", F.col("valid_to").isNull()),
    "select *, lead(ts) over (partition by user_id order by ts, event_id) as nxt from events",
)
register(
    "part_price_history", "SCD-1 WIN-7",
    "part_key s, price d, valid_from t, valid_to t",
    lambda w: rebuild_history(_price_changes(w), "part_key", "changed_at"),
    """select part_key, price, at1 as valid_from, lead(at1) over (partition by part_key order by at1) as valid_to from x_changes""",
    x_changes="""select p_partkey::varchar as part_key, (p_retailprice::decimal(18,2) * m)::decimal(18,4) as price, day::timestamp as at1 from part
        join (values (1.00, date '1995-01-01', 1), (1.10, date '1997-01-01', 2), (1.25, date '1999-06-01', 3)) v(m, day, k) on p_partkey % k = 0""",
)


def _price_changes(w: Lab) -> DataFrame:
    """Up to three list prices per part, by fixed days."""
    steps = [("1.00", date(1995, 1, 1), 1), ("1.10", date(1997, 1, 1), 2), ("1.25", date(1999, 6, 1), 3)]
    part = w.table("part").select("p_partkey", "p_retailprice")
    rows = [
        part.filter(F.col("p_partkey") % every == 0).select(
            F.col("p_partkey").cast("string").alias("part_key"),
            (F.col("p_retailprice").cast("decimal(18,2)") * F.lit(factor).cast("decimal(3,2)")).cast("decimal(18,4)").alias("price"),
            F.lit(day).cast("timestamp").alias("changed_at"),
        )
        for factor, day, every in steps
    ]
    return reduce(DataFrame.unionByName, rows)


register(
    "price_at_shipment", "JN-3 JN-4",
    "order_key l=l_orderkey, part_key s=l_partkey, line_number l=l_linenumber, supplier_key l=l_suppkey, price d",
    lambda w: point_in_time_join(
        w.table("lineitem").select(F.col("l_orderkey").alias("order_key"), F.col("l_partkey").cast("string").alias("part_key"),
                                   F.col("l_linenumber").alias("line_number"), F.col("l_suppkey").alias("supplier_key"), "l_shipdate"),
        rebuild_history(_price_changes(w), "part_key", "changed_at"), fact_key="part_key", version_key="part_key",
        at=F.col("l_shipdate").cast("timestamp"), take={"price": "price"},
    ),
    """select l.*, (select (p_retailprice::decimal(18,2) * case when l_shipdate >= date '1999-06-01' and p_partkey % 3 = 0 then 1.25 when l_shipdate >= date '1997-01-01' and p_partkey % 2 = 0 then 1.10 else 1.00 end)::decimal(18,4)
        from part where p_partkey = l_partkey) as price from lineitem l""",
)
register(
    "price_at_shipment_large", "JN-3 JN-4 JN-5",
    REGISTRY["price_at_shipment"].columns,
    lambda w: point_in_time_join_large(
        w.table("lineitem").select(F.col("l_orderkey").alias("order_key"), F.col("l_partkey").cast("string").alias("part_key"),
                                   F.col("l_linenumber").alias("line_number"), F.col("l_suppkey").alias("supplier_key"), "l_shipdate"),
        rebuild_history(_price_changes(w), "part_key", "changed_at"), fact_key="part_key", version_key="part_key", at="l_shipdate", take={"price": "price"},
    ),
    REGISTRY["price_at_shipment"].sql,
)
register(
    "fx_intervals", "WIN-1 SRC-6",
    "currency s=cur, valid_from D=lo, valid_to D=hi, rate d",
    lambda w: _rates(w), "o_rates",
)


def _rates(w: Lab) -> DataFrame:
    return rate_intervals(w.seeds()["fx_rates"], "USD").withColumnRenamed("from_currency", "currency")


register(
    "fx_convert_lines", "JN-6 PRJ-12",
    "line_item_id s, amount d=(price * coalesce(rate; if(cur = 'USD'; 1; null); 1)::decimal(20;8))::decimal(18;4), fx_rate d=coalesce(rate; if(cur = 'USD'; 1; null))",
    lambda w: with_fx_rate(
        w["stg_shopify__order_line_items"].join(
            w["stg_shopify__orders"].select("order_id", "order_date", "original_currency_code"), "order_id"),
        w.seeds()["fx_rates"], currency="original_currency_code", on="order_date", reporting_currency="USD",
    ).select("line_item_id", C.convert(F.col("unit_price"), F.col("fx_rate")).alias("amount"), "fx_rate"),
    """select l.line_item_id, l.price, upper(o.currency) as cur, r.rate from o_lines l join o_orders o using (order_id)
       left join o_rates r on r.cur = upper(o.currency) and o.order_date >= r.lo and (r.hi is null or o.order_date < r.hi)""",
)
register(
    "channel_fallback", "JN-7 CFG-2",
    "order_id s=o_orderkey, channel_id s=case o_orderpriority when '1-URGENT' then 'own_site' when '2-HIGH' then 'retail_pos' when '3-MEDIUM' then 'subscription_recharge' else 'catch_all' end",
    lambda w: lookup_with_wildcard(
        w.raw["shopify.orders"].select(F.col("id").alias("order_id"), "source_name"),
        with_channel_overrides(w.seeds()["channel_mapping"], small_table(
            w.spark, [("shopify", "web", "own_site"), ("shopify", "*", "catch_all")], "source_system string, source_value string, channel_id string",
        )).filter("source_system = 'shopify'"),
        fact_key="source_name", map_key="source_value", value="channel_id", out="channel_id",
    ),
    "orders",
)
register(
    "json_props_sum", "SRC-5 AGG-9 AGG-11",
    "event_type s, n l, k_sum l=k, tax d",
    lambda w: json_column(w.table("events"), "props").groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum(F.try_variant_get("props", "$.k", "bigint")).alias("k_sum"),
        F.sum(sum_items(json_items(F.concat(F.lit("[{\"price\":\""), F.col("value").cast("decimal(18,2)").cast("string"), F.lit("\"},{\"price\":1}]")), ("price",)), "price")).alias("tax"),
    ),
    "select event_type, count(*) as n, sum((props->>'k')::bigint) as k, sum(value::decimal(18,2) + 1) as tax from events group by event_type",
)
register(
    "json_pivot", "AGG-10",
    "event_id l, kind s=event_type, k s=props->>'k', missing s=null",
    lambda w: w.table("events").select(
        "event_id",
        *[c.alias(n) for n, c in pivot_items(json_items(
            F.concat(F.lit("[{\"name\":\"kind\",\"value\":\""), "event_type", F.lit("\"},{\"name\":\"other\",\"value\":\"x\"}]")), ("name", "value")),
            "name", "value", ("kind", "missing")).items()],
        text_at("props", "$.k").alias("k"),
    ),
    "events",
)
register(
    "pii_hashing", "GOV-2",
    "customer_key l=c_custkey, name_hash s=sha256('pepper' || lower(trim(c_name))), segment_hash s=sha256('pepper' || lower(c_mktsegment))",
    lambda w: w.table("customer").select(F.col("c_custkey").alias("customer_key"), pii_hash("c_name", PARAMS).alias("name_hash"), pii_hash("c_mktsegment", PARAMS).alias("segment_hash")),
    "customer",
)
register(
    "surrogate_keys", "GOV-3",
    "part_key l=p_partkey, sk s=md5(p_partkey || '-' || p_brand || '-_null_'), version_sk s=md5(p_partkey || '-1999-06-01')",
    lambda w: w.table("part").select(
        F.col("p_partkey").alias("part_key"), surrogate_key(["p_partkey", "p_brand", F.lit(None)]).alias("sk"),
        surrogate_key(["p_partkey"], F.lit(date(1999, 6, 1))).alias("version_sk")),
    "part",
)
register(
    "note_classifier", "PRJ-4",
    "doc_id l, category s=case when t like '%damage%' or t like '%broken%' then 'damaged' when t like '%wrong%' or t like '%incorrect%' then 'wrong_item' when t like '%as described%' then 'not_as_described'"
    " when t like '%changed%' or t like '%no longer%' or t like '%cancel%' then 'customer_change_of_mind' when t like '%quality%' or t like '%defect%' then 'quality_issue' when t like '%late%' or t like '%delay%' then 'late_delivery' else 'other' end",
    lambda w: w.table("documents").select("doc_id", C.refund_category(F.col("text")).alias("category")),
    "select doc_id, lower(text) as t from documents",
)

# ---- History ------------------------------------------------------------------------------
register(
    "scd2_check_merge", "SCD-1 SCD-2",
    "customer_key s, segment s, valid_from t, valid_to t, is_current b=valid_to is null",
    lambda w: _segment_history(w).withColumn("is_current", F.col("valid_to").isNull()),
    """select c_custkey::varchar as customer_key, if(c_custkey % 4 = 0, null, c_mktsegment) as segment, timestamp '2024-01-01' as valid_from, if(c_custkey % 6 in (0, 1) and not (c_custkey % 6 = 0 and c_custkey % 4 = 0 and false), timestamp '2025-01-01', null) as valid_to from customer where c_custkey % 5 <> 0
       union all select c_custkey::varchar, if(c_custkey % 6 = 0, 'NEW', if(c_custkey % 4 = 0, 'NOW KNOWN', c_mktsegment || '!')), timestamp '2025-01-01', null from customer where c_custkey % 6 in (0, 1) or (c_custkey % 5 = 0 and false)
         and c_custkey % 5 <> 0
       union all select c_custkey::varchar, if(c_custkey % 4 = 0, null, c_mktsegment), timestamp '2025-01-01', null from customer where c_custkey % 5 = 0 and c_custkey % 6 not in (0, 1) and c_custkey % 7 <> 0""",
)


def _segment_history(w: Lab) -> DataFrame:
    """Two loads of customer segments: new, changed, NULL-to-value, unchanged and vanished keys."""
    cust = w.table("customer")
    base = F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment"))
    k6 = F.col("c_custkey") % 6
    after = (
        F.when(k6 == 0, "NEW").when((k6 == 1) & (F.col("c_custkey") % 4 == 0), "NOW KNOWN")
        .when(k6 == 1, F.concat("c_mktsegment", F.lit("!"))).otherwise(base)
    )
    key = F.col("c_custkey").cast("string").alias("customer_key")
    first = cust.filter("c_custkey % 5 <> 0").select(key, base.alias("segment"))
    gone = (F.col("c_custkey") % 7 == 0) & ~k6.isin(0, 1)
    second = cust.filter(~gone).select(key, after.alias("segment"))
    history = scd2_start(first, "customer_key", now=F.lit("2024-01-01 00:00:00"))
    return scd2_merge(history, second, "customer_key", now=F.lit("2025-01-01 00:00:00"), check=["segment"])


register(
    "scd2_timestamp_merge", "SCD-3",
    "variant_id s, cost d=unit_cost, valid_from t, valid_to t",
    lambda w: w["snap_product"].withColumn("cost", F.col("unit_cost")),
    "select variant_id, if(k % 9 = 0, null, full_cost) as unit_cost, valid_from, valid_to from o_products",
)
register(
    "version_overlaps", "SCD-1 DQ-5",
    "part_key l=p, n l",
    lambda w: overlapping_versions(
        w.table("lineitem").select(F.col("l_partkey").alias("part_key"), F.expr("cast(l_shipdate as date) as valid_from"), F.expr("cast(l_shipdate as date) + cast(l_quantity as int) as valid_to")), "part_key",
    ).groupBy("part_key").agg(F.count("*").alias("n")),
    """with v as (select l_partkey as p, l_shipdate::date as a, l_shipdate::date + l_quantity::int as b, row_number() over (partition by l_partkey order by l_shipdate::date, l_quantity) as r from lineitem)
       select p, count(*) as n from v where exists (select 1 from v s where s.p = v.p and s.r > v.r and s.a < v.b) group by p""",
)
register(
    "erased_customers", "GOV-4",
    "customer_id s, email_hash s=if(h; null; email), marketing_consent b=consent and not r, sms_subscribed b=sub_sms and not r",
    lambda w: apply_erasure(w["dim_customer"], _erasure_requests(w), PARAMS),
    "select *, coalesce(shopify_customer_id::int % 10 = 3, false) as h, coalesce(shopify_customer_id::int % 10 in (3, 4), false) as r from o_dim_customer",
)


register(
    "erased_orders", "GOV-4",
    "order_id s, customer_id s, email_hash s=if(h; null; email_hash)",
    lambda w: erase_orders(w["fact_orders"], _erasure_requests(w), PARAMS).withColumn("email_hash", F.col("customer_email_hash_at_order")),
    "select o.*, coalesce(o.customer_id in (select customer_id from o_dim_customer where shopify_customer_id::int % 10 = 3), false) as h from o_fact_orders o",
)


def _erasure_requests(w: Lab) -> DataFrame:
    last = F.col("shopify_customer_id").cast("int") % 10
    due = w["dim_customer"].filter(last.isin(3, 4, 5))
    return due.select(
        "customer_id", F.when(last == 5, F.lit("2030-01-01")).otherwise(F.lit("2026-01-01")).cast("date").alias("request_date"),
        F.concat(F.lit("T-"), "shopify_customer_id").alias("ticket_id"),
        F.when(last == 4, "marketing_only").otherwise("full_erasure").alias("scope"),
    )


# ---- Incremental --------------------------------------------------------------------------
register(
    "upsert_orders", "SNK-3 SNK-4 STR-2",
    "order_key l=o_orderkey, total d=if(o_orderkey % 3 = 0; o_totalprice + 1; o_totalprice), tag s=if(o_orderkey % 3 = 0; 'late'; null)",
    lambda w: _upserted(w), "orders",
)


def _upserted(w: Lab) -> DataFrame:
    """A third of the orders arrives again with another total and a new column; applied twice."""
    orders = w.table("orders").select(F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("total"))
    target = orders.filter("order_key % 5 <> 0")
    batch = orders.filter("order_key % 3 = 0").select("order_key", (F.col("total") + 1).alias("total"), F.lit("late").alias("tag"))
    rest = orders.filter("order_key % 5 = 0 and order_key % 3 <> 0")
    once = upsert(upsert(target, batch, ["order_key"]), batch, ["order_key"])
    return once.unionByName(rest, allowMissingColumns=True)


register(
    "late_refund_batch", "SNK-6 STR-2",
    "refund_id s, refund_date D",
    lambda w: since_cutoff(w["stg_shopify__refunds"], w["stg_shopify__refunds"].filter("refund_date < date '2024-06-01'"), "refund_timestamp", 30)
    .select("refund_id", "refund_date"),
    "select * from o_refunds where refund_timestamp::date >= (select max(refund_timestamp::date) from o_refunds where refund_date < date '2024-06-01') - 30",
)
register(
    "sync_and_count", "SRC-8",
    "table_name s, row_count l=n",
    lambda w: row_counts({t: w.table(t) for t in ("customer", "orders", "lineitem", "part", "supplier", "events")}),
    " union all ".join(f"select '{t}' as table_name, count(*) as n from {t}" for t in ("customer", "orders", "lineitem", "part", "supplier", "events")),
)
register(
    "mapped_orders", "SRC-11 CFG-11",
    "order_id s=id, customer_email s=lower(trim(email)), gross_amount d=subtotal_price, order_status s=coalesce(map {'paid': 'paid'; 'pending': 'pending'; 'refunded': 'refunded'; 'partially_refunded': 'partial_refund'; 'voided': 'cancelled'}[financial_status]; 'unknown')",
    lambda w: apply_mapping(w.raw["shopify.orders"], TableMapping.from_document({
        "required_fields": ["id", "created_at", "total_price"],
        "optional_fields": ["app_id"],
        "field_mappings": {"order_id": "id", "customer_email": "email", "gross_amount": "subtotal_price", "net_amount": "total_price"},
        "filters": {"exclude_test_orders": True, "exclude_archived": False, "min_created_at": "2021-01-01"},
        "transformations": {"customer_email": ["lowercase", "trim"], "order_status": {"map_values": {
            "paid": "paid", "pending": "pending", "refunded": "refunded", "partially_refunded": "partial_refund", "voided": "cancelled"}}},
    })),
    "select * from raw_shopify_orders where not coalesce(test, false) and created_at >= timestamp '2021-01-01'",
)

# ---- Quality ------------------------------------------------------------------------------
# Every declared check of the order fact, with its severity and a SQL count of the rows that break it.
_ORDER_COUNTS = {
    "net_amount_non_negative": ("warn", "count(*) filter (where net4 < 0)"),
    "refunded_not_exceed_net": ("error", "count(*) filter (where back4 > net4 + 0.01)"),
    "gross_gte_discount": ("warn", "count(*) filter (where gross4 < discount4)"),
    "recency_order_date_2d": ("warn", f"(max(order_date) < {TODAY} - 2)::int"),
    **{f"not_null_{name}": ("error", f"count(*) filter (where {expr} is null)") for name, expr in {
        "order_sk": "order_sk", "order_id": "order_id", "order_number": "order_number", "order_date": "order_date", "order_timestamp": "order_timestamp",
        "order_status": "order_status", "gross_amount": "gross4", "discount_amount": "discount4", "net_amount": "net4", "refunded_amount": "back4",
        "net_after_refunds": "after4", "fx_rate_to_reporting": "coalesce(fx, 1)", "is_first_order": "is_first", "is_repeat_order": "is_repeat",
        "financial_status": "financial_status", "tax_amount": "tax4", "shipping_amount": "shipping4", "tip_amount": "tip4", "currency_code": "'USD'",
        "original_currency_code": "currency", "original_gross_amount": "gross4", "line_item_count": "line_count", "total_quantity": "units",
        "is_subscription_order": "subscription", "is_test_order": "false", "created_at": "order_timestamp", "updated_at": "updated_at", "loaded_at": "1"}.items()},
    "accepted_range_order_date": ("error", f"count(*) filter (where order_date not between date '{PARAMS.calendar_start}' and date '{PARAMS.calendar_end}')"),
    "accepted_values_order_status": ("error", "count(*) filter (where order_status not in ('pending', 'paid', 'fulfilled', 'cancelled', 'refunded', 'partial_refund', 'unknown'))"),
    "accepted_values_financial_status": ("error", "count(*) filter (where financial_status not in ('pending', 'paid', 'refunded', 'partially_refunded', 'voided'))"),
    "foreign_currency_has_rate": ("warn", "count(*) filter (where fx is null)"),
    "unique_order_sk": ("error", "count(*) - count(distinct order_sk)"),
    "unique_order_id": ("error", "count(*) - count(distinct order_id)"),
    **{f"relationship_{col}_{dim}": ("error", f"count(*) filter (where {expr} not in ({keys}))") for col, dim, expr, keys in (
        ("customer_sk", "dim_customer", "customer_sk", "select customer_sk from o_dim_customer"),
        ("channel_sk", "dim_channel", "channel_sk", ", ".join(f"md5('{c}')" for c in sorted({r[2] for r in channel_rows()}))),
        ("geography_sk", "dim_geography", "geography_sk", "select md5('C' || n_nationkey) from nation"),
        ("payment_method_sk", "dim_payment_method", "pm_sk", "select sk from o_payment_methods"))},
}
register(
    "dq_fact_orders", "DQ-1 DQ-2 DQ-3 DQ-4 DQ-5 DQ-6 DQ-7 DQ-10",
    "check_name s, severity s, failures l, status s",
    lambda w: Q.run_checks("fact_orders", w.kept("fact_orders"), model_checks(PARAMS)["fact_orders"], PARAMS,
                           {n: w[n] for n in ("dim_customer", "dim_channel", "dim_geography", "dim_payment_method")}),
    "select check_name, severity, failures, case when failures = 0 then 'pass' when severity = 'error' then 'fail' else 'warn' end as status from ("
    + " union all ".join(f"select '{name}' as check_name, '{severity}' as severity, {count} as failures from o_fact_orders" for name, (severity, count) in _ORDER_COUNTS.items()) + ")",
)
register(
    "dq_given_tables", "DQ-1 DQ-2 DQ-4 DQ-5 DQ-7",
    "check_name s, failures l",
    lambda w: Q.run_checks("lineitem", w.table("lineitem"), [
        Q.not_null("l_shipdate"), Q.accepted_values("l_returnflag", ("A", "N")), Q.accepted_range("l_quantity", 2, 49),
        Q.expression_is_true("discount_below_tenth", "l_discount < 0.1"), Q.unique("l_orderkey", "l_linenumber"),
    ], PARAMS),
    """select 'not_null_l_shipdate' as check_name, count(*) filter (where l_shipdate is null) as failures from lineitem
       union all select 'accepted_values_l_returnflag', count(*) filter (where l_returnflag = 'R') from lineitem
       union all select 'accepted_range_l_quantity', count(*) filter (where l_quantity < 2 or l_quantity > 49) from lineitem
       union all select 'discount_below_tenth', count(*) filter (where l_discount >= 0.1) from lineitem
       union all select 'unique_l_orderkey_l_linenumber', count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)""",
)
register(
    "dq_duplicate_keys", "DQ-2 DQ-8",
    "order_key l=l_orderkey, line_number l=l_linenumber, n_rows l=n",
    lambda w: Q.duplicate_keys(w.table("lineitem"), ["l_orderkey", "l_linenumber"]).select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_number"), "n_rows"),
    "select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1",
)
register(
    "dq_orphans", "DQ-3 JN-11",
    "order_id s, shipping_country_code s=ship_to",
    lambda w: Q.orphans(w["stg_shopify__orders"], "shipping_country_code", w["dim_geography"], "country_code").select("order_id", "shipping_country_code"),
    "select * from o_orders where ship_to not in (select 'C' || n_nationkey from nation)",
)
register(
    "dq_freshness", "DQ-9",
    "table_name s, newest t, status s",
    lambda w: reduce(DataFrame.unionByName, [
        Q.freshness(w.raw[n].select(F.col(t.loaded_at).cast("timestamp").alias(t.loaded_at)), n, t.loaded_at, t.warn_hours, t.error_hours, F.lit("2026-08-02 01:00:00"))
        for n, t in raw_tables().items() if n in ("shopify.orders", "shopify.inventory_levels", "klaviyo.events", "shopify.refunds")
    ]),
    """select table_name, newest, case when datediff('second', newest, timestamp '2026-08-02 01:00:00') > e * 3600 then 'error' when datediff('second', newest, timestamp '2026-08-02 01:00:00') > h * 3600 then 'warn' else 'pass' end as status from (
        select 'shopify.orders' as table_name, max(updated_at) as newest, 6 as h, 24 as e from raw_shopify_orders
        union all select 'shopify.inventory_levels', max(updated_at), 24, 48 from raw_shopify_inventory_levels
        union all select 'klaviyo.events', max(datetime), 6, 24 from raw_klaviyo_events
        union all select 'shopify.refunds', max(created_at), 6, 24 from raw_shopify_refunds)""",
)
register(
    "dq_monetary_balance", "DQ-11",
    "order_id s, discrepancy d=gap",
    lambda w: Q.monetary_imbalance(_skewed_net(w)),
    "select order_id, abs(net4 + if(n % 10 = 0, 2, 0) - (gross4 - discount4 + tax4 + shipping4 + tip4)) as gap from o_fact_orders where abs(net4 + if(n % 10 = 0, 2, 0) - (gross4 - discount4 + tax4 + shipping4 + tip4)) > 1",
)


def _skewed_net(w: Lab) -> DataFrame:
    """Every tenth order's net is put off by 2."""
    tenth = F.col("order_id").cast("long") % 10 == 0
    off = F.when(tenth, F.lit(2)).otherwise(F.lit(0)).cast("decimal(18,4)")
    return w["fact_orders"].withColumn("net_amount", (F.col("net_amount") + off).cast("decimal(18,4)"))


register(
    "dq_movement_signs", "DQ-12",
    "movement_id s, movement_type s=kind, quantity_change d=change",
    lambda w: Q.wrong_sign_movements(w["fact_inventory_movements"].withColumn("quantity_change", F.col("quantity_change") + 10)),
    "select movement_id, kind, change + 10 as change from o_movements where (kind = 'sale' and change + 10 >= 0) or (kind = 'return' and change + 10 <= 0)",
)
register(
    "dq_orders_without_lines", "DQ-13 JN-11",
    "order_id s",
    lambda w: Q.orders_without_lines(w["fact_orders"].withColumn("line_item_count", F.lit(1)), w["fact_order_lines"]),
    "select order_id from o_fact_orders where order_id not in (select order_id from o_fact_lines)",
)
register(
    "dq_refunds_without_orders", "DQ-14 JN-11",
    "refund_id s",
    lambda w: Q.refunds_without_orders(w["fact_refunds"], w["fact_orders"]),
    "select refund_id from o_fact_refunds where order_id not in (select order_id from o_fact_orders)",
)
register(
    "dq_expected_values", "DQ-15",
    "metric s, value d, expected d, passed b",
    lambda w: Q.expected_values(
        w.table("orders").agg(F.count("*").cast("double").alias("order_count"), F.sum(money("o_totalprice")).cast("double").alias("gmv"))
        .unpivot([], ["order_count", "gmv"], "metric", "value"),
        w.table("lineitem").agg(F.count_distinct("l_orderkey").cast("double").alias("order_count"), F.sum(money("l_extendedprice")).cast("double").alias("gmv"))
        .unpivot([], ["order_count", "gmv"], "metric", "expected").withColumn("tolerance_pct", F.when(F.col("metric") == "gmv", 50.0).otherwise(0.0)),
    ),
    """select 'order_count' as metric, a.n::double as value, b.n::double as expected, a.n = b.n as passed from (select count(*) as n from orders) a, (select count(distinct l_orderkey) as n from lineitem) b
       union all select 'gmv', a.v, b.v, abs(a.v - b.v) / b.v * 100 <= 50 from (select sum(o_totalprice::decimal(18,4))::double as v from orders) a, (select sum(l_extendedprice::decimal(18,4))::double as v from lineitem) b""",
)

# ---- KPIs ---------------------------------------------------------------------------------
register(
    "kpi_sales_totals", "KPI-1 KPI-2 KPI-3 KPI-4 KPI-9",
    "gmv d, net_revenue d=rev, order_count l=n, aov d=gmv::double / n, tax_collected d=tax",
    lambda w: kpis.sales_kpis(w["fact_orders"]),
    "select sum(gross4) as gmv, sum(gross4 - discount4 - back4) as rev, count(*) as n, sum(tax4) as tax from o_fact_orders where order_status <> 'cancelled'",
)
register(
    "kpi_sales_by_channel", "KPI-1 KPI-2 KPI-4",
    "channel_sk s, gmv d, net_revenue d=rev, aov d=gmv::double / n",
    lambda w: kpis.sales_kpis(w["fact_orders"], ("channel_sk",)),
    "select channel_sk, sum(gross4) as gmv, sum(gross4 - discount4 - back4) as rev, count(*) as n from o_fact_orders where order_status <> 'cancelled' group by 1",
)
register(
    "kpi_discounted_gmv", "KPI-1b KPI-4",
    "gmv d, order_count l=n, aov d=gmv::double / n",
    lambda w: kpis.discounted_gmv(w["stg_shopify__orders"]),
    "select sum(gross - discount) as gmv, count(*) as n from o_orders where financial_status <> 'voided'",
)
register(
    "kpi_new_repeat_customers", "KPI-12b KPI-13b KPI-14",
    "new_customers l=fresh, repeat_customers l=loyal, repeat_purchase_rate d=loyal::double / n * 100",
    lambda w: kpis.customers_by_order_count(w.table("orders"), "o_custkey"),
    "select count(*) filter (where n = 1) as fresh, count(*) filter (where n > 1) as loyal, count(*) as n from (select count(*) as n from orders group by o_custkey)",
)
register(
    "kpi_repeat_rate", "KPI-14",
    "order_date D, channel_sk s, geography_sk s, repeat_purchase_rate d=if(fresh + loyal = 0; null; loyal::double / (fresh + loyal))",
    lambda w: kpis.repeat_rate(w["mart_sales"]),
    "select order_date, channel_sk, geography_sk, count(distinct customer_sk) filter (where is_first) as fresh, count(distinct customer_sk) filter (where is_repeat) as loyal from o_fact_orders where order_status <> 'cancelled' group by 1, 2, 3",
)
register(
    "kpi_revenue_growth", "KPI-5 WIN-6",
    "period D, revenue d, prev_revenue d=prev, growth_pct d=(revenue - prev)::double / prev::double * 100",
    lambda w: kpis.revenue_growth(w["mart_sales"], "month"),
    "select date_trunc('month', order_date)::date as period, sum(gross4 - discount4 - back4) as revenue, lag(sum(gross4 - discount4 - back4)) over (order by date_trunc('month', order_date)::date) as prev from o_fact_orders where order_status <> 'cancelled' group by 1",
)
register(
    "kpi_active_customers", "KPI-10 KPI-11 AGG-12",
    "customer_key l=o_custkey, orders_90d l=n, revenue_90d d=v",
    lambda w: _trailing_90(w),
    "select o_custkey, count(*) as n, sum(o_totalprice::decimal(18,4)) as v from orders where o_orderdate::date > (select max(o_orderdate::date) from orders) - 90 group by o_custkey",
)


def _rolling_actives(w: Lab) -> DataFrame:
    """Active customers of 30 and 90 days overall, by channel and by country, from bitmaps that were brought up to date once."""
    orders = w["fact_orders"].filter(C.not_cancelled(F.col("order_status")) & F.col("customer_id").isNotNull())
    orders = stored(orders.select("customer_id", "order_date", "channel_sk", "geography_sk"), "orders")
    keys = ["channel_sk", "geography_sk"]
    before = orders.filter(F.col("order_date") < F.lit("2026-01-01").cast("date"))
    numbers = stored(rolling.number_members(orders.select("customer_id"), stored(rolling.number_members(before.select("customer_id")), "numbers")), "numbers")
    bitmaps = stored(rolling.daily_bitmaps(before, numbers, "customer_id", "order_date", keys), "bitmaps")
    bitmaps = stored(rolling.add_days(bitmaps, orders, numbers, "customer_id", "order_date", keys), "bitmaps")
    days = stored(snapshot_days("month_end", w.inputs()["fact_orders"], F.lit(PARAMS.as_of), "order_date"), "days")
    parts = []
    for kind, slices in (("all", []), ("channel", keys[:1]), ("country", keys[1:])):
        value = (F.col(slices[0]) if slices else F.lit(None)).cast("string").alias("slice")
        one, three = (rolling.rolling_distinct(bitmaps, days, n, slices, f"active_{n}d").select("snapshot_date", F.lit(kind).alias("kind"), value, f"active_{n}d") for n in (30, 90))
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("snapshot_date", "slice")]
        parts.append(three.alias("a").join(one.alias("b"), same, "left").select("a.snapshot_date", "a.kind", "a.slice", F.coalesce("active_30d", F.lit(0)).alias("active_30d"), "active_90d"))
    return reduce(DataFrame.union, parts)


_ACTIVE = "count(distinct customer_id) filter (where order_date > day - 30) as a30, count(distinct customer_id) as a90 from o_fact_orders join o_days on order_date between day - 89 and day where order_status <> 'cancelled' and customer_id is not null group by all"
register(
    "kpi_rolling_actives", "KPI-10/11 AGG-3",
    "snapshot_date D=day, kind s, slice s, active_30d l=a30, active_90d l=a90", _rolling_actives,
    f"select day, 'all' as kind, null::varchar as slice, {_ACTIVE} union all select day, 'channel', channel_sk, {_ACTIVE} union all select day, 'country', geography_sk, {_ACTIVE}",
)


def _trailing_90(w: Lab) -> DataFrame:
    orders = w.table("orders").select(F.col("o_custkey").alias("customer_key"), F.col("o_orderdate").cast("date").alias("day"), money("o_totalprice").alias("v"))
    daily = orders.groupBy("customer_key", "day").agg(F.count("*").alias("n"), F.sum("v").alias("v"))
    last = orders.agg(F.max("day").alias("snapshot_date"))
    return trailing_totals(daily, last, ["customer_key"], "day", {"orders_90d": F.sum("n"), "revenue_90d": F.sum("v")}, 89, 0)


register(
    "kpi_email_engagement", "KPI-19",
    "delivered l=d, opened l=o, clicked l=c, engagement_rate d=(o + c)::double / d * 100",
    lambda w: kpis.email_engagement(w["fact_email_engagement"]),
    "select count(*) filter (where event_type = 'signup') as d, count(*) filter (where event_type = 'view') as o, count(*) filter (where event_type = 'click') as c from events",
)
register(
    "kpi_inventory", "KPI-20 KPI-23",
    "snapshot_date D=day, inventory_value d=v, positions l=n, out_of_stock l=z, stockout_rate d=z::double / n * 100",
    lambda w: kpis.inventory_kpis(w["fact_inventory_snapshot"]),
    "select day, sum((qty * cost)::decimal(18,4)) as v, count(*) as n, count(*) filter (where qty <= 0) as z from o_inventory group by day",
)
register(
    "kpi_sku_stockout", "KPI-23 DQ-16",
    "sku_total l=n, sku_oos l=z, stockout_rate d=z::double / n * 100",
    lambda w: kpis.sku_stockout_rate(w["stg_shopify__inventory_snapshots"]),
    "select count(distinct inventory_item_id) as n, count(distinct if(available <= 0, inventory_item_id, null)) as z from raw_shopify_inventory_snapshots where snapshot_date = (select max(snapshot_date) from raw_shopify_inventory_snapshots)",
)
register(
    "kpi_stockout_skus", "DQ-16",
    "stockout_skus l=n",
    lambda w: kpis.stockout_skus(w["stg_shopify__inventory_snapshots"], "2024-01-01", "2024-06-30"),
    "select count(distinct inventory_item_id) as n from raw_shopify_inventory_snapshots where available <= 0 and snapshot_date between date '2024-01-01' and date '2024-06-30'",
)
register(
    "kpi_ad_spend", "KPI-M",
    "total_spend d=v", lambda w: kpis.total_ad_spend(w["fact_marketing_spend"]), "select sum(value::decimal(18,2)) as v from events",
)
register(
    "kpi_source_distribution", "AGG-19",
    "source s, n l, pct d=n::double / t::double * 100",
    lambda w: kpis.source_distribution(w["stg_shopify__orders"]),
    "select coalesce(utm_source, '(direct)') as source, count(*) as n, sum(count(*)) over () as t from o_orders group by 1",
)
register(
    "kpi_peak_day", "AGG-18 DQ-16",
    "peak_date D=day, peak_orders l=n",
    lambda w: kpis.peak_day(w["stg_shopify__orders"]),
    "select order_date as day, count(*) as n from o_orders group by 1 qualify row_number() over (order by count(*) desc, order_date) = 1",
)
register(
    "kpi_month_multiplier", "AGG-20 DQ-16",
    "month_orders l=m, baseline_avg d=b / 4.0::double, multiplier d=m::double / (b / 4.0::double)",
    lambda w: kpis.month_multiplier(w["stg_shopify__orders"], 9, (1, 2, 3, 5)),
    "select count(*) filter (where month(order_date) = 9) as m, count(*) filter (where month(order_date) in (1, 2, 3, 5)) as b from o_orders",
)
register(
    "customer_order_stats", "AGG-16",
    "id s, orders_count l=coalesce(n; 0), total_spent d=coalesce(v; 0), updated_at t=coalesce(last; changed)",
    lambda w: kpis.customer_order_stats(w.raw["shopify.customers"], w.raw["shopify.orders"]),
    "select c.id, c.updated_at as changed, o.* from raw_shopify_customers c left join (select customer_id, count(*) as n, sum(total_price) as v, max(created_at) as last from raw_shopify_orders where financial_status in ('paid', 'partially_refunded', 'refunded') group by 1) o on o.customer_id = c.id",
)
register(
    "variant_velocity", "AGG-17",
    "variant_id l=l_partkey, units l=q, daily_velocity d=q::double / 2400",
    lambda w: kpis.variant_velocity(w.raw["shopify.order_line_items"], w.raw["shopify.orders"].select(F.col("id").alias("order_id")), 2400),
    "select l_partkey, sum(l_quantity::bigint) as q from lineitem where l_orderkey in (select o_orderkey from orders) group by 1",
)

# ---- Rules --------------------------------------------------------------------------------
register(
    "rule_b2b", "CFG-1",
    "shopify_customer_id s=id, is_b2b_customer b=id % 30 in (0; 1; 2) or id % 25 = 0 or (id % 12 > 0 and total_spent::double / (id % 12) > 3000)",
    lambda w: rules.flag_b2b(w["stg_shopify__customers"], company_required=True, min_order_amount=3000.0), "raw_shopify_customers",
)
register(
    "rule_bot_filter", "CFG-3",
    "session_id s, events_count l=events", lambda w: without_bots(w["int_web_sessions"]), "select * from o_sessions where not (events = 1 and seconds = 0)",
)
register(
    "rule_channel_override", "CFG-4",
    "session_id s, channel_id s=case when source = 'Bing' then 'bing_paid' when source = 'facebook' then 'meta' else 'default' end",
    lambda w: override_channels(
        w["int_web_sessions"].withColumn("channel_id", F.lit("default")),
        small_table(w.spark, [("bing", "cpc", "bing_paid"), ("facebook", "CPC", "meta")], "source string, medium string, canonical_channel string"),
        "traffic_source", "traffic_medium"),
    "o_sessions",
)
register(
    "source_override", "SRC-10",
    "event_id l, kind s=coalesce(props->>'k'; null), plain s=event_type",
    lambda w: w.table("events").select(
        "event_id", *[source_col({"events": {"kind": "props:k"}}, "events", name, "event_type").alias(name) for name in ("kind", "plain")]),
    "events",
)
register(
    "traffic_overrides_in_run", "CFG-4 FCT-5",
    "session_id s, channel_sk s=case when source = 'facebook' then md5('referral_tiktok') else case substr(user_pseudo_id; 2)::int % 6 when 0 then md5('organic_search_google') when 1 then md5('paid_social_meta') when 2 then md5('paid_search_bing') when 3 then null else md5('direct') end end",
    lambda w: facts.fact_web_sessions(
        w["int_web_sessions"], dim_customer=w["dim_customer"], dim_channel=w["dim_channel"], dim_geography=w["dim_geography"], channel_mapping=w.warehouse().channels(), params=PARAMS,
        traffic_overrides=small_table(w.spark, [("facebook", "CPC", "referral_tiktok")], "source string, medium string, canonical_channel string")),
    "o_sessions",
)
register(
    "quarantine_rows", "SNK-8 GOV-5",
    "check_name s, order_id s, net_amount d=net4, refunded_amount d=back4", lambda w: _quarantined(w),
    "select 'refunded_not_exceed_net' as check_name, * from o_fact_orders where back4 > net4 + 0.01 union all select 'not_null_order_status', * from o_fact_orders where order_status is null",
)


def _quarantined(w: Lab) -> DataFrame:
    """What the order fact stores of its failing rows, read back from the quarantine table."""
    database = f"quarantine_{uuid.uuid4().hex}"
    w.spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(w.spark).rstrip('/')}/{database}'")
    checks = [c for c in model_checks(PARAMS)["fact_orders"] if c.name in ("refunded_not_exceed_net", "not_null_order_status")]
    names = Q.quarantine(w.kept("fact_orders"), "fact_orders", checks, PARAMS, {}, database)
    return w.spark.table(names[-1])


register(
    "rule_private_opens", "CFG-5",
    "event_id s", lambda w: rules.without_private_opens(
        w["stg_klaviyo__events"].withColumn("event_properties", F.parse_json(F.when(F.col("event_id").cast("long") % 4 == 0, F.lit('{"user_agent":"Apple Mail Privacy"}')).otherwise(F.lit("{}"))))),
    "select event_id from events where not (event_type = 'view' and event_id % 4 = 0)",
)
register(
    "rule_campaign_names", "CFG-6",
    "campaign_id s='meta_' || event_type, name_year s='2024', name_quarter s='Q1', name_theme s=event_type",
    lambda w: rules.parse_campaign_name(w["stg_meta_ads__campaigns"], r"(?P<year>\d{4})-(?P<quarter>Q\d)_(?P<theme>[a-z]+)"),
    "select distinct event_type from events",
)
register(
    "rule_insight_levels", "CFG-7 AGG-5",
    "campaign_id s='meta_' || event_type, ad_set_id s='as' || g, spend_date D=day, spend d=v, clicks l=n * 3",
    lambda w: rules.insights_at(w["stg_meta_ads__daily_insights"], "ad_set").withColumn("spend", F.col("spend_amount_local")),
    "select event_type, user_id % 10 as g, ts::date as day, count(*) as n, sum(value::decimal(18,2)) as v from events group by 1, 2, 3",
)
register(
    "rule_conversion_ratio", "CFG-8",
    "campaign_id s='meta_' || event_type, ratio d=p / h, status s=case when p / h > 10 then 'error' when p / h > 3 then 'warn' else 'pass' end",
    lambda w: rules.conversion_ratio_alerts(
        w["stg_meta_ads__daily_insights"].withColumn("conversions", F.col("platform_reported_conversions")),
        w.table("events").groupBy(F.concat(F.lit("meta_"), "event_type").alias("campaign_id")).agg(
            F.when(F.first("event_type") == "click", F.count("*")).otherwise(F.count_distinct(F.expr("user_id % 500"))).alias("conversions"))),
    "select event_type, sum(if(user_id % 13 = 0, 0, n + 2))::double as p, any_value(h)::double as h from (select event_type, user_id, ts::date as day, count(*) as n from events group by 1, 2, 3) join (select event_type, if(event_type = 'click', count(*), count(distinct user_id % 500)) as h from events group by 1) using (event_type) group by 1",
)
register(
    "rule_reconciliation", "CFG-9",
    "order_id s, order_amount d=net, charged_amount d=paid, issue s",
    lambda w: rules.reconcile_charges(w["stg_shopify__orders"], w["stg_stripe__charges"], 3.0),
    """select * from (select coalesce(o.order_id, c.order_id) as order_id, o.net, c.paid, case when c.paid is null then 'order_only' when o.net is null then 'charge_only'
        when abs(o.net - c.paid)::double / o.net::double * 100 > 3.0 then 'mismatch' end as issue
       from o_orders o full join (select order_id, sum(amount) as paid from o_charges where order_id is not null group by 1) c on c.order_id = o.order_id) where issue is not null""",
)
register(
    "rule_synthetic_orders", "CFG-10",
    "order_id s='stripe_' || charge_id, order_timestamp t=happened, net_amount d=amount, channel_sk s=md5('stripe_direct')",
    lambda w: rules.synthetic_orders(w["stg_stripe__charges"]), "select * from o_charges where order_id is null",
)


def _incremental_orders(w: Lab) -> DataFrame:
    """A stored fact that ends in mid 2025, brought up to date by one incremental run."""
    house = w.warehouse()
    held = [name for name, _, _ in REGISTRY["fact_orders_incremental"].columns]  # what the query returns of the stored fact
    before = w["fact_orders"].filter(F.col("updated_at") < F.lit("2025-06-15").cast("timestamp"))
    before = stored(before.select(*held), "fact_orders_before")
    changed = facts.fact_orders(
        w["int_orders_enriched"], w["stg_shopify__refunds"], w["stg_stripe__charges"], dim_customer=w["dim_customer"],
        dim_channel=w["dim_channel"], dim_geography=w["dim_geography"], dim_payment_method=w["dim_payment_method"],
        fx_rates=house.seeds["fx_rates"], channel_mapping=house.seeds["channel_mapping"], params=PARAMS, existing=before,
    )
    return upsert(before, changed, ["order_id"])


register(
    "fact_orders_incremental", "SNK-3 SNK-6 STR-2 FCT-1",
    "order_id s, order_status s, net_amount d=net4, refunded_amount d=back4, is_first_order b=is_first, updated_at t",
    _incremental_orders, "o_fact_orders",
)
