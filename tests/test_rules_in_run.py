"""Optional rules, channel overrides and erasure requests as parts of a whole run."""

import uuid
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyhouse.params import B2bRule, Params, Rules
from tallyhouse.plans.identity import ORDER_PERSONAL
from tallyhouse.plans.warehouse import SHARED, Warehouse, stored_run
from tallyhouse.sources.seeds import SEED_SCHEMAS, small_table
from tallyhouse.workload.raw import PARAMS
from tallyhouse.workload.registry import lab
from tests.conftest import SF_DIR


def test_rules_reach_the_models(spark):
    shop = lab(spark, SF_DIR)
    on = Rules(
        b2b=B2bRule(patterns=("vip",)), drop_bot_sessions=True, drop_private_opens=True, email_events={"Peeked": "opened"},
        storefront_consent_wins=True, campaign_name_pattern=r"(?P<year>\d{4})-(?P<quarter>Q\d)", insight_level="ad_set",
        synthetic_orders=True, disputes_as_refunds=True)
    seeds = {n: shop.seeds()[n] for n in shop.seeds()}
    seeds["channel_overrides"] = small_table(spark, [("shopify", "web", "own_site", "Own site", "own", "own", False, "own", None), ("shopify", "pos", "retail_pos", None, None, None, None, None, None)], SEED_SCHEMAS["channel_mapping"])
    off, made = (Warehouse(spark, shop.raw, s, replace(PARAMS, rules=r)) for s, r in ((shop.seeds(), Rules()), (seeds, on)))
    assert made["fact_web_sessions"].count() < off["fact_web_sessions"].count()
    assert {"name_year", "name_quarter"} <= set(made["int_campaign_names"].columns)
    assert "ad_set_id" in made["int_marketing_insights"].columns and "ad_set_id" not in off["int_marketing_insights"].columns
    orders, loose = made["fact_orders"], off["stg_stripe__charges"].filter("shopify_order_id is null and is_paid").count()
    assert orders.columns == off["fact_orders"].columns and orders.count() == off["fact_orders"].count() + loose and loose
    direct = orders.filter(F.col("order_id").startswith("stripe_"))
    assert direct.join(made["dim_channel"].filter("channel_id = 'stripe_direct'"), "channel_sk").count() == loose
    assert direct.filter("net_amount is null or order_sk is null or _record_hash is null or order_status <> 'paid'").count() == 0
    assert made["fact_refunds"].filter("refund_type = 'chargeback'").count() == off["stg_stripe__disputes"].count() > 0
    assert "own_site" in {r.channel_id for r in made["dim_channel"].collect()} and "own_site" not in {r.channel_id for r in off["dim_channel"].collect()}
    assert made["dim_channel"].count() == made["dim_channel"].select("channel_id").distinct().count()
    tagged = made["stg_shopify__customers"].filter("customer_tags_raw ilike '%vip%'")
    assert tagged.filter("not is_b2b_customer").count() == 0


def test_custom_email_events(spark):
    shop = lab(spark, SF_DIR)
    raw = {n: shop.raw[n] for n in shop.raw}
    raw["klaviyo.events"] = raw["klaviyo.events"].limit(1).withColumn("event_name", F.lit("Peeked"))
    kind = lambda rules: Warehouse(spark, raw, shop.seeds(), replace(PARAMS, rules=rules))["stg_klaviyo__events"].first().event_type
    assert (kind(Rules()), kind(Rules(email_events={"Peeked": "opened"}))) == ("other", "opened")


def test_account_currency_reaches_spend(spark):
    shop = lab(spark, SF_DIR)
    raw = {n: shop.raw[n] for n in shop.raw}
    raw["meta_ads.daily_insights"] = raw["meta_ads.daily_insights"].withColumn("account_currency", F.lit("eur"))
    spend = Warehouse(spark, raw, shop.seeds(), PARAMS)["fact_marketing_spend"]
    assert {r.original_currency_code for r in spend.select("original_currency_code").distinct().collect()} == {"EUR"}
    assert spend.filter("spend_amount <> original_spend_amount").count() > 0


def test_erasure_reaches_stored_rows(spark):
    """A request made after a load wipes the customer's history and the orders stored before it."""
    shop, database = lab(spark, SF_DIR), f"erased_{uuid.uuid4().hex}"
    spark.sql(f"create database {database}")
    names = ["snap_customer", "dim_customer", "fact_orders"]

    def run(seeds):
        return stored_run(spark, database, shop.raw, seeds, PARAMS, names=names, kept=SHARED | {*names})

    seeds = {n: shop.seeds()[n] for n in shop.seeds()}
    first = run(seeds)
    total, holds = first["fact_orders"].count(), F.coalesce(*ORDER_PERSONAL).isNotNull()
    who = [r.customer_id for r in first["fact_orders"].filter(holds & F.col("customer_id").isNotNull()).groupBy("customer_id").count().orderBy(F.desc("count"), "customer_id").limit(3).collect()]
    other = first["fact_orders"].filter(holds & ~F.col("customer_id").isin(who)).count()
    requests = [(who[0], date(2026, 1, 1), "a", "full_erasure"), (who[1], date(2026, 1, 1), "b", "marketing_only"), (who[2], date(2030, 1, 1), "c", "full_erasure"), (who[0], date(2026, 2, 1), "d", None)]
    seeds["erasure_requests"] = small_table(spark, requests, SEED_SCHEMAS["erasure_requests"])
    for _ in range(2):
        made = run(seeds)
        orders = made["fact_orders"]
        assert orders.count() == total == orders.select("order_id").distinct().count()
        assert {r.customer_id for r in orders.filter(holds & F.col("customer_id").isin(who)).select("customer_id").distinct().collect()} == set(who[1:])
        assert orders.filter(holds & ~F.col("customer_id").isin(who)).count() == other
        people = {(r.customer_id, r.email_hash is None, r.marketing_consent) for r in made["dim_customer"].filter(F.col("customer_id").isin(who)).collect()}
        assert {p for p in people if p[0] == who[0]} == {(who[0], True, False)}
        assert {p[:2] for p in people if p[0] == who[1]} == {(who[1], False)} and not any(c for i, _, c in people if i == who[1])
        assert {p[:2] for p in people if p[0] == who[2]} == {(who[2], False)}


def test_shared_skus_do_not_double_lines_and_stock(spark):
    shop = lab(spark, SF_DIR)
    raw = {n: shop.raw[n] for n in shop.raw}
    for name in ("shopify.product_variants", "shopify.order_line_items", "shopify.inventory_items"):
        raw[name] = raw[name].withColumn("sku", F.lit("S"))
    made = Warehouse(spark, raw, shop.seeds(), replace(PARAMS, product_key="variant", snapshot_mode="today"))
    lines = made["fact_order_lines"]
    assert lines.count() == made["stg_shopify__order_line_items"].count()
    assert lines.select("product_sk").distinct().count() > 100
    assert made["fact_inventory_snapshot"].count() == made["stg_shopify__inventory_levels"].count()


def test_settings_are_checked():
    with pytest.raises(ValueError, match="pii_salt"):
        Params(as_of=date(2026, 1, 1))
    with pytest.raises(ValueError, match="insight_level"):
        Rules(insight_level="planet")
