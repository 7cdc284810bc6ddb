"""Optional, configuration-driven rules."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import classify as C
from tallyhouse.functions.keys import surrogate_key, with_audit
from tallyhouse.operators.fx import with_fx_rate
from tallyhouse.params import B2bRule, Params
from tallyhouse.plans.facts import spend_rollup

GRANULARITY = {
    "campaign": ["campaign_id", "spend_date"],
    "ad_set": ["campaign_id", "ad_set_id", "spend_date"],
    "ad": ["campaign_id", "ad_set_id", "ad_id", "spend_date"],
}


def flag_b2b(
    customers: DataFrame, patterns: Sequence[str] = B2bRule().patterns, company_required: bool = False,
    min_order_amount: float | None = None,
) -> DataFrame:
    """Business flag: a tag pattern, a company name when asked for, or a high average order value."""
    by_tag = C.contains_any(F.lower(F.coalesce("customer_tags_raw", F.lit(""))), patterns)
    rule = by_tag
    if company_required:
        rule = rule | F.coalesce(F.length(F.trim("company")) > 0, F.lit(False))
    if min_order_amount is not None:
        average = F.try_divide(F.col("total_spent").cast("double"), F.col("orders_count").cast("double"))
        rule = rule | F.coalesce(average > min_order_amount, F.lit(False))
    return customers.withColumn("is_b2b_customer", rule)


def without_private_opens(events: DataFrame, pattern: str = r"(?i)mail ?privacy|GoogleImageProxy|Mozilla/5\.0$") -> DataFrame:
    """Drop opens pre-fetched by mail privacy proxies, told by the user agent in the properties."""
    agent = F.try_variant_get("event_properties", "$.user_agent", "string")
    machine = (F.col("event_type") == "opened") & F.coalesce(agent.rlike(pattern), F.lit(False))
    return events.filter(~machine)


def parse_campaign_name(campaigns: DataFrame, pattern: str, column: str = "campaign_name") -> DataFrame:
    """One column per named group of the pattern; no match gives NULL."""
    names = sorted(re.compile(pattern).groupindex.items(), key=lambda kv: kv[1])
    plain = re.sub(r"\(\?P<(\w+)>", "(", pattern)
    got = {f"name_{n}": F.nullif(F.regexp_extract(column, plain, i), F.lit("")) for n, i in names}
    return campaigns.withColumns(got)


def insights_at(insights: DataFrame, level: str) -> DataFrame:
    """Insights at campaign, ad set or ad level."""
    return spend_rollup(insights, GRANULARITY[level])


def conversion_ratio_alerts(platform: DataFrame, warehouse: DataFrame, warn: float = 3.0, error: float = 10.0) -> DataFrame:
    """Platform-reported over own conversions per campaign, with the alert level."""
    both = platform.groupBy("campaign_id").agg(F.sum("conversions").cast("double").alias("platform_conversions")).join(
        warehouse.groupBy("campaign_id").agg(F.sum("conversions").cast("double").alias("warehouse_conversions")), "campaign_id", "left"
    )
    share = F.try_divide("platform_conversions", "warehouse_conversions")
    level = F.when(share > error, "error").when(share > warn, "warn").otherwise("pass")
    return both.select("campaign_id", "platform_conversions", "warehouse_conversions", share.alias("ratio"), level.alias("status"))


def reconcile_charges(orders: DataFrame, charges: DataFrame, tolerance_pct: float = 0.5) -> DataFrame:
    """Orders and charges that disagree by more than the tolerance or lack a counterpart.

    Charges are summed per order first, so the full outer join is one to one.
    """
    paid = charges.filter(F.col("shopify_order_id").isNotNull()).groupBy(F.col("shopify_order_id").alias("order_id")).agg(
        F.sum("charge_amount").alias("charged_amount")
    )
    joined = orders.select("order_id", F.col("net_amount").alias("order_amount")).join(paid, "order_id", "full_outer")
    off = F.try_divide(
        F.abs(F.col("order_amount") - F.col("charged_amount")).cast("double"), F.abs("order_amount").cast("double")
    ) * 100.0
    kind = (
        F.when(F.col("charged_amount").isNull(), "order_only")
        .when(F.col("order_amount").isNull(), "charge_only")
        .when(F.coalesce(off > tolerance_pct, F.col("charged_amount") != 0), "mismatch")
    )
    return joined.select("order_id", "order_amount", "charged_amount", off.alias("diff_pct"), kind.alias("issue")).filter(
        F.col("issue").isNotNull()
    )


def synthetic_orders(charges: DataFrame, channel_id: str = "stripe_direct") -> DataFrame:
    """Order rows for charges that belong to no storefront order."""
    loose = charges.filter(F.col("shopify_order_id").isNull())
    return loose.select(
        F.concat(F.lit("stripe_"), "charge_id").alias("order_id"),
        surrogate_key([F.concat(F.lit("stripe_"), F.col("charge_id"))]).alias("order_sk"),
        F.col("charge_timestamp").alias("order_timestamp"),
        F.col("charge_timestamp").cast("date").alias("order_date"),
        F.col("charge_amount").cast("decimal(18,4)").alias("gross_amount"),
        F.col("charge_amount").cast("decimal(18,4)").alias("net_amount"),
        F.col("currency_code").alias("original_currency_code"),
        surrogate_key([F.lit(channel_id)]).alias("channel_sk"),
        F.lit("stripe").alias("_source_system"),
    )


def direct_orders(charges: DataFrame, fx_rates: DataFrame, params: Params) -> DataFrame:
    """``synthetic_orders`` of paid charges in the layout of ``fact_orders`` and in reporting currency.

    Columns that a charge knows nothing about are left to the union that adds these rows.
    """
    made = synthetic_orders(charges.filter("is_paid")).drop("_source_system")
    df = with_fx_rate(made, fx_rates, currency="original_currency_code", on="order_date", reporting_currency=params.reporting_currency)
    rate = F.col("fx_rate")
    out = df.withColumns({
        "original_gross_amount": F.col("gross_amount"),
        **{c: C.convert(F.col(c).cast("decimal(18,6)"), rate) for c in ("gross_amount", "net_amount")},
        "net_after_refunds": C.convert(F.col("net_amount").cast("decimal(18,6)"), rate),
        **{c: F.lit(0).cast("decimal(18,4)") for c in ("discount_amount", "tax_amount", "shipping_amount", "tip_amount", "refunded_amount")},
        "order_number": F.col("order_id"), "order_status": F.lit("paid"), "financial_status": F.lit("paid"),
        "currency_code": F.lit(params.reporting_currency),
        "fx_rate_to_reporting": F.coalesce(rate, F.lit(1).cast("decimal(18,8)")), "is_fx_rate_missing": rate.isNull(),
        **{c: F.lit(False) for c in ("is_first_order", "is_repeat_order", "is_subscription_order", "is_test_order")},
        "created_at": F.col("order_timestamp"), "updated_at": F.col("order_timestamp"),
        "loaded_at": F.lit(params.as_of).cast("timestamp"),
    }).drop("fx_rate")
    return with_audit(out, params, model="fact_orders", source_system="stripe", record_id="order_id",
                      business_columns=["order_id", "updated_at"], extracted_at="order_timestamp")
