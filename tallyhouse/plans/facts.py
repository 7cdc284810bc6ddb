"""Facts. Inputs are staged tables, dimensions and other facts; outputs carry the audit footer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.functions import classify as C
from tallyhouse.functions.json_ops import sum_items, to_decimal
from tallyhouse.functions.keys import date_key, packed, surrogate_key, unpacked, with_audit
from tallyhouse.operators.dedup import latest_per_key
from tallyhouse.operators.fx import with_fx_rate
from tallyhouse.operators.intervals import point_in_time_join
from tallyhouse.operators.lookup import country_level, join_known, lookup_with_wildcard, override_channels
from tallyhouse.operators.snapshots import bucket_totals, snapshot_days, trailing_sums, trailing_totals
from tallyhouse.operators.upsert import since_cutoff
from tallyhouse.params import Params

ORDER_AMOUNTS = ("gross_amount", "discount_amount", "tax_amount", "shipping_amount", "tip_amount", "net_amount")
META_CHANNEL = "paid_social_meta"


# ---- Orders -------------------------------------------------------------------------------
def under(rows: DataFrame, touched: DataFrame | None, key: str = "order_id") -> DataFrame:
    """The rows of touched orders; all rows where nothing limits them."""
    return rows if touched is None else rows.join(touched.select(F.col("order_id").alias(key)), key, "left_semi")


def is_paid_back(item: Column) -> Column:
    """A refund transaction that went through."""
    return (F.lower(item["kind"]) == "refund") & (F.lower(item["status"]) == "success")


def refund_totals(refunds: DataFrame) -> DataFrame:
    """Amount paid back per order, in order currency."""
    paid = sum_items(F.col("refund_transactions"), "amount", is_paid_back)
    return refunds.groupBy("order_id").agg(F.sum(paid).cast("decimal(18,6)").alias("refunded_amount_local"))


def payment_lookup(payment_methods: DataFrame) -> DataFrame:
    """(type, brand) -> surrogate key, with brand ``*`` for any; the smallest method id wins.

    Resolving on this small table turns the conditional lookup into one equality join.
    """
    best = F.min(F.struct("payment_method_id", "payment_method_sk"))["payment_method_sk"]
    any_brand = payment_methods.groupBy("payment_method_type").agg(best.alias("payment_method_sk"))
    by_brand = payment_methods.filter(F.col("card_brand").isNotNull()).groupBy("payment_method_type", "card_brand").agg(
        best.alias("payment_method_sk")
    )
    both = any_brand.select("payment_method_type", F.lit("*").alias("brand"), "payment_method_sk").unionByName(
        by_brand.select("payment_method_type", F.col("card_brand").alias("brand"), "payment_method_sk")
    )
    # Grouped, so that the optimizer sees one row per key and drops the lookup where nothing reads it.
    return both.groupBy("payment_method_type", "brand").agg(F.min("payment_method_sk").alias("payment_method_sk"))


def charge_payment_methods(charges: DataFrame, payment_methods: DataFrame) -> DataFrame:
    """Payment method of each order's newest charge.

    The newest charge is a grouped maximum and not a rank, so that the optimizer sees one row per order:
    where nothing reads the payment method, charges are not read at all.
    """
    linked = charges.filter(F.col("shopify_order_id").isNotNull()).select(
        F.col("shopify_order_id").alias("order_id"), "charge_id", "charge_timestamp",
        F.lower(F.coalesce("payment_type", F.lit("unknown"))).alias("raw"),
        F.lower(F.coalesce("card_brand", F.lit(""))).alias("brand"),
        F.lower(F.coalesce("card_wallet", F.lit(""))).alias("wallet"),
    )
    newest = linked.groupBy("order_id").agg(F.max(F.struct("charge_timestamp", "charge_id", "raw", "brand", "wallet")).alias("_newest"))
    newest = newest.select("order_id", "_newest.raw", "_newest.brand", "_newest.wallet")
    by_brand = (F.col("raw") == "card") & (F.col("brand") != "")
    keyed = newest.select(
        "order_id",
        C.payment_type(F.col("raw"), F.col("wallet"), observed=False).alias("payment_method_type"),
        F.when(by_brand, F.col("brand")).otherwise(F.lit("*")).alias("brand"),
    )
    return keyed.join(payment_lookup(payment_methods), ["payment_method_type", "brand"], "left").select(
        "order_id", "payment_method_sk"
    )


def fact_orders(
    enriched: DataFrame, refunds: DataFrame, charges: DataFrame, *, dim_customer: DataFrame,
    dim_channel: DataFrame, dim_geography: DataFrame, dim_payment_method: DataFrame, fx_rates: DataFrame,
    channel_mapping: DataFrame, params: Params, existing: DataFrame | None = None, links: DataFrame | None = None,
    touched: DataFrame | None = None,
) -> DataFrame:
    """One row per order in reporting currency, with its dimension keys and attribution.

    ``touched`` (``order_id``) limits a second run to these orders; so does ``existing``, the stored
    fact, to orders updated since. Refunds and charges are then read for these orders only.

    With ``links`` (``customer_links``) an order finds its customer through every storefront id
    that was merged into that customer, not only through the newest one.

    ``enriched`` are the staged orders with their line counts and first/repeat flags.

    Everything keyed by order id joins first, so those joins share one partitioning of the
    orders; customer versions follow; rates, channels and countries are small lookups.
    """
    recent = under(since_cutoff(enriched, existing, "updated_at", params.lookback_days["fact_orders"]), touched)
    refunds, charges = under(refunds, touched), under(charges, touched, "shopify_order_id")
    df = (
        recent.join(refund_totals(refunds), "order_id", "left")
        .join(charge_payment_methods(charges, dim_payment_method), "order_id", "left")
    )
    df = with_fx_rate(df, fx_rates, currency="original_currency_code", on="order_date",
                      reporting_currency=params.reporting_currency)
    key = "shopify_customer_id"
    if links is not None:
        known = links.filter(F.col("source_system") == "shopify").select(F.col("source_id").alias(key), F.col("customer_id").alias("_linked"))
        df = join_known(df, known, key, "order_id")
    df = point_in_time_join(
        df, dim_customer, fact_key=key if links is None else "_linked", version_key=key if links is None else "customer_id", at="order_timestamp",
        take={"customer_sk": "customer_sk", "customer_id": "customer_id"},
    )
    df = df.withColumn("_traffic", C.order_traffic_key(F.col("utm_source"), F.col("utm_medium"), F.col("source_name")))
    shop_channels = channel_mapping.filter(F.col("source_system") == "shopify")
    df = lookup_with_wildcard(df, shop_channels, fact_key="_traffic", map_key="source_value", value="channel_id", out="_channel_id")
    # Grouped by its key, so that the optimizer drops the lookup where nothing reads it.
    channels = dim_channel.groupBy(F.col("channel_id").alias("_channel_id")).agg(F.max("channel_sk").alias("channel_sk"))
    df = df.join(channels, "_channel_id", "left")
    countries = country_level(dim_geography).select(F.col("country_code").alias("shipping_country_code"), "geography_sk")
    df = df.join(countries, "shipping_country_code", "left")
    rate, back = F.col("fx_rate"), F.coalesce("refunded_amount_local", F.lit(0)).cast("decimal(18,6)")
    out = df.select(
        surrogate_key(["order_id"]).alias("order_sk"), "order_id", "order_number",
        "customer_sk", "customer_id", "channel_sk", "geography_sk", "payment_method_sk",
        "order_date", "order_timestamp", "order_status", "fulfillment_status", "financial_status",
        *[C.convert(F.col(c), rate).alias(c) for c in ORDER_AMOUNTS],
        C.convert(back, rate).alias("refunded_amount"),
        C.convert((F.col("net_amount") - back).cast("decimal(18,6)"), rate).alias("net_after_refunds"),
        F.lit(params.reporting_currency).alias("currency_code"), "original_currency_code",
        F.col("gross_amount").cast("decimal(18,4)").alias("original_gross_amount"),
        F.coalesce(rate, F.lit(1).cast("decimal(18,8)")).alias("fx_rate_to_reporting"),
        (rate.isNull()).alias("is_fx_rate_missing"),
        "line_item_count", "total_quantity", "is_first_order", "is_repeat_order",
        "is_subscription_order", "is_test_order", F.col("discount_codes_raw").alias("discount_codes"), "primary_discount_code",
        F.split(F.coalesce("tags_raw", F.lit("")), ",").alias("tags"), "note",
        "utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term", "referrer_url", "landing_page_url", "cart_id",
        "customer_email_hash_at_order", "ip_address_hash", "device_category", C.null_as("string").alias("browser"),
        F.col("order_timestamp").alias("created_at"), "updated_at", F.lit(params.as_of).cast("timestamp").alias("loaded_at"),
        "_extracted_at",
    )
    return with_audit(out, params, model="fact_orders", source_system="shopify", record_id="order_id",
                      business_columns=["order_id", "updated_at"], extracted_at="_extracted_at")


# ---- Lines --------------------------------------------------------------------------------
def refund_items(refunds: DataFrame, keys: tuple[str, ...] = ("order_id", "refund_id")) -> DataFrame:
    """The lines that refunds name, as in their payloads.

    An outer explode: for an inner one the optimizer adds a filter on the array's size, which
    would parse the payload a second time.
    """
    items = refunds.select(*keys, F.explode_outer("refund_line_items").alias("i")).filter(F.col("i.line_item_id").isNotNull())
    return items.select(*keys, "i.line_item_id", "i.quantity", "i.subtotal")


def refunded_lines(items: DataFrame) -> DataFrame:
    """Returned units and amount per (order, line), out of ``refund_items``."""
    return items.groupBy("order_id", "line_item_id").agg(
        F.sum(to_decimal(F.col("quantity"), 18, 2)).cast("decimal(18,2)").alias("refunded_quantity"),
        F.sum(to_decimal(F.col("subtotal"), 18, 6)).cast("decimal(18,6)").alias("refunded_amount_local"),
    )


def line_margin(net: Column, quantity: Column, unit_cost: Column, rate: Column) -> Column:
    """Net less cost of goods; NULL when the cost is unknown."""
    return C.convert((net - quantity * unit_cost).cast("decimal(18,6)"), rate)


def fact_order_lines(
    lines: DataFrame, orders: DataFrame, refunds: DataFrame, dim_product: DataFrame, params: Params,
    touched: DataFrame | None = None,
) -> DataFrame:
    """One row per order line with the product version of the order day, cost, margin and returns.

    Products are found by SKU, or with ``product_key="variant"`` by variant: then a line stays one
    row where variants share a SKU.
    """
    product_key = "variant_id" if params.product_key == "variant" else "sku"
    recent, refunds, orders = under(lines, touched), under(refunds, touched), under(orders, touched)
    keys = ("order_sk", "customer_sk", "channel_sk")  # as bytes through the shuffles by order and by product
    ctx = orders.select("order_id", *[packed(c).alias(c) for c in keys], "order_date", "order_timestamp", "fx_rate_to_reporting")
    df = recent.join(ctx, "order_id", "left").join(refunded_lines(refund_items(refunds, ("order_id",))), ["order_id", "line_item_id"], "left")  # one shuffle by order
    df = point_in_time_join(
        df, dim_product, fact_key=product_key, version_key=product_key, at="order_date", by_date=True,
        take={"product_sk": "product_sk", "unit_cost": "_cost"},
    ).withColumns({c: unpacked(c) for c in keys})
    rate, qty = F.col("fx_rate_to_reporting"), F.col("quantity").cast("decimal(18,2)")
    back = F.coalesce("refunded_quantity", F.lit(0)).cast("decimal(18,2)")
    back_amount = F.coalesce("refunded_amount_local", F.lit(0)).cast("decimal(18,6)")
    amounts = ("line_subtotal", "line_discount", "line_tax", "line_net_amount")
    out = df.select(
        surrogate_key(["line_item_id"]).alias("line_item_sk"), "line_item_id", "order_sk", "order_id", "customer_sk",
        "product_sk", "sku", "product_title_at_sale", "channel_sk", "order_date", qty.alias("quantity"),
        F.col("unit_price").cast("decimal(18,4)").alias("unit_price"), F.col("_cost").cast("decimal(18,4)").alias("unit_cost"),
        *[C.convert(F.col(c), rate).alias(c) for c in amounts],
        line_margin(F.col("line_net_amount"), qty, F.col("_cost"), rate).alias("line_gross_margin"),
        "was_promotional", back.alias("refunded_quantity"), C.convert(back_amount, rate).alias("refunded_amount"),
        (back > 0).alias("is_returned"), F.lit(params.reporting_currency).alias("currency_code"),
        F.col("order_timestamp").alias("created_at"), F.lit(params.as_of).cast("timestamp").alias("loaded_at"), "_extracted_at",
    )
    return with_audit(out, params, model="fact_order_lines", source_system="shopify", record_id="line_item_id",
                      business_columns=["line_item_id", "order_id"], extracted_at="_extracted_at")


# ---- Refunds ------------------------------------------------------------------------------
def processor_context(charges: DataFrame, processor_refunds: DataFrame) -> DataFrame:
    """Newest charge of each order with the reason of its refund."""
    back = processor_refunds.select("charge_id", F.col("refund_id").alias("_rid"), F.lower(F.coalesce("refund_reason", F.lit(""))).alias("reason"))
    linked = charges.filter(F.col("shopify_order_id").isNotNull()).select(
        F.col("shopify_order_id").alias("order_id"), "charge_id", "charge_timestamp"
    )
    newest = latest_per_key(linked, ["order_id"], "charge_timestamp", F.desc("charge_id"))
    with_reason = newest.join(back, "charge_id", "left")
    return with_reason.groupBy("order_id").agg(
        F.max("charge_id").alias("charge_id"), F.min(F.struct("_rid", "reason"))["reason"].alias("processor_reason")
    )


def fact_refunds(
    refunds: DataFrame, orders: DataFrame, charges: DataFrame, processor_refunds: DataFrame, params: Params,
    touched: DataFrame | None = None, disputes: DataFrame | None = None,
) -> DataFrame:
    """One row per refund: amount, type, category, processor. Payload sums happen inside the row.

    With ``disputes`` given, cardholder disputes are added as refunds of type ``chargeback``.
    """
    recent, known_charges = under(refunds, touched), under(charges, touched, "shopify_order_id")
    txns = F.col("refund_transactions")
    shipping = lambda t: is_paid_back(t) & F.lower(F.coalesce(t["reason"], F.lit(""))).contains("shipping")
    ctx = orders.select("order_id", "order_sk", "customer_sk", "net_amount", "fx_rate_to_reporting", "original_currency_code")
    df = (
        recent.withColumns({"_amount": sum_items(txns, "amount", is_paid_back), "_ship": sum_items(txns, "amount", shipping)})
        .join(ctx, "order_id", "left")
        .join(processor_context(known_charges, processor_refunds), "order_id", "left")
        .withColumns({
            "refund_type": C.refund_type(F.col("_amount"), F.col("net_amount")),
            "is_chargeback": F.coalesce(F.col("processor_reason") == "fraudulent", F.lit(False)),
        })
        .select("refund_id", "order_sk", "order_id", "customer_sk", "refund_date", "refund_timestamp", "refund_type",
                "refund_note", "_amount", "_ship", "fx_rate_to_reporting", "original_currency_code", "charge_id",
                "is_chargeback", "_extracted_at")
    )
    if disputes is not None:
        charge_orders = charges.select("charge_id", F.col("shopify_order_id").alias("order_id"))
        extra = disputes.join(charge_orders, "charge_id", "left").join(ctx, "order_id", "left").select(
            F.concat(F.lit("dispute_"), "dispute_id").alias("refund_id"), "order_sk", "order_id", "customer_sk",
            F.to_date(F.from_utc_timestamp("dispute_timestamp", params.reporting_timezone)).alias("refund_date"),
            F.col("dispute_timestamp").alias("refund_timestamp"), F.lit("chargeback").alias("refund_type"),
            F.col("dispute_reason").alias("refund_note"), F.col("dispute_amount").cast("decimal(18,6)").alias("_amount"),
            F.lit(0).cast("decimal(18,6)").alias("_ship"), "fx_rate_to_reporting", "original_currency_code", "charge_id",
            F.lit(True).alias("is_chargeback"), "_extracted_at",
        )
        if touched is not None:
            extra = extra.join(touched.withColumn("_touched", F.lit(True)), "order_id", "left").filter("_touched or order_id is null").drop("_touched")
        df = df.unionByName(extra)
    rate, none4 = F.col("fx_rate_to_reporting"), F.lit(0).cast("decimal(18,4)")
    out = df.select(
        surrogate_key(["refund_id"]).alias("refund_sk"), "refund_id", "order_sk", "order_id", "customer_sk", "refund_date",
        "refund_timestamp", "refund_type", F.col("refund_note").alias("refund_reason"),
        C.refund_category(F.col("refund_note")).alias("refund_category"),
        C.convert(F.col("_amount"), rate).alias("refund_amount"), none4.alias("refund_tax_amount"),
        C.convert(F.col("_ship"), rate).alias("refund_shipping_amount"), none4.alias("restocking_fee"),
        F.lit(params.reporting_currency).alias("currency_code"), "original_currency_code",
        F.col("_amount").cast("decimal(18,4)").alias("original_refund_amount"),
        F.when(F.col("charge_id").isNotNull(), "stripe").otherwise("shopify").alias("processor"), "is_chargeback",
        C.null_as("string").alias("processed_by"), F.col("refund_note").alias("note"),
        F.col("refund_timestamp").alias("created_at"), F.lit(params.as_of).cast("timestamp").alias("loaded_at"), "_extracted_at",
    )
    return with_audit(out, params, model="fact_refunds", source_system="shopify", record_id="refund_id",
                      business_columns=["refund_id", "order_id"], extracted_at="_extracted_at")


# ---- Marketing, web, email ----------------------------------------------------------------
def spend_rollup(insights: DataFrame, keys: list[str]) -> DataFrame:
    """Insights summed to any level, by default the campaign and day."""
    return insights.groupBy(*keys).agg(
        F.sum("spend_amount_local").cast("decimal(18,6)").alias("spend_amount_local"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("platform_reported_conversions").alias("conversions"),
        F.sum("platform_reported_conversion_value").alias("conversion_value"),
    )


def fact_marketing_spend(
    insights: DataFrame, *, dim_marketing_campaign: DataFrame, dim_channel: DataFrame, fx_rates: DataFrame, params: Params,
    existing: DataFrame | None = None,
) -> DataFrame:
    """One row per campaign and day. Without the ad channel in the channel dimension there are no rows.

    Accounts are taken to be in reporting currency, rate 1, unless the insights bring an
    ``account_currency``; then each campaign's currency is converted by the day's rate.
    """
    recent = since_cutoff(insights, existing, "spend_date", params.lookback_days["fact_marketing_spend"])
    keys = ["campaign_id", "spend_date"]
    if "account_currency" in insights.columns:
        df = spend_rollup(recent, [*keys, "account_currency"])
        df = with_fx_rate(df, fx_rates, currency="account_currency", on="spend_date", reporting_currency=params.reporting_currency)
    else:
        df = spend_rollup(recent, keys).withColumns(
            {"account_currency": F.lit(params.reporting_currency), "fx_rate": F.lit(1).cast("decimal(18,8)")}
        )
    df = point_in_time_join(
        df, dim_marketing_campaign, fact_key="campaign_id", version_key="campaign_id", at="spend_date", by_date=True,
        take={"campaign_sk": "campaign_sk"},
    )
    channel = dim_channel.filter(F.col("channel_id") == META_CHANNEL).agg(F.max("channel_sk")).scalar()
    out = df.withColumn("channel_sk", channel).filter(F.col("channel_sk").isNotNull()).select(
        surrogate_key(["campaign_id", "spend_date"]).alias("spend_sk"), "campaign_sk", "campaign_id", "channel_sk",
        C.null_as("string").alias("geography_sk"), "spend_date", date_key("spend_date").alias("date_sk"),
        C.convert(F.col("spend_amount_local"), F.col("fx_rate")).alias("spend_amount"),
        F.lit(params.reporting_currency).alias("currency_code"), F.col("account_currency").alias("original_currency_code"),
        F.col("spend_amount_local").cast("decimal(18,4)").alias("original_spend_amount"), "impressions", "clicks",
        F.col("conversions").cast("decimal(18,0)").alias("conversions_reported_by_platform"),
        F.col("conversion_value").cast("decimal(18,4)").alias("conversion_value_reported_by_platform"),
        F.lit(params.as_of).cast("timestamp").alias("loaded_at"),
    )
    return with_audit(out, params, model="fact_marketing_spend", source_system="meta_ads",
                      record_id=F.concat_ws("_", "campaign_id", F.col("spend_date").cast("string")),
                      business_columns=["campaign_id", "spend_date"], extracted_at="spend_date")


def fact_web_sessions(
    sessions: DataFrame, *, dim_customer: DataFrame, dim_channel: DataFrame, dim_geography: DataFrame,
    channel_mapping: DataFrame, params: Params, existing: DataFrame | None = None, traffic_overrides: DataFrame | None = None,
) -> DataFrame:
    """One row per session with customer, channel and country.

    ``traffic_overrides`` (``source``, ``medium``, ``canonical_channel``) sets the channel of listed
    pairs, whatever the mapping says.

    A login id may be the canonical customer id or the storefront's id, a country may come as
    code or as name; each pair is folded into one lookup table and one equality join.
    """
    recent = since_cutoff(sessions, existing, "session_date", params.lookback_days["fact_web_sessions"])
    now = dim_customer.filter("is_current")
    ids = now.select(F.col("customer_id").alias("user_id"), "customer_sk", "customer_id").unionByName(
        now.filter(F.col("shopify_customer_id").isNotNull()).select(
            F.col("shopify_customer_id").alias("user_id"), "customer_sk", "customer_id"
        )
    )
    geo = country_level(dim_geography)
    places = geo.select(F.col("country_code").alias("geo_country"), "geography_sk").unionByName(
        geo.filter(F.col("country_name") != F.col("country_code")).select(F.col("country_name").alias("geo_country"), "geography_sk")
    )
    df = recent.withColumn("_traffic", C.session_traffic_key(F.col("traffic_source"), F.col("traffic_medium")))
    web_channels = channel_mapping.filter(F.col("source_system") == "ga4")
    df = lookup_with_wildcard(df, web_channels, fact_key="_traffic", map_key="source_value", value="channel_id", out="_channel_id")
    if traffic_overrides is not None:
        df = override_channels(df, traffic_overrides, "traffic_source", "traffic_medium", "_channel_id")
    df = (
        df.join(dim_channel.select(F.col("channel_id").alias("_channel_id"), "channel_sk"), "_channel_id", "left")
        .join(places, "geo_country", "left")
    )
    df = join_known(df, ids, "user_id", "session_id")
    out = df.select(
        surrogate_key(["session_id"]).alias("session_sk"), "session_id", "user_pseudo_id", "customer_sk", "customer_id",
        "channel_sk", "geography_sk", "session_date", "session_start_timestamp", "session_duration_seconds", "page_views",
        "events_count", "device_category", C.null_as("string").alias("device_brand"), "device_os", "browser",
        "traffic_source", "traffic_medium", "traffic_campaign", C.null_as("string").alias("traffic_content"),
        C.null_as("string").alias("traffic_term"), "landing_page", "exit_page", "has_purchase_event",
        F.col("transaction_revenue").cast("decimal(18,4)").alias("transaction_revenue"), "is_new_user",
        F.lit(params.as_of).cast("timestamp").alias("loaded_at"),
    )
    return with_audit(out, params, model="fact_web_sessions", source_system="ga4", record_id="session_id",
                      business_columns=["session_id"], extracted_at="session_start_timestamp")


def fact_email_engagement(
    events: DataFrame, *, dim_customer: DataFrame, dim_email_campaign: DataFrame, params: Params, existing: DataFrame | None = None
) -> DataFrame:
    """One row per e-mail event with customer, campaign and the interesting properties."""
    recent = since_cutoff(events, existing, "event_timestamp", params.lookback_days["fact_email_engagement"])
    people = dim_customer.filter("is_current").filter(F.col("klaviyo_profile_id").isNotNull()).select("klaviyo_profile_id", "customer_sk")
    prop = lambda path: F.try_variant_get("event_properties", path, "string")
    df = (
        recent.withColumn("email_campaign_id", C.email_campaign_id(F.col("campaign_id"), F.col("flow_id")))
        .join(dim_email_campaign.select("email_campaign_id", "email_campaign_sk"), "email_campaign_id", "left")
    )
    df = join_known(df, people, "klaviyo_profile_id", "event_id")
    out = df.select(
        surrogate_key(["event_id"]).alias("event_sk"), "event_id", "customer_sk", "email_campaign_sk", "event_type",
        "event_date", "event_timestamp", prop("$.subject_line").alias("email_subject"), prop("$.url").alias("link_url"),
        C.bounce_type(prop("$.bounce_type")).alias("bounce_type"), prop("$.error_message").alias("bounce_reason"),
        prop("$['$device_type']").alias("device_type"), F.lit(params.as_of).cast("timestamp").alias("loaded_at"), "_extracted_at",
    )
    return with_audit(out, params, model="fact_email_engagement", source_system="klaviyo", record_id="event_id",
                      business_columns=["event_id", "event_timestamp"], extracted_at="_extracted_at")


# ---- Customer state -----------------------------------------------------------------------
def active_customers(dim_customer: DataFrame, as_of: Column) -> DataFrame:
    """Current customers changed within 24 months or consenting, and already acquired."""
    acquired = F.col("acquisition_date").cast("date")
    alive = (F.col("updated_at") >= F.add_months(as_of, -24)) | F.col("marketing_consent")
    return dim_customer.filter(F.col("is_current") & alive & (acquired.isNull() | (acquired <= as_of))).select(
        "customer_sk", "customer_id", acquired.alias("acquired")
    )


def customer_order_metrics(daily: DataFrame, days: DataFrame, grid: DataFrame) -> DataFrame:
    """Lifetime and trailing 30/90-day measures for every (customer, snapshot) of the grid.

    ``daily`` holds one row per customer and day. Lifetime values are running totals over one
    customer's snapshots (a window as long as the list of snapshots); trailing values come from
    an equality join with the few snapshots each day belongs to.
    """
    age = F.datediff("snapshot_date", "order_date")
    in30 = lambda c: F.when(age <= 29, F.col(c)).otherwise(0)
    trailing = trailing_totals(
        daily, days, ["customer_id"], "order_date",
        {"t30_n": F.sum(in30("n")), "t30_rev": F.sum(in30("rev")), "t90_n": F.sum("n"), "t90_rev": F.sum("rev")}, 89, 0,
    )
    fresh = bucket_totals(
        daily, days, ["customer_id"], "order_date",
        {"n": F.sum("n"), "rev": F.sum("rev"), "qty": F.sum("qty"), "lo": F.min("order_date"), "hi": F.max("order_date")},
    )
    key = ["customer_id", "snapshot_date"]
    so_far = W.partitionBy("customer_id").orderBy("snapshot_date")
    wide = grid.join(fresh, key, "full_outer").join(trailing, key, "left")
    return wide.select(
        *key,
        F.coalesce("_wanted", F.lit(False)).alias("_wanted"),
        F.min("lo").over(so_far).alias("first_order_date"),
        F.max("hi").over(so_far).alias("last_order_date"),
        F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("lifetime_order_count"),
        F.coalesce(F.sum("rev").over(so_far), F.lit(0)).cast("decimal(28,4)").alias("lifetime_revenue"),
        F.coalesce(F.sum("qty").over(so_far), F.lit(0)).cast("decimal(28,2)").alias("lifetime_quantity"),
        F.coalesce("t30_n", F.lit(0)).alias("trailing_30d_order_count"),
        F.coalesce("t30_rev", F.lit(0)).cast("decimal(28,4)").alias("trailing_30d_revenue"),
        F.coalesce("t90_n", F.lit(0)).alias("trailing_90d_order_count"),
        F.coalesce("t90_rev", F.lit(0)).cast("decimal(28,4)").alias("trailing_90d_revenue"),
    ).filter("_wanted").drop("_wanted")


def customer_grid(customers: DataFrame, days: DataFrame) -> DataFrame:
    """Each customer on every snapshot day since acquisition, by exploding the list of days."""
    listed = days.agg(F.collect_set("snapshot_date")).scalar()
    every = customers.select("customer_id", "acquired", F.explode(listed).alias("snapshot_date"))
    known = F.col("acquired").isNull() | (F.col("snapshot_date") >= F.col("acquired"))
    return every.filter(known).select("customer_id", "snapshot_date", F.lit(True).alias("_wanted"))


def customer_days(orders: DataFrame, dim_customer: DataFrame, params: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What customer state is made of: orders per customer and day, tracked customers, snapshot days."""
    as_of = F.lit(params.as_of)
    days = snapshot_days("today" if params.snapshot_mode == "today" else "month_end", orders, as_of, "order_date")
    sold = orders.filter(C.not_cancelled(F.col("order_status")) & F.col("customer_id").isNotNull() & (F.col("order_date") <= as_of))
    daily = sold.groupBy("customer_id", "order_date").agg(
        F.count("*").alias("n"), F.sum("net_after_refunds").alias("rev"), F.sum("total_quantity").alias("qty")
    )
    return daily, active_customers(dim_customer, as_of), days


def fact_customer_state_daily(orders: DataFrame, dim_customer: DataFrame, params: Params) -> DataFrame:
    """One row per active customer and snapshot day, all measures as of that day."""
    as_of = F.lit(params.as_of)
    daily, people, days = customer_days(orders, dim_customer, params)
    # Dealt by customer once; what follows groups and joins by customer and day without another exchange, and the grid is made behind it.
    daily, people = daily.repartition("customer_id"), people.repartition("customer_id")
    df = customer_order_metrics(daily, days, customer_grid(people, days)).join(people, "customer_id")
    day = F.col("snapshot_date")
    since = lambda c: F.datediff(day, F.col(c))
    out = df.select(
        surrogate_key(["customer_id", "snapshot_date"]).alias("customer_state_sk"), "customer_sk", "customer_id", "snapshot_date",
        since("acquired").alias("days_since_acquisition"), since("first_order_date").alias("days_since_first_order"),
        since("last_order_date").alias("days_since_last_order"),
        "lifetime_order_count", "lifetime_revenue", "lifetime_quantity", "trailing_30d_order_count", "trailing_30d_revenue",
        "trailing_90d_order_count", "trailing_90d_revenue",
        (F.col("trailing_30d_order_count") > 0).alias("is_active_30d"), (F.col("trailing_90d_order_count") > 0).alias("is_active_90d"),
        (since("acquired") <= 30).alias("is_new_30d"), (F.col("lifetime_order_count") >= 2).alias("is_repeat_customer"),
        *[C.null_as("string").alias(c) for c in ("customer_segment", "rfm_recency_tier", "rfm_frequency_tier", "rfm_monetary_tier")],
        C.null_as("decimal(5,4)").alias("predicted_churn_probability"), C.null_as("decimal(18,4)").alias("predicted_ltv"),
        as_of.cast("timestamp").alias("loaded_at"),
    )
    return with_audit(out, params, model="fact_customer_state_daily", source_system="generated",
                      record_id=F.concat_ws("_", "customer_id", F.col("snapshot_date").cast("string")),
                      business_columns=["customer_id", "snapshot_date"], extracted_at=as_of)


# ---- Inventory ----------------------------------------------------------------------------
def movement_rows(lines: DataFrame, orders: DataFrame, refunds: DataFrame, params: Params, items: DataFrame | None = None) -> DataFrame:
    """A row per sale and per return with the columns of its line; ``_units`` are without sign.

    A line becomes a sale and a return behind the shuffle by order, so lines are sent once for both,
    and a lookup of products behind it sends each movement once. With ``items`` (``refund_items``)
    returns are the units that refunds name.
    """
    kept = F.col("quantity") - F.col("refunded_quantity")
    sold, back = kept if params.sale_quantity == "net" else F.col("quantity"), F.col("refunded_quantity")
    is_sale = F.col("movement_type") == "sale"
    # Plain columns and no structs, so that only those asked for are sent.
    opened = orders.filter(C.not_cancelled(F.col("order_status")) & F.col("order_date").isNotNull()).select(
        F.col("order_id").alias("_opened"), F.col("order_date").alias("_sold_on"), F.col("order_timestamp").alias("_sold_at"), F.col("_extracted_at").alias("_sale_seen"))
    dated = refunds.filter(F.col("refund_date").isNotNull()).select(
        F.col("order_id").alias("_refunded"), "refund_id", F.col("refund_date").alias("_back_on"), F.col("refund_timestamp").alias("_back_at"),
        F.col("refund_reason").alias("_reason"), F.col("_extracted_at").alias("_back_seen"))
    on = ~is_sale & (F.col("order_id") == F.col("_refunded"))
    if items is not None:
        units = items.groupBy("refund_id", F.col("line_item_id").alias("_item")).agg(F.sum(F.col("quantity").try_cast("decimal(18,2)")).alias("units"))
        dated, on, back = dated.join(units.filter(F.col("units") != 0), "refund_id"), on & (F.col("line_item_id") == F.col("_item")), F.col("units")
    wanted = F.when(is_sale, sold != 0).otherwise(F.lit(True) if items is not None else back > 0)
    both = lines.withColumn("movement_type", F.explode(F.array(F.lit("sale"), F.lit("return")))).filter(wanted)
    met = both.join(dated, on, "left").join(opened, is_sale & (F.col("order_id") == F.col("_opened")), "left")  # finer key first: one sort for both
    either = lambda sale, back: F.when(is_sale, sale).otherwise(back)
    return met.filter(either(F.col("_opened"), F.col("_refunded")).isNotNull()).select(
        *lines.columns, "movement_type", "refund_id", either(F.col("_sold_on"), F.col("_back_on")).alias("movement_date"),
        either(F.col("_sold_at"), F.col("_back_at")).alias("movement_timestamp"), either(F.col("_sale_seen"), F.col("_back_seen")).alias("_extracted_at"),
        either(sold, back).alias("_units"), F.when(~is_sale, F.col("_reason")).alias("reason"),
    )


def movement_fact(rows: DataFrame, params: Params) -> DataFrame:
    """``movement_rows`` with product and cost in the shape of the fact."""
    is_sale = F.col("movement_type") == "sale"
    move_id = F.when(is_sale, F.concat(F.lit("sale_"), "line_item_id")).otherwise(F.concat(F.lit("return_"), "refund_id", F.lit("_"), "line_item_id"))
    shaped = rows.select(
        move_id.alias("movement_id"), "product_sk", "sku", C.null_as("string").alias("location_sk"), "movement_date", "movement_timestamp",
        "movement_type", F.when(is_sale, -F.col("_units")).otherwise(F.col("_units")).cast("decimal(18,2)").alias("quantity_change"), "unit_cost",
        (F.col("unit_cost") * F.col("_units")).cast("decimal(18,4)").alias("movement_value"),
        F.col("order_id").alias("reference_order_id"), C.null_as("string").alias("reference_movement_id"), "reason",
        C.null_as("string").alias("note"), C.null_as("string").alias("created_by"), "_extracted_at",
    )
    out = shaped.select(surrogate_key(["movement_id"]).alias("movement_sk"), "*", F.lit(params.as_of).cast("timestamp").alias("loaded_at"))
    return with_audit(out, params, model="fact_inventory_movements", source_system="shopify", record_id="movement_id",
                      business_columns=["movement_id"], extracted_at="_extracted_at")


def fact_inventory_movements(
    order_lines: DataFrame, orders: DataFrame, refunds: DataFrame, params: Params, touched: DataFrame | None = None,
    refund_lines: DataFrame | None = None,
) -> DataFrame:
    """Sales (negative) and returns (positive) per line, of touched orders only where ``touched`` is given.

    Returns follow every refund of the order; with ``refund_lines``, the staged refunds, they are
    the units that each refund's payload names for a line, so no unit comes back twice.
    """
    order_lines, orders, refunds = under(order_lines, touched), under(orders, touched), under(refunds, touched)
    lines = order_lines.select("line_item_id", "order_id", "product_sk", "sku", "quantity", "refunded_quantity", "unit_cost")
    items = None if refund_lines is None else refund_items(refund_lines, ("refund_id",))
    return movement_fact(movement_rows(lines, orders, refunds, params, items), params)


def movements_from_staged(
    lines: DataFrame, orders: DataFrame, refunds: DataFrame, items: DataFrame, dim_product: DataFrame, params: Params,
) -> DataFrame:
    """``fact_inventory_movements`` for a reader of this fact alone: facts of lines and refunds are not made first.

    ``lines`` and ``refunds`` are staged ones, ``items`` their ``refund_items``. Lines stay narrow until they
    have become movements, which then find the product that ``fact_order_lines`` gives their line: one shuffle
    by order and one by product.
    """
    product_key = "variant_id" if params.product_key == "variant" else "sku"
    # Both are dealt by order once, also where orders are few and broadcast: what follows joins by order without another exchange.
    df = lines.repartition("order_id").join(orders.select("order_id", F.col("order_date").alias("_ordered")), "order_id", "left").join(
        refunded_lines(items.repartition("order_id")), ["order_id", "line_item_id"], "left")
    narrow = df.select(
        "line_item_id", "order_id", "sku", F.col(product_key).alias("_product"), "_ordered", F.col("quantity").cast("decimal(18,2)").alias("quantity"),
        F.coalesce("refunded_quantity", F.lit(0)).cast("decimal(18,2)").alias("refunded_quantity"),
    )
    dated = refunds.select("order_id", "refund_id", "refund_date", "refund_timestamp", F.col("refund_note").alias("refund_reason"), "_extracted_at")
    rows = movement_rows(narrow, orders, dated, params, items if params.return_units == "refund_line" else None)
    # As in fact_refunds, a refund comes once for each order row of its id.
    again = orders.select(F.col("order_id").alias("_again"))
    rows = rows.join(again, (F.col("movement_type") == "return") & (F.col("order_id") == F.col("_again")), "left").drop("_again")
    rows = point_in_time_join(
        rows, dim_product, fact_key="_product", version_key=product_key, at="_ordered", by_date=True,
        take={"product_sk": "product_sk", "unit_cost": "_cost"},
    )
    return movement_fact(rows.withColumn("unit_cost", F.col("_cost").cast("decimal(18,4)")), params)


def average_daily_units(order_lines: DataFrame, asked: DataFrame) -> DataFrame:
    """Units per day over the 28 days before each asked (SKU, snapshot), the snapshot day itself left out."""
    totals = trailing_sums(daily_units(order_lines), asked, ["sku"], "order_date", {"units": "units_28d"}, 28, 1)
    return totals.select("sku", "snapshot_date", (F.col("units_28d").cast("double") / 28.0).alias("avg_daily_units_28d"))


def daily_units(order_lines: DataFrame) -> DataFrame:
    """Units sold less those returned, per SKU and day."""
    return order_lines.filter(F.col("sku").isNotNull()).groupBy("sku", "order_date").agg(F.sum(net_units()).cast("decimal(28,2)").alias("units"))


def net_units() -> Column:
    """A line's units less those returned."""
    return (F.col("quantity") - F.col("refunded_quantity")).cast("decimal(18,2)")


def sku_days(days: DataFrame, order_lines: DataFrame | None, movements: DataFrame | None) -> DataFrame:
    """Per SKU an array over the snapshot days in ascending order: units sold in the 28 days before, stock change after.

    A movement falls into the gap behind a snapshot, and a sum from the last gap down gives what came
    after each. Places in the array are places in the sorted list of days, so a reader takes a day's
    values by index. Rows are those of days with a change; the others are filled in inside the array.
    """
    line = W.orderBy("snapshot_date")  # of snapshot days only
    placed = days.select("snapshot_date", F.row_number().over(line).alias("_place"), F.lead("snapshot_date").over(line).alias("_next"))
    none, parts = F.lit(None).cast("decimal(18,2)"), []
    if order_lines is not None:
        before = placed.select("_place", F.explode(F.sequence(F.date_sub("snapshot_date", 28), F.date_sub("snapshot_date", 1))).alias("_day"))
        sold = order_lines.filter(F.col("sku").isNotNull()).join(F.broadcast(before), F.col("order_date") == F.col("_day"))
        parts.append(sold.select("sku", "_place", net_units().alias("units"), none.alias("q")))
    if movements is not None:
        behind = placed.select("_place", F.explode(F.sequence(F.date_add("snapshot_date", 1), "_next")).alias("_day"))
        last = days.agg(F.max("snapshot_date")).scalar()
        met = movements.filter(F.col("sku").isNotNull()).join(F.broadcast(behind), F.col("movement_date") == F.col("_day"), "left")
        place = F.coalesce("_place", F.when(F.col("movement_date") > last, days.agg(F.count("*").cast("int")).scalar()))
        parts.append(met.select("sku", place.alias("_place"), none.alias("units"), F.col("quantity_change").alias("q")).filter(F.col("_place").isNotNull()))
    changes = reduce(DataFrame.unionByName, parts).groupBy("sku", "_place").agg(F.sum("units").cast("decimal(28,2)").alias("units"), F.sum("q").cast("decimal(28,2)").alias("q"))
    per_sku = changes.groupBy("sku").agg(F.sort_array(F.collect_list(F.struct("_place", "units", "q")), asc=False).alias("_changes"))
    zero, unsold, kept = F.lit(0).cast("decimal(38,2)"), F.lit(0.0), lambda q: q.cast("decimal(18,2)")

    def down(held: Column, x: Column) -> Column:
        """One change more, from the last place down: nothing sold and no further change in the places between."""
        between, run = held["at"] - x["_place"] - 1, (held["run"] + F.coalesce(x["q"], zero)).cast("decimal(38,2)")
        sold = F.coalesce(x["units"].cast("double") / 28.0, unsold)
        return F.struct(
            x["_place"].alias("at"), run.alias("run"), F.concat(F.array(sold), F.array_repeat(unsold, between), held["units"]).alias("units"),
            F.concat(F.array(kept(run)), F.array_repeat(kept(held["run"]), between), held["after"]).alias("after"))

    none_yet = lambda kind: F.array().cast(f"array<{kind}>")
    start = F.struct((F.size("_listed") + 1).alias("at"), zero.alias("run"), none_yet("double").alias("units"), none_yet("decimal(18,2)").alias("after"))
    whole = lambda held: F.struct(
        F.concat(F.array_repeat(unsold, held["at"] - 1), held["units"]).alias("units"), F.concat(F.array_repeat(kept(held["run"]), held["at"] - 1), held["after"]).alias("after"))
    listed = days.agg(F.array_sort(F.collect_set("snapshot_date"))).scalar()
    filled = per_sku.withColumn("_listed", listed).select("sku", "_listed", F.aggregate("_changes", start, down, whole).alias("_all"))
    return filled.select("sku", F.arrays_zip(F.col("_listed").alias("snapshot_date"), F.col("_all.units").alias("units"), F.col("_all.after").alias("after")).alias("_by_day"))


def stock_by_day(
    levels: DataFrame, items: DataFrame, days: DataFrame, params: Params, *, order_lines: DataFrame | None = None,
    movements: DataFrame | None = None, daily_feed: DataFrame | None = None,
) -> DataFrame:
    """Stock per (item, location): today's level, rebuilt month-ends, or a row of the daily feed.

    The days lie in the array ``_days`` of day, stock and daily units, so that what follows joins
    items, not items times days, and explodes last.
    """
    costs = items.select("inventory_item_id", "sku", "unit_cost")
    placed = ["location_sk"] if "location_sk" in (daily_feed if params.snapshot_mode == "daily" else levels).columns else []
    columns = ["inventory_item_id", "location_id", *placed, "sku", "unit_cost", "quantity_incoming", "_extracted_at"]
    stock = F.col("quantity_available").cast("decimal(18,2)")
    if params.snapshot_mode == "daily":
        fed = daily_feed.join(costs, "inventory_item_id", "left")
        asked = fed.filter(F.col("sku").isNotNull()).select("sku", "snapshot_date").distinct()
        fed = fed.join(average_daily_units(order_lines, asked), ["sku", "snapshot_date"], "left")
        return fed.select(*columns, F.array(F.struct("snapshot_date", stock.alias("quantity_available"), "avg_daily_units_28d")).alias("_days"))
    listed = days.agg(F.array_sort(F.collect_set("snapshot_date"))).scalar()
    base = levels.join(costs, "inventory_item_id", "left")
    rebuilt = movements if params.snapshot_mode == "month_end" else None
    base = base.join(sku_days(days, order_lines, rebuilt), "sku", "left")

    def on(day: Column, i: Column) -> Column:
        then, at = stock, F.get("_by_day", i)
        if rebuilt is not None:
            then = (stock - F.coalesce(at["after"], F.lit(0))).cast("decimal(18,2)")
            # NULL stock stays NULL: greatest() alone would turn it into 0.
            then = F.when(then.isNotNull(), F.greatest(F.lit(0).cast("decimal(18,2)"), then))
        return F.struct(day.alias("snapshot_date"), then.alias("quantity_available"), at["units"].alias("avg_daily_units_28d"))

    return base.withColumn("_listed", listed).select(*columns, F.transform("_listed", on).alias("_days"))


def days_of_supply(available: Column, daily_units: Column) -> Column:
    """Days the stock lasts; NULL without sales."""
    return F.when(F.coalesce(daily_units, F.lit(0.0)) > 0, (available.cast("double") / daily_units).cast("decimal(18,2)"))


def fact_inventory_snapshot(
    levels: DataFrame, items: DataFrame, order_lines: DataFrame, *, dim_product: DataFrame, dim_warehouse_location: DataFrame,
    params: Params, movements: DataFrame | None = None, daily_feed: DataFrame | None = None,
) -> DataFrame:
    """One row per item, location and snapshot day: stock, value, supply, stock-out."""
    as_of = F.lit(params.as_of)
    if params.snapshot_mode == "daily":
        days = daily_feed.select("snapshot_date").distinct()
    else:
        days = snapshot_days(params.snapshot_mode, order_lines, as_of, "order_date")
    # Places come first: few locations hold all items, and rows are still narrow.
    places = dim_warehouse_location.select("location_id", "location_sk")
    if params.snapshot_mode == "daily":
        daily_feed = daily_feed.join(places, "location_id", "left")
    else:
        levels = levels.join(places, "location_id", "left")
    pos = stock_by_day(levels, items, days, params, order_lines=order_lines, movements=movements, daily_feed=daily_feed)
    products = dim_product.filter("is_current").select("sku", "product_sk")
    if params.product_key == "variant":  # a stock item knows only its SKU: one product each, so that stock is not doubled
        products = products.groupBy("sku").agg(F.min("product_sk").alias("product_sk"))
    df = pos.join(products, "sku", "left").select("*", F.inline("_days")).drop("_days")
    qty, cost = F.col("quantity_available"), F.col("unit_cost")
    out = df.select(
        surrogate_key(["inventory_item_id", "location_id", "snapshot_date"]).alias("inventory_snapshot_sk"),
        "product_sk", "sku", "location_sk", "inventory_item_id", "location_id", "snapshot_date",
        qty.alias("quantity_on_hand"), C.null_as("decimal(18,2)").alias("quantity_committed"), qty.alias("quantity_available"),
        F.col("quantity_incoming").cast("decimal(18,2)").alias("quantity_incoming"), cost.cast("decimal(18,4)").alias("unit_cost"),
        (qty * cost).cast("decimal(18,4)").alias("inventory_value"),
        days_of_supply(qty, F.col("avg_daily_units_28d")).alias("days_of_supply"),
        (qty <= 0).alias("is_out_of_stock"),
        *[C.null_as("boolean").alias(c) for c in ("is_low_stock", "is_overstock", "is_slow_mover")],
        as_of.cast("timestamp").alias("loaded_at"), "_extracted_at",
    )
    record = F.concat_ws("_", "inventory_item_id", "location_id", F.col("snapshot_date").cast("string"))
    return with_audit(out, params, model="fact_inventory_snapshot", source_system="shopify", record_id=record,
                      business_columns=["inventory_item_id", "location_id", "snapshot_date"], extracted_at="_extracted_at")
