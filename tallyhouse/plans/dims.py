"""Dimensions."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import classify as C
from tallyhouse.functions.keys import date_key, surrogate_key, with_audit
from tallyhouse.functions.pii import pii_null
from tallyhouse.operators.dedup import first_per_key
from tallyhouse.operators.scd2 import greatest_or_null
from tallyhouse.params import Params

SNAP_CUSTOMER_CHECKS = (
    "email_hash", "phone_hash", "customer_status", "country_code", "marketing_consent", "email_subscribed",
    "sms_subscribed", "is_b2b_customer",
)


# ---- Calendar -----------------------------------------------------------------------------
def fiscal_year(d: Column, start_month: int) -> Column:
    """Calendar year when the fiscal year starts in January, else the year it ends in."""
    if start_month == 1:
        return F.year(d)
    return F.year(d) + F.when(F.month(d) >= start_month, 1).otherwise(0)


def fiscal_month(d: Column, start_month: int) -> Column:
    return F.pmod(F.month(d) - start_month, F.lit(12)) + 1


def dim_date(spark: SparkSession, params: Params, holidays: DataFrame | None = None) -> DataFrame:
    """One row per day with calendar, fiscal, relative, to-date and trailing attributes."""
    last = F.lit(params.calendar_end) if params.calendar_end_inclusive else F.date_sub(F.lit(params.calendar_end), 1)
    days = spark.range(1).select(F.explode(F.sequence(F.lit(params.calendar_start), last)).alias("date_actual"))
    if holidays is None:
        days = days.withColumn("holiday_name", F.lit(None).cast("string"))
    else:
        named = holidays.filter(F.col("country_code") == params.holiday_country).groupBy(
            F.col("date").cast("date").alias("date_actual")
        ).agg(F.min("holiday_name").alias("holiday_name"))
        days = days.join(named, "date_actual", "left")
    d, today, start = F.col("date_actual"), F.lit(params.as_of), params.fiscal_year_start_month
    fm = fiscal_month(d, start)
    fy, this_fy = fiscal_year(d, start), fiscal_year(today, start)
    weekday = F.weekday(d) + 1
    prior = F.add_months(d, -12)
    same = lambda unit: F.trunc(d, unit) == F.trunc(today, unit)
    upto = lambda unit: d.between(F.trunc(today, unit), today)
    cols = {
        "date_sk": date_key(d),
        "date_actual": d,
        "day_of_week": weekday,
        "day_name": F.date_format(d, "EEE"),
        "day_short_name": F.date_format(d, "EEE"),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "is_weekend": weekday >= 6,
        "is_weekday": weekday <= 5,
        "is_holiday": F.col("holiday_name").isNotNull(),
        "holiday_name": F.col("holiday_name"),
        "is_business_day": (weekday <= 5) & F.col("holiday_name").isNull(),
        "week_of_year": F.weekofyear(d),
        "week_starting_date": F.trunc(d, "week"),
        "week_ending_date": F.date_add(F.trunc(d, "week"), 6),
        "month_number": F.month(d),
        "month_name": F.date_format(d, "MMM"),
        "month_short_name": F.date_format(d, "MMM"),
        "month_starting_date": F.trunc(d, "month"),
        "month_ending_date": F.last_day(d),
        "quarter_number": F.quarter(d),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "year": F.year(d),
        "fiscal_year": fy,
        "fiscal_month": fm,
        "fiscal_quarter": F.ceil(fm / 3.0).cast("int"),
        "prior_year_date_sk": date_key(prior),
        "prior_year_date_actual": prior,
        "days_from_today": F.datediff(d, today),
        "is_today": d == today,
        "is_yesterday": d == F.date_sub(today, 1),
        "is_current_week": same("week"),
        "is_current_month": same("month"),
        "is_current_quarter": same("quarter"),
        "is_current_year": same("year"),
        "is_current_fiscal_year": fy == this_fy,
        "is_wtd": upto("week"),
        "is_mtd": upto("month"),
        "is_qtd": upto("quarter"),
        "is_ytd": upto("year"),
        "is_fytd": (fy == this_fy) & (d <= today),
        **{f"is_last_{n}_days": d.between(F.date_sub(today, n - 1), today) for n in (7, 30, 90, 365)},
    }
    out = days.select(*[c.alias(n) for n, c in cols.items()])
    return with_audit(out, params, model="dim_date", source_system="generated", record_id="date_sk",
                      business_columns=["date_sk"], extracted_at=F.lit(params.as_of))


# ---- Type 1 -------------------------------------------------------------------------------
def dim_channel(channel_mapping: DataFrame, params: Params) -> DataFrame:
    """Canonical channels out of the mapping rows, one row each.

    Where rows of a channel differ, as after overrides that give no attributes, those with
    attributes win, then the greatest.
    """
    attrs = ["channel_name", "channel_category", "channel_subcategory", "is_paid", "platform", "parent_channel"]
    category = F.col("channel_category")
    rows = channel_mapping.groupBy("channel_id").agg(F.max(F.struct(*attrs)).alias("a")).select("channel_id", "a.*")
    out = rows.select(
        surrogate_key(["channel_id"]).alias("channel_sk"),
        "channel_id", "channel_name", "channel_category", "channel_subcategory",
        C.channel_type(category).alias("channel_type"),
        "platform", "parent_channel", F.col("is_paid").cast("boolean").alias("is_paid"),
        C.is_owned_channel(category).alias("is_owned"),
        F.lit(True).alias("is_active"),
        F.lit(params.as_of).cast("timestamp").alias("created_at"),
    )
    return with_audit(out, params, model="dim_channel", source_system="seeds", record_id="channel_id",
                      business_columns=["channel_id", "channel_category"], extracted_at=F.lit(params.as_of))


def dim_geography(geography: DataFrame, params: Params) -> DataFrame:
    """Countries and sub-regions."""
    names = ["geography_id", "country_code", "country_name", "country_region", "country_subregion",
             "state_or_region_code", "state_or_region_name", "default_currency", "default_timezone"]
    out = geography.select(
        surrogate_key(["geography_id"]).alias("geography_sk"),
        *[F.col(c).cast("string").alias(c) for c in names],
        F.col("is_tax_jurisdiction").cast("boolean").alias("is_tax_jurisdiction"),
    )
    return with_audit(out, params, model="dim_geography", source_system="seeds", record_id="geography_id",
                      business_columns=["geography_id", "country_code"], extracted_at=F.lit(params.as_of))


def dim_payment_method(payment_methods: DataFrame, params: Params) -> DataFrame:
    """Payment method types seen on instances, one row per canonical id, detailed rows first."""
    lowered = lambda c, blank: F.lower(F.coalesce(F.col(c), F.lit(blank)))
    seen = payment_methods.select(
        lowered("payment_method_type", "unknown").alias("raw"),
        lowered("card_brand", "").alias("brand"),
        lowered("card_funding", "").alias("funding"),
        lowered("card_wallet", "").alias("wallet"),
    ).distinct()
    raw, brand, funding, wallet = (F.col(c) for c in ("raw", "brand", "funding", "wallet"))
    typed = seen.select(
        C.payment_id(raw, brand, funding, wallet).alias("payment_method_id"),
        C.payment_type(raw, wallet).alias("payment_method_type"),
        C.payment_provider(raw, brand, wallet).alias("payment_provider"),
        F.nullif(brand, F.lit("")).alias("card_brand"),
        F.nullif(funding, F.lit("")).alias("card_funding"),
        wallet,
    )
    one = first_per_key(
        typed, ["payment_method_id"],
        [F.asc_nulls_last("card_brand"), F.asc_nulls_last("card_funding"), F.asc_nulls_last("payment_provider"), F.asc("wallet")],
    )
    kind = F.col("payment_method_type")
    out = one.select(
        surrogate_key(["payment_method_id"]).alias("payment_method_sk"),
        "payment_method_id",
        C.payment_name(kind, F.col("payment_method_id"), F.col("payment_provider"), F.col("card_brand"),
                       F.col("card_funding"), F.col("wallet")).alias("payment_method_name"),
        "payment_method_type", "payment_provider", "card_brand", "card_funding",
        (kind == "card").alias("is_credit_card"),
        (kind == "digital_wallet").alias("is_digital_wallet"),
        (kind == "bnpl").alias("is_bnpl"),
        kind.isin("card", "bank_transfer").alias("is_recurring_capable"),
    )
    return with_audit(out, params, model="dim_payment_method", source_system="stripe", record_id="payment_method_id",
                      business_columns=["payment_method_id", "payment_method_type"], extracted_at=F.lit(params.as_of))


def dim_email_campaign(campaigns: DataFrame, flows: DataFrame, params: Params) -> DataFrame:
    """One-time campaigns and automated flows under prefixed ids."""
    sent = campaigns.select(
        C.email_campaign_id(F.col("campaign_id"), F.lit(None).cast("string")).alias("email_campaign_id"),
        "campaign_name", "campaign_type", "subject_line", "send_date", "audience_size",
        (~F.col("is_sent")).alias("is_active"), "created_at", "updated_at", "_extracted_at",
    )
    automated = flows.select(
        C.email_campaign_id(F.lit(None).cast("string"), F.col("flow_id")).alias("email_campaign_id"),
        F.col("flow_name").alias("campaign_name"), "campaign_type", "send_date", "is_active", "created_at",
        "updated_at", "_extracted_at",
    )
    both = sent.unionByName(automated, allowMissingColumns=True)
    out = both.select(
        surrogate_key(["email_campaign_id"]).alias("email_campaign_sk"),
        "email_campaign_id", "campaign_name", "campaign_type",
        C.null_as("string").alias("flow_step"), "subject_line", "send_date",
        C.null_as("string").alias("target_segment"), "audience_size", "is_active", "created_at", "updated_at",
        "_extracted_at",
    )
    return with_audit(out, params, model="dim_email_campaign", source_system="klaviyo", record_id="email_campaign_id",
                      business_columns=["email_campaign_id", "campaign_type"], extracted_at="_extracted_at")


def dim_warehouse_location(locations: DataFrame, params: Params) -> DataFrame:
    out = locations.select(
        surrogate_key(["location_id"]).alias("location_sk"),
        "location_id", "location_name",
        C.location_type(F.col("fulfillment_service"), F.col("is_legacy")).alias("location_type"),
        "country_code", F.col("province_code").alias("state_or_region"), "city",
        F.lit(params.reporting_timezone).alias("timezone"),
        (~F.col("is_legacy") | F.col("is_active")).alias("is_fulfillment_location"),
        "is_active", "created_at", "_extracted_at",
    )
    return with_audit(out, params, model="dim_warehouse_location", source_system="shopify", record_id="location_id",
                      business_columns=["location_id", "location_name"], extracted_at="_extracted_at")


# ---- Type 2 -------------------------------------------------------------------------------
def product_snapshot_base(variants: DataFrame, products: DataFrame, items: DataFrame) -> DataFrame:
    """Variants with product and stock attributes; changed when either variant or product did."""
    v = variants.select(
        "variant_id", "product_id", "sku", "variant_title", "barcode", "unit_price", "compare_at_price",
        "inventory_item_id", "inventory_policy", "requires_shipping", "is_taxable", "weight", "weight_unit", "created_at",
        F.coalesce("updated_at", "created_at").alias("_v_updated"),
    )
    p = products.select(
        F.col("product_id").alias("_pid"), "product_title", "product_handle", "product_type", "vendor", "is_active",
        "product_status", "image_url", "product_tags_raw", F.coalesce("updated_at", "created_at").alias("_p_updated"),
    )
    i = items.select(F.col("inventory_item_id").alias("_iid"), "unit_cost", "country_of_origin", "inventory_tracked")
    newest = F.coalesce(greatest_or_null(F.col("_v_updated"), F.col("_p_updated")), F.col("_v_updated"))
    return (
        v.join(p, F.col("product_id") == F.col("_pid"), "left")
        .join(i, F.col("inventory_item_id") == F.col("_iid"), "left")
        .withColumn("updated_at", newest)
        .drop("_pid", "_iid", "_v_updated", "_p_updated")
    )


def dim_product(history: DataFrame, categories: DataFrame, params: Params) -> DataFrame:
    """Product variants per version, with category and display name; a SKU is required."""
    cat = categories.select(F.col("product_type").alias("_pt"), "category", "subcategory")
    df = history.filter(F.col("sku").isNotNull()).join(cat, F.col("product_type") == F.col("_pt"), "left")
    start = F.col("valid_from")
    if params.backdate_products:
        early = F.col("valid_to").isNull() & (F.col("created_at") < F.col("valid_from"))
        start = F.when(early, F.col("created_at")).otherwise(F.col("valid_from"))
    other = lambda c: F.coalesce(F.col(c), F.lit("Uncategorized")).alias(c)
    out = df.select(
        surrogate_key(["variant_id"], "valid_from").alias("product_sk"),
        "sku", "product_id", "variant_id", "product_title", "variant_title",
        C.product_display_name(F.col("product_title"), F.col("variant_title")).alias("display_name"),
        "barcode", "product_handle", "image_url", "product_type", other("category"), other("subcategory"),
        "vendor", F.col("vendor").alias("brand"),
        F.split(F.coalesce("product_tags_raw", F.lit("")), ",").alias("tags"),
        "unit_price", "compare_at_price", "unit_cost", F.lit(params.reporting_currency).alias("currency_code"),
        "weight", "weight_unit", "is_taxable", "requires_shipping", "is_active", "inventory_tracked", "inventory_policy",
        "created_at", "updated_at", start.alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"),
    )
    return with_audit(out, params, model="dim_product", source_system="shopify", record_id="variant_id",
                      business_columns=["variant_id", "sku"], extracted_at="created_at")


def dim_customer(history: DataFrame, params: Params) -> DataFrame:
    """Customers per version; plain-text columns stay NULL while masking is on."""
    tags = F.col("customer_tags_raw")
    hide = partial(pii_null, params=params)
    out = history.select(
        surrogate_key(["customer_id"], "valid_from").alias("customer_sk"),
        "customer_id", "shopify_customer_id", "stripe_customer_id", "klaviyo_profile_id",
        "email_hash", hide("email_hash").alias("email"), "phone_hash", hide("phone_hash").alias("phone"),
        hide("first_name_hash").alias("first_name"), hide("last_name_hash").alias("last_name"),
        "customer_status", C.null_as("string").alias("customer_segment"), C.null_as("string").alias("acquisition_channel"),
        "acquisition_source_system", "acquisition_date",
        C.null_as("date").alias("first_order_date"), C.null_as("timestamp").alias("last_seen_at"),
        "is_b2b_customer",
        F.when(F.length(F.trim(tags)) > 0, F.split(tags, ",")).otherwise(F.array().cast("array<string>")).alias("customer_tags"),
        C.null_as("string").alias("preferred_currency"), "country_code", F.col("province_code").alias("region"),
        C.null_as("string").alias("city"), "postal_code_hash", "marketing_consent", "email_subscribed", "sms_subscribed",
        "source_systems", "identity_resolution_method", "match_confidence", "created_at", "updated_at",
        "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"),
    )
    return with_audit(out, params, model="dim_customer", source_system="shopify", record_id="customer_id",
                      business_columns=["customer_id", "email_hash"], extracted_at="created_at")


def dim_marketing_campaign(history: DataFrame, channels: DataFrame, params: Params) -> DataFrame:
    """Paid campaigns per version, in canonical vocabulary."""
    meta = channels.filter(F.col("channel_id") == "paid_social_meta").agg(F.max("channel_sk")).scalar()
    out = history.select(
        surrogate_key(["campaign_id"], "valid_from").alias("campaign_sk"),
        "campaign_id", F.lit("meta").alias("platform"), "campaign_name",
        C.campaign_objective(F.col("campaign_objective")).alias("campaign_objective"),
        F.lower("campaign_status").alias("campaign_status"), F.lower("buying_type").alias("buying_type"),
        "start_date", "end_date", "daily_budget", "lifetime_budget",
        *[C.null_as("string").alias(c) for c in ("bid_strategy", "target_audience")],
        meta.alias("channel_sk"),
        *[C.null_as("string").alias(c) for c in ("utm_source", "utm_medium", "utm_campaign")],
        "created_at", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"), "_extracted_at",
    )
    return with_audit(out, params, model="dim_marketing_campaign", source_system="meta_ads", record_id="campaign_id",
                      business_columns=["campaign_id", "campaign_status"], extracted_at="_extracted_at")
