"""Storefront tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import classify as C
from tallyhouse.functions.dates import local_date
from tallyhouse.functions.json_ops import json_items, pivot_items, sum_items
from tallyhouse.functions.pii import loose_name_key, phone_hash, pii_hash
from tallyhouse.params import Params
from tallyhouse.plans.staging.common import flag, money, project, stamp, text
from tallyhouse.sources.mapping import Overrides, source_col

UTM_KEYS = ("utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term")
REFUND_LINE_FIELDS = ("line_item_id", "quantity", "subtotal")
REFUND_TXN_FIELDS = ("kind", "status", "amount", "reason")


def orders(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    """Orders without test orders and without those before the earliest date.

    Campaign tags come out of the note attributes inside the row, so no shuffle is needed. The
    attributes are parsed in a step of their own, once for all five tags.
    """
    src = partial(source_col, overrides, "shopify.orders")
    keep = (~F.coalesce(F.col("test"), F.lit(False))) & (
        stamp("created_at").cast("date") >= F.lit(params.min_order_date).cast("date")
    )
    parsed = raw.filter(keep).withColumn("_attrs", json_items("note_attributes", ("name", "value")))
    discounts = json_items("discount_codes", ("code",))
    cols = {
        "order_id": text(src("order_id", "id")),
        "order_number": F.coalesce(text("name"), text("order_number")),
        "shopify_customer_id": F.nullif(text("customer_id"), F.lit("0")),
        "order_timestamp": stamp("created_at"),
        "order_date": local_date("created_at", params.reporting_timezone),
        "updated_at": stamp("updated_at"),
        "cancelled_at": stamp("cancelled_at"),
        "closed_at": stamp("closed_at"),
        "processed_at": stamp("processed_at"),
        "customer_email_hash_at_order": pii_hash(src("customer_email", "email"), params),
        "order_status": C.order_status(F.col("cancelled_at"), F.col("financial_status"), F.col("fulfillment_status")),
        "financial_status": text("financial_status"),
        "fulfillment_status": text("fulfillment_status"),
        "gross_amount": money(src("gross_amount", "subtotal_price")),
        "discount_amount": money(src("discount_amount", "total_discounts")),
        "tax_amount": money(src("tax_amount", "total_tax")),
        "shipping_amount": money(src("shipping_amount", "total_shipping_price_set_shop_money_amount")),
        "tip_amount": money(F.coalesce(F.col("total_tip_received"), F.lit(0))),
        "net_amount": money(src("net_amount", "total_price")),
        "original_currency_code": text("currency"),
        "source_name": text("source_name"),
        "landing_page_url": text("landing_site"),
        "referrer_url": text("landing_site_ref"),
        "cart_id": text("cart_token"),
        **pivot_items(F.col("_attrs"), "name", "value", UTM_KEYS),
        "device_category": C.device_category(text(src("browser_width", "client_details_browser_width"))),
        "user_agent": text(src("user_agent", "client_details_user_agent")),
        "ip_address_hash": pii_hash("browser_ip", params),
        "is_test_order": flag("test", False),
        "is_subscription_order": C.is_subscription(text("source_name"), text("tags")),
        "tags_raw": text("tags"),
        "note": text("note"),
        "discount_codes_raw": F.try_parse_json(text("discount_codes")),
        "primary_discount_code": F.get(discounts, 0)["code"],
        "shipping_country_code": text(src("shipping_country_code", "shipping_address_country_code")),
        "shipping_province_code": text(src("shipping_province_code", "shipping_address_province_code")),
        "billing_country_code": text(src("billing_country_code", "billing_address_country_code")),
    }
    return project(
        parsed, cols, params, table="shopify.orders", record_id="order_id",
        business=["order_id", "updated_at"], extracted_at=F.col("updated_at"),
    )


def order_line_items(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    """Line amounts; tax is summed out of the tax lines within the row."""
    price, discount = money("price"), money(F.coalesce(F.col("total_discount"), F.lit(0)))
    subtotal = (F.col("quantity") * price).cast("decimal(18,6)")
    cols = {
        "line_item_id": text("id"),
        "order_id": text("order_id"),
        "variant_id": F.nullif(text("variant_id"), F.lit("0")),
        "product_id": text("product_id"),
        "sku": text("sku"),
        "line_item_name": text("name"),
        "product_title_at_sale": text("title"),
        "variant_title_at_sale": text("variant_title"),
        "quantity": F.col("quantity").cast("int"),
        "unit_price": price,
        "line_subtotal": subtotal,
        "line_discount": discount,
        "line_net_amount": (subtotal - discount).cast("decimal(18,6)"),
        "was_promotional": discount > 0,
        "line_tax": sum_items(json_items("tax_lines", ("price",)), "price"),
        "fulfillment_status": text("fulfillment_status"),
        "requires_shipping": flag("requires_shipping"),
        "is_taxable": flag("taxable"),
        "is_gift_card": flag("gift_card"),
        "line_properties": F.try_parse_json(text("properties")),
        "vendor": text("vendor"),
    }
    return project(
        raw, cols, params, table="shopify.order_line_items", record_id="line_item_id",
        business=["line_item_id", "order_id"], extracted_at=F.lit(params.as_of),
    )


def customers(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    """Customers with hashed personal data, consent, geography and the business flag."""
    src = partial(source_col, overrides, "shopify.customers")
    company = text(src("company", "default_address_company"))
    postal = text(src("postal_code", "default_address_zip"))
    cols = {
        "shopify_customer_id": text(src("customer_id", "id")),
        "customer_email_hash": pii_hash(src("customer_email", "email"), params),
        "phone_hash": phone_hash("phone", params),
        "first_name_hash": pii_hash("first_name", params),
        "last_name_hash": pii_hash("last_name", params),
        "name_address_key": loose_name_key(text("first_name"), text("last_name"), postal, params),
        "customer_status": C.customer_status(text("state")),
        "shopify_customer_state": text("state"),
        "marketing_consent": flag("accepts_marketing", False),
        "email_subscribed": flag("accepts_marketing", False),
        "sms_subscribed": flag("accepts_sms_marketing", False),
        "country_code": text(src("country_code", "default_address_country_code")),
        "province_code": text(src("province_code", "default_address_province_code")),
        "city_hash": pii_hash(src("city", "default_address_city"), params),
        "postal_code_hash": pii_hash(postal, params),
        "company": company,
        "is_b2b_customer": C.is_b2b(text("tags"), company),
        "customer_tags_raw": text("tags"),
        "customer_note": text("note"),
        "orders_count": F.col("orders_count").cast("int"),
        "total_spent": money("total_spent"),
        "created_at": stamp("created_at"),
        "updated_at": stamp("updated_at"),
    }
    return project(
        raw, cols, params, table="shopify.customers", record_id="shopify_customer_id",
        business=["shopify_customer_id", "updated_at"], extracted_at=F.col("updated_at"),
    )


def refunds(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    """Refunds with both payloads parsed to typed arrays; bad JSON becomes NULL."""
    cols = {
        "refund_id": text("id"),
        "order_id": text("order_id"),
        "refund_timestamp": stamp("created_at"),
        "refund_date": local_date("created_at", params.reporting_timezone),
        "processed_at": stamp("processed_at"),
        "refund_note": text("note"),
        "is_restock": flag("restock"),
        "refund_line_items": json_items("refund_line_items", REFUND_LINE_FIELDS),
        "refund_transactions": json_items("transactions", REFUND_TXN_FIELDS),
    }
    return project(
        raw, cols, params, table="shopify.refunds", record_id="refund_id",
        business=["refund_id", "order_id"], extracted_at=F.col("created_at"),
    )


def transactions(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    """Successful payment transactions only."""
    src = partial(source_col, overrides, "shopify.transactions")
    card = "payment_details_credit_card_"
    cols = {
        "transaction_id": text("id"),
        "order_id": text("order_id"),
        "transaction_kind": text("kind"),
        "transaction_status": text("status"),
        "payment_gateway": text("gateway"),
        "card_brand": text(src("card_brand", card + "company")),
        "card_bin": text(src("card_bin", card + "bin")),
        "card_exp_month": text(src("card_exp_month", card + "expiration_month")),
        "card_exp_year": text(src("card_exp_year", card + "expiration_year")),
        "digital_wallet": text(src("digital_wallet", card + "wallet")),
        "transaction_amount": money("amount"),
        "currency_code": text("currency"),
        "maximum_refundable": money(F.coalesce(F.col("maximum_refundable"), F.lit(0))),
        "authorization_code": text("authorization"),
        "error_code": text("error_code"),
        "error_message": text("message"),
        "parent_transaction_id": text("parent_id"),
        "created_at": stamp("created_at"),
        "processed_at": stamp("processed_at"),
    }
    return project(
        raw.filter(F.col("status") == "success"), cols, params, table="shopify.transactions",
        record_id="transaction_id", business=["transaction_id", "order_id"], extracted_at=F.col("created_at"),
    )


def products(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    src = partial(source_col, overrides, "shopify.products")
    cols = {
        "product_id": text("id"),
        "product_title": text("title"),
        "product_handle": text("handle"),
        "product_type": text("product_type"),
        "vendor": text("vendor"),
        "is_active": F.col("status") == "active",
        "product_status": text("status"),
        "published_at": stamp("published_at"),
        "image_url": text(src("image_url", "image_url")),
        "product_tags_raw": text("tags"),
        "body_html": text("body_html"),
        "created_at": stamp("created_at"),
        "updated_at": stamp("updated_at"),
    }
    return project(
        raw, cols, params, table="shopify.products", record_id="product_id",
        business=["product_id", "updated_at"], extracted_at=F.col("updated_at"),
    )


def product_variants(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    cols = {
        "variant_id": text("id"),
        "product_id": text("product_id"),
        "sku": text("sku"),
        "variant_title": text("title"),
        "barcode": text("barcode"),
        **{f"option_{i}": text(f"option{i}") for i in (1, 2, 3)},
        "unit_price": money("price"),
        "compare_at_price": money("compare_at_price"),
        "inventory_item_id": text("inventory_item_id"),
        "inventory_management": text("inventory_management"),
        "inventory_policy": text("inventory_policy"),
        "inventory_quantity": F.col("inventory_quantity").cast("int"),
        "old_inventory_quantity": F.col("old_inventory_quantity").cast("int"),
        "requires_shipping": flag("requires_shipping"),
        "is_taxable": flag("taxable"),
        "fulfillment_service": text("fulfillment_service"),
        "weight": F.col("weight").cast("decimal(10,4)"),
        "weight_unit": text("weight_unit"),
        "variant_image_id": text("image_id"),
        "created_at": stamp("created_at"),
        "updated_at": stamp("updated_at"),
    }
    return project(
        raw, cols, params, table="shopify.product_variants", record_id="variant_id",
        business=["variant_id", "updated_at"], extracted_at=F.col("updated_at"),
    )


def inventory_items(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    """Stock items; a NULL cost means the cost is not tracked."""
    cols = {
        "inventory_item_id": text("id"),
        "sku": text("sku"),
        "unit_cost": money("cost"),
        "country_of_origin": text("country_code_of_origin"),
        "province_of_origin": text("province_code_of_origin"),
        "hs_code": text("harmonized_system_code"),
        "inventory_tracked": flag("tracked"),
        "requires_shipping": flag("requires_shipping"),
        "created_at": stamp("created_at"),
        "updated_at": stamp("updated_at"),
    }
    return project(
        raw, cols, params, table="shopify.inventory_items", record_id="inventory_item_id",
        business=["inventory_item_id", "updated_at"], extracted_at=F.col("updated_at"),
    )


def inventory_levels(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    cols = {
        "inventory_item_id": text("inventory_item_id"),
        "location_id": text("location_id"),
        "quantity_available": F.col("available").cast("int"),
        "quantity_incoming": F.coalesce(F.col("incoming"), F.lit(0)).cast("int"),
        "updated_at": stamp("updated_at"),
    }
    return project(
        raw, cols, params, table="shopify.inventory_levels",
        record_id=F.concat("inventory_item_id", F.lit("_"), "location_id"),
        business=["inventory_item_id", "location_id", "updated_at"], extracted_at=F.col("updated_at"),
    )


def inventory_snapshots(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    """Daily stock history; values and supply are computed later from cost and sales."""
    cols = {
        "inventory_item_id": text("inventory_item_id"),
        "location_id": text("location_id"),
        "snapshot_date": F.col("snapshot_date").cast("date"),
        "quantity_available": F.col("available").cast("int"),
        "quantity_incoming": F.lit(0),
        "updated_at": stamp("updated_at"),
    }
    return project(
        raw, cols, params, table="shopify.inventory_snapshots",
        record_id=F.concat_ws("_", "inventory_item_id", "location_id", text("snapshot_date")),
        business=["inventory_item_id", "location_id", "snapshot_date"], extracted_at=F.col("updated_at"),
    )


def locations(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    cols = {
        "location_id": text("id"),
        "location_name": text("name"),
        "is_active": flag("active"),
        "is_legacy": flag("legacy"),
        "address_line_1": text("address1"),
        "address_line_2": text("address2"),
        "city": text("city"),
        "postal_code": text("zip"),
        "province": text("province"),
        "province_code": text("province_code"),
        "country_name": text("country"),
        "country_code": text("country_code"),
        "phone": text("phone"),
        "fulfillment_service": text("fulfillment_service"),
        "pickup_instructions": text("local_pickup_settings_instructions"),
        "created_at": stamp("created_at"),
        "updated_at": stamp("updated_at"),
    }
    return project(
        raw, cols, params, table="shopify.locations", record_id="location_id",
        business=["location_id", "updated_at"], extracted_at=F.col("updated_at"),
    )
