"""The 26 raw tables: declared schema, load column, freshness limits, criticality."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Raw table layouts as DDL. JSON payloads stay text.
_MONEY = "decimal(18,6)"
_SCHEMAS = {
    "shopify.orders": f"""id bigint, name string, order_number bigint, customer_id bigint, created_at timestamp,
        updated_at timestamp, processed_at timestamp, closed_at timestamp, cancelled_at timestamp,
        financial_status string, fulfillment_status string, email string, subtotal_price {_MONEY},
        total_discounts {_MONEY}, total_tax {_MONEY}, total_shipping_price_set_shop_money_amount {_MONEY},
        total_tip_received {_MONEY}, total_price {_MONEY}, currency string, source_name string,
        landing_site string, landing_site_ref string, cart_token string, note_attributes string,
        client_details_browser_width string, client_details_user_agent string, browser_ip string, test boolean,
        tags string, note string, discount_codes string, shipping_address_country_code string,
        shipping_address_province_code string, billing_address_country_code string""",
    "shopify.customers": f"""id bigint, created_at timestamp, updated_at timestamp, email string, first_name string,
        last_name string, phone string, accepts_marketing boolean, accepts_sms_marketing boolean, state string,
        default_address_country_code string, default_address_province_code string, default_address_city string,
        default_address_zip string, default_address_company string, tags string, note string, orders_count bigint,
        total_spent {_MONEY}""",
    "shopify.order_line_items": f"""id bigint, order_id bigint, variant_id bigint, product_id bigint, sku string,
        title string, name string, variant_title string, quantity bigint, price {_MONEY}, total_discount {_MONEY},
        tax_lines string, fulfillment_status string, requires_shipping boolean, taxable boolean, gift_card boolean,
        properties string, vendor string, _synced_at timestamp""",
    "shopify.refunds": """id bigint, order_id bigint, created_at timestamp, note string, processed_at timestamp,
        restock boolean, transactions string, refund_line_items string""",
    "shopify.products": """id bigint, title string, handle string, product_type string, vendor string, status string,
        published_at timestamp, image_url string, tags string, body_html string, created_at timestamp,
        updated_at timestamp""",
    "shopify.product_variants": f"""id bigint, product_id bigint, title string, sku string, price {_MONEY},
        compare_at_price {_MONEY}, option1 string, option2 string, option3 string, inventory_item_id bigint,
        inventory_management string, inventory_policy string, inventory_quantity bigint,
        old_inventory_quantity bigint, requires_shipping boolean, taxable boolean, fulfillment_service string,
        barcode string, weight decimal(10,4), weight_unit string, image_id string, created_at timestamp,
        updated_at timestamp""",
    "shopify.inventory_items": f"""id bigint, sku string, cost {_MONEY}, tracked boolean,
        country_code_of_origin string, province_code_of_origin string, harmonized_system_code string,
        requires_shipping boolean, created_at timestamp, updated_at timestamp""",
    "shopify.inventory_levels": """inventory_item_id bigint, location_id string, available bigint, incoming bigint,
        updated_at timestamp""",
    "shopify.inventory_snapshots": """inventory_item_id bigint, location_id string, snapshot_date date,
        available bigint, quantity_committed bigint, inventory_value decimal(18,2), days_of_supply decimal(18,2),
        is_low_stock string, is_overstock string, updated_at timestamp""",
    "shopify.locations": """id string, name string, active boolean, legacy boolean, address1 string,
        address2 string, city string, province string, province_code string, country string, country_code string,
        zip string, phone string, fulfillment_service string, local_pickup_settings_instructions string,
        created_at timestamp, updated_at timestamp""",
    "shopify.transactions": f"""id bigint, order_id bigint, kind string, status string, created_at timestamp,
        amount {_MONEY}, currency string, gateway string, processed_at timestamp, payment_method_type string,
        payment_details_credit_card_company string, payment_details_credit_card_bin string,
        payment_details_credit_card_expiration_month string, payment_details_credit_card_expiration_year string,
        payment_details_credit_card_wallet string, maximum_refundable {_MONEY}, authorization string,
        error_code string, message string, parent_id string""",
    "stripe.charges": """id string, created bigint, amount bigint, amount_refunded bigint, currency string,
        status string, livemode boolean, customer string, payment_method_details_type string,
        payment_method_details_card_brand string, payment_method_details_card_last4 string,
        payment_method_details_card_exp_month string, payment_method_details_card_exp_year string,
        payment_method_details_card_wallet string, metadata_shopify_order_id string, payment_method string,
        paid boolean, captured boolean, refunded boolean""",
    "stripe.customers": "id string, created bigint, email string, name string, phone string, delinquent boolean, livemode boolean",
    "stripe.refunds": "id string, charge string, amount bigint, currency string, status string, reason string, created bigint",
    "stripe.disputes": "id string, charge string, amount bigint, currency string, status string, reason string, created bigint",
    "stripe.payment_methods": """id string, type string, customer string, card_brand string, card_last4 string,
        card_exp_month string, card_exp_year string, card_wallet string, card_funding string, card_country string,
        livemode boolean, created bigint""",
    "ga4.events": f"""event_date string, event_name string, user_pseudo_id string, user_id string,
        ga_session_id string, event_timestamp bigint, device__category string, device__mobile_brand_name string,
        device__operating_system string, device__web_info__browser string, traffic_source__source string,
        traffic_source__medium string, traffic_source__name string, geo__country string, geo__region string,
        page_location string, page_referrer string, page_title string, ecommerce__transaction_id string,
        ecommerce__purchase_revenue {_MONEY}, ecommerce__currency string, engagement_time_msec bigint,
        is_new_user boolean""",
    "ga4.users": "user_pseudo_id string, user_id string, first_seen_date date, last_seen_date date, _synced_at timestamp",
    "meta_ads.daily_insights": f"""date_start date, campaign_id string, ad_set_id string, ad_id string,
        spend {_MONEY}, impressions bigint, clicks bigint, reach bigint, inline_link_clicks bigint, actions string,
        action_values string""",
    "meta_ads.campaigns": """id string, name string, objective string, status string, account_id string,
        buying_type string, daily_budget bigint, lifetime_budget bigint, start_time timestamp, stop_time timestamp,
        created_time timestamp, updated_time timestamp, _synced_at timestamp""",
    "meta_ads.ad_sets": """id string, campaign_id string, name string, status string, daily_budget bigint,
        bid_amount bigint, billing_event string, optimization_goal string, start_time timestamp,
        end_time timestamp, created_time timestamp, updated_time timestamp, _synced_at timestamp""",
    "meta_ads.ads": """id string, campaign_id string, adset_id string, name string, status string,
        creative_id string, created_time timestamp, updated_time timestamp, _synced_at timestamp""",
    "klaviyo.events": """id string, event_name string, profile_id string, datetime timestamp, campaign_id string,
        flow_id string, event_properties string""",
    "klaviyo.profiles": """id string, created timestamp, updated timestamp, email string, first_name string,
        last_name string, phone_number string, email_marketing__consent string, sms_marketing__consent string""",
    "klaviyo.campaigns": """id string, name string, subject string, status string, send_time timestamp,
        num_recipients int, created timestamp, updated timestamp, _synced_at timestamp""",
    "klaviyo.flows": """id string, name string, status string, trigger_type string, created timestamp,
        updated timestamp, _synced_at timestamp""",
}

# Load column, hours to warning, hours to error.
_FRESHNESS = {
    "shopify.orders": ("updated_at", 6, 24),
    "shopify.customers": ("updated_at", 6, 24),
    "shopify.order_line_items": ("_synced_at", 6, 24),
    "shopify.refunds": ("created_at", 6, 24),
    "shopify.products": ("updated_at", 12, 48),
    "shopify.product_variants": ("updated_at", 12, 48),
    "shopify.inventory_levels": ("updated_at", 24, 48),
    "shopify.inventory_snapshots": ("updated_at", 24, 48),
    "shopify.inventory_items": ("updated_at", 24, 48),
    "shopify.locations": ("updated_at", 48, 168),
    "shopify.transactions": ("created_at", 6, 24),
    "stripe.charges": ("created", 12, 48),
    "stripe.customers": ("created", 12, 48),
    "stripe.refunds": ("created", 6, 24),
    "stripe.disputes": ("created", 6, 24),
    "stripe.payment_methods": ("created", 24, 48),
    "ga4.events": ("event_date", 24, 48),
    "ga4.users": ("_synced_at", 24, 48),
    "meta_ads.daily_insights": ("date_start", 12, 48),
    "meta_ads.campaigns": ("_synced_at", 12, 72),
    "meta_ads.ad_sets": ("_synced_at", 12, 72),
    "meta_ads.ads": ("_synced_at", 12, 72),
    "klaviyo.events": ("datetime", 6, 24),
    "klaviyo.profiles": ("created", 6, 24),
    "klaviyo.campaigns": ("_synced_at", 12, 48),
    "klaviyo.flows": ("_synced_at", 24, 72),
}


@dataclass(frozen=True)
class RawTable:
    name: str
    schema: T.StructType
    loaded_at: str
    warn_hours: int
    error_hours: int
    critical: bool


def raw_tables(critical: frozenset[str] = frozenset()) -> dict[str, RawTable]:
    """All raw tables by ``source.table``; ``critical`` names those whose load must not fail."""
    return {
        name: RawTable(name, T.StructType.fromDDL(ddl), *_FRESHNESS[name], critical=name in critical)
        for name, ddl in _SCHEMAS.items()
    }
