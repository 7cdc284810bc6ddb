"""Raw retail tables derived from the given test tables.

Each derivation is one SQL text that Spark and DuckDB both understand, so the two sides start
from the same rows. Order dates are moved forward by 25 years (9,131 days) into the range the
calendar covers; payload columns are written as JSON text, some of it broken on purpose.
"""

from __future__ import annotations

import zlib
from datetime import date
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.params import EARLIER_READINGS, Params

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
AS_OF = date(2026, 8, 15)
PARAMS = Params(
    as_of=AS_OF, pii_salt="pepper", snapshot_mode="month_end", backdate_customers=True, run_id="driver", **EARLIER_READINGS,
)

_SHIFT = "interval '9131' day"
_LINE_ID = "(cast(l_orderkey as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string) || '-' || cast(l_linenumber as string))"
_PRICE = "cast(l_extendedprice as decimal(18,2))"
_DAY = "cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as string)"
_NULL = "cast(null as string)"

SQL: dict[str, str] = {
    "shopify.orders": f"""
        select o_orderkey as id, '#' || cast(o_orderkey as string) as name, o_orderkey as order_number, o_custkey as customer_id,
            o_orderdate + {_SHIFT} + (o_orderkey % 24) * interval '1' hour as created_at,
            o_orderdate + {_SHIFT} + interval '2' day as updated_at, o_orderdate + {_SHIFT} as processed_at,
            cast(null as timestamp) as closed_at,
            case when o_orderpriority = '5-LOW' and o_orderkey % 7 = 0 then o_orderdate + {_SHIFT} + interval '1' day end as cancelled_at,
            case when o_orderkey % 17 = 0 then null when o_orderkey % 11 = 0 then 'voided' when o_orderkey % 13 = 0 then 'refunded'
                 when o_orderstatus = 'F' then 'paid' when o_orderstatus = 'O' then 'pending' else 'partially_refunded' end as financial_status,
            case when o_orderkey % 2 = 0 then 'fulfilled' end as fulfillment_status,
            ' Customer' || cast(o_custkey as string) || '@Example.com' as email,
            cast(o_totalprice as decimal(18,6)) as subtotal_price,
            cast(cast(o_totalprice as decimal(18,2)) * 0.05 as decimal(18,6)) as total_discounts,
            cast(cast(o_totalprice as decimal(18,2)) * 0.08 as decimal(18,6)) as total_tax,
            cast(5 as decimal(18,6)) as total_shipping_price_set_shop_money_amount,
            case when o_orderkey % 4 = 0 then cast(1.5 as decimal(18,6)) end as total_tip_received,
            cast(cast(o_totalprice as decimal(18,2)) * 1.03 + 5 + case when o_orderkey % 4 = 0 then 1.5 else 0 end as decimal(18,6)) as total_price,
            case o_orderkey % 5 when 0 then 'EUR' when 1 then 'GBP' when 2 then 'usd' when 3 then 'USD' else 'JPY' end as currency,
            case o_orderpriority when '1-URGENT' then 'web' when '2-HIGH' then 'pos' when '3-MEDIUM' then 'recharge' when '5-LOW' then 'kiosk' end as source_name,
            '/landing/' || cast(o_orderkey % 20 as string) as landing_site, {_NULL} as landing_site_ref,
            'cart' || cast(o_orderkey as string) as cart_token,
            case when o_orderkey % 31 = 0 then '[{{"name":' when o_orderkey % 3 = 0 then
                '[{{"name":"utm_source","value":"Facebook"}},{{"name":"utm_medium","value":"CPC"}},{{"name":"utm_campaign","value":"c' || cast(o_orderkey % 9 as string) || '"}}]'
                 when o_orderkey % 3 = 1 then '[{{"name":"utm_source","value":"google"}},{{"name":"utm_medium","value":"organic"}}]' when o_orderkey % 5 = 0 then '[]' end as note_attributes,
            case when o_orderkey % 10 = 0 then 'n/a' else cast(300 + o_orderkey % 1200 as string) end as client_details_browser_width,
            'agent/' || cast(o_orderkey % 6 as string) as client_details_user_agent, '10.0.0.' || cast(o_orderkey % 256 as string) as browser_ip,
            case when o_orderkey % 97 = 0 then true when o_orderkey % 3 = 0 then false end as test,
            case when o_orderkey % 9 = 0 then 'VIP, Subscription' when o_orderkey % 9 = 1 then 'vip,gift' end as tags, {_NULL} as note,
            case when o_orderkey % 6 = 0 then '[{{"code":"SAVE' || cast(o_orderkey % 4 as string) || '","amount":"5.00"}}]' when o_orderkey % 6 = 1 then '[]' end as discount_codes,
            'C' || cast(o_custkey % 30 as string) as shipping_address_country_code, {_NULL} as shipping_address_province_code,
            'C' || cast(o_custkey % 25 as string) as billing_address_country_code
        from {{orders}}""",
    "shopify.order_line_items": f"""
        select {_LINE_ID} as id, l_orderkey as order_id, l_partkey as variant_id, l_partkey as product_id,
            'SKU-' || cast(l_partkey as string) as sku, 'Part ' || cast(l_partkey as string) as title, 'Line ' || cast(l_linenumber as string) as name,
            {_NULL} as variant_title, cast(l_quantity as bigint) as quantity, cast(l_extendedprice as decimal(18,6)) as price,
            case when l_discount > 0 then cast({_PRICE} * cast(l_discount as decimal(4,2)) as decimal(18,6)) end as total_discount,
            case when l_linenumber = 7 and l_partkey % 5 = 0 then 'oops' else
                '[{{"title":"Tax","price":' || cast(cast({_PRICE} * cast(l_tax as decimal(4,2)) as decimal(18,4)) as string) || '}},{{"title":"Levy","price":"0.5"}},{{"title":"Bad","price":"x"}}]' end as tax_lines,
            l_linestatus as fulfillment_status, true as requires_shipping, l_tax > 0 as taxable, false as gift_card, {_NULL} as properties,
            'Supplier ' || cast(l_suppkey as string) as vendor
        from {{lineitem}}""",
    "shopify.refunds": f"""
        select 'R' || {_LINE_ID} as id, l_orderkey as order_id, l_shipdate + {_SHIFT} + (l_partkey % 24) * interval '1' hour as created_at,
            case l_linenumber when 1 then 'Arrived DAMAGED' when 2 then 'wrong size' when 3 then 'Not as described' when 4 then 'no longer needed'
                when 5 then 'poor quality' when 6 then 'came too late' end as note,
            l_shipdate + {_SHIFT} as processed_at, l_linestatus = 'O' as restock,
            '[{{"kind":"Refund","status":"success","amount":"' || cast({_PRICE} as string) || '","reason":"' || case when l_linenumber = 3 then 'Shipping delay' else 'other' end
                || '"}},{{"kind":"refund","status":"failure","amount":"9.99"}},{{"kind":"sale","status":"success","amount":"1.00"}}]' as transactions,
            case when l_linenumber = 6 and l_partkey % 4 = 0 then 'null' else
                '[{{"line_item_id":"' || {_LINE_ID} || '","quantity":' || cast(case when l_linestatus = 'O' then cast(l_quantity as bigint) else 1 end as string)
                || ',"subtotal":"' || cast({_PRICE} as string) || '"}},{{"quantity":3}}]' end as refund_line_items
        from {{lineitem}} where l_returnflag = 'R'""",
    "shopify.transactions": f"""
        select o_orderkey as id, o_orderkey as order_id, case when o_orderstatus = 'O' then 'authorization' else 'sale' end as kind,
            case when o_orderkey % 10 = 3 then 'failure' when o_orderkey % 10 = 7 then null else 'success' end as status,
            o_orderdate + {_SHIFT} as created_at, cast(o_totalprice as decimal(18,6)) as amount, 'USD' as currency, 'stripe' as gateway,
            o_orderdate + {_SHIFT} as processed_at, 'card' as payment_method_type,
            case o_custkey % 3 when 0 then 'visa' when 1 then 'mastercard' else 'amex' end as payment_details_credit_card_company,
            {_NULL} as payment_details_credit_card_bin, '1' as payment_details_credit_card_expiration_month,
            '2030' as payment_details_credit_card_expiration_year, {_NULL} as payment_details_credit_card_wallet,
            case when o_orderkey % 2 = 0 then cast(o_totalprice as decimal(18,6)) end as maximum_refundable, {_NULL} as authorization,
            {_NULL} as error_code, {_NULL} as message, {_NULL} as parent_id
        from {{orders}}""",
    "shopify.customers": f"""
        select c_custkey as id, timestamp '2020-01-01 00:00:00' + (c_custkey % 900) * interval '1' day as created_at,
            timestamp '2024-01-01 00:00:00' + (c_custkey % 800) * interval '1' day as updated_at,
            case when c_custkey % 20 <> 7 and c_custkey % 20 <> 9 then 'Customer' || cast(c_custkey as string) || '@example.com ' end as email,
            'Ann' as first_name, 'Smith' || cast(c_custkey % 40 as string) as last_name,
            case when c_custkey % 20 <> 9 then '+1-' || cast(c_custkey - c_custkey % 2 as string) end as phone,
            case when c_custkey % 4 = 0 then null else c_custkey % 4 = 1 end as accepts_marketing, c_custkey % 8 = 1 as accepts_sms_marketing,
            case c_custkey % 5 when 0 then 'enabled' when 1 then 'disabled' when 2 then 'invited' when 3 then 'weird' end as state,
            'C' || cast(c_nationkey as string) as default_address_country_code, {_NULL} as default_address_province_code,
            'City ' || cast(c_nationkey as string) as default_address_city, 'Z' || cast(c_custkey % 200 as string) as default_address_zip,
            case when c_custkey % 25 = 0 then 'Acme' when c_custkey % 25 = 1 then '  ' end as default_address_company,
            case when c_custkey % 30 = 0 then 'vip, B2B' when c_custkey % 30 = 1 then 'Wholesale' when c_custkey % 30 = 2 then 'reseller' end as tags,
            {_NULL} as note, c_custkey % 12 as orders_count, cast(c_acctbal as decimal(18,6)) as total_spent
        from {{customer}}""",
    "shopify.products": f"""
        select p_partkey as id, p_name as title, 'h-' || cast(p_partkey as string) as handle, p_type as product_type, p_brand as vendor,
            case when p_size % 10 = 0 then 'archived' else 'active' end as status, timestamp '2019-01-01 00:00:00' as published_at,
            {_NULL} as image_url, case when p_partkey % 2 = 0 then 'a,b' end as tags, {_NULL} as body_html,
            timestamp '2018-06-01 00:00:00' as created_at,
            case when p_partkey % 3 = 0 then timestamp '2023-01-01 00:00:00' else timestamp '2019-01-01 00:00:00' end as updated_at
        from {{part}}""",
    "shopify.product_variants": f"""
        select p_partkey as id, p_partkey as product_id, case when p_partkey % 211 <> 1 then 'SKU-' || cast(p_partkey as string) end as sku,
            case when p_size % 2 = 0 then 'Default Title' when p_size % 3 = 0 then 'Size ' || cast(p_size as string) end as title,
            cast(p_retailprice as decimal(18,6)) as price, cast(null as decimal(18,6)) as compare_at_price, {_NULL} as option1, {_NULL} as option2,
            {_NULL} as option3, p_partkey as inventory_item_id, {_NULL} as inventory_management, 'deny' as inventory_policy,
            cast(p_size as bigint) as inventory_quantity, cast(null as bigint) as old_inventory_quantity, true as requires_shipping, true as taxable,
            {_NULL} as fulfillment_service, {_NULL} as barcode, cast(1.25 as decimal(10,4)) as weight, 'kg' as weight_unit, {_NULL} as image_id,
            timestamp '2018-06-01 00:00:00' as created_at, case when p_partkey % 5 = 0 then null else timestamp '2018-12-01 00:00:00' end as updated_at
        from {{part}}""",
    "shopify.inventory_items": f"""
        select p_partkey as id, 'SKU-' || cast(p_partkey as string) as sku,
            case when p_partkey % 9 <> 0 then cast(cast(p_retailprice as decimal(18,2)) * 0.6 as decimal(18,6)) end as cost, true as tracked,
            'KE' as country_code_of_origin, {_NULL} as province_code_of_origin, {_NULL} as harmonized_system_code, true as requires_shipping,
            timestamp '2018-06-01 00:00:00' as created_at, timestamp '2019-01-01 00:00:00' as updated_at
        from {{part}}""",
    "shopify.inventory_levels": """
        select p_partkey as inventory_item_id, cast(p_partkey % 120 as string) as location_id,
            case when p_partkey % 77 = 5 then null else cast(p_size as bigint) * 7 - 20 end as available,
            case when p_partkey % 2 = 0 then cast(p_size as bigint) end as incoming, timestamp '2026-08-01 00:00:00' as updated_at
        from {part}""",
    "shopify.inventory_snapshots": f"""
        select l_partkey as inventory_item_id, cast(l_partkey % 120 as string) as location_id,
            cast(date_trunc('month', l_shipdate + {_SHIFT}) as date) as snapshot_date, cast(sum(l_quantity) as bigint) - 25 as available,
            timestamp '2026-08-01 00:00:00' as updated_at
        from {{lineitem}} group by l_partkey, cast(date_trunc('month', l_shipdate + {_SHIFT}) as date)""",
    "shopify.locations": f"""
        select s_suppkey as id, s_name as name, s_suppkey % 6 <> 0 as active, s_suppkey % 4 = 0 as legacy, {_NULL} as address1, {_NULL} as address2,
            'Town' as city, {_NULL} as zip, {_NULL} as province, 'P' || cast(s_nationkey as string) as province_code, {_NULL} as country,
            'C' || cast(s_nationkey as string) as country_code, {_NULL} as phone,
            case s_suppkey % 5 when 0 then 'shipbob' when 1 then 'manual' when 2 then '' end as fulfillment_service,
            {_NULL} as local_pickup_settings_instructions, timestamp '2019-01-01 00:00:00' as created_at, timestamp '2020-01-01 00:00:00' as updated_at
        from {{supplier}}""",
    "stripe.charges": f"""
        select 'ch_' || suffix || cast(o_orderkey as string) as id,
            case when suffix = 'z' and o_orderkey % 4 = 0 then null else cast(EPOCH(o_orderdate + {_SHIFT}) as bigint) + late end as created,
            cast(cast(o_totalprice as decimal(18,2)) * 100 as bigint) as amount, case when o_orderkey % 3 = 0 then 250 end as amount_refunded,
            'usd' as currency, 'succeeded' as status, case when o_orderkey % 40 = 1 then null when o_orderkey % 40 = 2 then false else true end as livemode,
            'cus_' || cast(o_custkey as string) as customer,
            case (o_orderkey + late) % 6 when 0 then 'Card' when 1 then 'card' when 2 then 'klarna' when 3 then 'sepa_debit' when 4 then 'link' end as payment_method_details_type,
            case (o_orderkey + late) % 6 when 0 then 'Visa' when 1 then 'amex' end as payment_method_details_card_brand,
            '4242' as payment_method_details_card_last4, '1' as payment_method_details_card_exp_month, '2030' as payment_method_details_card_exp_year,
            case when o_orderkey % 18 = 0 then 'apple_pay' end as payment_method_details_card_wallet,
            case when o_orderkey % 19 <> 0 then cast(o_orderkey as string) end as metadata_shopify_order_id, 'pm_' || cast(o_custkey as string) as payment_method,
            true as paid, case when o_orderkey % 2 = 0 then true end as captured, o_orderkey % 3 = 0 as refunded
        from (select *, 'a' as suffix, 0 as late from {{orders}} union all select *, 'z', 3601 from {{orders}} where o_orderkey % 5 = 0)""",
    "stripe.customers": f"""
        select 'cus_' || cast(c_custkey as string) as id, 1577836800 + (c_custkey % 1000) * 86400 as created,
            case when c_custkey % 2 = 1 then 'Payer' || cast(c_custkey as string) || '@example.org' when c_custkey % 10 <> 4 then 'CUSTOMER' || cast(c_custkey as string) || '@example.com' end as email, c_name as name,
            case when c_custkey % 2 = 0 and c_custkey % 3 = 1 then '+1-' || cast(c_custkey as string) end as phone,
            case when c_custkey % 50 = 0 then true end as delinquent, case when c_custkey % 2 = 0 then true end as livemode
        from {{customer}}""",
    "stripe.refunds": """
        select 're_' || cast(o_orderkey as string) as id, 'ch_a' || cast(o_orderkey as string) as charge,
            cast(cast(o_totalprice as decimal(18,2)) * 100 as bigint) as amount, 'eur' as currency,
            case when o_orderkey % 5 = 0 then 'pending' else 'succeeded' end as status,
            case when o_orderkey % 7 = 0 then 'Fraudulent' when o_orderkey % 7 = 1 then 'requested_by_customer' end as reason,
            cast(EPOCH(o_orderdate) as bigint) as created
        from {orders}""",
    "stripe.disputes": """
        select 'dp_' || cast(o_orderkey as string) as id, 'ch_a' || cast(o_orderkey as string) as charge,
            cast(cast(o_totalprice as decimal(18,2)) * 100 as bigint) as amount, 'usd' as currency, 'lost' as status, 'product_not_received' as reason,
            cast(EPOCH(o_orderdate + interval '9131' day) as bigint) as created
        from {orders}""",
    "stripe.payment_methods": f"""
        select 'pm_' || cast(c_custkey as string) as id,
            case when c_custkey % 11 = 0 then null else case c_mktsegment when 'BUILDING' then 'card' when 'AUTOMOBILE' then 'Card' when 'MACHINERY' then 'klarna'
                when 'HOUSEHOLD' then 'sepa_debit' else case c_custkey % 4 when 0 then 'link' when 1 then 'gift_card' when 2 then 'paypal' else 'affirm' end end end as type,
            'cus_' || cast(c_custkey as string) as customer, case when c_mktsegment in ('BUILDING', 'AUTOMOBILE') and c_custkey % 7 <> 0 then
                case c_custkey % 3 when 0 then 'Visa' when 1 then 'mastercard' else 'amex' end end as card_brand, '4242' as card_last4,
            '1' as card_exp_month, '2030' as card_exp_year, case when c_custkey % 8 = 0 then 'apple_pay' when c_custkey % 8 = 1 then 'google_pay' end as card_wallet,
            case c_custkey % 5 when 0 then 'credit' when 1 then 'debit' end as card_funding, 'US' as card_country,
            case when c_custkey % 10 = 0 then null when c_custkey % 33 = 0 then false else true end as livemode, 1577836800 + c_custkey as created
        from {{customer}}""",
    "ga4.events": f"""
        select {_DAY} as event_date, case event_type when 'view' then 'page_view' when 'click' then 'scroll' when 'signup' then 'sign_up' when 'purchase' then 'purchase' else 'exception' end as event_name,
            'u' || cast(user_id as string) as user_pseudo_id, case when user_id % 3 = 0 then cast(user_id as string) end as user_id,
            case when event_type <> 'error' or event_id % 50 <> 0 then {_DAY} end as ga_session_id, EPOCH_US(ts) as event_timestamp,
            case user_id % 3 when 0 then 'desktop' when 1 then 'mobile' else 'tablet' end as device__category, {_NULL} as device__mobile_brand_name,
            case when event_id % 2 = 0 then 'os' || cast(user_id % 4 as string) end as device__operating_system, 'browser' || cast(user_id % 5 as string) as device__web_info__browser,
            case user_id % 6 when 0 then 'google' when 1 then 'facebook' when 2 then 'Bing' when 3 then 'unknown' end as traffic_source__source,
            case user_id % 6 when 0 then 'organic' when 1 then 'cpc' when 2 then 'CPC' when 3 then 'x' end as traffic_source__medium, {_NULL} as traffic_source__name,
            case when user_id % 2 = 0 then 'C' || cast(user_id % 28 as string) else 'NATION_' || cast(user_id % 28 as string) end as geo__country, {_NULL} as geo__region,
            case when event_type in ('view', 'click') then '/p/' || cast(event_id % 20 as string) end as page_location, {_NULL} as page_referrer, {_NULL} as page_title,
            case when event_type = 'purchase' then 't' || cast(event_id as string) end as ecommerce__transaction_id,
            cast(value as decimal(18,6)) as ecommerce__purchase_revenue, 'usd' as ecommerce__currency, event_id % 5000 as engagement_time_msec,
            case when event_type = 'signup' then true when event_id % 2 = 0 then false end as is_new_user
        from {{events}}""",
    "ga4.users": """
        select 'u' || cast(user_id as string) as user_pseudo_id, case when user_id % 3 = 0 then cast(user_id as string) end as user_id,
            cast(min(ts) as date) as first_seen_date, cast(max(ts) as date) as last_seen_date
        from {events} group by user_id""",
    "meta_ads.daily_insights": """
        select cast(ts as date) as date_start, event_type as campaign_id, 'as' || cast(user_id % 10 as string) as ad_set_id, 'ad' || cast(user_id as string) as ad_id,
            cast(sum(cast(value as decimal(18,2))) as decimal(18,6)) as spend, count(*) * 100 as impressions, count(*) * 3 as clicks,
            case when user_id % 2 = 0 then count(*) * 50 end as reach, count(*) as inline_link_clicks,
            case when user_id % 13 = 0 then 'bad json' else '[{"action_type":"purchase","value":"' || cast(count(*) as string) || '"},{"action_type":"link_click","value":"7"},{"action_type":"purchase","value":2}]' end as actions,
            '[{"action_type":"purchase","value":"' || cast(sum(cast(value as decimal(18,2))) as string) || '"}]' as action_values
        from {events} group by cast(ts as date), event_type, user_id""",
    "meta_ads.campaigns": f"""
        select event_type as id, '2024-Q1_' || event_type || '_Sales_US' as name,
            case event_type when 'view' then 'OUTCOME_AWARENESS' when 'click' then 'outcome_traffic' when 'purchase' then 'OUTCOME_SALES' else 'CUSTOM_GOAL' end as objective,
            case when event_type = 'error' then 'PAUSED' else 'ACTIVE' end as status, 'acct' as account_id, 'AUCTION' as buying_type, count(*) as daily_budget,
            case when event_type = 'view' then count(*) * 3 end as lifetime_budget, min(ts) as start_time, cast(null as timestamp) as stop_time,
            min(ts) - interval '10' day as created_time, min(ts) - interval '9' day as updated_time
        from {{events}} group by event_type""",
    "meta_ads.ad_sets": """
        select 'as' || cast(user_id % 10 as string) || event_type as id, event_type as campaign_id, 'set ' || cast(user_id % 10 as string) as name,
            case when user_id % 10 = 0 then 'PAUSED' else 'ACTIVE' end as status, count(*) as daily_budget, case when user_id % 10 > 4 then count(*) * 7 end as bid_amount,
            'IMPRESSIONS' as billing_event, 'PURCHASE' as optimization_goal, min(ts) as start_time, max(ts) as end_time, min(ts) as created_time, cast(null as timestamp) as updated_time
        from {events} group by user_id % 10, event_type""",
    "meta_ads.ads": """
        select 'ad' || cast(user_id as string) || event_type as id, event_type as campaign_id, 'as' || cast(user_id % 10 as string) as adset_id, 'ad ' || cast(user_id as string) as name,
            case when user_id % 4 = 0 then 'ARCHIVED' else 'ACTIVE' end as status, 'cr' || cast(user_id as string) as creative_id, min(ts) as created_time, max(ts) as updated_time
        from {events} group by user_id, event_type""",
    "klaviyo.events": """
        select event_id as id, case event_type when 'view' then 'Opened Email' when 'click' then 'Clicked Email' when 'signup' then 'Received Email' when 'purchase' then 'Placed Order'
                else case when event_id % 3 = 0 then 'Custom Thing' else 'Bounced Email' end end as event_name,
            'k' || cast(user_id as string) as profile_id, ts as datetime, case event_id % 3 when 0 then cast(user_id % 120 as string) when 1 then '' end as campaign_id,
            case when event_id % 3 <> 0 then case when event_id % 7 <> 0 then cast(user_id % 30 as string) end end as flow_id,
            case when event_id % 29 = 0 then 'broken' else '{"url":"http://x/' || cast(event_id % 10 as string) || '","subject_line":"S' || cast(user_id % 5 as string) || '"'
                || case when event_type = 'error' then ',"bounce_type":"' || case event_id % 3 when 1 then 'Hard' else 'Odd' end || '","error_message":"mailbox full"' else '' end
                || ',"$device_type":"mobile"}' end as event_properties
        from {events}""",
    "klaviyo.profiles": """
        select 'k' || cast(c_custkey as string) as id, timestamp '2021-01-01 00:00:00' + (c_custkey % 700) * interval '1' day as created,
            case when c_custkey % 2 = 0 then timestamp '2025-01-01 00:00:00' end as updated, case when c_custkey % 20 <> 9 then case when c_custkey % 3 = 2 then 'reader' else 'customer' end || cast(c_custkey as string) || '@example.com' end as email,
            'Ann' as first_name, 'Smith' as last_name, cast(null as string) as phone_number,
            case c_custkey % 4 when 0 then 'subscribed' when 1 then 'unsubscribed' when 2 then 'never_subscribed' end as email_marketing__consent,
            case when c_custkey % 6 = 0 then 'subscribed' end as sms_marketing__consent
        from {customer}""",
    "klaviyo.campaigns": """
        select s_suppkey as id, s_name as name, 'Subject ' || cast(s_suppkey as string) as subject, case when s_suppkey % 3 = 0 then 'draft' else 'sent' end as status,
            case when s_suppkey % 3 <> 0 then timestamp '2023-05-05 09:30:00' end as send_time, case when s_suppkey % 4 <> 0 then cast(s_suppkey * 10 as int) end as num_recipients,
            timestamp '2023-05-01 00:00:00' as created, case when s_suppkey % 2 = 0 then timestamp '2023-05-06 00:00:00' end as updated
        from {supplier}""",
    "klaviyo.flows": """
        select n_nationkey as id, n_name as name, case when n_nationkey % 3 = 0 then 'draft' else 'live' end as status, 'metric' as trigger_type,
            timestamp '2022-05-01 00:00:00' as created, case when n_nationkey % 2 = 0 then timestamp '2022-06-01 00:00:00' end as updated
        from {nation}""",
}

# Reference tables: rates change by quarter and are built from the order months present in the data.
SEEDS: dict[str, str] = {
    "fx_rates": f"""
        with quarters as (select distinct cast(date_trunc('quarter', o_orderdate + {_SHIFT}) as date) as rate_date from {{orders}})
        select 'EUR' as from_currency, 'USD' as to_currency, rate_date, cast(1.05 + cast(month(rate_date) as decimal(4,0)) * 0.0125 as decimal(18,8)) as rate
        from quarters where rate_date >= date '2020-04-01'
        union all
        select 'GBP', 'USD', rate_date, cast(1.25 + cast(month(rate_date) as decimal(4,0)) * 0.0125 as decimal(18,8)) from quarters""",
    "geography_data": """
        select 'C' || cast(n_nationkey as string) as geography_id, 'C' || cast(n_nationkey as string) as country_code, n_name as country_name, r_name as country_region,
            cast(null as string) as country_subregion, cast(null as string) as state_or_region_code, cast(null as string) as state_or_region_name, 'USD' as default_currency,
            'UTC' as default_timezone, true as is_tax_jurisdiction
        from {nation} join {region} on n_regionkey = r_regionkey
        union all
        select 'C' || cast(n_nationkey as string) || '-01', 'C' || cast(n_nationkey as string), n_name, 'sub', cast(null as string), '01', 'First', 'USD', 'UTC', true from {nation}""",
    "product_category_mapping": """
        select p_type as product_type, 'Cat ' || p_type as category, 'Sub ' || p_type as subcategory from {part} where p_type <> 'PROMO' group by p_type""",
}


def spread(scan: DataFrame, *by: str) -> DataFrame:
    """Deal the rows of a scan out to all cores when it has fewer splits than there are cores.

    Meant for raw files with one large row group that feed costly projections. Scans with
    enough splits, as any big table has, stay as they are and are not shuffled. Name columns
    with many values in ``by``: hashing them repeats exactly when a task is retried, without
    the sort that dealing rows out in turn needs for that.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, *by) if scan.rdd.getNumPartitions() < cores else scan


# Given tables that come as one row group and feed wide projections, with columns to deal them out by.
SPREAD_BY = {"orders": ("o_orderkey",), "lineitem": ("l_orderkey", "l_partkey"), "events": ("event_id",)}


def read_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=64)
def base_view(spark: SparkSession, sf_dir: str, table: str) -> str:
    """A temporary view on one given table."""
    name = f"given_{zlib.crc32(sf_dir.encode()):x}_{table}"
    df = read_base(spark, sf_dir, table)
    (spread(df, *SPREAD_BY[table]) if table in SPREAD_BY else df).createOrReplaceTempView(name)
    return name


def spark_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run a shared text on Spark with the test tables it names."""
    text = text.replace("EPOCH_US(ts)", "unix_micros(cast(ts as timestamp))").replace("EPOCH(", "unix_timestamp(")
    for table in BASE:
        if "{" + table + "}" in text:
            text = text.replace("{" + table + "}", base_view(spark, sf_dir, table))
    return spark.sql(text)


def duck_sql(text: str) -> str:
    """The same text for DuckDB."""
    for table in BASE:
        text = text.replace("{" + table + "}", table)
    return text
