"""Queries that read whole models: staging, dimensions, facts, marts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tallyhouse.plans import dims, facts
from tallyhouse.sources.seeds import channel_rows
from tallyhouse.workload.oracle import NOW, TODAY, hashed
from tallyhouse.workload.raw import PARAMS
from tallyhouse.workload.registry import register

# ---- Staging ------------------------------------------------------------------------------
register(
    "stg_orders", "STG-1 PRJ-1 PRJ-2 PRJ-3 AGG-10 GOV-2",
    "order_id s, order_number s, shopify_customer_id s, order_timestamp t, order_date D, updated_at t, cancelled_at t,"
    "customer_email_hash_at_order s=email_hash, order_status s, financial_status s, gross_amount d=gross, discount_amount d=discount, tax_amount d=tax,"
    "shipping_amount d=shipping, tip_amount d=tip, net_amount d=net, original_currency_code s=currency, source_name s, utm_source s, utm_medium s, utm_campaign s,"
    "device_category s=device, ip_address_hash s=ip_hash, is_subscription_order b=subscription, primary_discount_code s=discount_code, shipping_country_code s=ship_to",
    lambda w: w["stg_shopify__orders"], "o_orders",
)
register(
    "stg_order_line_items", "STG-2 AGG-11 JN-12",
    "line_item_id s, order_id s, sku s, quantity l, unit_price d=price, line_subtotal d=subtotal, line_discount d=discount, line_net_amount d=subtotal - discount,"
    "line_tax d=tax, was_promotional b=promo",
    lambda w: w["stg_shopify__order_line_items"], "o_lines",
)
register(
    "stg_customers", "STG-3 GOV-2",
    "shopify_customer_id s=id, customer_email_hash s=" + hashed("email") + ", phone_hash s=" + hashed("phone") + ", last_name_hash s=" + hashed("last_name")
    + ", customer_status s=case id % 5 when 0 then 'active' when 2 then 'active' when 1 then 'blocked' when 3 then 'weird' else 'unknown' end,"
    "marketing_consent b=id % 4 = 1, sms_subscribed b=id % 8 = 1, country_code s=default_address_country_code,"
    "is_b2b_customer b=id % 30 in (0; 1) or id % 25 = 0, orders_count l, total_spent d, created_at t, updated_at t",
    lambda w: w["stg_shopify__customers"], "raw_shopify_customers",
)
register(
    "stg_refunds", "STG-4",
    "refund_id s, order_id s, refund_timestamp t, refund_date D, transactions l=3, lines l=case when has_lines then 2 end",
    lambda w: w["stg_shopify__refunds"].withColumns({"transactions": F.size("refund_transactions"), "lines": F.array_size("refund_line_items")}),
    "o_refunds",
)
register(
    "stg_transactions", "STG-5",
    "transaction_id s=o_orderkey, order_id s=o_orderkey, transaction_kind s=case o_orderstatus when 'O' then 'authorization' else 'sale' end,"
    "card_brand s=['visa'; 'mastercard'; 'amex'][o_custkey % 3 + 1], transaction_amount d=o_totalprice::decimal(18;6),"
    "maximum_refundable d=if(o_orderkey % 2 = 0; o_totalprice::decimal(18;6); 0), created_at t=o_orderdate + interval 9131 day",
    lambda w: w["stg_shopify__transactions"], "select * from orders where o_orderkey % 10 not in (3, 7)",
)
register(
    "stg_products", "STG-6",
    "product_id s=p_partkey, product_title s=p_name, product_type s=p_type, vendor s=p_brand, is_active b=p_size % 10 <> 0, product_tags_raw s=if(p_partkey % 2 = 0; 'a,b'; null),"
    "updated_at t=if(p_partkey % 3 = 0; timestamp '2023-01-01'; timestamp '2019-01-01')".replace("'a,b'", "'a;b'"),
    lambda w: w["stg_shopify__products"], "part",
)
register(
    "stg_product_variants", "STG-7",
    "variant_id s=p_partkey, product_id s=p_partkey, sku s=if(p_partkey % 211 = 1; null; 'SKU-' || p_partkey), unit_price d=p_retailprice::decimal(18;6), inventory_item_id s=p_partkey,"
    "inventory_quantity l=p_size, weight d=1.25, updated_at t=if(p_partkey % 5 = 0; null; timestamp '2018-12-01')",
    lambda w: w["stg_shopify__product_variants"], "part",
)
register(
    "stg_inventory_items", "STG-8",
    "inventory_item_id s=p_partkey, sku s='SKU-' || p_partkey, unit_cost d=if(p_partkey % 9 = 0; null; p_retailprice::decimal(18;2) * 0.6), inventory_tracked b=true",
    lambda w: w["stg_shopify__inventory_items"], "part",
)
register(
    "stg_inventory_levels", "STG-9",
    "inventory_item_id s=p_partkey, location_id s=p_partkey % 120, quantity_available l=if(p_partkey % 77 = 5; null; p_size * 7 - 20), quantity_incoming l=if(p_partkey % 2 = 0; p_size; 0)",
    lambda w: w["stg_shopify__inventory_levels"], "part",
)
register(
    "stg_inventory_snapshots", "STG-10",
    "inventory_item_id s, location_id s=inventory_item_id % 120, snapshot_date D, quantity_available l=available, quantity_incoming l=0",
    lambda w: w["stg_shopify__inventory_snapshots"], "raw_shopify_inventory_snapshots",
)
register(
    "stg_locations", "STG-11",
    "location_id s=s_suppkey, location_name s=s_name, is_active b=s_suppkey % 6 <> 0, is_legacy b=s_suppkey % 4 = 0, province_code s='P' || s_nationkey, country_code s='C' || s_nationkey",
    lambda w: w["stg_shopify__locations"], "supplier",
)
register(
    "stg_charges", "STG-12",
    "charge_id s, stripe_customer_id s=customer, charge_amount d=amount, amount_refunded d=refunded, currency_code s='USD', card_wallet s=nullif(wallet; ''), shopify_order_id s=order_id, charge_timestamp t=happened",
    lambda w: w["stg_stripe__charges"], "o_charges",
)
register(
    "stg_payment_customers", "STG-13",
    "stripe_customer_id s=id, customer_email_hash s=" + hashed("email") + ", phone_hash s=" + hashed("phone") + ", name_hash s=" + hashed("name")
    + ", is_delinquent b=c % 50 = 0, is_live b=true, created_at t=timestamp '2020-01-01' + (c % 1000) * interval 1 day",
    lambda w: w["stg_stripe__customers"], "select *, substr(id, 5)::bigint as c from raw_stripe_customers",
)
register(
    "stg_processor_refunds", "STG-14",
    "refund_id s='re_' || o_orderkey, charge_id s='ch_a' || o_orderkey, refund_amount d=o_totalprice, currency_code s='EUR',"
    "refund_reason s=case o_orderkey % 7 when 0 then 'Fraudulent' when 1 then 'requested_by_customer' end, is_chargeback b=false, refund_timestamp t=o_orderdate",
    lambda w: w["stg_stripe__refunds"], "select * from orders where o_orderkey % 5 <> 0",
)
register(
    "stg_disputes", "STG-15",
    "dispute_id s='dp_' || o_orderkey, charge_id s='ch_a' || o_orderkey, dispute_amount d=o_totalprice, currency_code s='USD', dispute_status s='lost', is_chargeback b=true,"
    "dispute_timestamp t=o_orderdate + interval 9131 day",
    lambda w: w["stg_stripe__disputes"], "orders",
)
register(
    "stg_payment_methods", "STG-16",
    "payment_method_id s=id, payment_method_type s=type, card_brand s, card_funding s, card_wallet s, is_live b=true, created_at t=timestamp '1970-01-01' + to_seconds(created)",
    lambda w: w["stg_stripe__payment_methods"], "select * from raw_stripe_payment_methods where livemode is distinct from false",
)
register(
    "stg_web_events", "STG-17",
    "user_pseudo_id s='u' || user_id, ga_session_id s=if(event_type = 'error' and event_id % 50 = 0; null; strftime(ts; '%Y%m%d')), event_name s=case event_type when 'view' then 'page_view' when 'click' then 'scroll' when 'signup' then 'sign_up' when 'purchase' then 'purchase' else 'exception' end,"
    "event_date D=ts, event_timestamp t=ts, device_category s=['desktop'; 'mobile'; 'tablet'][user_id % 3 + 1], page_location s=if(event_type in ('view'; 'click'); '/p/' || (event_id % 20); null),"
    "purchase_value d=value, purchase_currency s='USD', engagement_time_msec l=event_id % 5000, is_new_user b=if(event_type = 'signup'; true; if(event_id % 2 = 0; false; null))",
    lambda w: w["stg_ga4__events"], "events",
)
register(
    "stg_web_users", "STG-18",
    "user_pseudo_id s='u' || user_id, user_id s=if(user_id % 3 = 0; user_id; null), first_seen_date D=lo, last_seen_date D=hi",
    lambda w: w["stg_ga4__users"], "select user_id, min(ts) as lo, max(ts) as hi from events group by user_id",
)
register(
    "stg_ad_campaigns", "STG-19",
    "campaign_id s='meta_' || event_type, meta_campaign_id s=event_type, campaign_status s=if(event_type = 'error'; 'PAUSED'; 'ACTIVE'), is_active b=event_type <> 'error', daily_budget d=n / 100, lifetime_budget d=if(event_type = 'view'; n * 3 / 100; 0),"
    "start_date D=lo, created_at t=lo - interval 10 day, updated_at t=lo - interval 9 day",
    lambda w: w["stg_meta_ads__campaigns"], "select event_type, count(*) as n, min(ts) as lo from events group by all",
)
register(
    "stg_ad_sets", "STG-20",
    "ad_set_id s='as' || g || event_type, campaign_id s='meta_' || event_type, is_active b=g <> 0, daily_budget d=n / 100, bid_amount d=if(g > 4; n * 7 / 100; 0), start_date D=lo, end_date D=hi",
    lambda w: w["stg_meta_ads__ad_sets"], "select user_id % 10 as g, event_type, count(*) as n, min(ts) as lo, max(ts) as hi from events group by all",
)
register(
    "stg_ads", "STG-21",
    "ad_id s='ad' || user_id || event_type, ad_set_id s='as' || (user_id % 10), campaign_id s='meta_' || event_type, ad_status s=if(user_id % 4 = 0; 'ARCHIVED'; 'ACTIVE'), is_active b=user_id % 4 <> 0, created_at t=lo, updated_at t=hi",
    lambda w: w["stg_meta_ads__ads"], "select user_id, event_type, min(ts) as lo, max(ts) as hi from events group by all",
)
register(
    "stg_ad_insights", "STG-22 AGG-9 JN-16",
    "spend_date D=day, campaign_id s='meta_' || event_type, ad_set_id s='as' || (user_id % 10), ad_id s='ad' || user_id, spend_amount_local d=v, impressions l=n * 100, clicks l=n * 3,"
    "reach l=if(user_id % 2 = 0; n * 50; 0), link_clicks l=n, platform_reported_conversions d=if(user_id % 13 = 0; 0; n + 2), platform_reported_conversion_value d=v",
    lambda w: w["stg_meta_ads__daily_insights"],
    "select ts::date as day, event_type, user_id, count(*) as n, sum(value::decimal(18,2)) as v from events group by all",
)
register(
    "stg_email_events", "STG-23 CFG-5",
    "event_id s, klaviyo_profile_id s='k' || user_id, event_type s=case event_type when 'view' then 'opened' when 'click' then 'clicked' when 'signup' then 'delivered' when 'purchase' then 'converted' else if(event_id % 3 = 0; 'other'; 'bounced') end,"
    "campaign_id s=case event_id % 3 when 0 then (user_id % 120)::varchar when 1 then '' end, event_timestamp t=ts, event_date D=ts, url s=if(event_id % 29 = 0; null; 'http://x/' || (event_id % 10))",
    lambda w: w["stg_klaviyo__events"].withColumn("url", F.try_variant_get("event_properties", "$.url", "string")), "events",
)
register(
    "stg_email_profiles", "STG-24",
    "klaviyo_profile_id s='k' || c_custkey, customer_email_hash s=if(c_custkey % 20 = 9; null; sha256('pepper' || if(c_custkey % 3 = 2; 'reader'; 'customer') || c_custkey || '@example.com')), email_subscribed b=c_custkey % 4 = 0, sms_subscribed b=c_custkey % 6 = 0,"
    "marketing_consent b=c_custkey % 4 = 0 or c_custkey % 6 = 0, updated_at t=if(c_custkey % 2 = 0; timestamp '2025-01-01'; timestamp '2021-01-01' + (c_custkey % 700) * interval 1 day)",
    lambda w: w["stg_klaviyo__profiles"], "customer",
)
register(
    "stg_email_campaigns", "STG-25",
    "campaign_id s=s_suppkey, campaign_name s=s_name, is_sent b=s_suppkey % 3 <> 0, send_date D=if(s_suppkey % 3 <> 0; date '2023-05-05'; null), audience_size l=if(s_suppkey % 4 = 0; 0; s_suppkey * 10),"
    "updated_at t=if(s_suppkey % 2 = 0; timestamp '2023-05-06'; timestamp '2023-05-01')",
    lambda w: w["stg_klaviyo__campaigns"], "supplier",
)
register(
    "stg_email_flows", "STG-26",
    "flow_id s=n_nationkey, flow_name s=n_name, is_active b=n_nationkey % 3 <> 0, send_date D=null, updated_at t=if(n_nationkey % 2 = 0; timestamp '2022-06-01'; timestamp '2022-05-01')",
    lambda w: w["stg_klaviyo__flows"], "nation",
)
register(
    "audit_columns", "GOV-1",
    "order_id s, _source_system s='shopify', _source_record_id s=order_id, _extracted_at t=updated_at, _loaded_at t=" + NOW + ", _run_id s='driver', _model s='stg_shopify__orders',"
    "_record_hash s=md5(order_id || '-' || updated_at::varchar), _is_deleted_at_source b=false",
    lambda w: w["stg_shopify__orders"], "o_orders",
)

# ---- Identity and enrichment --------------------------------------------------------------
register(
    "customer_identity", "INT-1 GOV-2",
    "customer_id s, shopify_customer_id s, stripe_customer_id s, klaviyo_profile_id s, email_hash s=email, phone_hash s=phone, customer_status s=status, is_b2b_customer b=b2b, country_code s=country,"
    "email_subscribed b=sub_email, sms_subscribed b=sub_sms, marketing_consent b=consent, source_systems j=systems, identity_resolution_method s=method, match_confidence s=confidence,"
    "acquisition_source_system s=first_system, acquisition_date D=acquired, created_at t=born, updated_at t=changed",
    lambda w: w["int_customer_identity"], "o_identity",
)
register(
    "orders_enriched", "INT-2 WIN-5",
    "order_id s, line_item_count l=line_count, total_quantity d=units, is_first_order b=is_first, is_repeat_order b=is_repeat",
    lambda w: w["int_orders_enriched"], "o_enriched",
)
register(
    "web_sessions", "INT-3 STR-1",
    "session_id s, user_pseudo_id s, session_date D=day, session_start_timestamp t=began, session_duration_seconds l=seconds, page_views l=views, events_count l=events, landing_page s=landing, exit_page s=leaving,"
    "has_purchase_event b=bought, transaction_revenue d=revenue, is_new_user b=is_new, user_id s, device_category s=device, device_os s=os, traffic_source s=source, traffic_medium s=medium",
    lambda w: w["int_web_sessions"], "o_sessions",
)

# ---- Dimensions ---------------------------------------------------------------------------
_D = "d::date"
# Holidays found another way: each weekday of a month is numbered from the front and from the back.
_HOLIDAYS = f"""select d, case when month(d) = 1 and day(d) = 1 then 'New Year''s Day' when month(d) = 6 and day(d) = 19 then 'Juneteenth National Independence Day'
        when month(d) = 7 and day(d) = 4 then 'Independence Day' when month(d) = 11 and day(d) = 11 then 'Veterans Day' when month(d) = 12 and day(d) = 25 then 'Christmas Day'
        when isodow(d) = 1 and month(d) = 1 and nth = 3 then 'Martin Luther King Jr. Day' when isodow(d) = 1 and month(d) = 2 and nth = 3 then 'Presidents'' Day'
        when isodow(d) = 1 and month(d) = 5 and back = 1 then 'Memorial Day' when isodow(d) = 1 and month(d) = 9 and nth = 1 then 'Labor Day'
        when isodow(d) = 1 and month(d) = 10 and nth = 2 then 'Columbus Day' when isodow(d) = 4 and month(d) = 11 and nth = 4 then 'Thanksgiving Day' end as name
    from (select d, row_number() over (partition by year(d), month(d), isodow(d) order by d) as nth, row_number() over (partition by year(d), month(d), isodow(d) order by d desc) as back
          from (select unnest(range(timestamp '{PARAMS.calendar_start}', timestamp '{PARAMS.calendar_end}' + interval 1 day, interval 1 day))::date as d))"""
register(
    "dim_date", "DIM-1 DIM-1a DIM-1b DIM-1c DIM-1d DIM-1e",
    "date_sk l=strftime(d; '%Y%m%d'), date_actual D=d, day_of_week l=isodow(d), day_name s=strftime(d; '%a'), day_of_year l=dayofyear(d), is_weekend b=isodow(d) > 5, holiday_name s=holiday, is_holiday b=holiday is not null, is_business_day b=isodow(d) < 6 and holiday is null,"
    "week_of_year l=weekofyear(d), week_starting_date D=date_trunc('week'; d), week_ending_date D=date_trunc('week'; d) + interval 6 day, month_short_name s=strftime(d; '%b'), month_ending_date D=last_day(d),"
    "quarter_name s='Q' || quarter(d), year l=year(d), fiscal_year l=year(d + interval 6 month), fiscal_month l=month(d + interval 6 month), fiscal_quarter l=quarter(d + interval 6 month),"
    "prior_year_date_actual D=d - interval 1 year, prior_year_date_sk l=strftime(d - interval 1 year; '%Y%m%d'), days_from_today l=d - t, is_today b=d = t, is_yesterday b=d = t - 1,"
    "is_current_week b=date_trunc('week'; d) = date_trunc('week'; t), is_current_month b=date_trunc('month'; d) = date_trunc('month'; t), is_current_quarter b=date_trunc('quarter'; d) = date_trunc('quarter'; t),"
    "is_current_fiscal_year b=year(d + interval 6 month) = year(t + interval 6 month), is_wtd b=d between date_trunc('week'; t) and t, is_mtd b=d between date_trunc('month'; t) and t, is_qtd b=d between date_trunc('quarter'; t) and t,"
    "is_ytd b=d between date_trunc('year'; t) and t, is_fytd b=year(d + interval 6 month) = year(t + interval 6 month) and d <= t, is_last_7_days b=d > t - 7 and d <= t, is_last_30_days b=d > t - 30 and d <= t,"
    "is_last_90_days b=d > t - 90 and d <= t, is_last_365_days b=d > t - 365 and d <= t, orders l=n",
    lambda w: dims.dim_date(w.spark, replace(PARAMS, fiscal_year_start_month=7), w.seeds()["holidays"]).join(
        w["stg_shopify__orders"].groupBy(F.col("order_date").alias("date_actual")).agg(F.count("*").alias("orders")), "date_actual", "left"
    ),
    f"""select c.d, {TODAY} as t, h.name as holiday, o.n from (select unnest(range(timestamp '{PARAMS.calendar_start}', timestamp '{PARAMS.calendar_end}' + interval 1 day, interval 1 day))::date as d) c
        left join (select order_date, count(*) as n from o_orders group by order_date) o on o.order_date = c.d left join ({_HOLIDAYS}) h on h.d = c.d""",
)
_CHANNELS = ", ".join("(" + ", ".join("null" if v is None else str(v).lower() if isinstance(v, bool) else "'" + v.replace("'", "''") + "'" for v in (r[2], r[3], r[4])) + ")" for r in channel_rows())
register(
    "dim_channel", "DIM-5 AGG-14 PRJ-7",
    "channel_sk s=md5(id), channel_id s=id, channel_name s=name, channel_category s=category, orders l=coalesce(n; 0),"
    "channel_type s=case when category in ('retail'; 'marketplace') then 'sales' when category in ('search'; 'social'; 'email'; 'direct'; 'referral'; 'other') then 'acquisition' else 'both' end",
    lambda w: w["dim_channel"].join(w["fact_orders"].groupBy("channel_sk").agg(F.count("*").alias("orders")), "channel_sk", "left").fillna(0, ["orders"]),
    f"select c.*, o.n from (select id, max(name) as name, max(category) as category from (values {_CHANNELS}) v(id, name, category) group by id) c"
    " left join (select channel_sk, count(*) as n from o_fact_orders group by channel_sk) o on o.channel_sk = md5(c.id)",
)
register(
    "dim_geography", "DIM-6",
    "geography_sk s=md5(g), geography_id s=g, country_code s='C' || n_nationkey, country_name s=n_name, country_region s=region, state_or_region_code s=state",
    lambda w: w["dim_geography"],
    "select n_nationkey, n_name, 'C' || n_nationkey as g, r_name as region, null as state from nation join region on r_regionkey = n_regionkey union all select n_nationkey, n_name, 'C' || n_nationkey || '-01', 'sub', '01' from nation",
)
register(
    "dim_payment_method", "DIM-7 PRJ-6 WIN-4",
    "payment_method_sk s=sk, payment_method_id s=id, payment_method_type s=kind, payment_provider s=provider, card_brand s=brand, card_funding s=funding, is_credit_card b=kind = 'card',"
    "is_digital_wallet b=kind = 'digital_wallet', is_bnpl b=kind = 'bnpl', is_recurring_capable b=kind in ('card'; 'bank_transfer'),"
    "payment_method_name s=case when kind = 'card' and brand is not null then upper(brand[1]) || brand[2:] || coalesce(' ' || upper(funding[1]) || funding[2:]; '') || ' Card'"
    " when wallet = 'apple_pay' and kind = 'digital_wallet' then 'Apple Pay' when wallet = 'google_pay' and kind = 'digital_wallet' then 'Google Pay' when kind = 'bnpl' then upper(provider[1]) || provider[2:]"
    " when kind = 'bank_transfer' then 'Bank Transfer (' || upper(provider) || ')' else (select string_agg(upper(p[1]) || p[2:]; ' ') from (select unnest(string_split(id; '_')) as p)) end",
    lambda w: w["dim_payment_method"], "o_payment_methods",
)
register(
    "dim_email_campaign", "DIM-8 SET-1 PRJ-20",
    "email_campaign_sk s=md5(id), email_campaign_id s=id, campaign_name s=name, campaign_type s=kind, subject_line s=subject, send_date D=sent, audience_size l=size, is_active b=active",
    lambda w: w["dim_email_campaign"],
    "select 'cmp_' || s_suppkey as id, s_name as name, 'campaign' as kind, 'Subject ' || s_suppkey as subject, if(s_suppkey % 3 = 0, null, date '2023-05-05') as sent, if(s_suppkey % 4 = 0, 0, s_suppkey * 10) as size, s_suppkey % 3 = 0 as active from supplier"
    " union all select 'flw_' || n_nationkey, n_name, 'flow', null, null, null, n_nationkey % 3 <> 0 from nation",
)
register(
    "dim_warehouse_location", "DIM-9 PRJ-8",
    "location_sk s=md5(s_suppkey::varchar), location_id s=s_suppkey, location_type s=if(s_suppkey % 5 = 0; '3pl'; if(s_suppkey % 4 = 0; 'store'; 'warehouse')), is_fulfillment_location b=s_suppkey % 4 <> 0 or s_suppkey % 6 <> 0, timezone s='Africa/Nairobi'",
    lambda w: w["dim_warehouse_location"], "supplier",
)
register(
    "dim_customer", "DIM-2 SCD-2 SCD-6 SNK-9",
    "customer_sk s, customer_id s, shopify_customer_id s, email s=null, customer_status s=status, is_b2b_customer b=b2b, customer_tags j=coalesce(tags; ''), marketing_consent b=consent, valid_from t, valid_to t=null::timestamp, is_current b=true",
    lambda w: w["dim_customer"],
    "select d.*, case d.shopify_customer_id::int % 30 when 0 then 'vip| B2B' when 1 then 'Wholesale' when 2 then 'reseller' end as tags from o_dim_customer d",
)
register(
    "dim_product", "DIM-3 SCD-3 SCD-4 PRJ-10 JN-17",
    "product_sk s, sku s, variant_id s, product_title s=p_name, display_name s, category s, vendor s=p_brand, unit_cost d, tags j=if(k % 2 = 0; 'a|b'; ''), valid_from t, valid_to t, is_current b=valid_to is null",
    lambda w: w["dim_product"], "o_dim_product",
)
register(
    "dim_marketing_campaign", "DIM-4 PRJ-9",
    "campaign_sk s=md5('meta_' || event_type || '-' || (lo - interval 9 day)::varchar), campaign_id s='meta_' || event_type, campaign_objective s=case event_type when 'view' then 'awareness' when 'click' then 'traffic' when 'purchase' then 'conversions' else 'custom_goal' end,"
    "campaign_status s=if(event_type = 'error'; 'paused'; 'active'), buying_type s='auction', channel_sk s=md5('paid_social_meta'), valid_from t=lo - interval 9 day, is_current b=true",
    lambda w: w["dim_marketing_campaign"], "select event_type, min(ts) as lo from events group by event_type",
)

# ---- Facts --------------------------------------------------------------------------------
register(
    "fact_orders", "FCT-1 JN-1 JN-3 JN-6 JN-7 JN-8 JN-9 JN-18 AGG-6 WIN-2 WIN-3 PRJ-12 PRJ-19",
    "order_sk s, order_id s, customer_sk s, customer_id s, channel_sk s, geography_sk s, payment_method_sk s=pm_sk, order_date D, order_status s, gross_amount d=gross4, discount_amount d=discount4, tax_amount d=tax4,"
    "shipping_amount d=shipping4, tip_amount d=tip4, net_amount d=net4, refunded_amount d=back4, net_after_refunds d=after4, currency_code s='USD', original_currency_code s=currency, fx_rate_to_reporting d=coalesce(fx; 1),"
    "is_fx_rate_missing b=fx is null, line_item_count l=line_count, total_quantity d=units, is_first_order b=is_first, is_repeat_order b=is_repeat, tags j=coalesce(replace(tags; ','; '|'); ''), utm_source s, device_category s=device".replace("','", "chr(44)"),
    lambda w: w["fact_orders"], "o_fact_orders",
)
register(
    "fact_order_lines", "FCT-2 JN-4 AGG-8 PRJ-15",
    "line_item_id s, order_id s, order_sk s, customer_sk s, product_sk s, sku s, channel_sk s, order_date D, quantity d, unit_price d=price, unit_cost d, line_subtotal d=subtotal4, line_discount d=discount4, line_tax d=tax4,"
    "line_net_amount d=net4, line_gross_margin d=margin4, was_promotional b=promo, refunded_quantity d=back_units, refunded_amount d=back4, is_returned b=back_units > 0",
    lambda w: w["fact_order_lines"], "o_fact_lines",
)
register(
    "fact_refunds", "FCT-3 AGG-7 JN-10 JN-18 PRJ-4 PRJ-5 PRJ-22",
    "refund_sk s, refund_id s, order_sk s, order_id s, customer_sk s, refund_date D, refund_timestamp t, refund_type s, refund_category s=category, refund_amount d=amount4, refund_shipping_amount d=shipping4, original_refund_amount d=amount, processor s, is_chargeback b=chargeback",
    lambda w: w["fact_refunds"], "o_fact_refunds",
)
register(
    "fact_inventory_movements", "FCT-9 JN-2 JN-13 SET-2 SNK-7 PRJ-20",
    "movement_id s, product_sk s, sku s, movement_date D=day, movement_type s=kind, quantity_change d=change, unit_cost d, movement_value d=value, reference_order_id s=order_id",
    lambda w: w["fact_inventory_movements"], "o_movements",
)
register(
    "fact_customer_state_daily", "FCT-7 AGG-4 AGG-15 JN-14 JN-15 PRJ-14 PRJ-17 PRJ-18 SET-3",
    "customer_id s, customer_sk s, snapshot_date D=day, days_since_acquisition l=age, days_since_first_order l=since_first, days_since_last_order l=since_last, lifetime_order_count l=n, lifetime_revenue d=rev, lifetime_quantity d=qty,"
    "trailing_30d_order_count l=n30, trailing_30d_revenue d=rev30, trailing_90d_order_count l=n90, trailing_90d_revenue d=rev90, is_active_30d b=n30 > 0, is_active_90d b=n90 > 0, is_new_30d b=age <= 30, is_repeat_customer b=n >= 2, predicted_ltv d=null",
    lambda w: w["fact_customer_state_daily"], "o_state",
)
register(
    "fact_inventory_snapshot", "FCT-8 AGG-12 AGG-13 JN-14 JN-15 PRJ-16 PRJ-21",
    "inventory_item_id s=item, location_id s=place, snapshot_date D=day, sku s, product_sk s, location_sk s=loc, quantity_available d=qty, unit_cost d=cost, inventory_value d=(qty * cost)::decimal(18;4), is_out_of_stock b=qty <= 0,"
    "days_of_supply r=if(per_day > 0; (qty::double / per_day)::decimal(18;2); null)",
    lambda w: w["fact_inventory_snapshot"],
    "select i.*, md5(s.s_suppkey::varchar) as loc from o_inventory i left join supplier s on s.s_suppkey::varchar = i.place",
)
register(
    "fact_inventory_snapshot_daily", "FCT-8",
    "inventory_item_id s, snapshot_date D, quantity_available d=available, unit_cost d=cost, inventory_value d=(available * cost)::decimal(18;4), is_out_of_stock b=available <= 0, days_of_supply r=if(u > 0; (available::double / (u::double / 28.0))::decimal(18;2); null)",
    lambda w: facts.fact_inventory_snapshot(
        w["stg_shopify__inventory_levels"], w["stg_shopify__inventory_items"], w.inputs()["fact_order_lines"], dim_product=w["dim_product"],
        dim_warehouse_location=w["dim_warehouse_location"], params=replace(PARAMS, snapshot_mode="daily"),
        daily_feed=w["stg_shopify__inventory_snapshots"]),
    "select s.inventory_item_id, s.snapshot_date, s.available, max(i.cost) as cost, sum(l.quantity - l.back_units) as u from raw_shopify_inventory_snapshots s"
    " join raw_shopify_inventory_items i on i.id = s.inventory_item_id left join o_fact_lines l on l.sku = i.sku and l.order_date between s.snapshot_date - 28 and s.snapshot_date - 1 group by 1, 2, 3",
)
register(
    "fact_marketing_spend", "FCT-4 AGG-5 JN-5 JN-13",
    "campaign_id s='meta_' || event_type, spend_date D=day, campaign_sk s=if(event_type = 'none'; null; md5('meta_' || event_type || '-' || (first - interval 9 day)::varchar)), channel_sk s=md5('paid_social_meta'), date_sk l=strftime(day; '%Y%m%d'),"
    "spend_amount d=v, impressions l=n * 100, clicks l=n * 3, conversions_reported_by_platform d=c, conversion_value_reported_by_platform d=v",
    lambda w: w["fact_marketing_spend"],
    "select day, event_type, sum(n) as n, sum(v) as v, sum(if(user_id % 13 = 0, 0, n + 2)) as c, any_value(first) as first from (select ts::date as day, event_type, user_id, count(*) as n, sum(value::decimal(18,2)) as v from events group by all)"
    " join (select event_type, min(ts) as first from events group by all) using (event_type) group by day, event_type",
)
register(
    "fact_web_sessions", "FCT-5 JN-7 JN-9 PRJ-19",
    "session_id s, user_pseudo_id s, customer_id s, customer_sk s, channel_sk s=case u % 6 when 0 then md5('organic_search_google') when 1 then md5('paid_social_meta') when 2 then md5('paid_search_bing') when 3 then null else md5('direct') end,"
    "geography_sk s=if(u % 28 < 25; md5('C' || (u % 28)); null), session_date D=day, page_views l=views, transaction_revenue d=revenue",
    lambda w: w["fact_web_sessions"],
    "select s.*, substr(s.user_pseudo_id, 2)::int as u, c.customer_id, c.customer_sk from o_sessions s left join o_dim_customer c on c.shopify_customer_id = s.user_id",
)
register(
    "fact_email_engagement", "FCT-6 PRJ-11 PRJ-20",
    "event_id s, customer_sk s, email_campaign_sk s=camp, event_type s=kind, event_date D=ts, email_subject s=if(event_id % 29 = 0; null; 'S' || (user_id % 5)), link_url s=if(event_id % 29 = 0; null; 'http://x/' || (event_id % 10)),"
    "bounce_type s=if(event_type = 'error' and event_id % 29 <> 0; if(event_id % 3 = 1; 'hard'; 'Odd'); null), device_type s=if(event_id % 29 = 0; null; 'mobile')",
    lambda w: w["fact_email_engagement"],
    "select e.*, c.customer_sk, case event_type when 'view' then 'opened' when 'click' then 'clicked' when 'signup' then 'delivered' when 'purchase' then 'converted' else if(event_id % 3 = 0, 'other', 'bounced') end as kind,"
    " case when event_id % 3 = 0 then (select md5('cmp_' || s_suppkey) from supplier where s_suppkey = user_id % 120) when event_id % 7 <> 0 then (select md5('flw_' || n_nationkey) from nation where n_nationkey = user_id % 30) end as camp"
    " from events e left join o_dim_customer c on c.klaviyo_profile_id = 'k' || e.user_id",
)

# ---- Marts --------------------------------------------------------------------------------
_SALES = (
    "select order_date, channel_sk, geography_sk, sum(gross4) as gmv, sum(gross4 - discount4 - back4) as net_revenue, count(distinct order_id) as order_count, sum(tax4) as tax,"
    " count(distinct customer_sk) filter (where is_first) as fresh, count(distinct customer_sk) filter (where is_repeat) as loyal, count(distinct customer_sk) as people, sum(discount4) as discounts,"
    " sum(shipping4) as shipping, sum(back4) as refunds from o_fact_orders where order_status <> 'cancelled' group by order_date, channel_sk, geography_sk"
)
register(
    "mart_sales", "MRT-1 AGG-1 AGG-2 JN-19 PRJ-13 KPI-1 KPI-2 KPI-3 KPI-9 KPI-12 KPI-13",
    "order_date D, date_sk l=strftime(order_date; '%Y%m%d'), channel_sk s, geography_sk s, country_name s=place, gmv d, net_revenue d, order_count l, tax_collected d=tax, new_customers l=fresh, repeat_customers l=loyal,"
    "unique_customers l=people, total_discounts d=discounts, shipping_revenue d=shipping, total_refunds d=refunds, mart_sales_sk s=md5(order_date::varchar || '-' || coalesce(channel_sk; '_null_') || '-' || coalesce(geography_sk; '_null_'))",
    lambda w: w["mart_sales"], f"select s.*, n_name as place from ({_SALES}) s left join nation on md5('C' || n_nationkey) = s.geography_sk",
)
register(
    "mart_customer", "MRT-2 AGG-3 KPI-10 KPI-11 JN-19",
    "snapshot_date D=day, date_sk l=strftime(day; '%Y%m%d'), active_customers_30d l=a30, active_customers_90d l=a90, total_tracked_customers l=n, new_in_30d_window l=fresh, repeat_customers l=loyal, avg_lifetime_revenue r=avg_rev, avg_lifetime_orders r=avg_n,"
    "total_trailing_30d_revenue d=r30, total_trailing_90d_revenue d=r90",
    lambda w: w["mart_customer"],
    "select day, count(distinct customer_id) filter (where n30 > 0) as a30, count(distinct customer_id) filter (where n90 > 0) as a90, count(distinct customer_id) as n, count(distinct customer_id) filter (where age <= 30) as fresh,"
    " count(distinct customer_id) filter (where o_state.n >= 2) as loyal, avg(rev) as avg_rev, avg(o_state.n) as avg_n, sum(rev30) as r30, sum(rev90) as r90 from o_state group by day",
)
register(
    "mart_inventory", "MRT-3 KPI-20 KPI-22 JN-19",
    "snapshot_date D=day, sku s, category s=cat, product_display_name s=title, location_type s=kind, quantity_available d=qty, inventory_value d=(qty * cost)::decimal(18;4), is_out_of_stock b=qty <= 0, month_number l=month(day)",
    lambda w: w["mart_inventory"],
    "select i.*, d.category as cat, d.display_name as title, case when s_suppkey is null then null when s_suppkey % 5 = 0 then '3pl' when s_suppkey % 4 = 0 then 'store' else 'warehouse' end as kind from o_inventory i"
    " left join o_dim_product d on d.product_sk = i.product_sk left join supplier on s_suppkey::varchar = i.place",
)
register(
    "dim_product_backdated", "SCD-5",
    "variant_id s, valid_from t=if(valid_to is null; timestamp '2018-06-01'; valid_from), valid_to t, product_sk s",
    lambda w: dims.dim_product(
        w["snap_product"], w.warehouse().seeds["product_category_mapping"], replace(PARAMS, backdate_products=True)),
    "o_dim_product",
)
