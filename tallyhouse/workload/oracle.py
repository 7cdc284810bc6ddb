"""DuckDB counterparts of the models, written from the raw derivations.

Texts refer to one another by name; ``with_models`` turns the needed ones into a WITH clause.
They avoid the library's own routes: payload results are computed from the numbers the payload
was made of, history joins are correlated by range, and as-of measures by inequality joins.
"""

from __future__ import annotations

import re

from tallyhouse.workload.raw import AS_OF, SEEDS, SQL, duck_sql

TODAY = f"date '{AS_OF.isoformat()}'"
NOW = f"timestamp '{AS_OF.isoformat()} 00:00:00'"


def hashed(expr: str) -> str:
    return f"sha256('pepper' || lower(trim(cast({expr} as varchar))))"


def local_day(expr: str) -> str:
    """Nairobi is three hours ahead of UTC all year."""
    return f"cast({expr} + interval 3 hour as date)"


_LINE = "(l_orderkey::varchar || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber)"
_CENT = "cast(l_extendedprice as decimal(18,2))"

MODELS: dict[str, str] = {
    **{"raw_" + k.replace(".", "_"): duck_sql(v) for k, v in SQL.items()},
    **{"seed_" + k: duck_sql(v) for k, v in SEEDS.items()},
    "o_orders": f"""
        select id::varchar as order_id, id as n, name as order_number, case when customer_id <> 0 then customer_id::varchar end as shopify_customer_id,
            created_at as order_timestamp, {local_day('created_at')} as order_date, updated_at, cancelled_at, {hashed('email')} as email_hash,
            case when cancelled_at is not null or (financial_status = 'voided') then 'cancelled'
                 when financial_status in ('refunded') then 'refunded' when financial_status = 'partially_refunded' then 'partial_refund'
                 when financial_status = 'paid' then case fulfillment_status when 'fulfilled' then 'fulfilled' else 'paid' end
                 when financial_status = 'pending' then 'pending' else 'unknown' end as order_status,
            financial_status, subtotal_price as gross, total_discounts as discount, total_tax as tax, cast(5 as decimal(18,6)) as shipping,
            coalesce(total_tip_received, 0)::decimal(18,6) as tip, total_price as net, currency, source_name,
            case when id % 31 = 0 then null when id % 3 = 0 then 'Facebook' when id % 3 = 1 then 'google' end as utm_source,
            case when id % 31 = 0 then null when id % 3 = 0 then 'CPC' when id % 3 = 1 then 'organic' end as utm_medium,
            case when id % 31 <> 0 and id % 3 = 0 then 'c' || (id % 9) end as utm_campaign,
            case when id % 10 = 0 then null when 300 + id % 1200 < 768 then 'mobile' when 300 + id % 1200 < 1024 then 'tablet' else 'desktop' end as device,
            {hashed('browser_ip')} as ip_hash, (coalesce(source_name, '') = 'recharge' or id % 9 = 0) as subscription,
            case when id % 6 = 0 then 'SAVE' || (id % 4) end as discount_code, shipping_address_country_code as ship_to, tags
        from raw_shopify_orders where id % 97 <> 0 and created_at::date >= date '2020-01-01'""",
    "o_lines": f"""
        select {_LINE} as line_item_id, l_orderkey::varchar as order_id, 'SKU-' || l_partkey as sku, l_quantity::int as quantity, {_CENT}::decimal(18,6) as price,
            (l_quantity::int * {_CENT})::decimal(18,6) as subtotal, ({_CENT} * l_discount::decimal(4,2))::decimal(18,6) as discount,
            case when l_linenumber = 7 and l_partkey % 5 = 0 then 0 else ({_CENT} * l_tax::decimal(4,2))::decimal(18,4) + 0.5 end::decimal(18,6) as tax,
            l_discount > 0 as promo
        from lineitem""",
    "o_refunds": f"""
        select 'R' || {_LINE} as refund_id, {_LINE} as line_item_id, l_orderkey::varchar as order_id,
            l_shipdate + interval 9131 day + (l_partkey % 24) * interval 1 hour as refund_timestamp,
            {local_day('l_shipdate + interval 9131 day + (l_partkey % 24) * interval 1 hour')} as refund_date, l_linenumber as k,
            {_CENT}::decimal(18,6) as amount, case when l_linenumber = 3 then {_CENT} else 0 end::decimal(18,6) as shipping_amount,
            not (l_linenumber = 6 and l_partkey % 4 = 0) as has_lines, case when l_linestatus = 'O' then l_quantity else 1 end::decimal(18,2) as units
        from lineitem where l_returnflag = 'R'""",
    "o_refund_lines": """
        select order_id, line_item_id, sum(units) as units, sum(amount) as amount from o_refunds where has_lines group by all""",
    "o_charges": """
        select id as charge_id, customer, (amount::decimal(18,6) / 100)::decimal(18,6) as amount, coalesce(amount_refunded, 0) / 100 as refunded,
            lower(coalesce(payment_method_details_type, 'unknown')) as kind, lower(coalesce(payment_method_details_card_brand, '')) as brand,
            coalesce(payment_method_details_card_wallet, '') as wallet, metadata_shopify_order_id as order_id, timestamp '1970-01-01' + to_seconds(created) as happened
        from raw_stripe_charges where livemode""",
    "o_last_charge": """
        select * from o_charges where order_id is not null
        qualify row_number() over (partition by order_id order by happened desc nulls last, charge_id desc) = 1""",
    "o_people": f"""
        select 'shopify' as src, id::varchar as sid, {hashed('email')} as email, {hashed('phone')} as phone, {hashed('first_name')} as fn, {hashed('last_name')} as ln,
            sha256('pepper' || 'S530|A|Z' || (id % 200)) as nk, created_at as born, updated_at as changed, coalesce(accepts_marketing, false) as sub_email,
            coalesce(accepts_sms_marketing, false) as sub_sms, coalesce(accepts_marketing, false) as consent,
            case state when 'enabled' then 'active' when 'invited' then 'active' when 'disabled' then 'blocked' when 'weird' then 'weird' else 'unknown' end as status,
            (id % 30 in (0, 1) or id % 25 = 0) as b2b, default_address_country_code as country
        from raw_shopify_customers
        union all
        select 'stripe', id, {hashed('email')}, {hashed('phone')}, null, null, null, timestamp '1970-01-01' + to_seconds(created), timestamp '1970-01-01' + to_seconds(created), null, null, null, null, null, null
        from raw_stripe_customers
        union all
        select 'klaviyo', id, {hashed('email')}, null, {hashed('first_name')}, {hashed('last_name')}, null, created, coalesce(updated, created),
            coalesce(email_marketing__consent = 'subscribed', false), coalesce(sms_marketing__consent = 'subscribed', false),
            coalesce(email_marketing__consent = 'subscribed', false) or coalesce(sms_marketing__consent = 'subscribed', false), null, null, null
        from raw_klaviyo_profiles""",
    "o_links": """
        with phones as (select phone, min(email) as owner from o_people where email is not null and phone is not null group by phone),
        t12 as (select p.*, coalesce(p.email, h.owner, 'ph_' || p.phone) as cid, case when p.email is not null then 1 when p.phone is not null then 2 end as tier
            from o_people p left join phones h on p.email is null and h.phone = p.phone),
        names as (select nk, min(cid) as owner, count(*) filter (where cid is null or cid is not null) as n from t12 where nk is not null group by nk)
        select t.* exclude (cid, tier), coalesce(t.cid, m.owner, case when m.n > 1 then 'nm_' || t.nk end, t.src || '_' || t.sid) as cid,
            coalesce(t.tier, case when m.owner is not null or m.n > 1 then 3 else 4 end) as tier
        from t12 t left join names m on t.cid is null and m.nk = t.nk""",
    "o_identity": """
        with shop as (select * from o_links where src = 'shopify' qualify row_number() over (partition by cid order by changed desc, sid desc) = 1),
        mail as (select * from o_links where src = 'klaviyo' qualify row_number() over (partition by cid order by changed desc, sid desc) = 1),
        pay as (select * from o_links where src = 'stripe' qualify row_number() over (partition by cid order by changed desc, sid desc) = 1),
        agg as (select cid, min(email) as email, min(phone) as phone, min(tier) as tier, string_agg(distinct src, '|' order by src) as systems,
                    min(born) as born, max(changed) as changed from o_links group by cid)
        select a.cid as customer_id, shop.sid as shopify_customer_id, pay.sid as stripe_customer_id, mail.sid as klaviyo_profile_id, a.email, a.phone,
            shop.status, coalesce(shop.b2b, false) as b2b, shop.country, coalesce(mail.sub_email, shop.sub_email, false) as sub_email,
            coalesce(mail.sub_sms, shop.sub_sms, false) as sub_sms, coalesce(mail.consent, shop.consent, false) as consent, a.systems,
            case a.tier when 1 then 'email' when 2 then 'phone' when 3 then 'fuzzy_name_address' else 'unmatched' end as method,
            case when a.tier < 3 then 'high' else 'medium' end as confidence, a.born::date as acquired, a.born, a.changed,
            (select min(l.src) from o_links l where l.cid = a.cid and l.born = a.born) as first_system
        from agg a left join shop using (cid) left join mail using (cid) left join pay using (cid)""",
    "o_dim_customer": f"""
        select i.*, least({NOW}, coalesce(c.created_at, {NOW})) as valid_from, md5(i.customer_id || '-' || {NOW}::varchar) as seed_sk,
            md5(i.customer_id || '-' || least({NOW}, coalesce(c.created_at, {NOW}))::varchar) as customer_sk
        from o_identity i left join raw_shopify_customers c on c.id::varchar = i.shopify_customer_id""",
    "o_products": """
        select p_partkey::varchar as variant_id, case when p_partkey % 211 <> 1 then 'SKU-' || p_partkey end as sku, p_name, p_type, p_brand, p_size,
            p_partkey as k, v.valid_from, v.valid_to, (case when v.old then 0.5 else 0.6 end * p_retailprice::decimal(18,2))::decimal(18,6) as full_cost
        from part join (select true as old, timestamp '2019-01-01' as valid_from, timestamp '2023-01-01' as valid_to
                        union all select false, timestamp '2023-01-01', null
                        union all select true, timestamp '2019-01-01', null) v
            on case when p_partkey % 3 = 0 then not (v.old and v.valid_to is null) else v.old and v.valid_to is null end""",
    "o_dim_product": """
        select *, case when k % 9 <> 0 then full_cost end as unit_cost, md5(variant_id || '-' || valid_from::varchar) as product_sk,
            case when p_size % 2 = 0 then p_name when p_size % 3 = 0 then p_name || ' - Size ' || p_size else p_name end as display_name,
            case when p_type = 'PROMO' then 'Uncategorized' else 'Cat ' || p_type end as category
        from o_products where sku is not null""",
    "o_rates": """
        select from_currency as cur, rate, rate_date as lo, lead(rate_date) over (partition by from_currency order by rate_date) as hi from seed_fx_rates""",
    "o_payment_methods": """
        with t as (select distinct lower(coalesce(type, 'unknown')) as raw, lower(coalesce(card_brand, '')) as brand, coalesce(card_funding, '') as funding,
                coalesce(card_wallet, '') as wallet from raw_stripe_payment_methods where coalesce(livemode, true)),
        d as (select *, case raw when 'card' then case when wallet <> '' then 'wallet_' || replace(wallet, '_', '') when brand = '' then 'card_unknown'
                    else 'card_' || brand || '_' || if(funding = '', 'unknown', funding) end
                when 'klarna' then 'bnpl_klarna' when 'affirm' then 'bnpl_affirm' when 'sepa_debit' then 'bank_transfer_sepa' when 'link' then 'wallet_link'
                else 'other_' || raw end as id,
            case when raw = 'card' and wallet = '' then 'card' when raw in ('card', 'link') then 'digital_wallet' when raw in ('klarna', 'affirm') then 'bnpl'
                when raw = 'sepa_debit' then 'bank_transfer' when raw = 'gift_card' then 'gift_card' else 'other' end as kind,
            case when wallet = 'apple_pay' then 'applepay' when wallet = 'google_pay' then 'googlepay' when raw = 'card' and brand <> '' then brand else raw end as provider
            from t)
        select id, kind, provider, nullif(brand, '') as brand, nullif(funding, '') as funding, wallet, md5(id) as sk from d
        qualify row_number() over (partition by id order by nullif(brand, '') nulls last, nullif(funding, '') nulls last, provider nulls last, wallet) = 1""",
    "o_charge_pm": """
        with want as (select order_id, kind as raw, brand, case when kind = 'card' and wallet <> '' then 'digital_wallet' when kind = 'card' then 'card'
                when kind = 'klarna' then 'bnpl' when kind = 'sepa_debit' then 'bank_transfer' when kind = 'link' then 'digital_wallet' else 'other' end as kind from o_last_charge)
        select w.order_id, min_by(p.sk, p.id) as sk from want w left join o_payment_methods p
            on p.kind = w.kind and (w.raw <> 'card' or w.brand = '' or p.brand = w.brand) group by w.order_id""",
    "o_enriched": """
        with l as (select order_id, count(*) as n, sum(quantity) as q from o_lines group by order_id),
        f as (select order_id, row_number() over (partition by shopify_customer_id order by order_timestamp, order_id) as r from o_orders where shopify_customer_id is not null)
        select o.order_id, coalesce(l.n, 0) as line_count, coalesce(l.q, 0) as units, coalesce(f.r = 1, false) as is_first, coalesce(f.r > 1, false) as is_repeat
        from o_orders o left join l using (order_id) left join f using (order_id)""",
    "o_fact_orders": """
        with paid as (select order_id, sum(amount) as back from o_refunds group by order_id),
        base as (
            select o.*, coalesce(p.back, 0)::decimal(18,6) as back, e.line_count, e.units, e.is_first, e.is_repeat, m.sk as pm_sk,
                coalesce(r.rate, case when upper(o.currency) = 'USD' then 1 end) as fx, c.customer_sk, c.customer_id
            from o_orders o left join paid p using (order_id) left join o_enriched e using (order_id) left join o_charge_pm m using (order_id)
            left join o_rates r on r.cur = upper(o.currency) and o.order_date >= r.lo and (o.order_date < r.hi or r.hi is null)
            left join o_dim_customer c on c.shopify_customer_id = o.shopify_customer_id and o.order_timestamp >= c.valid_from)
        select *, md5(order_id) as order_sk,
            md5(case when utm_source = 'Facebook' then 'paid_social_meta' when utm_source = 'google' then 'organic_search_google' when source_name = 'web' then 'online_store'
                when source_name = 'pos' then 'retail_pos' when source_name = 'recharge' then 'subscription_recharge' end) as channel_sk,
            case when substr(ship_to, 2)::int < 25 then md5(ship_to) end as geography_sk,
            (gross * coalesce(fx, 1)::decimal(20,8))::decimal(18,4) as gross4, (discount * coalesce(fx, 1)::decimal(20,8))::decimal(18,4) as discount4, (tax * coalesce(fx, 1)::decimal(20,8))::decimal(18,4) as tax4,
            (shipping * coalesce(fx, 1)::decimal(20,8))::decimal(18,4) as shipping4, (tip * coalesce(fx, 1)::decimal(20,8))::decimal(18,4) as tip4, (net * coalesce(fx, 1)::decimal(20,8))::decimal(18,4) as net4,
            (back * coalesce(fx, 1)::decimal(20,8))::decimal(18,4) as back4, ((net - back) * coalesce(fx, 1)::decimal(20,8))::decimal(18,4) as after4
        from base""",
    "o_fact_lines": """
        select l.line_item_id, l.order_id, l.sku, o.order_sk, o.customer_sk, o.channel_sk, o.order_date, o.order_timestamp, d.product_sk, l.quantity::decimal(18,2) as quantity,
            l.price::decimal(18,4) as price, d.unit_cost::decimal(18,4) as unit_cost, (l.subtotal * coalesce(o.fx, 1)::decimal(20,8))::decimal(18,4) as subtotal4,
            (l.discount * coalesce(o.fx, 1)::decimal(20,8))::decimal(18,4) as discount4, (l.tax * coalesce(o.fx, 1)::decimal(20,8))::decimal(18,4) as tax4,
            ((l.subtotal - l.discount) * coalesce(o.fx, 1)::decimal(20,8))::decimal(18,4) as net4,
            ((l.subtotal - l.discount - l.quantity * d.unit_cost)::decimal(18,6) * coalesce(o.fx, 1)::decimal(20,8))::decimal(18,4) as margin4,
            coalesce(r.units, 0)::decimal(18,2) as back_units, (coalesce(r.amount, 0)::decimal(18,6) * coalesce(o.fx, 1)::decimal(20,8))::decimal(18,4) as back4, l.promo
        from o_lines l left join o_fact_orders o using (order_id) left join o_refund_lines r using (order_id, line_item_id)
        left join o_dim_product d on d.sku = l.sku and o.order_date >= d.valid_from::date and (d.valid_to is null or o.order_date < d.valid_to::date)""",
    "o_fact_refunds": """
        with reason as (select id, charge, lower(reason) as why from raw_stripe_refunds where status = 'succeeded')
        select r.*, md5(r.refund_id) as refund_sk, o.order_sk, o.customer_sk, (r.amount * coalesce(o.fx, 1)::decimal(20,8))::decimal(18,4) as amount4,
            (r.shipping_amount * coalesce(o.fx, 1)::decimal(20,8))::decimal(18,4) as shipping4, case when abs(r.amount - o.net4) < 0.01 then 'full_refund' else 'partial_refund' end as refund_type,
            ['damaged', 'wrong_item', 'not_as_described', 'customer_change_of_mind', 'quality_issue', 'late_delivery', 'other'][r.k] as category,
            case when c.charge_id is not null then 'stripe' else 'shopify' end as processor, coalesce(w.why = 'fraudulent', false) as chargeback
        from o_refunds r left join o_fact_orders o using (order_id) left join o_last_charge c using (order_id) left join reason w on w.charge = c.charge_id""",
    "o_movements": """
        select 'sale_' || l.line_item_id as movement_id, l.product_sk, l.sku, o.order_date as day, 'sale' as kind, l.back_units - l.quantity as change, l.unit_cost,
            (l.unit_cost * (l.quantity - l.back_units))::decimal(18,4) as value, l.order_id
        from o_fact_lines l join o_fact_orders o using (order_id) where o.order_status <> 'cancelled' and l.quantity <> l.back_units
        union all
        select 'return_' || r.refund_id || '_' || l.line_item_id, l.product_sk, l.sku, r.refund_date, 'return', l.back_units, l.unit_cost,
            (l.unit_cost * l.back_units)::decimal(18,4), l.order_id
        from o_fact_refunds r join o_fact_lines l using (order_id) where l.back_units > 0""",
    "o_days": f"""
        select distinct last_day(m)::date as day from (select unnest(range((select min(order_date) from o_fact_orders)::timestamp,
            (select max(order_date) from o_fact_orders)::timestamp + interval 1 month, interval 1 month)) as m)
        where last_day(m) between (select min(order_date) from o_fact_orders) and (select max(order_date) from o_fact_orders)
        union select {TODAY}""",
    "o_state": f"""
        with live as (select * from o_dim_customer where (changed >= {TODAY} - interval 24 month or consent) and acquired <= {TODAY}),
        m as (select o.customer_id, d.day, min(o.order_date) as lo, max(o.order_date) as hi, count(*) as n, sum(o.after4) as rev, sum(o.units) as qty,
                count(*) filter (where o.order_date > d.day - 30) as n30, coalesce(sum(o.after4) filter (where o.order_date > d.day - 30), 0) as rev30,
                count(*) filter (where o.order_date > d.day - 90) as n90, coalesce(sum(o.after4) filter (where o.order_date > d.day - 90), 0) as rev90
              from o_fact_orders o join o_days d on o.order_date <= d.day where o.order_status <> 'cancelled' and o.customer_id is not null group by all)
        select c.customer_id, c.customer_sk, d.day, d.day - c.acquired as age, d.day - m.lo as since_first, d.day - m.hi as since_last, coalesce(n, 0) as n, coalesce(rev, 0) as rev,
            coalesce(qty, 0) as qty, coalesce(n30, 0) as n30, coalesce(rev30, 0) as rev30, coalesce(n90, 0) as n90, coalesce(rev90, 0) as rev90
        from live c join o_days d on c.acquired <= d.day left join m on m.customer_id = c.customer_id and m.day = d.day""",
    "o_inv_days": f"""
        select distinct last_day(m)::date as day from (select unnest(range((select min(order_date) from o_fact_lines)::timestamp,
            (select max(order_date) from o_fact_lines)::timestamp + interval 1 month, interval 1 month)) as m)
        where last_day(m) between (select min(order_date) from o_fact_lines) and (select max(order_date) from o_fact_lines)
        union select {TODAY}""",
    "o_inventory": """
        with mv as (select sku, day, sum(change) as q from o_movements where sku is not null group by all),
        late as (select mv.sku, d.day, sum(mv.q) as q from mv join o_inv_days d on mv.day > d.day group by all),
        sold as (select sku, order_date as day, sum(quantity - back_units) as u from o_fact_lines where sku is not null group by all),
        pace as (select s.sku, d.day, sum(s.u) / 28.0::double as per_day from sold s join o_inv_days d on s.day >= d.day - 28 and s.day < d.day group by all)
        select p_partkey::varchar as item, (p_partkey % 120)::varchar as place, 'SKU-' || p_partkey as sku, d.day,
            case when p_partkey % 77 <> 5 then greatest(0, p_size * 7 - 20 - coalesce(late.q, 0)) end::decimal(18,2) as qty,
            case when p_partkey % 9 <> 0 then p_retailprice::decimal(18,2) * 0.6 end::decimal(18,4) as cost, pace.per_day,
            (select product_sk from o_dim_product x where x.sku = 'SKU-' || p_partkey and x.valid_to is null) as product_sk
        from part cross join o_inv_days d left join late on late.sku = 'SKU-' || p_partkey and late.day = d.day
        left join pace on pace.sku = 'SKU-' || p_partkey and pace.day = d.day""",
    "o_sessions": """
        with e as (select *, timestamp '1970-01-01' + to_microseconds(event_timestamp) as seen from raw_ga4_events where ga_session_id is not null)
        select user_pseudo_id || ga_session_id as session_id, user_pseudo_id, min(seen)::date as day, min(seen) as began,
            floor(epoch(max(seen)))::bigint - floor(epoch(min(seen)))::bigint as seconds, count(*) filter (where event_name = 'page_view') as views, count(*) as events,
            min_by(page_location, (seen, page_location)) filter (where page_location is not null) as landing, max_by(page_location, (seen, page_location)) filter (where page_location is not null) as leaving,
            bool_or(event_name = 'purchase') as bought, coalesce(sum(ecommerce__purchase_revenue) filter (where event_name = 'purchase'), 0) as revenue,
            coalesce(bool_or(is_new_user), false) as is_new, min(user_id) as user_id, min(device__category) as device, min(device__operating_system) as os,
            min(traffic_source__source) as source, min(traffic_source__medium) as medium, min(geo__country) as country
        from e group by user_pseudo_id, ga_session_id""",
}


def with_models(select: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a query with the models it needs, innermost first."""
    known = {**MODELS, **(extra or {})}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b(?:raw|seed|o|x)_[a-z0-9_]+\b", text)):
            if name in known and name not in ordered:
                visit(known[name])
                ordered.append(name)

    visit(select)
    if not ordered:
        return select
    ctes = ",\n".join(f"{n} as ({known[n].strip()})" for n in ordered)
    return f"with {ctes}\n{select}"
