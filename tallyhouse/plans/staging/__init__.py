"""One function per raw table: ``stage(raw, params, overrides) -> DataFrame``."""

from tallyhouse.plans.staging import ga4, klaviyo, meta_ads, shopify, stripe

STAGES = {
    "shopify.orders": shopify.orders,
    "shopify.order_line_items": shopify.order_line_items,
    "shopify.customers": shopify.customers,
    "shopify.refunds": shopify.refunds,
    "shopify.transactions": shopify.transactions,
    "shopify.products": shopify.products,
    "shopify.product_variants": shopify.product_variants,
    "shopify.inventory_items": shopify.inventory_items,
    "shopify.inventory_levels": shopify.inventory_levels,
    "shopify.inventory_snapshots": shopify.inventory_snapshots,
    "shopify.locations": shopify.locations,
    "stripe.charges": stripe.charges,
    "stripe.customers": stripe.customers,
    "stripe.refunds": stripe.refunds,
    "stripe.disputes": stripe.disputes,
    "stripe.payment_methods": stripe.payment_methods,
    "ga4.events": ga4.events,
    "ga4.users": ga4.users,
    "meta_ads.campaigns": meta_ads.campaigns,
    "meta_ads.ad_sets": meta_ads.ad_sets,
    "meta_ads.ads": meta_ads.ads,
    "meta_ads.daily_insights": meta_ads.daily_insights,
    "klaviyo.events": klaviyo.events,
    "klaviyo.profiles": klaviyo.profiles,
    "klaviyo.campaigns": klaviyo.campaigns,
    "klaviyo.flows": klaviyo.flows,
}
