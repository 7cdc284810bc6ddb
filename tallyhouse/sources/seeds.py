"""Small reference tables."""

from __future__ import annotations

from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyhouse.sources.csv import scan_csv

SEED_SCHEMAS = {
    "fx_rates": "from_currency string, to_currency string, rate_date date, rate decimal(18,8)",
    "geography_data": """geography_id string, country_code string, country_name string, country_region string,
        country_subregion string, state_or_region_code string, state_or_region_name string,
        default_currency string, default_timezone string, is_tax_jurisdiction boolean""",
    "channel_mapping": """source_system string, source_value string, channel_id string, channel_name string,
        channel_category string, channel_subcategory string, is_paid boolean, platform string, parent_channel string""",
    "product_category_mapping": "product_type string, category string, subcategory string",
    "holidays": "date date, country_code string, holiday_name string, holiday_type string",
    "erasure_requests": "customer_id string, request_date date, ticket_id string, scope string",
}

# Raw traffic source -> canonical channel.
CHANNELS = """
ga4,google / organic,organic_search_google,Google Organic,search,organic_search,false,google,search
ga4,google / cpc,paid_search_google,Google Ads,search,paid_search,true,google,search
ga4,google / ppc,paid_search_google,Google Ads,search,paid_search,true,google,search
ga4,bing / organic,organic_search_bing,Bing Organic,search,organic_search,false,bing,search
ga4,bing / cpc,paid_search_bing,Bing Ads,search,paid_search,true,bing,search
ga4,facebook.com / referral,referral_facebook,Facebook Referral,social,organic_social,false,facebook,meta
ga4,facebook.com / (none),referral_facebook,Facebook Referral,social,organic_social,false,facebook,meta
ga4,instagram.com / referral,referral_instagram,Instagram Referral,social,organic_social,false,instagram,meta
ga4,l.instagram.com / referral,referral_instagram,Instagram Referral,social,organic_social,false,instagram,meta
ga4,facebook / cpc,paid_social_meta,Meta Ads,social,paid_social,true,meta,meta
ga4,instagram / cpc,paid_social_meta,Meta Ads,social,paid_social,true,meta,meta
ga4,tiktok.com / referral,referral_tiktok,TikTok Referral,social,organic_social,false,tiktok,tiktok
ga4,tiktok / cpc,paid_social_tiktok,TikTok Ads,social,paid_social,true,tiktok,tiktok
ga4,twitter.com / referral,referral_twitter,Twitter / X Referral,social,organic_social,false,twitter,twitter
ga4,x.com / referral,referral_twitter,Twitter / X Referral,social,organic_social,false,twitter,twitter
ga4,pinterest.com / referral,referral_pinterest,Pinterest Referral,social,organic_social,false,pinterest,pinterest
ga4,pinterest / cpc,paid_social_pinterest,Pinterest Ads,social,paid_social,true,pinterest,pinterest
ga4,youtube.com / referral,referral_youtube,YouTube,social,video,false,google,search
ga4,(direct) / (none),direct,Direct,direct,direct,false,,
ga4,(not set) / (not set),direct,Direct,direct,direct,false,,
ga4,email / email,email_marketing,Email Marketing,email,email,false,,
ga4,klaviyo / email,email_klaviyo,Klaviyo Email,email,email,false,klaviyo,email
ga4,mailchimp / email,email_mailchimp,Mailchimp Email,email,email,false,mailchimp,email
ga4,(none) / organic,organic_other,Organic Other,other,organic,false,,
shopify,web,online_store,Online Store,online_store,online_store,false,shopify,online
shopify,pos,retail_pos,Retail POS,retail,in_store,false,shopify,offline
shopify,instagram,social_instagram,Instagram Shopping,social,social_commerce,false,instagram,meta
shopify,facebook,social_facebook,Facebook Shop,social,social_commerce,false,facebook,meta
shopify,shop_app,shopify_shop_app,Shop App,online_store,mobile_app,false,shopify,online
shopify,shop-app,shopify_shop_app,Shop App,online_store,mobile_app,false,shopify,online
shopify,draft_orders,shopify_draft_orders,Draft Orders,online_store,draft,false,shopify,online
shopify,shopify_draft_orders,shopify_draft_orders,Draft Orders,online_store,draft,false,shopify,online
shopify,amazon,marketplace_amazon,Amazon,marketplace,marketplace,false,amazon,marketplace
shopify,google,paid_search_google,Google Ads,search,paid_search,true,google,search
shopify,facebook / cpc,paid_social_meta,Meta Ads,social,paid_social,true,meta,meta
shopify,google / organic,organic_search_google,Google Organic,search,organic_search,false,google,search
shopify,google / cpc,paid_search_google,Google Ads,search,paid_search,true,google,search
shopify,referral / referral,referral_other,Referral,referral,organic_referral,false,,referral
shopify,tiktok,social_tiktok,TikTok Shop,social,social_commerce,false,tiktok,tiktok
shopify,recharge,subscription_recharge,ReCharge Subscriptions,online_store,subscription,false,recharge,subscriptions
shopify,subscription,subscription_other,Subscriptions,online_store,subscription,false,,subscriptions
meta_ads,*,paid_social_meta,Meta Ads,social,paid_social,true,meta,meta
klaviyo,*,email_klaviyo,Klaviyo Email,email,email,false,klaviyo,email
stripe,direct,stripe_direct,Stripe Direct,online_store,payment_api,false,stripe,direct
"""


def channel_rows() -> list[tuple]:
    rows = [line.split(",") for line in CHANNELS.strip().splitlines()]
    return [(*r[:6], r[6] == "true", r[7] or None, r[8] or None) for r in rows]


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Literal rows as a local relation, whose exact size lets the planner broadcast it."""
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows, strict=True))
    return spark.createDataFrame(pa.table(dict(zip(fields.names, map(list, columns), strict=True))), fields)


def channel_mapping(spark: SparkSession) -> DataFrame:
    """The built-in channel table."""
    return small_table(spark, channel_rows(), SEED_SCHEMAS["channel_mapping"])


def with_channel_overrides(mapping: DataFrame, overrides: DataFrame) -> DataFrame:
    """Client rows replace built-in rows of the same (source system, source value)."""
    keys = ["source_system", "source_value"]
    return mapping.join(overrides.select(*keys), keys, "left_anti").unionByName(overrides, allowMissingColumns=True)


def read_seed(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A seed CSV with its declared types."""
    return scan_csv(spark, path, T.StructType.fromDDL(SEED_SCHEMAS[name]))


def _nth_weekday(year: int, month: int, weekday: int, nth: int) -> date:
    """The nth given weekday (Monday = 0) of a month; nth = -1 is the last one."""
    if nth > 0:
        first = date(year, month, 1)
        return first + timedelta(days=(weekday - first.weekday()) % 7 + 7 * (nth - 1))
    last = date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)
    return last - timedelta(days=(last.weekday() - weekday) % 7)


# United States federal holidays, by fixed day or by (weekday, nth).
US_FIXED = {
    (1, 1): "New Year's Day",
    (6, 19): "Juneteenth National Independence Day",
    (7, 4): "Independence Day",
    (11, 11): "Veterans Day",
    (12, 25): "Christmas Day",
}
US_FLOATING = {
    (1, 0, 3): "Martin Luther King Jr. Day",
    (2, 0, 3): "Presidents' Day",
    (5, 0, -1): "Memorial Day",
    (9, 0, 1): "Labor Day",
    (10, 0, 2): "Columbus Day",
    (11, 3, 4): "Thanksgiving Day",
}


def us_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Federal holidays by rule, in the layout of the holidays seed."""
    rows = []
    for year in range(first_year, last_year + 1):
        rows += [(date(year, m, d), "US", name, "federal") for (m, d), name in US_FIXED.items()]
        rows += [(_nth_weekday(year, m, wd, n), "US", name, "federal") for (m, wd, n), name in US_FLOATING.items()]
    return small_table(spark, sorted(rows), SEED_SCHEMAS["holidays"])
