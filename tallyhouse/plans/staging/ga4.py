"""Web analytics tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.params import Params
from tallyhouse.plans.staging.common import flag, money, project, text
from tallyhouse.sources.mapping import Overrides, source_col

# Staged name -> flattened export column.
EVENT_TEXT = {
    "device_category": "device__category",
    "device_mobile_brand": "device__mobile_brand_name",
    "device_os": "device__operating_system",
    "browser": "device__web_info__browser",
    "traffic_source": "traffic_source__source",
    "traffic_medium": "traffic_source__medium",
    "traffic_campaign": "traffic_source__name",
    "geo_country": "geo__country",
    "geo_region": "geo__region",
    "page_location": "page_location",
    "page_referrer": "page_referrer",
    "page_title": "page_title",
    "transaction_id": "ecommerce__transaction_id",
}


def events(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    """Events: the day is a yyyymmdd string, the time integer microseconds."""
    src = partial(source_col, overrides, "ga4.events")
    cols = {
        "user_pseudo_id": text("user_pseudo_id"),
        "user_id": text("user_id"),
        "ga_session_id": text(src("ga_session_id", "ga_session_id")),
        "event_name": text("event_name"),
        "event_date": F.to_date(text("event_date"), "yyyyMMdd"),
        "event_timestamp": F.timestamp_micros(src("event_timestamp", "event_timestamp").cast("long")),
        **{name: text(src(name, column)) for name, column in EVENT_TEXT.items()},
        "purchase_value": money(src("purchase_value", "ecommerce__purchase_revenue")),
        "purchase_currency": F.upper(text(src("purchase_currency", "ecommerce__currency"))),
        "engagement_time_msec": src("engagement_time_msec", "engagement_time_msec").cast("int"),
        "is_new_user": flag(src("is_new_user", "is_new_user")),
    }
    record = F.concat_ws(
        "_", "user_pseudo_id", F.coalesce("ga_session_id", F.lit("unknown")), "event_name", text("event_timestamp")
    )
    return project(
        raw, cols, params, table="ga4.events", record_id=record,
        business=["user_pseudo_id", "ga_session_id", "event_timestamp"], extracted_at=F.lit(params.as_of),
    )


def users(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    src = partial(source_col, overrides, "ga4.users")
    cols = {
        "user_pseudo_id": text("user_pseudo_id"),
        "user_id": text("user_id"),
        "first_seen_date": src("first_seen_date", "first_seen_date").cast("date"),
        "last_seen_date": src("last_seen_date", "last_seen_date").cast("date"),
    }
    return project(
        raw, cols, params, table="ga4.users", record_id="user_pseudo_id",
        business=["user_pseudo_id"], extracted_at=F.lit(params.as_of),
    )
