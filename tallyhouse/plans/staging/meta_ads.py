"""Advertising tables: ids get a platform prefix, budgets arrive in minor units."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.json_ops import json_items, sum_items
from tallyhouse.params import Params
from tallyhouse.plans.staging.common import cents, money, project, stamp, text
from tallyhouse.sources.mapping import Overrides, source_col

PREFIX = "meta_"


def _campaign_ids(column: str) -> dict[str, Column]:
    return {"campaign_id": F.concat(F.lit(PREFIX), text(column)), "meta_campaign_id": text(column)}


def _budget(column: str) -> Column:
    return cents(F.coalesce(F.col(column), F.lit(0)))


def _run_times(start: str, end: str) -> dict[str, Column]:
    return {
        "start_at": stamp(start),
        "end_at": stamp(end),
        "start_date": F.col(start).cast("date"),
        "end_date": F.col(end).cast("date"),
    }


def _changes() -> dict[str, Column]:
    return {"created_at": stamp("created_time"), "updated_at": stamp("updated_time")}


def _extracted() -> Column:
    return F.coalesce(stamp("updated_time"), stamp("created_time"))


def campaigns(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    cols = {
        **_campaign_ids("id"),
        "account_id": text("account_id"),
        "campaign_name": text("name"),
        "campaign_objective": text("objective"),
        "campaign_status": text("status"),
        "buying_type": text("buying_type"),
        "daily_budget": _budget("daily_budget"),
        "lifetime_budget": _budget("lifetime_budget"),
        **_run_times("start_time", "stop_time"),
        "is_active": text("status") == "ACTIVE",
        **_changes(),
    }
    return project(
        raw, cols, params, table="meta_ads.campaigns", record_id="campaign_id",
        business=["campaign_id", "updated_at"], extracted_at=_extracted(),
    )


def ad_sets(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    cols = {
        "ad_set_id": text("id"),
        **_campaign_ids("campaign_id"),
        "ad_set_name": text("name"),
        "ad_set_status": text("status"),
        "is_active": text("status") == "ACTIVE",
        "daily_budget": _budget("daily_budget"),
        "bid_amount": _budget("bid_amount"),
        "billing_event": text("billing_event"),
        "optimization_goal": text("optimization_goal"),
        **_run_times("start_time", "end_time"),
        **_changes(),
    }
    return project(
        raw, cols, params, table="meta_ads.ad_sets", record_id="ad_set_id",
        business=["ad_set_id", "updated_at"], extracted_at=_extracted(),
    )


def ads(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    cols = {
        "ad_id": text("id"),
        "ad_set_id": text("adset_id"),
        **_campaign_ids("campaign_id"),
        "ad_name": text("name"),
        "ad_status": text("status"),
        "is_active": text("status") == "ACTIVE",
        "creative_id": text("creative_id"),
        **_changes(),
    }
    return project(
        raw, cols, params, table="meta_ads.ads", record_id="ad_id",
        business=["ad_id", "updated_at"], extracted_at=_extracted(),
    )


def daily_insights(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    """Daily performance per ad; purchases are summed out of the two payloads within the row."""
    src = partial(source_col, overrides, "meta_ads.daily_insights")

    def purchases(name: str, default: str) -> Column:
        items = json_items(src(name, default), ("action_type", "value"))
        return sum_items(items, "value", lambda e: e["action_type"] == "purchase")

    cols = {
        "spend_date": F.col("date_start").cast("date"),
        **_campaign_ids("campaign_id"),
        "ad_set_id": text("ad_set_id"),
        "ad_id": text("ad_id"),
        "spend_amount_local": money("spend"),
        "impressions": F.col("impressions").cast("int"),
        "clicks": F.col("clicks").cast("int"),
        "reach": F.coalesce(F.col("reach"), F.lit(0)).cast("int"),
        "link_clicks": F.coalesce(F.col("inline_link_clicks"), F.lit(0)).cast("int"),
        "platform_reported_conversions": purchases("actions_raw", "actions"),
        "platform_reported_conversion_value": purchases("action_values_raw", "action_values"),
    }
    if "account_currency" in raw.columns or "account_currency" in overrides.get("meta_ads.daily_insights", {}):
        cols["account_currency"] = F.upper(text(src("account_currency", "account_currency")))
    blank = lambda c: F.coalesce(c, F.lit("null"))
    record = F.concat_ws("_", "campaign_id", blank(F.col("ad_set_id")), blank(F.col("ad_id")), text("spend_date"))
    return project(
        raw, cols, params, table="meta_ads.daily_insights", record_id=record,
        business=["campaign_id", "ad_set_id", "ad_id", "spend_date"], extracted_at=F.col("date_start"),
    )
