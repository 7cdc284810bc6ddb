"""Email marketing tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import classify as C
from tallyhouse.functions.pii import phone_hash, pii_hash
from tallyhouse.params import Params
from tallyhouse.plans.staging.common import project, stamp, text
from tallyhouse.sources.mapping import Overrides, source_col


def events(
    raw: DataFrame, params: Params, overrides: Overrides = {}, custom_events: dict[str, str] | None = None
) -> DataFrame:
    """Engagement events with canonical types; properties stay a VARIANT."""
    src = partial(source_col, overrides, "klaviyo.events")
    cols = {
        "event_id": text("id"),
        "klaviyo_profile_id": text("profile_id"),
        "event_type": C.email_event_type(text("event_name"), custom_events),
        "event_name_raw": text("event_name"),
        "campaign_id": text(src("campaign_id", "campaign_id")),
        "flow_id": text(src("flow_id", "flow_id")),
        "event_timestamp": stamp("datetime"),
        "event_date": F.col("datetime").cast("date"),
        "event_properties": F.try_parse_json(text("event_properties")),
    }
    return project(
        raw, cols, params, table="klaviyo.events", record_id="event_id",
        business=["event_id", "event_timestamp"], extracted_at=F.col("datetime"),
    )


def _subscribed(col: Column) -> Column:
    return F.coalesce(text(col) == "subscribed", F.lit(False))


def _updated(src) -> Column:
    return F.coalesce(stamp(src("updated", "updated")), stamp("created"))


def profiles(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    src = partial(source_col, overrides, "klaviyo.profiles")
    email = _subscribed(src("email_consent", "email_marketing__consent"))
    sms = _subscribed(src("sms_consent", "sms_marketing__consent"))
    cols = {
        "klaviyo_profile_id": text("id"),
        "customer_email_hash": pii_hash("email", params),
        "phone_hash": phone_hash("phone_number", params),
        "first_name_hash": pii_hash("first_name", params),
        "last_name_hash": pii_hash("last_name", params),
        "email_subscribed": email,
        "sms_subscribed": sms,
        "marketing_consent": email | sms,
        "created_at": stamp("created"),
        "updated_at": _updated(src),
    }
    return project(
        raw, cols, params, table="klaviyo.profiles", record_id="klaviyo_profile_id",
        business=["klaviyo_profile_id", "updated_at"], extracted_at=_updated(src),
    )


def campaigns(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    src = partial(source_col, overrides, "klaviyo.campaigns")
    cols = {
        "campaign_id": text("id"),
        "campaign_name": text("name"),
        "subject_line": text("subject"),
        "campaign_status": text("status"),
        "campaign_type": F.lit("campaign"),
        "sent_at": stamp("send_time"),
        "send_date": F.col("send_time").cast("date"),
        "audience_size": F.coalesce(F.col("num_recipients"), F.lit(0)).cast("int"),
        "is_sent": text("status") == "sent",
        "created_at": stamp("created"),
        "updated_at": _updated(src),
    }
    return project(
        raw, cols, params, table="klaviyo.campaigns", record_id="campaign_id",
        business=["campaign_id", "updated_at"], extracted_at=_updated(src),
    )


def flows(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    """Automated flows; they have no send day."""
    src = partial(source_col, overrides, "klaviyo.flows")
    cols = {
        "flow_id": text("id"),
        "flow_name": text("name"),
        "flow_status": text("status"),
        "campaign_type": F.lit("flow"),
        "trigger_type": text("trigger_type"),
        "send_date": F.lit(None).cast("date"),
        "is_active": text("status") == "live",
        "created_at": stamp("created"),
        "updated_at": _updated(src),
    }
    return project(
        raw, cols, params, table="klaviyo.flows", record_id="flow_id",
        business=["flow_id", "updated_at"], extracted_at=_updated(src),
    )
