"""Event grain to session grain, and order enrichment."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.dedup import first_per_key

FIRST_TOUCH = (
    "user_id", "device_category", "device_os", "browser", "traffic_source", "traffic_medium", "traffic_campaign", "geo_country",
)


def sessionize(events: DataFrame) -> DataFrame:
    """One row per (user, session number); attributes come from the earliest event that has them.

    A plain grouped aggregation with map-side combine: no window and no collected group, so a
    session or user with very many events costs no more than its rows. Events that name no user or
    no session belong to none.
    """
    at = F.col("event_timestamp")

    def earliest(col: str) -> Column:
        return F.min(F.when(F.col(col).isNotNull(), F.struct(at, F.col(col))))[col].alias(col)

    page = F.when(F.col("page_location").isNotNull(), F.struct(at, F.col("page_location")))
    grouped = events.filter(session_key().isNotNull()).groupBy("user_pseudo_id", "ga_session_id").agg(
        F.min(at).alias("session_start_timestamp"),
        F.max(at).alias("_end"),
        F.count_if(F.col("event_name") == "page_view").alias("page_views"),
        F.count("*").alias("events_count"),
        F.min(page)["page_location"].alias("landing_page"),
        F.max(page)["page_location"].alias("exit_page"),
        F.coalesce(F.bool_or(F.col("event_name") == "purchase"), F.lit(False)).alias("has_purchase_event"),
        F.sum(F.when(F.col("event_name") == "purchase", F.col("purchase_value"))).alias("transaction_revenue"),
        F.coalesce(F.bool_or("is_new_user"), F.lit(False)).alias("is_new_user"),
        *[earliest(c) for c in FIRST_TOUCH],
    )
    return grouped.select(
        session_key().alias("session_id"),
        "user_pseudo_id",
        "ga_session_id",
        F.col("session_start_timestamp").cast("date").alias("session_date"),
        "session_start_timestamp",
        (F.unix_seconds("_end") - F.unix_seconds("session_start_timestamp")).alias("session_duration_seconds"),
        "page_views", "events_count", "landing_page", "exit_page", "has_purchase_event",
        F.coalesce("transaction_revenue", F.lit(0)).cast("decimal(18,6)").alias("transaction_revenue"),
        "is_new_user",
        *FIRST_TOUCH,
    )


def session_key() -> Column:
    return F.concat("user_pseudo_id", "ga_session_id")


def events_from(events: DataFrame, day: date) -> DataFrame:
    """Events from a day on. The day column, a literal's comparison that reaches the files, has a day's
    margin, as it follows the property's time zone; the time decides."""
    near = F.col("event_date").isNull() | (F.col("event_date") >= F.lit(day - timedelta(days=1)))
    return events.filter(near & (F.col("event_timestamp") >= F.lit(day).cast("timestamp")))


def touched_sessions(events: DataFrame, kept: Sequence[DataFrame], day: date) -> DataFrame:
    """``session_id`` of sessions with an event from ``day`` on, and of stored ones that start there.

    The latter may have lost all their events since.
    """
    ids = events_from(events, day).select(session_key().alias("session_id"))
    for sessions in kept:
        ids = ids.union(sessions.filter(F.col("session_date") >= F.lit(day)).select("session_id"))
    return ids.filter(F.col("session_id").isNotNull()).distinct()


def sessions_again(events: DataFrame, touched: DataFrame, start: date) -> DataFrame:
    """The touched sessions from all their events, none of which lies before ``start``."""
    own = events_from(events, start).withColumn("session_id", session_key())
    return sessionize(own.join(touched, "session_id", "left_semi"))


def without_bots(sessions: DataFrame) -> DataFrame:
    """Drop sessions of one event and no duration."""
    return sessions.filter(~((F.col("events_count") == 1) & (F.col("session_duration_seconds") == 0)))


def enrich_orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """The orders with line count, units and first/repeat flags.

    The first order of a customer is found by a ranked filter that runs before the exchange, and
    flags return to orders by order id, so no step gathers one customer's orders in a task.
    """
    per_order = lines.groupBy("order_id").agg(F.count("*").alias("_n"), F.sum("quantity").alias("_q"))
    owned = orders.filter(F.col("shopify_customer_id").isNotNull()).select("shopify_customer_id", "order_timestamp", "order_id")
    first = first_per_key(
        owned, ["shopify_customer_id"], [F.col("order_timestamp").asc_nulls_last(), F.col("order_id").asc()]
    ).select("order_id", F.lit(True).alias("_first"))
    is_first = F.coalesce("_first", F.lit(False))
    return (
        orders.join(per_order, "order_id", "left")
        .join(first, "order_id", "left")
        .withColumns({
            "line_item_count": F.coalesce("_n", F.lit(0)),
            "total_quantity": F.coalesce("_q", F.lit(0)).cast("decimal(18,2)"),
            "is_first_order": is_first,
            "is_repeat_order": F.col("shopify_customer_id").isNotNull() & ~is_first,
        })
        .drop("_n", "_q", "_first")
    )
