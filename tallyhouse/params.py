"""Run-wide settings, passed explicitly to every operator that needs them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import SparkSession

# Late-data windows, in days, per fact.
LOOKBACK_DAYS = {
    "fact_orders": 14,
    "fact_order_lines": 14,
    "fact_refunds": 30,
    "fact_marketing_spend": 7,
    "fact_web_sessions": 3,
    "fact_email_engagement": 3,
    "fact_inventory_movements": 14,
}


@dataclass(frozen=True)
class B2bRule:
    """What makes a customer a business: a tag pattern, a company name, or a high average order value."""

    # Tag patterns of business customers.
    patterns: tuple[str, ...] = ("wholesale", "b2b", "reseller", "trade", "business")
    company_required: bool = False
    min_order_amount: float | None = None


@dataclass(frozen=True)
class Rules:
    """Optional rules of a run; all of them are off by default."""

    b2b: B2bRule | None = None  # None keeps the flag that staging derives
    drop_bot_sessions: bool = False  # sessions of one event and no duration
    drop_private_opens: bool = False  # opens fetched ahead by mail privacy proxies
    email_events: Mapping[str, str] = field(default_factory=dict)  # further raw event name -> event type
    storefront_consent_wins: bool = False  # over the e-mail system's
    campaign_name_pattern: str | None = None  # named groups become columns of int_campaign_names
    insight_level: str = "campaign"  # campaign | ad_set | ad: grain of int_marketing_insights
    synthetic_orders: bool = False  # orders for paid charges without a storefront order
    disputes_as_refunds: bool = False  # refunds of type chargeback

    def __post_init__(self) -> None:
        if self.insight_level not in ("campaign", "ad_set", "ad"):
            raise ValueError(f"unknown insight_level: {self.insight_level}")


@dataclass(frozen=True)
class Params:
    """One immutable bundle of business settings.

    ``EARLIER_READINGS`` names the settings under which units are counted once per refund of an order,
    variants of one SKU double lines, and orders of merged customers find nobody.

    ``as_of`` replaces the wall clock everywhere, so a run can be repeated for any day
    with the same result.
    """

    as_of: date
    reporting_currency: str = "USD"
    reporting_timezone: str = "Africa/Nairobi"
    pii_masking: bool = True
    pii_salt: str = ""
    phone_format: str = "digits"  # digits | as_given: what of a phone number is hashed
    min_order_date: str = "2020-01-01"
    fiscal_year_start_month: int = 1
    holiday_country: str = "US"
    calendar_start: date = date(2015, 1, 1)
    calendar_end: date = date(2031, 12, 31)
    calendar_end_inclusive: bool = True
    snapshot_mode: str = "today"  # today | month_end | daily
    backdate_products: bool = False
    backdate_customers: bool = False
    link_customers: bool = True  # orders find customers through merged storefront ids too
    product_key: str = "variant"  # variant | sku: by what order lines find their product; variants may share a SKU
    return_units: str = "refund_line"  # refund_line | order: what a return movement counts
    sale_quantity: str = "net"  # net | gross units on sale movements
    run_id: str = "manual"
    rules: Rules = field(default_factory=Rules)
    lookback_days: Mapping[str, int] = field(default_factory=lambda: dict(LOOKBACK_DAYS))

    def __post_init__(self) -> None:
        if self.snapshot_mode not in ("today", "month_end", "daily"):
            raise ValueError(f"unknown snapshot_mode: {self.snapshot_mode}")
        if self.sale_quantity not in ("net", "gross"):
            raise ValueError(f"unknown sale_quantity: {self.sale_quantity}")
        if self.product_key not in ("sku", "variant"):
            raise ValueError(f"unknown product_key: {self.product_key}")
        if self.return_units not in ("order", "refund_line"):
            raise ValueError(f"unknown return_units: {self.return_units}")
        if self.phone_format not in ("as_given", "digits"):
            raise ValueError(f"unknown phone_format: {self.phone_format}")
        if self.pii_masking and not self.pii_salt:
            raise ValueError("masking needs a pii_salt; without one, hashes of known addresses can be looked up")
        if not 1 <= self.fiscal_year_start_month <= 12:
            raise ValueError("fiscal_year_start_month must be 1..12")


# How earlier warehouses read the same sources; pass as ``Params(..., **EARLIER_READINGS)``.
EARLIER_READINGS = {"phone_format": "as_given", "link_customers": False, "product_key": "sku", "return_units": "order"}


def tune(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on; all of them are runtime SQL settings.

    Skewed shuffle partitions are split even when that costs one more exchange, because a
    single customer, SKU or source may own a large share of the rows. Fused methods above 8,000
    bytes are never compiled by the JVM, so wide projections are better left unfused. Small reduce
    partitions keep the sorts of joins in a row in memory, and rows dealt by one of a join's keys are not dealt again.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark
