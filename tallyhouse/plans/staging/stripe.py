"""Payment processor tables: amounts arrive in minor units, times in epoch seconds."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.pii import phone_hash, pii_hash
from tallyhouse.params import Params
from tallyhouse.plans.staging.common import cents, epoch, flag, project, text
from tallyhouse.sources.mapping import Overrides, source_col

CARD_FIELDS = ("brand", "last4", "exp_month", "exp_year", "wallet")


def charges(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    """Live charges. An unknown mode counts as test here."""
    src = partial(source_col, overrides, "stripe.charges")
    cols = {
        "charge_id": text("id"),
        "stripe_customer_id": text("customer"),
        "charge_amount": cents("amount"),
        "amount_refunded": cents(F.coalesce(F.col("amount_refunded"), F.lit(0))),
        "currency_code": F.upper(text("currency")),
        "charge_status": text("status"),
        "payment_type": text(src("payment_type", "payment_method_details_type")),
        **{f"card_{f}": text(src(f"card_{f}", f"payment_method_details_card_{f}")) for f in CARD_FIELDS},
        "shopify_order_id": text(src("shopify_order_id", "metadata_shopify_order_id")),
        "payment_method_id": text("payment_method"),
        "is_paid": flag("paid", False),
        "is_captured": flag("captured", False),
        "is_refunded": flag("refunded", False),
        "charge_timestamp": epoch("created"),
    }
    return project(
        raw.filter(flag("livemode", False)), cols, params, table="stripe.charges", record_id="charge_id",
        business=["charge_id", "charge_timestamp"], extracted_at=epoch("created"),
    )


def customers(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    cols = {
        "stripe_customer_id": text("id"),
        "customer_email_hash": pii_hash("email", params),
        "phone_hash": phone_hash("phone", params),
        "name_hash": pii_hash("name", params),
        "is_delinquent": flag("delinquent", False),
        "is_live": flag("livemode", True),
        "created_at": epoch("created"),
    }
    return project(
        raw, cols, params, table="stripe.customers", record_id="stripe_customer_id",
        business=["stripe_customer_id", "created_at"], extracted_at=epoch("created"),
    )


def _reversal(kind: str, is_chargeback: bool) -> dict:
    return {
        f"{kind}_id": text("id"),
        "charge_id": text("charge"),
        f"{kind}_amount": cents("amount"),
        "currency_code": F.upper(text("currency")),
        f"{kind}_status": text("status"),
        f"{kind}_reason": text("reason"),
        "is_chargeback": F.lit(is_chargeback),
        f"{kind}_timestamp": epoch("created"),
    }


def refunds(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    """Refunds that went through."""
    return project(
        raw.filter(text("status") == "succeeded"), _reversal("refund", False), params, table="stripe.refunds",
        record_id="refund_id", business=["refund_id", "charge_id"], extracted_at=epoch("created"),
    )


def disputes(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    """Chargebacks raised by the cardholder."""
    return project(
        raw, _reversal("dispute", True), params, table="stripe.disputes",
        record_id="dispute_id", business=["dispute_id", "charge_id"], extracted_at=epoch("created"),
    )


def payment_methods(raw: DataFrame, params: Params, overrides: Overrides = {}) -> DataFrame:
    """Live payment methods. An unknown mode counts as live here."""
    src = partial(source_col, overrides, "stripe.payment_methods")
    cols = {
        "payment_method_id": text("id"),
        "stripe_customer_id": text("customer"),
        "payment_method_type": text("type"),
        **{f"card_{f}": text(src(f"card_{f}", f"card_{f}")) for f in (*CARD_FIELDS, "funding", "country")},
        "is_live": flag("livemode", True),
        "created_at": epoch("created"),
    }
    return project(
        raw.filter(flag("livemode", True)), cols, params, table="stripe.payment_methods",
        record_id="payment_method_id", business=["payment_method_id", "created_at"], extracted_at=epoch("created"),
    )
