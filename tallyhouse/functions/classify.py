"""Business vocabularies: status, device, refund, payment, channel, location and email rules.

Each rule set is data (ordered pairs), turned into one CASE expression by ``first_match``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first rule whose condition holds."""
    chain = None
    for cond, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(cond, value) if chain is None else chain.when(cond, value)
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit


def translate(col: Column, mapping: dict[str, str], default: Column) -> Column:
    return first_match([(col == key, value) for key, value in mapping.items()], default)


# ---- Fixed values -------------------------------------------------------------------------
PAID_STATES = ("paid", "partially_paid")
PENDING_STATES = ("pending", "authorized")

CUSTOMER_STATES = {
    "enabled": "active",
    "disabled": "blocked",
    "declined": "blocked",
    "invited": "active",
}

REFUND_CATEGORIES = (
    ("damaged", ("damage", "broken")),
    ("wrong_item", ("wrong", "incorrect")),
    ("not_as_described", ("not as described", "as described")),
    ("customer_change_of_mind", ("changed", "no longer", "cancel")),
    ("quality_issue", ("quality", "defect")),
    ("late_delivery", ("late", "delay")),
)

EMAIL_EVENTS = {
    "Received Email": "delivered",
    "Opened Email": "opened",
    "Clicked Email": "clicked",
    "Bounced Email": "bounced",
    "Unsubscribed": "unsubscribed",
    "Marked Email as Spam": "marked_spam",
    "Placed Order": "converted",
}

CAMPAIGN_OBJECTIVES = {
    "OUTCOME_SALES": "conversions",
    "OUTCOME_TRAFFIC": "traffic",
    "OUTCOME_AWARENESS": "awareness",
    "OUTCOME_ENGAGEMENT": "engagement",
    "OUTCOME_LEADS": "leads",
    "OUTCOME_APP_PROMOTION": "app_installs",
}

BNPL_TYPES = ("klarna", "afterpay_clearpay", "affirm", "zip", "laybuy")
BANK_TYPES = ("us_bank_account", "ach_debit", "sepa_debit", "bacs_debit", "au_becs_debit")
PAYMENT_IDS = {
    "klarna": "bnpl_klarna",
    "afterpay_clearpay": "bnpl_afterpay",
    "affirm": "bnpl_affirm",
    "zip": "bnpl_zip",
    "us_bank_account": "bank_transfer_ach",
    "ach_debit": "bank_transfer_ach",
    "sepa_debit": "bank_transfer_sepa",
    "bacs_debit": "bank_transfer_bacs",
    "au_becs_debit": "bank_transfer_becs",
    "link": "wallet_link",
}
WALLET_PROVIDERS = {
    "apple_pay": "applepay",
    "google_pay": "googlepay",
    "samsung_pay": "samsungpay",
    "link": "link",
}

SALES_CATEGORIES = ("retail", "marketplace")
ACQUISITION_CATEGORIES = ("search", "social", "email", "direct", "referral", "other")
OWNED_CATEGORIES = ("email", "online_store")
B2B_TAGS = ("b2b", "wholesale", "business")
BOUNCE_TYPES = ("hard", "soft", "block")
# -------------------------------------------------------------------------------------------


def order_status(cancelled_at: Column, financial: Column, fulfillment: Column) -> Column:
    paid = financial.isin(*PAID_STATES)
    return first_match(
        [
            (cancelled_at.isNotNull(), "cancelled"),
            (financial == "refunded", "refunded"),
            (financial == "partially_refunded", "partial_refund"),
            (financial == "voided", "cancelled"),
            (paid & (fulfillment == "fulfilled"), "fulfilled"),
            (paid, "paid"),
            (financial.isin(*PENDING_STATES), "pending"),
        ],
        "unknown",
    )


def device_category(width: Column) -> Column:
    """Screen width to device; a width that is no number gives NULL."""
    px = width.try_cast("int")
    return first_match([(px < 768, "mobile"), (px < 1024, "tablet"), (px >= 1024, "desktop")])


def is_subscription(source_name: Column, tags: Column) -> Column:
    return F.lower(F.coalesce(source_name, F.lit(""))).eqNullSafe("recharge") | F.lower(
        F.coalesce(tags, F.lit(""))
    ).contains("subscription")


def is_b2b(tags: Column, company: Column, patterns: Sequence[str] = B2B_TAGS) -> Column:
    has_company = F.coalesce(F.length(F.trim(company)) > 0, F.lit(False))
    return contains_any(F.lower(F.coalesce(tags, F.lit(""))), patterns) | has_company


def customer_status(state: Column) -> Column:
    return translate(state, CUSTOMER_STATES, F.coalesce(state, F.lit("unknown")))


def refund_category(note: Column) -> Column:
    text = F.lower(note)
    return first_match([(contains_any(text, words), label) for label, words in REFUND_CATEGORIES], "other")


def refund_type(refunded: Column, order_net: Column) -> Column:
    return first_match([(F.abs(refunded - order_net) < 0.01, "full_refund")], "partial_refund")


def email_event_type(name: Column, extra: dict[str, str] | None = None) -> Column:
    """Provider event name to the canonical type; ``extra`` adds client-specific names."""
    return translate(name, {**EMAIL_EVENTS, **(extra or {})}, F.lit("other"))


def bounce_type(raw: Column) -> Column:
    return F.when(F.lower(raw).isin(*BOUNCE_TYPES), F.lower(raw)).otherwise(raw)


def campaign_objective(raw: Column) -> Column:
    return translate(F.upper(raw), CAMPAIGN_OBJECTIVES, F.lower(raw))


def channel_type(category: Column) -> Column:
    return first_match(
        [(category.isin(*SALES_CATEGORIES), "sales"), (category.isin(*ACQUISITION_CATEGORIES), "acquisition")],
        "both",
    )


def is_owned_channel(category: Column) -> Column:
    return category.isin(*OWNED_CATEGORIES)


def location_type(service: Column, is_legacy: Column) -> Column:
    service = F.coalesce(service, F.lit(""))
    return first_match([(~service.isin("", "manual"), "3pl"), (is_legacy, "store")], "warehouse")


def payment_type(raw_type: Column, wallet: Column, *, observed: bool = True) -> Column:
    """Canonical payment class. ``observed=False`` leaves out gift cards and cash, which
    never appear on a processor charge."""
    rules = [
        ((raw_type == "card") & (wallet != ""), "digital_wallet"),
        (raw_type == "card", "card"),
        (raw_type.isin(*BNPL_TYPES), "bnpl"),
        (raw_type.isin(*BANK_TYPES), "bank_transfer"),
        (raw_type == "link", "digital_wallet"),
    ]
    if observed:
        rules += [(raw_type == "gift_card", "gift_card"), (raw_type == "cash", "cash")]
    return first_match(rules, "other")


def payment_id(raw_type: Column, brand: Column, funding: Column, wallet: Column) -> Column:
    card = raw_type == "card"
    funding = F.when(funding == "", F.lit("unknown")).otherwise(funding)
    wallet_id = F.concat(F.lit("wallet_"), F.replace(wallet, F.lit("_pay"), F.lit("pay")))
    return first_match(
        [
            (card & (wallet != ""), wallet_id),
            (card & (brand != ""), F.concat(F.lit("card_"), brand, F.lit("_"), funding)),
            (card, "card_unknown"),
            *[(raw_type == raw, name) for raw, name in PAYMENT_IDS.items()],
        ],
        F.concat(F.lit("other_"), raw_type),
    )


def payment_provider(raw_type: Column, brand: Column, wallet: Column) -> Column:
    by_wallet = [(wallet == raw, name) for raw, name in WALLET_PROVIDERS.items()]
    return first_match([*by_wallet, ((raw_type == "card") & (brand != ""), brand)], raw_type)


def payment_name(kind: Column, pm_id: Column, provider: Column, brand: Column, funding: Column, wallet: Column) -> Column:
    spaced = lambda c: F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))
    card = (kind == "card") & brand.isNotNull()
    return first_match(
        [
            (card & funding.isNotNull(), F.concat(F.initcap(brand), F.lit(" "), F.initcap(funding), F.lit(" Card"))),
            (card, F.concat(F.initcap(brand), F.lit(" Card"))),
            ((kind == "digital_wallet") & (wallet != ""), spaced(wallet)),
            (kind == "bnpl", F.initcap(provider)),
            (kind == "bank_transfer", F.concat(F.lit("Bank Transfer ("), F.upper(provider), F.lit(")"))),
        ],
        spaced(pm_id),
    )


def product_display_name(product_title: Column, variant_title: Column) -> Column:
    single = variant_title.isNull() | (variant_title == "Default Title")
    return F.when(single, product_title).otherwise(F.concat(product_title, F.lit(" - "), variant_title))


def session_traffic_key(source: Column, medium: Column) -> Column:
    return F.lower(
        F.concat(F.coalesce(source, F.lit("(direct)")), F.lit(" / "), F.coalesce(medium, F.lit("(none)")))
    )


def order_traffic_key(utm_source: Column, utm_medium: Column, source_name: Column) -> Column:
    """Campaign tags when present, else the storefront's own source name."""
    tagged = F.concat(F.lower(utm_source), F.lit(" / "), F.coalesce(F.lower(utm_medium), F.lit("(none)")))
    return F.coalesce(tagged, source_name)


def email_campaign_id(campaign_id: Column, flow_id: Column) -> Column:
    return first_match(
        [
            (F.length(campaign_id) > 0, F.concat(F.lit("cmp_"), campaign_id)),
            (F.length(flow_id) > 0, F.concat(F.lit("flw_"), flow_id)),
        ]
    )


def not_cancelled(status: Column) -> Column:
    """False or NULL for cancelled and for missing status, so a filter drops both."""
    return status != "cancelled"


def convert(amount: Column, rate: Column) -> Column:
    """Amount in reporting currency; a missing rate counts as 1."""
    one = F.lit(1).cast("decimal(18,8)")
    return (amount * F.coalesce(rate, one)).cast("decimal(18,4)")


def null_as(kind: str) -> Column:
    return F.lit(None).cast(kind)
