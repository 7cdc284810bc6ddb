"""Customer identity across storefront, payment and email systems."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.classify import null_as
from tallyhouse.params import Params

# Match tier -> method and confidence.
METHODS = {1: "email", 2: "phone", 3: "fuzzy_name_address", 4: "unmatched"}
CONFIDENCE = {1: "high", 2: "high", 3: "medium", 4: "medium"}

PROFILE = {
    "customer_status": "string",
    "is_b2b_customer": "boolean",
    "country_code": "string",
    "province_code": "string",
    "postal_code_hash": "string",
    "company": "string",
    "customer_tags_raw": "string",
}
CONSENT = ("email_subscribed", "sms_subscribed", "marketing_consent")


def identity_records(shopify: DataFrame, stripe: DataFrame, klaviyo: DataFrame) -> DataFrame:
    """The three sources in one layout, one row per source record."""

    def common(df: DataFrame, system: str, source_id: str) -> DataFrame:
        has = set(df.columns)
        pick = lambda c, kind="string": (F.col(c) if c in has else null_as(kind)).alias(c)
        return df.select(
            F.lit(system).alias("source_system"),
            F.col(source_id).alias("source_id"),
            F.col("customer_email_hash").alias("email_hash"),
            pick("phone_hash"),
            pick("first_name_hash"),
            pick("last_name_hash"),
            pick("name_address_key"),
            *[pick(c, kind) for c, kind in PROFILE.items()],
            *[pick(c, "boolean") for c in CONSENT],
            F.col("created_at"),
            (F.col("updated_at") if "updated_at" in has else F.col("created_at")).alias("updated_at"),
        )

    parts = [
        common(shopify, "shopify", "shopify_customer_id"),
        common(stripe, "stripe", "stripe_customer_id"),
        common(klaviyo, "klaviyo", "klaviyo_profile_id"),
    ]
    return reduce(DataFrame.unionByName, parts)


def identity_links(records: DataFrame) -> DataFrame:
    """Every source record with its customer_id and match tier.

    Tier 1 is the e-mail hash. Without e-mail, a phone known to an e-mail customer leads to that
    customer, any other phone forms its own. With neither, the loose name-and-address key is
    tried. Tiers take precedence and links are not chained. Owners of a phone or a name key are
    found by aggregation, so a shared placeholder value never pairs records with each other, and
    records that are already identified skip the lookups. ``records`` is read several times, so
    pass a stored copy.
    """
    by_email = records.filter(F.col("email_hash").isNotNull())
    no_email = records.filter(F.col("email_hash").isNull())
    by_phone = no_email.filter(F.col("phone_hash").isNotNull())
    bare = no_email.filter(F.col("phone_hash").isNull())

    phone_owner = (
        by_email.filter(F.col("phone_hash").isNotNull()).groupBy("phone_hash").agg(F.min("email_hash").alias("_owner"))
    )
    tier1 = by_email.withColumns({"customer_id": F.col("email_hash"), "_tier": F.lit(1)})
    tier2 = (
        by_phone.join(phone_owner, "phone_hash", "left")
        .withColumns({"customer_id": F.coalesce("_owner", F.concat(F.lit("ph_"), "phone_hash")), "_tier": F.lit(2)})
        .drop("_owner")
    )
    known = tier1.unionByName(tier2)
    name_owner = (
        known.select("name_address_key", "customer_id")
        .unionByName(bare.select("name_address_key", F.lit(None).cast("string").alias("customer_id")))
        .filter(F.col("name_address_key").isNotNull())
        .groupBy("name_address_key")
        .agg(F.min("customer_id").alias("_owner"), F.count("*").alias("_n"))
    )
    group_id = F.coalesce("_owner", F.when(F.col("_n") > 1, F.concat(F.lit("nm_"), "name_address_key")))
    alone = F.concat_ws("_", "source_system", "source_id")
    tier3 = (
        bare.join(name_owner, "name_address_key", "left")
        .withColumns({"_tier": F.when(group_id.isNotNull(), 3).otherwise(4), "customer_id": F.coalesce(group_id, alone)})
        .drop("_owner", "_n")
    )
    return known.unionByName(tier3)


def customer_links(records: DataFrame) -> DataFrame:
    """``source_system``, ``source_id``, ``customer_id`` and match ``tier`` of every source record, merged ones included."""
    return identity_links(records).select("source_system", "source_id", "customer_id", F.col("_tier").alias("tier"))


def resolve_identity(records: DataFrame, let_shopify_win: bool = False) -> DataFrame:
    """One row per customer: ids per source, profile, consent, match method, sources.

    The profile comes from the storefront record that changed last. Consent comes from the
    email system, then the storefront; ``let_shopify_win`` turns that order around.
    """
    links = identity_links(records)
    is_src = lambda s: F.col("source_system") == s
    recency = F.struct("updated_at", "source_id")

    def newest(system: str, cols: list[str]) -> Column:
        """Newest record of one source as a struct, NULL when it has none."""
        row = F.when(is_src(system), F.struct(recency.alias("_at"), *cols))
        return F.max(row)

    grouped = links.groupBy("customer_id").agg(
        newest("shopify", ["source_id", *PROFILE, *CONSENT]).alias("_shop"),
        newest("klaviyo", ["source_id", *CONSENT]).alias("_mail"),
        newest("stripe", ["source_id"]).alias("_pay"),
        F.min("email_hash").alias("email_hash"),
        F.min("phone_hash").alias("phone_hash"),
        F.min("first_name_hash").alias("first_name_hash"),
        F.min("last_name_hash").alias("last_name_hash"),
        F.min("_tier").alias("_tier"),
        F.array_sort(F.collect_set("source_system")).alias("source_systems"),
        F.min(F.struct("created_at", "source_system")).alias("_first"),
        F.max("updated_at").alias("updated_at"),
    )
    order = ("_shop", "_mail") if let_shopify_win else ("_mail", "_shop")
    consent = {c: F.coalesce(*[F.col(f"{s}.{c}") for s in order], F.lit(False)) for c in CONSENT}
    tier = lambda names: F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("_tier"))
    return grouped.select(
        "customer_id",
        F.col("_shop.source_id").alias("shopify_customer_id"),
        F.col("_pay.source_id").alias("stripe_customer_id"),
        F.col("_mail.source_id").alias("klaviyo_profile_id"),
        "email_hash", "phone_hash", "first_name_hash", "last_name_hash",
        F.col("_shop.customer_status").alias("customer_status"),
        F.coalesce("_shop.is_b2b_customer", F.lit(False)).alias("is_b2b_customer"),
        *[F.col(f"_shop.{c}").alias(c) for c in PROFILE if c not in ("customer_status", "is_b2b_customer")],
        *[expr.alias(c) for c, expr in consent.items()],
        "source_systems",
        tier(METHODS).alias("identity_resolution_method"),
        tier(CONFIDENCE).alias("match_confidence"),
        F.col("_first.source_system").alias("acquisition_source_system"),
        F.col("_first.created_at").cast("date").alias("acquisition_date"),
        F.col("_first.created_at").alias("created_at"),
        "updated_at",
    )


def due_requests(requests: DataFrame, params: Params) -> DataFrame:
    """``_cid`` of every customer with a request up to ``as_of``, and whether one of them is ``_full``."""
    return requests.filter(F.col("request_date") <= F.lit(params.as_of)).groupBy(F.col("customer_id").alias("_cid")).agg(
        F.coalesce(F.bool_or(F.col("scope") == "full_erasure"), F.lit(False)).alias("_full")
    )


def apply_erasure(customers: DataFrame, requests: DataFrame, params: Params) -> DataFrame:
    """Honour erasure requests made up to ``as_of``: full ones null personal data, both revoke consent."""
    due = due_requests(requests, params)
    personal = ["email_hash", "phone_hash", "first_name_hash", "last_name_hash", "postal_code_hash", "company",
                "email", "phone", "first_name", "last_name"]
    joined = customers.join(due, F.col("customer_id") == F.col("_cid"), "left")
    hidden = F.coalesce(F.col("_full"), F.lit(False))
    revoked = F.col("_cid").isNotNull()
    changes = {c: F.when(~hidden, F.col(c)) for c in personal if c in customers.columns}
    changes |= {c: F.when(revoked, F.lit(False)).otherwise(F.col(c)) for c in CONSENT if c in customers.columns}
    return joined.withColumns(changes).drop("_cid", "_full")


# What an order knows about the person who placed it.
ORDER_PERSONAL = ("customer_email_hash_at_order", "ip_address_hash", "note")


def erase_orders(batch: DataFrame, requests: DataFrame, params: Params, stored: DataFrame | None = None) -> DataFrame:
    """``batch`` without personal data of customers who asked for full erasure.

    Of ``stored``, the orders stored earlier that are not in the batch, those of such customers
    that still hold personal data come along, erased, so that a merge rewrites them. Later runs
    find none of them again.
    """
    full = due_requests(requests, params).filter("_full").select("_cid")
    marked = batch.join(full, F.col("customer_id") == F.col("_cid"), "left")
    out = marked.withColumns({c: F.when(F.col("_cid").isNull(), F.col(c)) for c in ORDER_PERSONAL}).drop("_cid")
    if stored is None:
        return out
    holds = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in ORDER_PERSONAL])
    old = stored.filter(holds).join(full, F.col("customer_id") == F.col("_cid"), "left_semi")
    blank = {c: F.lit(None).cast(stored.schema[c].dataType) for c in ORDER_PERSONAL}
    return out.unionByName(old.withColumns(blank))
