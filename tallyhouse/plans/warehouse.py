"""The models and what each one is made of."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import quality as Q
from tallyhouse.operators.stored import stored
from tallyhouse.operators.upsert import FIRST_RUN, first_day, since_cutoff
from tallyhouse.operators.scd2 import backdate_current, scd2_merge, scd2_start
from tallyhouse.params import Params
from tallyhouse.plans import dims, facts, marts, rules
from tallyhouse.plans.checks import STAGING_KEYS, model_checks, staging_checks
from tallyhouse.plans.identity import apply_erasure, customer_links, erase_orders, identity_records, resolve_identity
from tallyhouse.plans.sessions import enrich_orders, sessionize, sessions_again, touched_sessions, without_bots
from tallyhouse.plans.staging import STAGES, klaviyo
from tallyhouse.plans.store import Scope, Store
from tallyhouse.sources.mapping import Overrides
from tallyhouse.sources.seeds import with_channel_overrides

Save = Callable[[str, DataFrame, Scope], DataFrame]


# Models that several others are built on; everything else is a projection or is read once.
SHARED = frozenset({
    "int_customer_records", "dim_date", "dim_channel", "dim_geography", "dim_payment_method", "dim_email_campaign",
    "dim_warehouse_location", "dim_customer", "dim_product", "dim_marketing_campaign", "fact_orders", "fact_order_lines", "fact_refunds",
    "fact_inventory_movements", "fact_inventory_snapshot", "fact_customer_state_daily",
})


def shared_saver(names: frozenset[str] = SHARED) -> Save:
    """Store the shared models in the session's shared folder, leave the others lazy."""
    return lambda name, df, _: stored(df, name) if name in names else df


# What other models read of a fact.
READ_BY_MODELS = {
    "fact_orders": ("order_id", "order_sk", "customer_sk", "customer_id", "channel_sk", "order_date", "order_timestamp", "order_status", "net_amount",
                    "net_after_refunds", "total_quantity", "fx_rate_to_reporting", "original_currency_code", "_extracted_at"),
    "fact_order_lines": ("line_item_id", "order_id", "product_sk", "sku", "order_date", "quantity", "refunded_quantity", "unit_cost"),
    "fact_refunds": ("refund_id", "order_id", "refund_date", "refund_timestamp", "refund_reason", "_extracted_at"),
    "fact_inventory_movements": ("sku", "movement_date", "quantity_change"),
}


CHECK_RESULTS = "check_results"


def stored_run(spark: SparkSession, database: str, raw: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame], params: Params, *,
               names: list[str] | None = None, kept: frozenset[str] | None = None, overrides: Overrides | None = None,
               checks: bool = False, gate: Collection[str] = ()) -> dict[str, DataFrame]:
    """One run of a stored warehouse: builds ``names`` (all models by default), then publishes them together.

    ``kept`` limits what is stored. If the run fails, readers go on seeing the former one.

    With ``checks``, every stored model's row checks are counted while it is written (for facts: the
    rows of this run), keys and references on the stored tables; all results become the model
    ``check_results``. A run in which a check named in ``gate`` fails is not published.
    """
    store = Store(spark, database, kept)
    declared = {**model_checks(params), **STAGING_KEYS} if checks else {}
    results: list[tuple] = []

    def checks_of(name: str, df: DataFrame) -> list[Q.Check]:
        return staging_checks(name, df.columns) if name in STAGING_KEYS else declared[name]

    def save(name: str, df: DataFrame, scope: Scope) -> DataFrame:
        if name not in declared or (kept is not None and name not in kept):
            return store.save(name, df, scope)
        watched = Q.Watched(name, checks_of(name, df), params)
        out = store.save(name, watched.attach(df), scope)
        results.extend(watched.results())
        return out

    house = Warehouse(spark, raw, seeds, params, overrides=overrides, save=save, **store.state())
    built = house.build(names)
    if checks:
        for name in [n for n in built if n in declared and (kept is None or n in kept)]:
            apart = [c for c in checks_of(name, built[name]) if isinstance(c, (Q.Unique, Q.ForeignKey))]
            if apart:
                parents = {c.parent: house[c.parent] for c in apart if isinstance(c, Q.ForeignKey)}
                results.extend(tuple(r) for r in Q.run_checks(name, built[name], apart, params, parents).collect())
        failed = sorted({f"{r[0]}.{r[1]}" for r in results if r[4] == "fail" and r[1] in gate})
        if failed:
            raise ValueError(f"checks failed, the run is not published: {', '.join(failed)}")
        if results:
            store.names = None if store.names is None else {*store.names, CHECK_RESULTS}
            built[CHECK_RESULTS] = store.save(CHECK_RESULTS, spark.createDataFrame(sorted(results), "table_name string, check_name string, severity string, failures long, status string"))
    store.publish()
    return built


# What second runs replace by order, by session, and by day: the column whose newest stored value limits a run.
BY_ORDER = ("fact_orders", "fact_order_lines", "fact_refunds", "fact_inventory_movements")
BY_SESSION = ("int_web_sessions", "fact_web_sessions")
BY_DAY = {"fact_marketing_spend": "spend_date", "fact_email_engagement": "event_timestamp"}


class Warehouse:
    """Models by name, each made on first use: ``Warehouse(...)["fact_orders"]``.

    ``raw`` maps ``source.table`` to raw frames, ``seeds`` the reference tables, ``history`` the
    stored SCD2 snapshots and ``existing`` the stored facts whose newest day limits an incremental
    run. ``holding`` gives the part of a stored fact that may hold some keys; without it, all of it
    is looked into. Everything is lazy unless ``save`` stores the models.

    Optional seeds: ``holidays``; ``traffic_overrides``, which set the channel of sessions by source and medium; ``channel_overrides``, whose rows replace channel rows of the same
    source system and value; ``erasure_requests``, which are honoured in the customer history and in
    orders. Optional rules come with ``params.rules``.
    """

    def __init__(
        self, spark: SparkSession, raw: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame], params: Params, *,
        history: Mapping[str, DataFrame] | None = None, existing: Mapping[str, DataFrame] | None = None,
        overrides: Overrides | None = None, save: Save = lambda _, df, __: df, holding: Callable[[str, DataFrame], DataFrame] | None = None,
    ) -> None:
        self.spark, self.raw, self.seeds, self.params = spark, raw, seeds, params
        self.holding = holding or (lambda name, _: self.existing[name])
        self.history, self.existing, self.overrides = history or {}, existing or {}, overrides or {}
        self._save, self._made = save, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            df = MODELS[name](self)
            self._made[name] = self._save(name, df, self.scope(name))
        return self._made[name]

    def scope(self, name: str) -> Scope:
        """What of a stored fact its batch replaces: touched orders or sessions, or all days from one on. None: what the batch holds."""
        if name in BY_ORDER:
            return self.touched_orders()
        if name in BY_SESSION and name in self.existing:
            return self["int_touched_sessions"]
        if name in BY_DAY and name in self.existing:
            return first_day(self.existing[name], BY_DAY[name], self.params.lookback_days[name])
        return None

    def touched_orders(self) -> DataFrame | None:
        """Orders whose facts are to be made anew; None on a first run, where all are."""
        return self["int_touched_orders"] if "fact_orders" in self.existing else None

    def build(self, names: list[str] | None = None) -> dict[str, DataFrame]:
        """Several models, by default all of them, in dependency order."""
        return {name: self[name] for name in names or MODELS}

    def channels(self) -> DataFrame:
        mapping = self.seeds["channel_mapping"]
        return with_channel_overrides(mapping, self.seeds["channel_overrides"]) if "channel_overrides" in self.seeds else mapping

    def erased(self, customers: DataFrame) -> DataFrame:
        return apply_erasure(customers, self.seeds["erasure_requests"], self.params) if "erasure_requests" in self.seeds else customers

    def snapshot(self, name: str, current: DataFrame, key: str, **strategy) -> DataFrame:
        now = F.lit(self.params.as_of).cast("timestamp")
        if name in self.history:
            return scd2_merge(self.history[name], current, key, now=now, **strategy)
        return scd2_start(current, key, now=now, updated_at=strategy.get("updated_at"))


class Inputs(Warehouse):
    """A warehouse's models as what others are made of: of a fact only the columns that models read are made and stored."""

    def __init__(self, whole: Warehouse) -> None:
        self.__dict__.update(whole.__dict__)
        self._whole, self._made = whole, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in READ_BY_MODELS:
            return self._whole[name]
        if name not in self._made:
            self._made[name] = stored(MODELS[name](self).select(*READ_BY_MODELS[name]), name)
        return self._made[name]

    def __contains__(self, name: str) -> bool:
        """Whether a model is made already."""
        return name in self._made


# What movements read of orders.
READ_BY_MOVEMENTS = ("order_id", "order_date", "order_timestamp", "order_status", "_extracted_at")


class Movements(Warehouse):
    """A warehouse's models as what the movement fact alone is made of.

    Orders are stored with the columns that movements read; the dimensions of customers and products
    are read once and stay lazy, so that only what is read of them is made.
    """

    def __init__(self, whole: Warehouse) -> None:
        self.__dict__.update(whole.__dict__)
        self._whole, self._made = whole, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in ("fact_orders", "dim_customer", "dim_product"):
            return self._whole[name]
        if name not in self._made:
            df = MODELS[name](self)
            self._made[name] = stored(df.select(*READ_BY_MOVEMENTS), name) if name == "fact_orders" else df
        return self._made[name]

    def fact(self, params: Params | None = None) -> DataFrame:
        """The movements, under other readings of units where ``params`` are given."""
        params = params or self.params
        if params.rules.disputes_as_refunds:  # disputes are rows of the refund fact only
            house = Inputs(self._whole)
            house.params = params
            return MODELS["fact_inventory_movements"](house)
        refunds = self["stg_shopify__refunds"]
        items = facts.refund_items(refunds)
        if params.sale_quantity == "net" and params.return_units == "refund_line":  # read twice: payloads are parsed once
            items = stored(items.select("order_id", "refund_id", "line_item_id", "quantity", F.lit(None).cast("string").alias("subtotal")), "refund_items")
        return facts.movements_from_staged(self["stg_shopify__order_line_items"], self["fact_orders"], refunds, items, self["dim_product"], params)


# What the fact of order lines reads of orders, and what stock snapshots read of orders and lines.
READ_BY_LINES = ("order_id", "order_sk", "customer_sk", "channel_sk", "order_date", "order_timestamp", "fx_rate_to_reporting")
READ_BY_STOCK = {"fact_orders": tuple(dict.fromkeys((*READ_BY_MOVEMENTS, *READ_BY_LINES, "net_amount", "original_currency_code"))), "fact_order_lines": READ_BY_MODELS["fact_order_lines"]}


class ReadOnce(Warehouse):
    """A warehouse's models as what one query alone is made of.

    ``held`` names facts and marts that are stored, with the columns that are read of them; the models in
    ``lazy`` are read once and stay lazy, so that only what is read of them is made.
    """

    def __init__(self, whole: Warehouse, held: Mapping[str, Collection[str]], lazy: Collection[str]) -> None:
        self.__dict__.update(whole.__dict__)
        self._whole, self._made, self._held, self._lazy = whole, {}, held, lazy

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._held and name not in self._lazy:
            return self._whole[name]
        if name not in self._made:
            df = MODELS[name](self)
            self._made[name] = stored(df.select(*[c for c in df.columns if c in self._held[name]]), name) if name in self._held else df
        return self._made[name]


def order_lines_alone(whole: Warehouse) -> DataFrame:
    """The fact of order lines for a reader of this fact alone."""
    return MODELS["fact_order_lines"](ReadOnce(whole, {"fact_orders": READ_BY_LINES}, ("dim_customer",)))


def stock_alone(whole: Warehouse) -> DataFrame:
    """The stock snapshots for a reader of this fact alone."""
    return MODELS["fact_inventory_snapshot"](ReadOnce(whole, READ_BY_STOCK, ("dim_customer", "fact_refunds", "fact_inventory_movements")))


def _stage(name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: STAGES[name](w.raw[name], w.params, w.overrides)


def _snap_customer(w: Warehouse) -> DataFrame:
    history = w.erased(w.snapshot("snap_customer", w["int_customer_identity"], "customer_id", check=dims.SNAP_CUSTOMER_CHECKS))
    if not w.params.backdate_customers:
        return history
    return backdate_current(history, w["stg_shopify__customers"], key="shopify_customer_id",
                            created_key="shopify_customer_id", created_at="created_at")


def _stg_customers(w: Warehouse) -> DataFrame:
    staged, rule = _stage("shopify.customers")(w), w.params.rules.b2b
    return staged if rule is None else rules.flag_b2b(staged, rule.patterns, rule.company_required, rule.min_order_amount)


def _stg_email_events(w: Warehouse) -> DataFrame:
    staged = klaviyo.events(w.raw["klaviyo.events"], w.params, w.overrides, dict(w.params.rules.email_events) or None)
    return rules.without_private_opens(staged) if w.params.rules.drop_private_opens else staged


def _session_cutoff(w: Warehouse) -> date:
    """The day from which on events are new to all that is stored of sessions."""
    days = w.params.lookback_days["fact_web_sessions"]
    return min(first_day(w.existing[n], "session_date", days) for n in BY_SESSION if n in w.existing)


def _touched_sessions(w: Warehouse) -> DataFrame:
    """Sessions whose rows second runs make anew and replace as a set; on a first run, all."""
    kept = [w.existing[n] for n in BY_SESSION if n in w.existing]
    if not kept:
        return w["int_web_sessions"].select("session_id")
    return stored(touched_sessions(w["stg_ga4__events"], kept, _session_cutoff(w)), "touched_sessions")


def _sessions_again(w: Warehouse) -> DataFrame:
    """Touched sessions, whole: their events are read from the day on which the earliest of them starts.

    A session that began before the cutoff is stored with its start, unless the rule against bots
    kept it out of the only stored model; then all events are read.
    """
    touched, start = w["int_touched_sessions"], _session_cutoff(w)
    if "int_web_sessions" not in w.existing and w.params.rules.drop_bot_sessions:
        start = FIRST_RUN
    else:
        name = next(n for n in BY_SESSION if n in w.existing)
        known = w.holding(name, touched).select("session_id", "session_date").join(touched, "session_id", "left_semi")
        earliest = known.agg(F.min("session_date")).first()[0]
        start = start if earliest is None else min(start, earliest)
    return sessions_again(w["stg_ga4__events"], touched, start)


def _web_sessions(w: Warehouse) -> DataFrame:
    return _sessions_again(w) if "int_web_sessions" in w.existing else sessionize(w["stg_ga4__events"])


def _fact_web_sessions(w: Warehouse) -> DataFrame:
    if "fact_web_sessions" not in w.existing:
        sessions = sessionize(w["stg_ga4__events"]) if "int_web_sessions" in w.existing else w["int_web_sessions"]
    else:
        sessions = _sessions_again(w)
    return facts.fact_web_sessions(
        without_bots(sessions) if w.params.rules.drop_bot_sessions else sessions,
        dim_customer=w["dim_customer"], dim_channel=w["dim_channel"], dim_geography=w["dim_geography"],
        channel_mapping=w.channels(), params=w.params,
        traffic_overrides=w.seeds["traffic_overrides"] if "traffic_overrides" in w.seeds else None)


def _campaign_names(w: Warehouse) -> DataFrame:
    campaigns, pattern = w["stg_meta_ads__campaigns"].select("campaign_id", "campaign_name"), w.params.rules.campaign_name_pattern
    return campaigns if pattern is None else rules.parse_campaign_name(campaigns, pattern)


def _touched_orders(w: Warehouse) -> DataFrame:
    """Orders changed, refunded or charged since the last load, and orders that stopped being their customer's first.

    ``int_touched_orders`` is what second runs pass downstream: facts under these orders are replaced as a set.
    """
    stored_orders, stored_refunds = w.existing["fact_orders"], w.existing.get("fact_refunds")
    days = w.params.lookback_days
    changed = since_cutoff(w["stg_shopify__orders"], stored_orders, "updated_at", days["fact_orders"]).select("order_id")
    newest = first_day(stored_orders, "updated_at", days["fact_orders"])
    if stored_refunds is None:  # the stored orders tell how far the last load went, as they do for charges
        since = F.lit(first_day(stored_orders, "updated_at", days["fact_refunds"])).cast("timestamp")
        refunds = w["stg_shopify__refunds"].filter(F.col("refund_timestamp").isNull() | (F.col("refund_timestamp") >= since))
    else:
        refunds = since_cutoff(w["stg_shopify__refunds"], stored_refunds, "refund_timestamp", days["fact_refunds"])
    refunded = refunds.select("order_id")
    charged = w["stg_stripe__charges"].filter(F.col("charge_timestamp").isNull() | (F.col("charge_timestamp") >= F.lit(newest).cast("timestamp")))
    once_first = stored_orders.filter("is_first_order").select("order_id")
    no_longer = once_first.join(w["int_orders_enriched"].filter("is_repeat_order").select("order_id"), "order_id")
    every = changed.union(refunded).union(charged.filter(F.col("shopify_order_id").isNotNull()).select("shopify_order_id")).union(no_longer)
    if w.params.rules.disputes_as_refunds:
        every = every.union(w["stg_stripe__disputes"].join(w["stg_stripe__charges"].select("charge_id", "shopify_order_id"), "charge_id").select("shopify_order_id"))
    return stored(every.filter(F.col("order_id").isNotNull()).distinct(), "touched_orders")


def _fact_orders(w: Warehouse) -> DataFrame:
    existing, days, touched = w.existing.get("fact_orders"), w.params.lookback_days["fact_orders"], w.touched_orders()
    orders = facts.fact_orders(
        w["int_orders_enriched"], w["stg_shopify__refunds"], w["stg_stripe__charges"],
        dim_customer=w["dim_customer"], dim_channel=w["dim_channel"], dim_geography=w["dim_geography"],
        dim_payment_method=w["dim_payment_method"], fx_rates=w.seeds["fx_rates"],
        channel_mapping=w.channels(), params=w.params, touched=touched,
        links=w["int_customer_links"] if w.params.link_customers else None)
    if w.params.rules.synthetic_orders:
        charges = w["stg_stripe__charges"]
        if existing is not None:
            charges = since_cutoff(charges.withColumn("updated_at", F.col("charge_timestamp")), existing, "updated_at", days)
        orders = orders.unionByName(rules.direct_orders(charges, w.seeds["fx_rates"], w.params), allowMissingColumns=True)
    if "erasure_requests" in w.seeds:
        stored_before = None
        if existing is not None:
            stored_before = existing.join(touched, "order_id", "left_anti")
        orders = erase_orders(orders, w.seeds["erasure_requests"], w.params, stored_before)
    return orders


def _fact_inventory_snapshot(w: Warehouse) -> DataFrame:
    mode = w.params.snapshot_mode
    return facts.fact_inventory_snapshot(
        w["stg_shopify__inventory_levels"], w["stg_shopify__inventory_items"], w["fact_order_lines"],
        dim_product=w["dim_product"], dim_warehouse_location=w["dim_warehouse_location"], params=w.params,
        movements=w["fact_inventory_movements"] if mode == "month_end" else None,
        daily_feed=w["stg_shopify__inventory_snapshots"] if mode == "daily" else None)


def _mart_customer(w: Warehouse) -> DataFrame:
    """Rebuilt snapshots come from daily changes; in mode ``today`` former days are only in the stored fact."""
    if w.params.snapshot_mode == "today":
        return marts.mart_customer(w["fact_customer_state_daily"], w["dim_date"], w.params)
    swept = marts.swept_customer_state(*facts.customer_days(w["fact_orders"], w["dim_customer"], w.params))
    return marts.customer_kpis(swept, w["dim_date"], w.params)


MODELS: dict[str, Callable[[Warehouse], DataFrame]] = {
    **{f"stg_{name.replace('.', '__')}": _stage(name) for name in STAGES},
    "stg_shopify__customers": _stg_customers,
    "stg_klaviyo__events": _stg_email_events,
    "dim_date": lambda w: dims.dim_date(w.spark, w.params, w.seeds.get("holidays")),
    "dim_channel": lambda w: dims.dim_channel(w.channels(), w.params),
    "dim_geography": lambda w: dims.dim_geography(w.seeds["geography_data"], w.params),
    "dim_payment_method": lambda w: dims.dim_payment_method(w["stg_stripe__payment_methods"], w.params),
    "dim_email_campaign": lambda w: dims.dim_email_campaign(w["stg_klaviyo__campaigns"], w["stg_klaviyo__flows"], w.params),
    "dim_warehouse_location": lambda w: dims.dim_warehouse_location(w["stg_shopify__locations"], w.params),
    "int_customer_records": lambda w: identity_records(
        w["stg_shopify__customers"], w["stg_stripe__customers"], w["stg_klaviyo__profiles"]),
    "int_customer_links": lambda w: customer_links(w["int_customer_records"]),
    "int_customer_identity": lambda w: w.erased(resolve_identity(w["int_customer_records"], w.params.rules.storefront_consent_wins)),
    "snap_customer": _snap_customer,
    "snap_product": lambda w: w.snapshot(
        "snap_product",
        dims.product_snapshot_base(w["stg_shopify__product_variants"], w["stg_shopify__products"], w["stg_shopify__inventory_items"]),
        "variant_id", updated_at="updated_at"),
    "snap_marketing_campaign": lambda w: w.snapshot(
        "snap_marketing_campaign", w["stg_meta_ads__campaigns"], "campaign_id", updated_at="updated_at"),
    "dim_customer": lambda w: dims.dim_customer(w["snap_customer"], w.params),
    "dim_product": lambda w: dims.dim_product(w["snap_product"], w.seeds["product_category_mapping"], w.params),
    "dim_marketing_campaign": lambda w: dims.dim_marketing_campaign(w["snap_marketing_campaign"], w["dim_channel"], w.params),
    "int_orders_enriched": lambda w: enrich_orders(w["stg_shopify__orders"], w["stg_shopify__order_line_items"]),
    "int_touched_orders": lambda w: _touched_orders(w) if "fact_orders" in w.existing else w["stg_shopify__orders"].select("order_id"),
    "int_touched_sessions": _touched_sessions,
    "int_web_sessions": _web_sessions,
    "int_campaign_names": _campaign_names,
    "int_marketing_insights": lambda w: rules.insights_at(w["stg_meta_ads__daily_insights"], w.params.rules.insight_level),
    "fact_orders": _fact_orders,
    "fact_order_lines": lambda w: facts.fact_order_lines(
        w["stg_shopify__order_line_items"], w["fact_orders"], w["stg_shopify__refunds"], w["dim_product"], w.params,
        w.touched_orders()),
    "fact_refunds": lambda w: facts.fact_refunds(
        w["stg_shopify__refunds"], w["fact_orders"], w["stg_stripe__charges"], w["stg_stripe__refunds"], w.params,
        w.touched_orders(), w["stg_stripe__disputes"] if w.params.rules.disputes_as_refunds else None),
    "fact_inventory_movements": lambda w: facts.fact_inventory_movements(
        w["fact_order_lines"], w["fact_orders"], w["fact_refunds"], w.params, w.touched_orders(),
        w["stg_shopify__refunds"] if w.params.return_units == "refund_line" else None),
    "fact_inventory_snapshot": _fact_inventory_snapshot,
    "fact_customer_state_daily": lambda w: facts.fact_customer_state_daily(w["fact_orders"], w["dim_customer"], w.params),
    "fact_marketing_spend": lambda w: facts.fact_marketing_spend(
        w["stg_meta_ads__daily_insights"], dim_marketing_campaign=w["dim_marketing_campaign"], dim_channel=w["dim_channel"],
        fx_rates=w.seeds["fx_rates"], params=w.params, existing=w.existing.get("fact_marketing_spend")),
    "fact_web_sessions": _fact_web_sessions,
    "fact_email_engagement": lambda w: facts.fact_email_engagement(
        w["stg_klaviyo__events"], dim_customer=w["dim_customer"], dim_email_campaign=w["dim_email_campaign"], params=w.params,
        existing=w.existing.get("fact_email_engagement")),
    "mart_sales": lambda w: marts.mart_sales(w["fact_orders"], w["dim_date"], w["dim_channel"], w["dim_geography"], w.params),
    "mart_customer": _mart_customer,
    "mart_inventory": lambda w: marts.mart_inventory(
        w["fact_inventory_snapshot"], w["dim_date"], w["dim_product"], w["dim_warehouse_location"], w.params),
}
