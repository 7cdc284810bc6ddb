"""Identity, facts and marts against brute force on small fixtures."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import rolling
from tallyhouse.operators.snapshots import snapshot_days
from tallyhouse.params import Params
from tallyhouse.plans import facts, marts, rules
from tallyhouse.plans.identity import apply_erasure, identity_links, resolve_identity
from tallyhouse.plans.sessions import enrich_orders, sessionize, without_bots

AS_OF = date(2026, 8, 15)
PARAMS = Params(as_of=AS_OF, pii_salt="s", snapshot_mode="month_end")
RECORD = """source_system string, source_id string, email_hash string, phone_hash string, first_name_hash string, last_name_hash string,
    name_address_key string, customer_status string, is_b2b_customer boolean, country_code string, province_code string, postal_code_hash string,
    company string, customer_tags_raw string, email_subscribed boolean, sms_subscribed boolean, marketing_consent boolean, created_at timestamp, updated_at timestamp"""


def record(system, sid, email=None, phone=None, key=None, consent=None, at=1):
    stamp = datetime(2024, 1, at)
    return (system, sid, email, phone, None, None, key, "active" if system == "shopify" else None, None, None, None, None, None, None, consent, consent, consent, stamp, stamp)


def test_identity_tiers(spark):
    data = [
        record("shopify", "1", "e1", "p1", "n1", True, 2), record("klaviyo", "k1", "e1", consent=False, at=3), record("stripe", "c1", phone="p1", at=1),
        record("stripe", "c2", phone="p9"), record("shopify", "4", key="n1"), record("shopify", "5", key="n5"), record("shopify", "6", key="n5"),
        record("shopify", "7", key="n7"), record("stripe", "c8"),
    ]
    records = spark.createDataFrame(data, RECORD)
    links = {(r.source_system, r.source_id): (r.customer_id, r._tier) for r in identity_links(records).collect()}
    assert links == {
        ("shopify", "1"): ("e1", 1), ("klaviyo", "k1"): ("e1", 1), ("stripe", "c1"): ("e1", 2), ("stripe", "c2"): ("ph_p9", 2), ("shopify", "4"): ("e1", 3),
        ("shopify", "5"): ("nm_n5", 3), ("shopify", "6"): ("nm_n5", 3), ("shopify", "7"): ("shopify_7", 4), ("stripe", "c8"): ("stripe_c8", 4),
    }
    people = {r.customer_id: r for r in resolve_identity(records).collect()}
    one = people["e1"]
    assert one.source_systems == ["klaviyo", "shopify", "stripe"] and one.marketing_consent is False and one.acquisition_source_system in ("shopify", "stripe")
    assert one.identity_resolution_method == "email" and one.match_confidence == "high" and one.shopify_customer_id in ("1", "4")
    assert {r.customer_id: r.marketing_consent for r in resolve_identity(records, let_shopify_win=True).collect()}["ph_p9"] is False
    assert people["nm_n5"].match_confidence == "medium" and people["shopify_7"].identity_resolution_method == "unmatched"


def test_shared_phone_stays_linear(spark):
    """A placeholder phone on many records neither pairs them up nor loses any."""
    hot = [record("shopify", str(i), f"e{i}", "p0") for i in range(50)] + [record("stripe", f"c{i}", phone="p0") for i in range(100)]
    links = identity_links(spark.createDataFrame(hot, RECORD))
    assert links.count() == 150
    assert links.filter("source_system = 'stripe'").select("customer_id").distinct().collect()[0][0] == "e0"


def test_erasure(spark):
    people = spark.createDataFrame([("a", "h", True), ("b", "h", True), ("c", "h", True)], "customer_id string, email_hash string, marketing_consent boolean")
    wanted = spark.createDataFrame(
        [("a", date(2026, 1, 1), "T1", "full_erasure"), ("b", date(2026, 1, 1), "T2", "marketing_only"), ("c", date(2027, 1, 1), "T3", "full_erasure")],
        "customer_id string, request_date date, ticket_id string, scope string")
    out = [tuple(r) for r in apply_erasure(people, wanted, PARAMS).orderBy("customer_id").collect()]
    assert out == [("a", None, False), ("b", "h", False), ("c", "h", True)]


def test_first_and_repeat_orders(spark):
    orders = spark.createDataFrame(
        [("o1", "c", datetime(2024, 1, 2)), ("o2", "c", datetime(2024, 1, 1)), ("o3", "c", datetime(2024, 1, 1)), ("o4", None, datetime(2020, 1, 1)), ("o5", "d", None)],
        "order_id string, shopify_customer_id string, order_timestamp timestamp")
    lines = spark.createDataFrame([("o1", 2), ("o1", 3), ("gone", 9)], "order_id string, quantity int")
    out = {r.order_id: (r.line_item_count, r.total_quantity, r.is_first_order, r.is_repeat_order) for r in enrich_orders(orders, lines).collect()}
    assert out == {"o1": (2, 5, False, True), "o2": (0, 0, True, False), "o3": (0, 0, False, True), "o4": (0, 0, False, False), "o5": (0, 0, True, False)}


def test_sessions(spark):
    base = dict.fromkeys(("user_id", "device_category", "device_os", "browser", "traffic_source", "traffic_medium", "traffic_campaign", "geo_country", "page_location"))
    event = lambda s, name, second, **kw: {**base, "user_pseudo_id": "u", "ga_session_id": s, "event_name": name, "event_timestamp": datetime(2024, 1, 1, 0, 0, second),
                                           "purchase_value": kw.pop("value", None), "is_new_user": kw.pop("new", None), **kw}
    data = [event("1", "page_view", 5, page_location="/b", traffic_source="late"), event("1", "page_view", 1, page_location="/a"), event("1", "purchase", 9, value=Decimal("3.5"), new=True),
            event("2", "scroll", 7), event(None, "scroll", 7)]
    schema = ", ".join(f"{c} string" for c in (*base, "user_pseudo_id", "ga_session_id", "event_name")) + ", event_timestamp timestamp, purchase_value decimal(18,6), is_new_user boolean"
    names = [f.split()[0] for f in schema.split(", ") if " " in f]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in data], schema.replace("decimal(18, 6)", "decimal(18,6)"))
    out = {r.session_id: r for r in sessionize(df).collect()}
    one = out["u1"]
    assert (one.landing_page, one.exit_page, one.session_duration_seconds, one.page_views, one.events_count) == ("/a", "/b", 8, 2, 3)
    assert one.has_purchase_event and one.transaction_revenue == Decimal("3.5") and one.is_new_user and one.traffic_source == "late"
    assert set(out) == {"u1", "u2"} and [r.session_id for r in without_bots(sessionize(df)).collect()] == ["u1"]


# ---- Customer state -----------------------------------------------------------------------
def test_customer_state_matches_brute_force(spark):
    import random

    rng = random.Random(7)
    hot = [("hot", AS_OF - timedelta(days=d)) for d in (0, 29, 30, 89, 90, 91, 400)]
    orders = hot + [(f"c{rng.randrange(6)}", AS_OF - timedelta(days=rng.randrange(900))) for _ in range(120)]
    data = [(c, d, "cancelled" if i % 11 == 10 else None if i % 13 == 12 else "paid", Decimal(i + 1), Decimal(i % 3)) for i, (c, d) in enumerate(orders)]
    df = spark.createDataFrame(data, "customer_id string, order_date date, order_status string, net_after_refunds decimal(18,4), total_quantity decimal(18,2)")
    people = [("hot", date(2020, 1, 1)), *[(f"c{i}", AS_OF - timedelta(days=200 * i)) for i in range(7)]]
    dim = spark.createDataFrame([(f"sk_{c}", c, a, True, datetime(2026, 1, 1), False) for c, a in people],
                                "customer_sk string, customer_id string, acquisition_date date, is_current boolean, updated_at timestamp, marketing_consent boolean")
    state = facts.fact_customer_state_daily(df, dim, PARAMS)
    got = {(r.customer_id, r.snapshot_date): (r.lifetime_order_count, r.lifetime_revenue, r.trailing_30d_order_count, r.trailing_30d_revenue, r.trailing_90d_order_count,
                                              r.trailing_90d_revenue, r.days_since_first_order, r.days_since_last_order) for r in state.collect()}
    days = {r.snapshot_date for r in snapshot_days("month_end", df, F.lit(AS_OF), "order_date").collect()}
    assert AS_OF in days and len(days) > 25
    kept = [r for r in data if r[2] == "paid"]
    want = {}
    for c, acquired in people:
        for s in days:
            if acquired > s:
                continue
            mine = [r for r in kept if r[0] == c and r[1] <= s]
            within = lambda n: [r for r in mine if r[1] >= s - timedelta(days=n - 1)]  # noqa: E731,B023
            ages = [(s - r[1]).days for r in mine]
            want[c, s] = (len(mine), sum(r[3] for r in mine), len(within(30)), sum(r[3] for r in within(30)), len(within(90)), sum(r[3] for r in within(90)),
                          max(ages, default=None), min(ages, default=None))
    assert got == want
    kpi = {r.snapshot_date: r for r in marts.daily_customer_state(state).collect()}
    assert kpi[AS_OF].active_customers_30d == sum(1 for (c, s), v in want.items() if s == AS_OF and v[2] > 0)


# ---- Inventory ----------------------------------------------------------------------------
def test_stock_is_rebuilt_backwards(spark):
    moves = [("S", date(2026, 5, 31), -5), ("S", date(2026, 6, 1), -3), ("S", date(2026, 8, 15), 2), ("S", date(2026, 8, 20), -1), ("T", date(2026, 6, 10), 50)]
    movements = spark.createDataFrame([(s, d, Decimal(q)) for s, d, q in moves], "sku string, movement_date date, quantity_change decimal(18,2)")
    days = spark.createDataFrame([(date(2026, 5, 31),), (date(2026, 6, 30),), (date(2026, 8, 15),)], "snapshot_date date")
    got = {(r.sku, d.snapshot_date): d.after for r in facts.sku_days(days, None, movements).collect() for d in r._by_day}
    want = {(s, d): sum(q for k, at, q in moves if k == s and at > d) for s in "ST" for (d,) in [tuple(r) for r in days.collect()]}
    assert {k: got.get(k, 0) for k in want} == want
    levels = spark.createDataFrame([("1", "L", 10, 0, datetime(2026, 8, 1)), ("2", "L", 4, 0, datetime(2026, 8, 1)), ("3", "L", None, 0, datetime(2026, 8, 1))],
                                   "inventory_item_id string, location_id string, quantity_available int, quantity_incoming int, _extracted_at timestamp")
    items = spark.createDataFrame([("1", "S", None), ("2", "T", None), ("3", "U", None)], "inventory_item_id string, sku string, unit_cost decimal(18,6)")
    pos = facts.stock_by_day(levels, items, days, PARAMS, movements=movements).select("sku", F.inline("_days"))
    at = {(r.sku, r.snapshot_date): r.quantity_available for r in pos.collect()}
    assert at["S", date(2026, 5, 31)] == 12 and at["S", date(2026, 8, 15)] == 11 and at["T", date(2026, 5, 31)] == 0 and at["U", date(2026, 5, 31)] is None


def test_supply_window_excludes_the_day_itself(spark):
    day = date(2026, 6, 30)
    lines = spark.createDataFrame([("S", day - timedelta(days=28), Decimal(28), Decimal(0)), ("S", day - timedelta(days=1), Decimal(56), Decimal(28)), ("S", day, Decimal(999), Decimal(0)),
                                   ("S", day - timedelta(days=29), Decimal(999), Decimal(0))], "sku string, order_date date, quantity decimal(18,2), refunded_quantity decimal(18,2)")
    asked = spark.createDataFrame([("S", day), ("T", day)], "sku string, snapshot_date date")
    got = {r.sku: r.avg_daily_units_28d for r in facts.average_daily_units(lines, asked).collect()}
    assert got == {"S": 2.0, "T": 0.0}
    assert [x.units for x in facts.sku_days(asked.select("snapshot_date").distinct(), lines, None).first()._by_day] == [2.0]
    plan = facts.average_daily_units(lines, asked)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan


def test_swept_state_equals_the_grid(spark):
    """Customers acquired before, between and after their orders, unknown acquisition, windows that touch."""
    rng = random.Random(3)
    day = date(2026, 1, 1)
    rows = {(f"c{rng.randrange(12)}", day + timedelta(days=rng.randrange(240))) for _ in range(90)} | {("c0", day), ("c0", day + timedelta(days=30)), ("c1", day), ("c1", day + timedelta(days=29))}
    daily = spark.createDataFrame([(c, d, rng.randrange(1, 3), Decimal(rng.randrange(100)), Decimal(1)) for c, d in sorted(rows)], "customer_id string, order_date date, n long, rev decimal(28,4), qty decimal(28,2)")
    people = spark.createDataFrame([(f"s{i}", f"c{i}", None if i % 4 == 0 else day + timedelta(days=20 * i - 30)) for i in range(11)], "customer_sk string, customer_id string, acquired date")
    days = spark.createDataFrame([(day + timedelta(days=13 * i),) for i in range(25)], "snapshot_date date")
    state = facts.customer_order_metrics(daily, days, facts.customer_grid(people, days)).join(people, "customer_id").withColumns({
        "is_active_30d": F.col("trailing_30d_order_count") > 0, "is_active_90d": F.col("trailing_90d_order_count") > 0,
        "is_new_30d": F.datediff("snapshot_date", "acquired") <= 30, "is_repeat_customer": F.col("lifetime_order_count") >= 2})
    columns = ["snapshot_date", "active_customers_30d", "active_customers_90d", "total_tracked_customers", "new_in_30d_window", "repeat_customers"]
    money = ["avg_lifetime_revenue", "avg_lifetime_orders", "total_trailing_30d_revenue", "total_trailing_90d_revenue"]
    shown = [*columns, *[F.round(F.col(c).cast("double"), 4).alias(c) for c in money]]
    swept = marts.swept_customer_state(daily, people, days)
    assert sorted(map(tuple, swept.select(shown).collect())) == sorted(map(tuple, marts.daily_customer_state(state).select(shown).collect()))


def test_rolling_bitmaps_add_up(spark):
    rng = random.Random(4)
    day = date(2026, 1, 1)
    rows = [(f"m{rng.randrange(300)}" if rng.random() > 0.02 else None, day + timedelta(days=rng.randrange(120)), rng.choice("ab"), rng.choice(["x", "y", None])) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "member string, day date, a string, b string").repartition(5)
    old = frame.filter(F.col("day") < day + timedelta(days=80))
    first = rolling.number_members(old.select("member"))
    numbers = rolling.number_members(frame.select("member"), first)
    listed = [r.number for r in numbers.collect()]
    assert sorted(listed) == list(range(1, len({m for m, *_ in rows if m}) + 1))
    assert not first.exceptAll(numbers).count()
    bitmaps = rolling.daily_bitmaps(old, first, "member", "day", ["a", "b"])
    newer = frame.withColumn("a", F.when(F.col("day") < day + timedelta(days=80), F.raise_error(F.lit("old rows are not read")).cast("string")).otherwise(F.col("a")))
    grown = rolling.add_days(bitmaps, newer, numbers, "member", "day", ["a", "b"])
    days = spark.createDataFrame([(day + timedelta(days=x),) for x in (10, 79, 80, 100, 119)], "snapshot_date date")
    for slices in ([], ["a"], ["b"], ["a", "b"]):
        got = {tuple(r) for r in rolling.rolling_distinct(grown, days, 30, slices, "n").collect()}
        want = {}
        for (s,) in map(tuple, days.collect()):
            for m, d, a, b in rows:
                if m and s - timedelta(days=29) <= d <= s:
                    want.setdefault((s, *[{"a": a, "b": b}[c] for c in slices]), set()).add(m)
        assert got == {(*k, len(v)) for k, v in want.items()}


def test_movements_of_two_refunds_repeat_lines(spark):
    lines = spark.createDataFrame([("l1", "o", "p", "S", Decimal(5), Decimal(2), Decimal(1)), ("l2", "o", "p", "S", Decimal(1), Decimal(1), None)],
                                  "line_item_id string, order_id string, product_sk string, sku string, quantity decimal(18,2), refunded_quantity decimal(18,2), unit_cost decimal(18,4)")
    orders = spark.createDataFrame([("o", "paid", date(2026, 1, 1), datetime(2026, 1, 1), datetime(2026, 1, 1))], "order_id string, order_status string, order_date date, order_timestamp timestamp, _extracted_at timestamp")
    refunds = spark.createDataFrame([(r, "o", date(2026, 2, 1), datetime(2026, 2, 1), "n", datetime(2026, 2, 1)) for r in ("r1", "r2")],
                                    "refund_id string, order_id string, refund_date date, refund_timestamp timestamp, refund_reason string, _extracted_at timestamp")
    got = {r.movement_id: r.quantity_change for r in facts.fact_inventory_movements(lines, orders, refunds, PARAMS).collect()}
    assert got == {"sale_l1": -3, "return_r1_l1": 2, "return_r1_l2": 1, "return_r2_l1": 2, "return_r2_l2": 1}
    gross = facts.fact_inventory_movements(lines, orders, refunds, Params(as_of=AS_OF, pii_salt="s", sale_quantity="gross"))
    assert {r.movement_id: r.quantity_change for r in gross.filter("movement_type = 'sale'").collect()} == {"sale_l1": -5, "sale_l2": -1}


# ---- Sales and payments -------------------------------------------------------------------
def test_unknown_customer_counts_in_sums_only(spark):
    data = [(date(2024, 1, 1), c, s, False, Decimal(10), f, not f) for c, s, f in
            [("a", "paid", True), ("a", "paid", False), (None, "paid", False), ("b", "cancelled", True), ("b", None, True), ("c", "paid", False)]]
    df = spark.createDataFrame(data, "order_date date, customer_sk string, order_status string, is_test_order boolean, gross_amount decimal(18,4), is_first_order boolean, is_repeat_order boolean")
    zero = F.lit(0).cast("decimal(18,4)")
    df = df.withColumns({c: zero for c in ("discount_amount", "refunded_amount", "tax_amount", "shipping_amount")})
    r = marts.daily_sales(df, ("order_date",)).first()
    assert (r.gmv, r.order_count, r.new_customers, r.repeat_customers, r.unique_customers) == (40, 4, 1, 2, 2)


def test_payment_lookup_prefers_brand(spark):
    methods = spark.createDataFrame([("b", "card_amex_credit", "card", "amex"), ("a", "card_amex_debit", "card", "amex"), ("v", "card_visa_credit", "card", "visa"), ("k", "bnpl_klarna", "bnpl", None)],
                                    "payment_method_sk string, payment_method_id string, payment_method_type string, card_brand string")
    charges = spark.createDataFrame([("o1", "c1", datetime(2024, 1, 1), "card", "VISA", None), ("o1", "c2", None, "klarna", None, None), ("o2", "c3", datetime(2024, 1, 1), "card", None, None),
                                     ("o3", "c4", datetime(2024, 1, 1), "card", "unionpay", None), ("o4", "c5", datetime(2024, 1, 1), "klarna", None, None), (None, "c6", None, "card", None, None)],
                                    "shopify_order_id string, charge_id string, charge_timestamp timestamp, payment_type string, card_brand string, card_wallet string")
    got = {r.order_id: r.payment_method_sk for r in facts.charge_payment_methods(charges, methods).collect()}
    assert got == {"o1": "v", "o2": "b", "o3": None, "o4": "k"}


def test_disputes_become_chargebacks(spark):
    refund = "refund_id string, order_id string, refund_timestamp timestamp, refund_date date, refund_note string, refund_transactions array<struct<kind:string,status:string,amount:string,reason:string>>, _extracted_at timestamp"
    refunds = spark.createDataFrame([("r", "o", datetime(2024, 1, 1), date(2024, 1, 1), None, [("refund", "success", "5", None)], datetime(2024, 1, 1))], refund)
    orders = spark.createDataFrame([("o", "sk", "cs", Decimal(5), Decimal(2), "EUR")], "order_id string, order_sk string, customer_sk string, net_amount decimal(18,4), fx_rate_to_reporting decimal(18,8), original_currency_code string")
    charges = spark.createDataFrame([("ch", "o", datetime(2024, 1, 1))], "charge_id string, shopify_order_id string, charge_timestamp timestamp")
    reasons = spark.createDataFrame([("x", "ch", "Fraudulent")], "refund_id string, charge_id string, refund_reason string")
    disputes = spark.createDataFrame([("d", "ch", Decimal(7), "lost", datetime(2024, 2, 1), datetime(2024, 2, 1))], "dispute_id string, charge_id string, dispute_amount decimal(18,6), dispute_reason string, dispute_timestamp timestamp, _extracted_at timestamp")
    out = {r.refund_id: r for r in facts.fact_refunds(refunds, orders, charges, reasons, PARAMS, disputes=disputes).collect()}
    assert out["r"].refund_type == "full_refund" and out["r"].is_chargeback and out["r"].refund_amount == 10 and out["r"].processor == "stripe"
    assert out["dispute_d"].refund_type == "chargeback" and out["dispute_d"].refund_amount == 14


def test_reconciliation(spark):
    orders = spark.createDataFrame([("1", Decimal(100)), ("2", Decimal(100)), ("3", Decimal(5)), ("0", Decimal(0))], "order_id string, net_amount decimal(18,6)")
    charges = spark.createDataFrame([("1", Decimal(60)), ("1", Decimal("40.4")), ("2", Decimal(90)), ("9", Decimal(1)), (None, Decimal(1)), ("0", Decimal(3))], "shopify_order_id string, charge_amount decimal(18,6)")
    got = {r.order_id: r.issue for r in rules.reconcile_charges(orders, charges).collect()}
    assert got == {"2": "mismatch", "3": "order_only", "9": "charge_only", "0": "mismatch"}


@pytest.mark.parametrize("mode", ["today", "month_end"])
def test_snapshot_days_inside_history(spark, mode):
    bounds = spark.createDataFrame([(date(2026, 1, 31),), (date(2026, 3, 30),)], "d date")
    got = sorted(r.snapshot_date for r in snapshot_days(mode, bounds, F.lit(AS_OF), "d").collect())
    assert got == ([AS_OF] if mode == "today" else [date(2026, 1, 31), date(2026, 2, 28), AS_OF])


def test_daily_totals_by_hand(spark):
    per = defaultdict(int)
    for i in range(40):
        per[i % 4] += i
    df = spark.range(40).groupBy((F.col("id") % 4).alias("k")).agg(F.sum("id").alias("s"))
    assert {r.k: r.s for r in df.collect()} == dict(per)
