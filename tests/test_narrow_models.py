"""Queries make and store only what they read: facts by column, second runs by fact, one shuffle per key."""

from datetime import date

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import key_summary
from tallyhouse.operators.key_summary import Part
from tallyhouse.operators.stored import stored
from tallyhouse.plans import facts, warehouse
from tallyhouse.plans.store import MERGES, replace_scope
from tallyhouse.plans.warehouse import READ_BY_MODELS, READ_BY_MOVEMENTS, Warehouse
from tallyhouse.workload.raw import PARAMS
from tallyhouse.workload.registry import REGISTRY, Lab


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """A few given tables of every kind."""
    path = str(tmp_path_factory.mktemp("given"))
    at = "timestamp_ntz '1996-03-05 00:00:00'"
    tables = {
        "region": "select 0 as r_regionkey, 'R' as r_name",
        "nation": "select 0 as n_nationkey, 'N' as n_name, 0 as n_regionkey",
        "customer": "select id as c_custkey, 'C' as c_name, 0 as c_nationkey, 1.5D as c_acctbal, 'BUILDING' as c_mktsegment from range(1, 9)",
        "supplier": "select id as s_suppkey, 'S' as s_name, 0 as s_nationkey, 1.5D as s_acctbal from range(1, 4)",
        "part": "select id as p_partkey, 'P' as p_name, 'B' as p_brand, 'T' as p_type, 7 as p_size, 9.5D as p_retailprice from range(1, 9)",
        "orders": f"select id as o_orderkey, 1 + id % 8 as o_custkey, 'F' as o_orderstatus, 90.5D as o_totalprice, {at} as o_orderdate, '1-URGENT' as o_orderpriority from range(1, 9)",
        "lineitem": f"select id as l_orderkey, 1 + id % 8 as l_partkey, 1L as l_suppkey, 1 as l_linenumber, 3.0D as l_quantity, 9.5D as l_extendedprice, 0.01D as l_discount, 0.02D as l_tax, 'R' as l_returnflag, 'O' as l_linestatus, {at} as l_shipdate from range(1, 9)",
        "events": "select id as event_id, timestamp_ntz '2024-01-02 00:00:00' as ts, id as user_id, 'view' as event_type, 1.5D as value, '{}' as props from range(1, 9)",
    }
    for name, text in tables.items():
        spark.sql(text).write.parquet(f"{path}/{name}.parquet")
    return path


def test_a_fact_is_made_with_the_columns_asked_for(spark, given):
    shop = Lab(spark, given)
    sums = shop["fact_orders"].groupBy("channel_sk").agg(F.sum("gross_amount").alias("gmv"))
    assert sums.collect()
    plan = sums._jdf.queryExecution().optimizedPlan().toString()
    assert "browser_ip" not in plan and "note_attributes" not in shop.inputs()["fact_orders"].columns
    assert all(shop.inputs()[name].columns == [*columns] for name, columns in READ_BY_MODELS.items())
    assert shop["fact_order_lines"].count() == shop["fact_inventory_movements"].filter("movement_type = 'return'").count() == 8


@pytest.mark.parametrize(("query", "kinds"), [("movements_by_refund_line", {"sale": (8, -24), "return": (8, 24)}), ("default_inventory_movements", {"return": (8, 24)})])
def test_movements_are_made_without_storing_lines(spark, given, monkeypatch, query, kinds):
    kept = {}
    monkeypatch.setattr(warehouse, "stored", lambda df, name: (kept.update({name: tuple(df.columns)}), stored(df, name))[1])
    out = REGISTRY[query].run(spark, given)
    assert {r.movement_type: (r.n, r.q) for r in out.groupBy("movement_type").agg(F.count("*").alias("n"), F.sum("quantity_change").alias("q")).collect()} == kinds
    assert kept.keys().isdisjoint({"fact_order_lines", "fact_refunds", "dim_customer", "dim_product"})
    assert kept["fact_orders"] == READ_BY_MOVEMENTS


@pytest.mark.parametrize("params", [replace(PARAMS, return_units=units, sale_quantity=sale) for units in ("order", "refund_line") for sale in ("net", "gross")], ids=lambda p: f"{p.return_units}-{p.sale_quantity}")
def test_movements_from_staged_rows_equal_those_from_facts(spark, params):
    """Orders and refunds that come twice, lines without an order, products that share a SKU, days between versions; lines are sent by order once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        zero = "cast(0 as decimal(18,6))"
        lines = spark.sql(f"""select concat('L', id) as line_item_id, if(id = 9, null, concat('O', id % 4)) as order_id, concat('S', id % 3) as sku, 'v' as variant_id, 'T' as product_title_at_sale, cast(id as int) as quantity,
            2.0BD as unit_price, {zero} as line_subtotal, {zero} as line_discount, {zero} as line_tax, {zero} as line_net_amount, false as was_promotional, timestamp '2020-01-01' as _extracted_at from range(10)""")
        orders = spark.sql("""select concat('O', id % 3) as order_id, 's' as order_sk, 'c' as customer_sk, 'h' as channel_sk, date_add(date '2020-01-30', cast(id as int)) as order_date, timestamp '2020-01-31' as order_timestamp,
            if(id = 1, 'cancelled', 'open') as order_status, cast(1 as decimal(18,8)) as fx_rate_to_reporting, timestamp '2020-02-02' as _extracted_at from range(4)""")
        refunds = spark.sql("""select *, timestamp '2020-03-01' as refund_timestamp, timestamp '2020-03-02' as _extracted_at from values
            ('R1', 'O0', date '2020-03-01', 'a', array(named_struct('line_item_id', 'L4', 'quantity', '2', 'subtotal', '1'), named_struct('line_item_id', 'L8', 'quantity', '1', 'subtotal', '1'))),
            ('R1', 'O0', date '2020-03-01', 'b', array(named_struct('line_item_id', 'L4', 'quantity', '1', 'subtotal', '1'))),
            ('R2', 'O1', date '2020-03-02', 'c', array(named_struct('line_item_id', 'L1', 'quantity', '1', 'subtotal', '1'), named_struct('line_item_id', 'L5', 'quantity', 'x', 'subtotal', '1'))),
            ('R3', 'O3', date '2020-03-03', null, array(named_struct('line_item_id', 'L7', 'quantity', '0', 'subtotal', '1'))), ('R4', 'O2', null, 'd', array(named_struct('line_item_id', 'L2', 'quantity', '1', 'subtotal', '1')))
            as t(refund_id, order_id, refund_date, refund_note, refund_line_items)""")
        products = spark.sql("""select *, cast(null as timestamp) as valid_to from values ('S0', 'p', 1.5BD, timestamp '2020-01-31'), ('S1', 'q', 2BD, timestamp '2019-01-01'), ('S1', 'r', null, timestamp '2019-01-01') as t(sku, product_sk, unit_cost, valid_from)""")
        made = facts.fact_order_lines(lines, orders, refunds, products, params)
        refund_fact = refunds.withColumn("refund_reason", F.col("refund_note")).join(orders.select("order_id"), "order_id", "left")
        expected = facts.fact_inventory_movements(made, orders, refund_fact, params, refund_lines=refunds if params.return_units == "refund_line" else None)
        got = facts.movements_from_staged(lines, orders, refunds, facts.refund_items(refunds), products, params)
        assert got.columns == expected.columns
        rows = lambda df: sorted(str(r) for r in df.collect())
        assert rows(got) == rows(expected) and {r.movement_type for r in got.collect()} == {"sale", "return"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_kept_models_hold_the_named_columns(spark, given):
    shop = Lab(spark, given)
    assert shop.kept("fact_refunds", {"refund_id", "order_id"}).columns == ["refund_id", "order_id"]
    assert shop.kept("fact_refunds", {"refund_id", "order_id"}) is shop.kept("fact_refunds", {"order_id", "refund_id"})
    assert shop.kept("fact_refunds").columns == shop["fact_refunds"].columns


def test_a_second_run_builds_what_its_fact_needs(spark, given):
    shop = Lab(spark, given)
    assert "fact_marketing_spend" in shop.rerun("fact_marketing_spend").before
    assert shop.rerun("fact_marketing_spend").before.keys().isdisjoint({"fact_orders", "fact_order_lines", "dim_customer", "fact_inventory_snapshot"})
    assert shop.rerun("fact_refunds") is shop.rerun("fact_orders")
    assert {"fact_orders", "fact_refunds"} <= shop.rerun("fact_orders").before.keys()
    assert shop.rerun("fact_refunds").read("fact_refunds").count() == 8


def test_lines_meet_orders_and_refunds_in_one_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.sql("""select concat('L', id) as line_item_id, concat('O', id % 3) as order_id, 'A' as sku, 'T' as product_title_at_sale, id as quantity, 2.0BD as unit_price,
            cast(4 as decimal(18,6)) as line_subtotal, cast(1 as decimal(18,6)) as line_discount, cast(0 as decimal(18,6)) as line_tax, cast(3 as decimal(18,6)) as line_net_amount,
            false as was_promotional, timestamp '2020-01-01' as _extracted_at from range(1, 6)""")
        orders = spark.sql("select concat('O', id) as order_id, 's' as order_sk, 'c' as customer_sk, 'h' as channel_sk, date '2020-01-31' as order_date, timestamp '2020-01-31' as order_timestamp, cast(1 as decimal(18,8)) as fx_rate_to_reporting from range(3)")
        refunds = spark.sql("select 'O1' as order_id, array(named_struct('line_item_id', 'L4', 'quantity', '2', 'subtotal', '2.5')) as refund_line_items")
        products = spark.sql("select 'A' as sku, 'p' as product_sk, cast(1 as decimal(18,6)) as unit_cost, timestamp '2019-01-01' as valid_from, cast(null as timestamp) as valid_to")
        out = facts.fact_order_lines(lines, orders, refunds, products, PARAMS).select("line_item_id", "order_sk", "product_sk", "refunded_quantity")
        assert plan_of(out).count("Exchange hashpartitioning(order_id") <= 3  # lines, orders and refunded lines; never the joined lines again
        assert sorted(tuple(map(str, r)) for r in out.collect()) == [(f"L{i}", "s", "p", "2.00" if i == 4 else "0.00") for i in range(1, 6)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stock_changes_are_shuffled_once_and_sparse(spark):
    days = spark.sql("select explode(sequence(date '2020-01-31', date '2020-12-31', interval 1 month)) as snapshot_date")
    moves = spark.createDataFrame([("A", date(2020, 3, 2), 5.0), ("A", date(2020, 2, 2), 1.0), ("B", date(2021, 2, 1), -2.0)], "sku string, movement_date date, quantity_change double")
    moves = moves.withColumn("quantity_change", F.col("quantity_change").cast("decimal(18,2)"))
    per_sku = facts.sku_days(days, None, moves)
    shuffled = [x for x in plan_of(per_sku).splitlines() if "Exchange hashpartitioning" in x and "snapshot_date" in x]
    assert not shuffled  # days and SKUs in one key would deal out every SKU's every day
    got = {r.sku: {d.snapshot_date: d.after for d in r._by_day} for r in per_sku.collect()}
    assert [len(x) for x in got.values()] == [12, 12]
    assert got["A"][date(2020, 1, 31)] == 6 and got["A"][date(2020, 2, 29)] == 5 and got["A"][date(2020, 3, 31)] == 0
    assert got["B"][date(2020, 12, 31)] == -2


def test_many_keys_name_the_partitions_in_range(spark, monkeypatch):
    monkeypatch.setattr(key_summary, "PAIRS", 3)
    parts = [Part("a", "", "/no/such/words", 1, "k1", "k5"), Part("b", "", "/no/such/words", 1, "k4", "k9"), Part("c", "", "/no/such/words", 1, "x", "z")]
    keys = spark.createDataFrame([(f"k{i}",) for i in range(1, 8)] + [(None,)], "k string")
    assert key_summary.may_hold(keys, "k", parts, "p") == ["a", "b"]  # 14 pairs against 8 rows: no words are read


def test_charges_are_left_unread_where_no_payment_method_is_asked_for(spark, given):
    orders = Lab(spark, given)["fact_orders"]
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (orders, orders.groupBy("channel_sk").agg(F.sum("gross_amount")))]
    assert ["metadata_shopify_order_id" in p or "ch_" in p for p in plans] == [True, False]


def test_the_newest_charge_decides_and_a_missing_time_is_oldest(spark):
    """Of equal times the greatest id; a charge of no order counts nowhere."""
    charges = spark.sql("""select * from values ('1', 'b', timestamp '2024-01-02', 'card', 'visa', null), ('1', 'c', null, 'klarna', null, null), ('1', 'a', timestamp '2024-01-02', 'link', null, null),
        ('2', 'a', null, 'card', 'visa', null), ('2', 'b', null, 'klarna', null, null), (null, 'x', null, 'card', null, null)
        as t(shopify_order_id, charge_id, charge_timestamp, payment_type, card_brand, card_wallet)""")
    methods = spark.sql("""select * from values ('m1', 'k1', 'credit_card', 'visa'), ('m2', 'k2', 'buy_now_pay_later', null)
        as t(payment_method_id, payment_method_sk, payment_method_type, card_brand)""")
    of_all, of_newest = (sorted(map(str, facts.charge_payment_methods(c, methods).collect())) for c in (charges, charges.filter("charge_id = 'b'")))
    assert len(of_all) == 2 and of_all == of_newest


def test_old_refunds_touch_no_orders_where_only_orders_are_stored(spark, given):
    shop = Lab(spark, given)
    held = spark.sql("select '1' as order_id, false as is_first_order, timestamp '2026-01-01' as updated_at")
    house = Warehouse(spark, shop.raw, shop.seeds(), PARAMS, existing={"fact_orders": held}, save=shop.warehouse()._save)
    assert house["int_touched_orders"].count() == 0
    held = held.withColumn("updated_at", F.lit("2021-03-20").cast("timestamp"))
    house = Warehouse(spark, shop.raw, shop.seeds(), PARAMS, existing={"fact_orders": held}, save=shop.warehouse()._save)
    assert house["int_touched_orders"].count() == 8


def test_two_runs_store_the_columns_that_are_compared(spark, given):
    shop = Lab(spark, given)
    held = shop.rerun("fact_orders").read("fact_orders").columns
    assert "gross_amount" in held and "updated_at" in held and "ip_address_hash" not in held


def test_two_runs_store_narrow_day_facts(spark, given):
    shop = Lab(spark, given)
    held = shop.rerun("fact_email_engagement").read("fact_email_engagement").columns
    assert {"event_id", "event_timestamp", "customer_sk"} <= {*held} and "event_sk" not in held and "bounce_reason" not in held


def test_stored_rows_are_not_shuffled_to_meet_days_or_few_parents(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        held = spark.range(1000).selectExpr("concat('i', id % 40) as inventory_item_id", "'l' as location_id", "date_add(date '2024-01-01', cast(id / 40 as int)) as snapshot_date")
        held.write.parquet(f"{tmp_path}/held")
        target = spark.read.parquet(f"{tmp_path}/held")
        batch = target.filter("snapshot_date >= date '2024-01-20' and inventory_item_id = 'i1'")
        out = replace_scope(target, batch, MERGES["fact_inventory_snapshot"], None)
        assert "Exchange hashpartitioning(inventory_item_id" not in plan_of(out) and "SortMergeJoin" not in plan_of(out)
        assert out.count() == 19 * 40 + 6
        undated = batch.limit(1).withColumn("snapshot_date", F.lit(None).cast("date"))
        once = replace_scope(target, batch.unionByName(undated), MERGES["fact_inventory_snapshot"], None)
        assert replace_scope(once, undated, MERGES["fact_inventory_snapshot"], None).filter("snapshot_date is null").count() == 2  # null keys equal no key
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_customers_are_dealt_once(spark):
    """Orders and days of a customer meet behind one exchange by customer; days find their snapshots by broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = spark.sql("select concat('c', id % 3) as customer_id, date_add(date '2024-01-10', cast(id as int)) as order_date, 'open' as order_status, cast(2 as decimal(18,4)) as net_after_refunds, cast(1 as decimal(18,2)) as total_quantity from range(90)")
        people = spark.sql("select concat('s', id) as customer_sk, concat('c', id) as customer_id, true as is_current, true as marketing_consent, timestamp '2024-01-01' as updated_at, date '2024-01-01' as acquisition_date from range(5)")
        state = facts.fact_customer_state_daily(orders, people, PARAMS)
        dealt = [x for x in plan_of(state).splitlines() if "Exchange hashpartitioning(" in x]
        assert not any("customer_id" in x.split("[plan_id")[0] and "snapshot_date" in x.split("[plan_id")[0] for x in dealt)
        got = {(r.customer_id, str(r.snapshot_date)): r for r in state.collect()}
        assert len(got) == 5 * 4 and got["c4", "2024-03-31"].lifetime_order_count == 0
        assert got["c0", "2024-03-31"].lifetime_order_count == 28 and got["c0", "2024-03-31"].trailing_30d_order_count == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
