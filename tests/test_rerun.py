"""A stored warehouse that is loaded twice equals one that is built at once."""

import hashlib
import uuid
from dataclasses import replace
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.pii import phone_hash
from tallyhouse.operators.clustering import clustered
from tallyhouse.operators.key_summary import may_hold
from tallyhouse.operators.lookup import join_known
from tallyhouse.operators.upsert import replace_table, since_cutoff
from tallyhouse.operators import quality as Q
from tallyhouse.plans import facts
from tallyhouse.plans.checks import model_checks, staging_checks
from tallyhouse.plans.store import MERGES, Store
from tallyhouse.plans.warehouse import Warehouse, shared_saver, stored_run
from tallyhouse.sources.csv import scan_csv
from tallyhouse.sources.mapping import TableMapping, apply_mapping
from tallyhouse.workload.raw import PARAMS
from tallyhouse.workload.registry import Lab
from tests.conftest import SF_DIR

def plain(df, columns):
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def shop(spark):
    return Lab(spark, SF_DIR)


def test_second_run_has_changes_to_follow(spark, shop):
    """The early sources hold rows that the later ones take back: each fact loses some and gains some."""
    raw = {**shop.early()}
    early, late = Warehouse(spark, raw, shop.seeds(), PARAMS, save=shared_saver()), shop.warehouse()
    early.history = late.history
    for fact, key in (("fact_inventory_movements", "movement_id"), ("fact_customer_state_daily", "customer_id"), ("fact_web_sessions", "session_id"),
                      ("fact_email_engagement", "event_id"), ("fact_marketing_spend", "spend_sk")):
        before, after = early[fact].select(key).distinct(), late[fact].select(key).distinct()
        assert before.join(after, key, "left_anti").count() > 0, fact
        assert fact == "fact_customer_state_daily" or after.join(before, key, "left_anti").count() > 0, fact
    assert early["fact_orders"].filter("order_status <> 'cancelled'").join(late["fact_orders"].filter("order_status = 'cancelled'"), "order_id", "left_semi").count() > 0


@pytest.mark.parametrize("fact", sorted(MERGES))
def test_second_run_equals_full_build(shop, fact):
    skip = {"customer_sk", "loaded_at", "_loaded_at", "_record_hash", "customer_state_sk"}
    columns = [c for c in shop[fact].columns if c not in skip]
    assert plain(shop.rerun().read(fact), columns) == plain(shop[fact], columns)


def web_events(spark, rows):
    """Raw events: user, session, day of January 2025 (more days follow), hour."""
    at = "unix_micros(timestamp'2025-01-01') + ((day - 1) * 24 + hour) * 3600000000L"
    texts = ("device__mobile_brand_name", "device__category", "device__operating_system", "device__web_info__browser", "traffic_source__source", "traffic_source__medium",
             "traffic_source__name", "geo__country", "geo__region", "page_location", "page_referrer", "page_title", "ecommerce__transaction_id", "ecommerce__currency")
    frame = spark.createDataFrame(rows, "user_pseudo_id string, ga_session_id string, day int, hour int")
    return frame.selectExpr("user_pseudo_id", "cast(null as string) as user_id", "ga_session_id", "'page_view' as event_name",
                            "date_format(date_add(date'2025-01-01', day - 1), 'yyyyMMdd') as event_date", f"{at} as event_timestamp",
                            *[f"cast(null as string) as {c}" for c in texts], "cast(1 as decimal(18,6)) as ecommerce__purchase_revenue",
                            "1 as engagement_time_msec", "false as is_new_user")


EARLY_EVENTS = [("a", "1", 1, 0), ("a", "1", 70, 5), ("b", "1", 80, 1), ("c", "1", 40, 1), ("gone", "1", 81, 2), (None, "1", 80, 1), ("b", None, 80, 1), ("d", "1", 10, 3)]
LATE_EVENTS = [r for r in EARLY_EVENTS if r[0] != "gone"] + [("a", "1", 82, 1), ("b", "1", 82, 9), ("new", "7", 83, 1), (None, "1", 82, 4)]


@pytest.mark.parametrize("kept,bots", [(("int_web_sessions", "fact_web_sessions"), False), (("fact_web_sessions",), True)])
def test_sessions_longer_than_the_lookback(spark, shop, kept, bots):
    """A session that goes on for months is made anew from all its events, and one without events goes."""
    database = f"sessions_{uuid.uuid4().hex}"
    spark.sql(f"create database {database}")
    params = replace(PARAMS, rules=replace(PARAMS.rules, drop_bot_sessions=bots))
    for rows in (EARLY_EVENTS, LATE_EVENTS):
        raw = {**shop.raw, "ga4.events": web_events(spark, rows)}
        stored_run(spark, database, raw, shop.seeds(), params, names=list(kept), kept=frozenset(kept))
    whole = Warehouse(spark, raw, shop.seeds(), params)
    for name in kept:
        columns = [c for c in ("session_id", "session_start_timestamp", "session_duration_seconds", "events_count", "page_views") if c in whole[name].columns]
        assert plain(spark.table(f"{database}.{name}"), columns) == plain(whole[name], columns)
    ids = {r.session_id: r.events_count for r in spark.table(f"{database}.{kept[0]}").collect()}
    assert ids["a1"] == 3 and ids["b1"] == 2 and "gone1" not in ids
    assert ("d1" in ids) == (not bots or kept[0] == "int_web_sessions")


def test_second_run_prunes_events_and_months(spark, shop, tmp_path):
    """Without a long session, a second run reads the last days of events, and only months that may hold a touched session."""
    database = f"pruned_{uuid.uuid4().hex}"
    spark.sql(f"create database {database}")
    raw = {"ga4.events": web_events(spark, [(f"u{d}", "1", d, 1) for d in range(1, 90)])}
    stored_run(spark, database, raw, {}, PARAMS, names=["int_web_sessions"], kept=frozenset({"int_web_sessions"}))
    store = Store(spark, database)
    house = Warehouse(spark, raw, {}, PARAMS, **store.state())
    house["stg_ga4__events"].write.parquet(f"{tmp_path}/events")
    house._made["stg_ga4__events"] = spark.read.parquet(f"{tmp_path}/events")
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = house["int_web_sessions"]._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(event_date," in plan and "GreaterThanOrEqual(event_timestamp," in plan
    days = PARAMS.lookback_days["fact_web_sessions"]
    assert {r.session_id for r in house["int_touched_sessions"].collect()} == {f"u{d}1" for d in range(89 - days, 90)}
    months = store.holding("int_web_sessions", house["int_touched_sessions"])
    assert {str(r[0])[:7] for r in months.select("session_date").distinct().collect()} == {"2025-03"}


def test_join_with_missing_keys(spark):
    """Rows without the key meet nothing, not even a key that equals what they go by; they do not share a task."""
    facts_ = spark.sql("select if(id < 900, null, cast(id % 7 as string)) as k, cast(id as string) as id from range(1000)")
    other = spark.sql("select cast(id as string) as k, id * 10 as v from range(5) union all select null, 99 union all select '500', 1")
    made = join_known(facts_, other, "k", "id")
    assert made.columns == ["k", "id", "v"]
    assert plain(made, made.columns) == plain(facts_.join(other, "k", "left"), made.columns)


def test_third_run_changes_nothing_and_old_runs_go(spark, shop):
    store, names = shop.rerun(), ["fact_orders", "fact_inventory_movements", "fact_web_sessions", "mart_sales"]
    before = {n: plain(store.read(n), store.read(n).columns[:5]) for n in names[:3]}
    stored_run(spark, store.database, shop.raw, shop.seeds(), PARAMS, names=names)
    third = Store(spark, store.database)
    assert {n: plain(third.read(n), third.read(n).columns[:5]) for n in names[:3]} == before
    assert plain(third.read("mart_sales"), ["order_date", "total_refunds"]) == plain(shop["mart_sales"], ["order_date", "total_refunds"])
    for _ in range(2):
        stored_run(spark, store.database, shop.raw, shop.seeds(), PARAMS, names=names)
    last = Store(spark, store.database)
    assert last.retire() and {n: plain(last.read(n), last.read(n).columns[:5]) for n in names[:3]} == before
    runs = {t.name.split("__run_")[1][:32] for t in spark.catalog.listTables(store.database) if "__run_" in t.name}
    assert all(t in {x.name for x in spark.catalog.listTables(store.database)} for t in last.before.values()) and len(runs) <= 4


class Stop(Exception):
    pass


def small_models(spark, day):
    orders = [(str(i), f"2026-0{1 + i % day}-01", str(i % 3), "c") for i in range(6)]
    frame = spark.createDataFrame(orders, "order_id string, order_date string, customer_id string, channel_sk string").withColumn("order_date", F.to_date("order_date"))
    return {"dim_channel": spark.range(day).withColumnRenamed("id", "channel_sk"), "fact_orders": frame, "mart_sales": spark.range(10 * day)}


def seen(spark, database, names):
    return {n: sorted(map(str, spark.table(f"{database}.{n}").collect())) for n in names}


@pytest.mark.parametrize("stop_at", ["dim_channel", "fact_orders", "mart_sales", "views"])
def test_a_run_is_seen_whole_or_not_at_all(spark, stop_at, monkeypatch):
    database = f"pub_{uuid.uuid4().hex}"
    spark.sql(f"create database {database}")
    first, names = Store(spark, database), list(small_models(spark, 1))
    for n, df in small_models(spark, 1).items():
        first.save(n, df)
    first.publish()
    before, second = seen(spark, database, names), Store(spark, database)
    if stop_at == "views":  # all written and the list replaced, but only some views moved
        for n, df in small_models(spark, 3).items():
            second.save(n, df)
        show = Store._show
        monkeypatch.setattr(Store, "_show", lambda self, models: (show(self, dict(list(models.items())[:1])), (_ for _ in ()).throw(Stop()))[0])
        with pytest.raises(Stop):
            second.publish()
        monkeypatch.undo()
        whole = {n: sorted(map(str, Store(spark, database).read(n).collect())) for n in names}
        assert whole["mart_sales"] != before["mart_sales"]
        assert {n: [r for r in seen(spark, database, [n])[n]] for n in ("dim_channel", "mart_sales")} == {n: whole[n] for n in ("dim_channel", "mart_sales")}
        return
    with pytest.raises(Stop):
        for n, df in small_models(spark, 3).items():
            if n == stop_at:
                raise Stop
            second.save(n, df)
        second.publish()
    assert seen(spark, database, names) == before
    third = Store(spark, database)
    assert seen(spark, database, names) == before and set(third.before) == set(names)


def fact_rows(spark, rows):
    return spark.createDataFrame(rows, "order_id string, order_date string, customer_id string, channel_sk string").withColumn("order_date", F.to_date("order_date"))


def test_merge_opens_few_months(spark):
    """A batch of one day reads and writes its month, and the one month from which an order has moved."""
    database = f"keys_{uuid.uuid4().hex}"
    spark.sql(f"create database {database}")
    rows = [(f"{m:02d}-{i:03d}", f"2025-{m:02d}-10", str(i), "x") for m in range(1, 13) for i in range(200)]
    first = Store(spark, database)
    first.save("fact_orders", fact_rows(spark, rows))
    first.publish()
    batch = [("12-001", "2025-12-11", "new", "x"), ("12-500", "2025-12-11", "new", "x"), ("03-007", "2025-12-11", "moved", "x")]
    gone = spark.createDataFrame([("12-002",)], "order_id string")
    second = Store(spark, database)
    old = second.parts(second.before["fact_orders"])
    made = second.save("fact_orders", fact_rows(spark, batch), gone)
    second.publish()
    assert len(old) == 12 and all(p.words and p.low and p.high for p in old)
    kept = {p.value for p in second.parts(second._made["fact_orders"]) if p in old}
    assert kept == {f"2025-{m:02d}" for m in range(1, 13)} - {"2025-03", "2025-12"}
    got = {r.order_id: r.customer_id for r in spark.table(f"{database}.fact_orders").collect()}
    assert made.count() == len(got) == len(rows) and "12-002" not in got and got["03-007"] == "moved"
    asked = spark.createDataFrame([("03-007",), ("zz",), (None,)], "order_id string")
    assert may_hold(asked, "order_id", old, "load_month") == ["2025-03"]


def test_filters_on_any_column_skip_row_groups(spark, tmp_path):
    """Of rows clustered by three columns, a filter on each of them reads a fraction of the row groups."""
    rows = spark.range(300_000).select(
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") * 7919 % 90).cast("int")).alias("day"),
        F.md5((F.col("id") * 104729 % 500).cast("string")).alias("product"), (F.col("id") * 31337 % 1000).alias("place"))
    shares = {}
    for name, df in (("plain", rows.repartition(8)), ("clustered", clustered(rows, ["day", "product", "place"]))):
        df.write.option("parquet.block.size", 32 << 10).option("parquet.enable.dictionary", "false").parquet(f"{tmp_path}/{name}")
        groups = [g for f in (tmp_path / name).glob("*.parquet") for m in [pq.ParquetFile(f).metadata] for g in (m.row_group(i) for i in range(m.num_row_groups))]
        shares[name] = {c: sum(lo <= v <= hi for g in groups for s in [g.column(i).statistics] for lo, hi in [(s.min, s.max)]) / len(groups)
                        for i, (c, v) in enumerate({"day": date(2025, 2, 3), "product": hashlib.md5(b"77").hexdigest(), "place": 421}.items())}
    assert all(x > 0.9 for x in shares["plain"].values())
    assert all(x < 0.4 for x in shares["clustered"].values())


def test_failed_rebuild_keeps_the_table(spark):
    name = f"default.kept_{uuid.uuid4().hex}"
    replace_table(spark.range(5), name)
    with pytest.raises(Exception, match="stop here"):
        replace_table(spark.table(name).select(F.raise_error(F.lit("stop here")).cast("long").alias("id")), name)
    assert spark.table(name).count() == 5
    replace_table(spark.table(name).union(spark.table(name)), name)
    assert spark.table(name).count() == 10


def test_cutoff_reaches_the_scan(spark, tmp_path):
    path = f"{tmp_path}/events"
    spark.sql("select cast('2024-01-01' as timestamp) + make_interval(0, 0, 0, cast(id as int)) as at from range(100)").write.parquet(path)
    stored = spark.read.parquet(path)
    recent = since_cutoff(stored, stored, "at", 3)
    assert recent.count() == 4
    assert "GreaterThanOrEqual(at," in recent._jdf.queryExecution().executedPlan().toString()


def test_headers_in_different_orders(spark, tmp_path):
    for i, text in enumerate(("id,a,b\n1,x,y\n", "id,b,a\n2,q,p\n", "b,id\nz,3\n")):
        (tmp_path / f"{i}.csv").write_text(text)
    schema = spark.createDataFrame([], "id int, a string, b string").schema
    assert sorted(map(tuple, scan_csv(spark, str(tmp_path), schema).collect()), key=str) == [(1, "x", "y"), (2, "p", "q"), (3, None, "z")]


def test_value_maps_name_their_column(spark):
    raw = spark.createDataFrame([(1, "web")], "id int, source_name string")
    doc = {"field_mappings": {"order_id": "id"}, "transformations": {"channel": {"map_values": {"web": "online"}, "source": "source_name"}}}
    assert apply_mapping(raw, TableMapping.from_document(doc)).first().channel == "online"
    del doc["transformations"]["channel"]["source"]
    with pytest.raises(ValueError):
        apply_mapping(raw, TableMapping.from_document(doc))


def test_phone_spelling_does_not_matter(spark):
    made = spark.createDataFrame([("+1-555-0100",), ("+15550100",), (" +1 (555) 0100",), ("n/a",), (None,)], "p string").select(phone_hash("p", replace(PARAMS, phone_format="digits")).alias("h")).collect()
    assert len({r.h for r in made[:3]}) == 1 and made[0].h and made[3].h is None and made[4].h is None


def test_snapshot_grid_is_not_shuffled(spark):
    """Stock rows become rows per day only above the last exchange."""
    day = "cast('2024-02-10' as date)"
    levels = spark.sql("select 'i' as inventory_item_id, 'l' as location_id, 5 as quantity_available, 0 as quantity_incoming, now() as _extracted_at")
    items = spark.sql("select 'i' as inventory_item_id, 's' as sku, 2.0 as unit_cost")
    lines = spark.sql(f"select 's' as sku, {day} as order_date, 2 as quantity, 0 as refunded_quantity")
    moves = spark.sql(f"select 's' as sku, {day} as movement_date, -2 as quantity_change")
    fact = facts.fact_inventory_snapshot(
        levels, items, lines, dim_product=spark.sql("select 's' as sku, 'p' as product_sk, true as is_current"),
        dim_warehouse_location=spark.sql("select 'l' as location_id, 'w' as location_sk"), params=PARAMS, movements=moves)
    plan = fact._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "Generate inline" in line)
    assert not any("Join" in line or "Aggregate" in line for line in plan[:at])
    assert fact.count() >= 1


def test_checks_ride_along_with_the_writes(spark):
    """Row checks counted while models are written equal a scan of the stored tables; a gated failure keeps the former run."""
    shop, database = Lab(spark, SF_DIR), f"checked_{uuid.uuid4().hex}"
    spark.sql(f"create database {database}")
    names = ["stg_stripe__charges", "stg_shopify__order_line_items", "dim_channel", "dim_geography", "fact_email_engagement"]
    kept = frozenset({*names, "dim_email_campaign", "dim_customer"})
    made = stored_run(spark, database, shop.raw, shop.seeds(), PARAMS, names=names, kept=kept, checks=True)
    results = {(r.table_name, r.check_name): (r.failures, r.status) for r in spark.table(f"{database}.check_results").collect()}
    assert made["check_results"].count() == len(results) > 25
    assert results["fact_email_engagement", "accepted_values_bounce_type"][1] == "fail"
    parents = {"dim_email_campaign": made["fact_email_engagement"].select("email_campaign_sk")}
    for name, checks in (("fact_email_engagement", model_checks(PARAMS)["fact_email_engagement"]), ("stg_stripe__charges", staging_checks("stg_stripe__charges", made["stg_stripe__charges"].columns))):
        alone = [c for c in checks if not isinstance(c, Q.ForeignKey)]
        for r in Q.run_checks(name, made[name], alone, PARAMS, parents).collect():
            assert results[name, r.check_name] == (r.failures, r.status), (name, r.check_name)
    before = Store(spark, database).before
    with pytest.raises(ValueError, match="accepted_values_bounce_type"):
        stored_run(spark, database, shop.raw, shop.seeds(), PARAMS, names=names, kept=kept, checks=True, gate=["accepted_values_bounce_type"])
    assert Store(spark, database).before == before
