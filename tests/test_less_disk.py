"""What is stored and shuffled takes little room: hashes go as bytes, batches go when they are in their table, facts are narrow."""

import os
import uuid
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tallyhouse.functions.keys import packed, unpacked
from tallyhouse.operators import quality as Q
from tallyhouse.operators.clustering import clustered, range_bounds, rank_of
from tallyhouse.operators.stored import shared_folder, staged, stored
from tallyhouse.plans import facts, store, warehouse
from tallyhouse.plans.store import Store
from tallyhouse.plans.warehouse import READ_BY_LINES
from tallyhouse.workload.raw import PARAMS
from tallyhouse.workload.registry import REGISTRY, Lab, again
from tests.test_narrow_models import given  # noqa: F401


def files_in(path):
    return [os.path.join(at, f) for at, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_packed_text_comes_back_and_hashes_take_half(spark):
    texts = ["", "a", "0a", "0A", "xyz", "é", "00", "d41d8cd98f00b204e9800998ecf8427e", "d41d8cd98f00b204e9800998ecf8427", "ph_00ff", "\x01ab", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed("t").alias("p"))
    rows = df.select("t", unpacked("p").alias("back"), F.length("p").alias("n"), "p").collect()
    assert all(r.t == r.back for r in rows) and len({bytes(r.p) for r in rows if r.p is not None}) == len(texts) - 1
    assert {r.t: r.n for r in rows}["d41d8cd98f00b204e9800998ecf8427e"] == 17


def test_ranks_are_counts_of_cuts(spark):
    cuts = [-1.5, 0.0, 2.0, 2.5, 7.0]
    values = [float("-inf"), -2.0, -1.5, 0.0, 1.0, 2.0, 2.4, 6.9, 7.0, 8.0]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", rank_of(F.col("v"), cuts).alias("r")).collect()
    assert {r.v: r.r for r in got} == {v: sum(v >= c for c in cuts) for v in values}


def test_clustered_rows_are_the_same_rows_and_hashes_are_dealt_as_bytes(spark, tmp_path):
    spark.sql("select md5(cast(id as string)) as a_sk, if(id % 7 = 0, null, concat('c', id)) as customer_id, cast(id % 5 as int) as place, '2025-01' as month from range(300)").write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    out = clustered(df, ["place", "customer_id"], ("month",), range_bounds(df, ["place", "customer_id"]))
    assert out.schema == df.schema and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "unhex(a_sk" in plan and "Exchange rangepartitioning" in plan


def test_keys_and_references_are_counted_as_before(spark):
    rows = spark.sql("select * from values ('k1', 1, 'p'), ('k1', 1, 'q'), ('k1', 2, 'q'), (null, 1, 'q'), (null, 1, null), ('0a', 1, 'p') as t(k, n, ref)")
    assert [tuple(r) for r in Q.duplicate_keys(rows, ["k", "n"]).collect()] == [("k1", 1, 2)]
    checks = [Q.Unique("unique_k", "error", ("k",)), Q.ForeignKey("ref_known", "error", "ref", "parent", "id")]
    parents = {"parent": spark.sql("select * from values ('p'), (null) as t(id)")}
    found = Q.run_checks("t", rows, checks, PARAMS, parents)
    assert {r.check_name: r.failures for r in found.collect()} == {"unique_k": 1, "ref_known": 3}
    none = Q.run_checks("t", rows.filter("ref = 'p'"), checks[1:], PARAMS, parents).collect()
    assert [r.failures for r in none] == [0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(ref" in plan and plan.index("Exchange hashpartitioning(ref") > plan.index("partial_count")


def test_a_batch_goes_when_it_is_in_its_table(spark):
    database = f"batch_{uuid.uuid4().hex}"
    spark.sql(f"create database {database}")
    before = {*files_in(shared_folder(spark))}
    rows = [("o1", "2025-01-10", "c", "x"), ("o2", "2025-02-10", "c", "x")]
    for part in (rows, [("o2", "2025-03-01", "d", "y")]):
        run = Store(spark, database)
        frame = spark.createDataFrame(part, "order_id string, order_date string, customer_id string, channel_sk string").withColumn("order_date", F.to_date("order_date"))
        run.save("fact_orders", frame)
        run.publish()
    assert sorted((r.order_id, str(r.order_date)) for r in Store(spark, database).read("fact_orders").collect()) == [("o1", "2025-01-10"), ("o2", "2025-03-01")]
    assert {*files_in(shared_folder(spark))} == before
    with staged(spark.range(3), "three") as three:
        assert three.count() == 3 and {*files_in(shared_folder(spark))} != before
    assert {*files_in(shared_folder(spark))} == before


def test_months_of_the_batch_are_not_looked_up(spark, monkeypatch):
    """Where a batch touches all stored months, key words are not asked at all."""
    database, asked = f"months_{uuid.uuid4().hex}", []
    spark.sql(f"create database {database}")
    monkeypatch.setattr(store, "may_hold", lambda keys, key, parts, partition: asked.append([p.value for p in parts]) or [])
    for part in ([("o1", "2025-01-10"), ("o2", "2025-02-10")], [("o1", "2025-01-11")]):
        run = Store(spark, database)
        run.save("fact_orders", spark.createDataFrame([(*r, "c", "x") for r in part], "order_id string, order_date string, customer_id string, channel_sk string").withColumn("order_date", F.to_date("order_date")))
        run.publish()
    assert asked == [["2025-02"]]


def test_stored_files_are_compressed(spark):
    out = stored(spark.sql("select md5(cast(id as string)) as k from range(20000)").coalesce(1), "keys")
    assert sum(os.path.getsize(f.removeprefix("file:").replace("///", "/")) for f in out.inputFiles()) < 20000 * 24


def test_lines_alone_store_what_they_read_of_orders(spark, given, monkeypatch):  # noqa: F811
    kept = {}
    monkeypatch.setattr(warehouse, "stored", lambda df, name: (kept.update({name: {*df.columns}}), stored(df, name))[1])
    assert REGISTRY["fact_order_lines"].run(spark, given).count() == 8
    assert kept["fact_orders"] == {*READ_BY_LINES}


def test_two_runs_store_their_inputs_narrow(spark, given):  # noqa: F811
    orders = Lab(spark, given).warehouse()["fact_orders"]
    assert "gross_amount" not in again("fact_orders", orders, "fact_order_lines").columns
    assert "gross_amount" in again("fact_orders", orders, "fact_refunds").columns
    lines = Lab(spark, given).warehouse()["fact_order_lines"]
    assert "customer_sk" not in again("fact_order_lines", lines, "fact_order_lines").columns
    assert "order_sk" not in again("fact_order_lines", lines, "fact_inventory_movements").columns


def test_facts_that_are_checked_are_made_once(spark, given, monkeypatch):  # noqa: F811
    made = []
    for name in ("fact_orders", "fact_order_lines", "fact_refunds", "fact_inventory_movements"):
        monkeypatch.setitem(warehouse.MODELS, name, lambda w, name=name, make=warehouse.MODELS[name]: (made.append(name), make(w))[1])
    assert REGISTRY["dq_facts"].run(spark, given).count() > 100
    assert sorted(made) == ["fact_inventory_movements", "fact_order_lines", "fact_orders", "fact_refunds"]


def test_sku_days_fill_days_without_change(spark):
    """Several lines and movements a day, none, units that are NULL, days before, between and behind the snapshots."""
    days = spark.createDataFrame([(date(2026, 3, 31),), (date(2026, 4, 30),), (date(2026, 5, 10),)], "snapshot_date date")
    lines = spark.createDataFrame(
        [("A", date(2026, 4, 20), Decimal(28), Decimal(0)), ("A", date(2026, 4, 20), Decimal(56), Decimal(28)), ("A", date(2026, 4, 30), Decimal(14), Decimal(0)), ("B", date(2026, 4, 5), None, Decimal(0)),
         ("C", date(2020, 1, 1), Decimal(1), Decimal(0)), (None, date(2026, 4, 20), Decimal(1), Decimal(0)), ("D", None, Decimal(1), Decimal(0))],
        "sku string, order_date date, quantity decimal(18,2), refunded_quantity decimal(18,2)")
    moves = spark.createDataFrame(
        [("A", date(2026, 3, 31), Decimal(100)), ("A", date(2026, 4, 1), Decimal(1)), ("A", date(2026, 4, 1), Decimal(2)), ("A", date(2027, 1, 1), Decimal(4)), ("E", date(2026, 5, 10), Decimal(-7)), ("F", None, Decimal(1))],
        "sku string, movement_date date, quantity_change decimal(18,2)")
    got = {r.sku: [(str(d.snapshot_date), d.units, d.after) for d in r._by_day] for r in facts.sku_days(days, lines, moves).collect()}
    assert got == {
        "A": [("2026-03-31", 0.0, Decimal(7)), ("2026-04-30", 2.0, Decimal(4)), ("2026-05-10", 2.5, Decimal(4))],
        "B": [("2026-03-31", 0.0, Decimal(0)), ("2026-04-30", 0.0, Decimal(0)), ("2026-05-10", 0.0, Decimal(0))],
        "E": [("2026-03-31", 0.0, Decimal(-7)), ("2026-04-30", 0.0, Decimal(-7)), ("2026-05-10", 0.0, Decimal(0))],
    }
