"""CSV landing, mappings, stored tables and streams."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.stored import SETTING, stored
from tallyhouse.operators.upsert import overwrite_table, upsert_table
from tallyhouse.sources import csv as S
from tallyhouse.sources.mapping import TableMapping, apply_mapping, source_col
from tallyhouse.sources.registry import RawTable, raw_tables
from tallyhouse.sources.seeds import channel_mapping, read_seed, with_channel_overrides
from tallyhouse.streaming.late_upsert import start_late_upsert

SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("at", T.TimestampType()),
    T.StructField("ok", T.BooleanType()), T.StructField("amount", T.DecimalType(18, 6)),
])


def test_header_order_quotes_and_nulls(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('AMOUNT,id,extra,name,at,ok\n1.50,1,x,"a,""b""",2024-01-01 10:00:00,true\n\n,2,x,NULL,,\nnull,3,x,,null,false\n')
    out = [tuple(r) for r in S.scan_csv(spark, str(path), SCHEMA).orderBy("id").collect()]
    assert out[0] == (1, 'a,"b"', datetime(2024, 1, 1, 10), True, pytest.approx(1.5))
    assert out[1] == (2, None, None, None, None) and out[2] == (3, None, None, False, None)


def test_bad_value_aborts(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,name,at,ok,amount\nxx,a,,,\n")
    with pytest.raises(Exception):
        S.scan_csv(spark, str(path), SCHEMA).collect()


def test_positional_scan_trims(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("whatever,the,header,says,here\n 7 ,  b ,2024-01-01 00:00:00, true , 2.5 \n")
    r = S.scan_csv_positional(spark, str(path), SCHEMA).first()
    assert (r.id, r.name, r.ok) == (7, "b", True)


def test_inferred_types_follow_names(spark, tmp_path):
    path = tmp_path / "i.csv"
    path.write_text("id,created_at,datetime,label\n1,2024-01-01 00:00:00,2024-01-02 00:00:00,x\n")
    kinds = dict(S.scan_csv_inferred(spark, str(path)).dtypes)
    assert kinds["created_at"] == kinds["datetime"] == "timestamp" and kinds["label"] == "string" and kinds["id"] in ("int", "bigint")


def test_load_policy(spark, tmp_path):
    spark.sql("create database if not exists bronze")
    good, bad = tmp_path / "g.csv", tmp_path / "b.csv"
    good.write_text("id,name,at,ok,amount\n1,a,,,\n")
    bad.write_text("id,name,at,ok,amount\nzz,a,,,\n")
    table = lambda n, critical: RawTable(n, SCHEMA, "at", 1, 2, critical)
    tables = {"s.good": table("s.good", True), "s.bad": table("s.bad", False)}
    report = S.load_all(spark, {"s.good": str(good), "s.bad": str(bad)}, tables, "bronze", datetime(2026, 1, 1))
    assert report.loaded == ["s.good"] and list(report.errors) == ["s.bad"]
    assert spark.table("bronze.s__good").first()._deleted is False
    S.load_all(spark, {"s.good": str(good)}, tables, "bronze", datetime(2026, 1, 1), mode="append")
    assert spark.table("bronze.s__good").count() == 2
    with pytest.raises(RuntimeError):
        S.load_all(spark, {"s.bad": str(bad)}, {"s.bad": table("s.bad", True)}, "bronze", datetime(2026, 1, 1))
    counts = {r.table_name: r.row_count for r in S.row_counts({"good": spark.table("bronze.s__good")}).collect()}
    assert counts == {"good": 2}


def test_json_after_load(spark):
    df = spark.createDataFrame([('{"a":1}',), ("nope",)], "j string")
    assert [r[0] for r in S.json_column(df, "j", strict=False).select(F.try_variant_get("j", "$.a", "int")).collect()] == [1, None]
    with pytest.raises(Exception):
        S.json_column(df, "j").collect()


def test_registry_is_complete(spark):
    tables = raw_tables(frozenset({"shopify.orders"}))
    assert len(tables) == 26 and tables["shopify.orders"].critical and not tables["ga4.users"].critical
    assert all(t.loaded_at in t.schema.names for t in tables.values())


def test_column_overrides(spark):
    df = spark.createDataFrame([("x", '{"code":{"iso":"KE"}}')], "plain string, addr string")
    pick = lambda o: df.select(source_col(o, "t", "country", "plain")).first()[0]
    assert pick({}) == "x" and pick({"t": {"country": "addr:code:iso"}}) == "KE"


def test_mapping_document(spark):
    raw = spark.createDataFrame([(1, " A@B.c ", "paid", False, "vip"), (2, "x", "odd", False, "TEST order"), (3, "x", "paid", True, None)],
                                "id int, email string, financial_status string, test boolean, tags string")
    doc = {"required_fields": ["id"], "optional_fields": ["note"], "field_mappings": {"order_id": "id", "customer_email": "email"}, "filters": {"exclude_test_orders": True},
           "transformations": {"customer_email": ["lowercase", "trim"], "order_status": {"map_values": {"paid": "paid"}}}}
    r = apply_mapping(raw, TableMapping.from_document(doc)).collect()
    assert [(x.order_id, x.customer_email, x.order_status, x.note) for x in r] == [(1, "a@b.c", "paid", None)]
    with pytest.raises(ValueError):
        apply_mapping(raw, TableMapping(required=("missing",)))


def test_seeds(spark, tmp_path):
    built_in = channel_mapping(spark)
    assert built_in.count() == 44 and built_in.filter("source_value = '*'").count() == 2
    mine = spark.createDataFrame([("shopify", "web", "mine")], "source_system string, source_value string, channel_id string")
    merged = with_channel_overrides(built_in, mine)
    assert merged.count() == 44 and merged.filter("source_value = 'web'").first().channel_id == "mine"
    path = tmp_path / "fx.csv"
    path.write_text("from_currency,to_currency,rate_date,rate\nEUR,USD,2024-01-01,1.1\n")
    assert read_seed(spark, "fx_rates", str(path)).first().rate_date == date(2024, 1, 1)


def test_stored_goes_to_the_shared_folder(spark):
    df = stored(spark.range(5), "five")
    assert df.count() == 5 and df.inputFiles()[0].startswith("file://" + spark.conf.get(SETTING))


# ---- Stored upsert ------------------------------------------------------------------------
def table_rows(spark, table):
    spark.catalog.refreshTable(table)  # a stream writes from its own session
    return sorted(tuple(r) for r in spark.table(table).select("k", "month", "v").collect())


def test_partitioned_upsert(spark):
    spark.sql("create database if not exists gold")
    frame = lambda data: spark.createDataFrame(data, "k int, month string, v string")
    overwrite_table(frame([(1, "01", "a"), (2, "01", "a"), (3, "02", "a")]), "gold.t", "month", ["k"])
    batch = frame([(1, "01", "new"), (3, "03", "moved"), (4, "03", "fresh")])
    want = [(1, "01", "new"), (2, "01", "a"), (3, "03", "moved"), (4, "03", "fresh")]
    for _ in range(2):
        upsert_table(batch, "gold.t", ["k"], "month", "gold.t_staging")
        assert table_rows(spark, "gold.t") == want
    assert [r[0] for r in spark.sql("show partitions gold.t").collect()] == ["month=01", "month=03"]
    wider = batch.filter("k = 1").withColumn("extra", F.lit(5))
    upsert_table(wider, "gold.t", ["k"], "month", "gold.t_staging")
    assert {r.k: r.extra for r in spark.table("gold.t").collect()} == {1: 5, 2: None, 3: None, 4: None}


def test_late_rows_from_a_stream(spark, tmp_path):
    spark.sql("create database if not exists gold")
    schema = "k int, month string, v string, at timestamp"
    feed, checkpoint = str(tmp_path / "feed"), str(tmp_path / "cp")
    put = lambda data: spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(feed)

    def run():
        stream = spark.readStream.schema(schema).parquet(feed)
        start_late_upsert(stream, "gold.s", ["k"], version="at", partition="month", staging="gold.s_staging", checkpoint=checkpoint, available_now=True).awaitTermination()

    put([(1, "01", "old", datetime(2024, 1, 1)), (1, "01", "newer", datetime(2024, 1, 2)), (2, "01", "b", datetime(2024, 1, 1))])
    run()
    assert table_rows(spark, "gold.s") == [(1, "01", "newer"), (2, "01", "b")]
    put([(2, "02", "late", datetime(2024, 2, 1))])
    run()
    assert table_rows(spark, "gold.s") == [(1, "01", "newer"), (2, "02", "late")]
