"""Operators on small fixtures, edge cases first."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import classify as C
from tallyhouse.functions.json_ops import json_items, pivot_items, sum_items
from tallyhouse.functions.pii import loose_name_key, pii_hash, pii_null
from tallyhouse.operators import quality as Q
from tallyhouse.operators.dedup import latest_per_key
from tallyhouse.operators.fx import with_fx_rate
from tallyhouse.operators.intervals import overlapping_versions, point_in_time_join, point_in_time_join_large, to_intervals, to_intervals_skewed
from tallyhouse.operators.lookup import lookup_with_wildcard
from tallyhouse.operators.scd2 import backdate_current, greatest_or_null, scd2_merge, scd2_start
from tallyhouse.operators.upsert import cutoff, since_cutoff, upsert
from tallyhouse.params import Params
from tallyhouse.plans import dims, kpis
from tallyhouse.sources.seeds import us_holidays

PARAMS = Params(as_of=date(2026, 8, 15), pii_salt="s")


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# ---- Point in time ------------------------------------------------------------------------
@pytest.fixture(scope="module")
def versions(spark):
    data = [("a", "a1", datetime(2024, 1, 1), datetime(2024, 6, 1)), ("a", "a2", datetime(2024, 6, 1), None), ("b", "b1", datetime(2024, 3, 1), None)]
    return spark.createDataFrame(data, "k string, v string, valid_from timestamp, valid_to timestamp")


@pytest.mark.parametrize(
    ("key", "at", "expected"),
    [("a", datetime(2024, 1, 1), "a1"), ("a", datetime(2024, 5, 31, 23, 59, 59), "a1"), ("a", datetime(2024, 6, 1), "a2"),
     ("a", datetime(2023, 12, 31), None), ("b", datetime(2030, 1, 1), "b1"), ("zz", datetime(2024, 6, 1), None), (None, datetime(2024, 6, 1), None)],
)
def test_version_bounds(spark, versions, key, at, expected):
    facts = spark.createDataFrame([(key, at)], "key string, at timestamp")
    out = point_in_time_join(facts, versions, fact_key="key", version_key="k", at="at", take={"v": "v"})
    assert [r.v for r in out.collect()] == [expected]


def test_overlap_is_reported(spark, versions):
    assert overlapping_versions(versions, "k").count() == 0
    extra = spark.createDataFrame([("b", "b2", datetime(2024, 5, 1), None)], versions.schema)
    assert overlapping_versions(versions.union(extra), "k").count() == 1


def test_skewed_intervals_equal_plain(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("k"), "id",
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=(F.col("id") * 37) % 9000)).alias("at"),
    )
    df = df.dropDuplicates(["k", "at"])
    plain = to_intervals(df, ["k"], "at").select("k", "valid_from", "valid_to")
    split = to_intervals_skewed(df, ["k"], "at", ["id"]).select("k", "valid_from", "valid_to")
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


@pytest.mark.parametrize(
    ("code", "day", "rate"),
    [("EUR", "2024-01-01", "1.10"), ("eur", "2024-03-31", "1.10"), ("EUR", "2024-04-01", "1.20"), ("EUR", "2031-01-01", "1.20"),
     ("EUR", "2023-12-31", None), ("USD", "2024-01-01", "1"), ("JPY", "2024-01-01", None), (None, "2024-01-01", None)],
)
def test_fx_rate(spark, code, day, rate):
    rates = spark.createDataFrame(
        [("EUR", "USD", date(2024, 1, 1), Decimal("1.10")), ("EUR", "USD", date(2024, 4, 1), Decimal("1.20")), ("EUR", "GBP", date(2024, 2, 1), Decimal("0.9"))],
        "from_currency string, to_currency string, rate_date date, rate decimal(18,8)",
    )
    facts = spark.createDataFrame([(code, date.fromisoformat(day))], "cur string, day date")
    out = with_fx_rate(facts, rates, currency="cur", on="day", reporting_currency="USD").collect()
    assert len(out) == 1
    assert out[0].fx_rate == (None if rate is None else Decimal(rate))


def test_latest_ignores_unknown_time(spark):
    df = spark.createDataFrame([("o", "c1", None), ("o", "c2", 5), ("o", "c3", 5), ("p", "c4", None)], "o string, c string, t int")
    assert rows(latest_per_key(df, ["o"], "t", F.desc("c")).select("o", "c"), "o") == [("o", "c3"), ("p", "c4")]


def test_latest_limits_before_the_exchange(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("k"), "id")
    plan = latest_per_key(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    exchange, first, last = plan.index("Exchange"), plan.index("WindowGroupLimit"), plan.rindex("WindowGroupLimit")
    assert first < exchange < last


def test_wildcard_lookup(spark):
    facts = spark.createDataFrame([("x",), ("y",), (None,)], "key string")
    mapping = spark.createDataFrame([("x", "one"), ("*", "rest")], "src string, ch string")
    args = dict(fact_key="key", map_key="src", value="ch", out="channel")
    assert rows(lookup_with_wildcard(facts, mapping, **args), "key") == [(None, "rest"), ("x", "one"), ("y", "rest")]
    without = lookup_with_wildcard(facts, mapping.filter("src <> '*'"), **args)
    assert rows(without, "key") == [(None, None), ("x", "one"), ("y", None)]


def test_scd2_check(spark):
    schema = "k string, a string, b int"
    history = scd2_start(spark.createDataFrame([("same", "x", 1), ("changed", "x", 1), ("filled", None, 1), ("gone", "x", 1)], schema), "k", now=F.lit("2024-01-01"))
    current = spark.createDataFrame([("same", "x", 9), ("changed", "y", 1), ("filled", "v", 1), ("new", "n", 1)], schema)
    merged = scd2_merge(history, current, "k", now=F.lit("2025-01-01"), check=["a"])
    t0, t1 = datetime(2024, 1, 1), datetime(2025, 1, 1)
    assert rows(merged.select("k", "a", "valid_from", "valid_to"), "k", "valid_from") == [
        ("changed", "x", t0, t1), ("changed", "y", t1, None), ("filled", None, t0, t1), ("filled", "v", t1, None),
        ("gone", "x", t0, None), ("new", "n", t1, None), ("same", "x", t0, None),
    ]
    assert merged.select("scd_id").distinct().count() == merged.count()
    again = scd2_merge(merged, current, "k", now=F.lit("2026-01-01"), check=["a"])
    assert again.exceptAll(merged).count() == 0 and again.count() == merged.count()


def test_scd2_timestamp(spark):
    schema = "k string, a string, updated_at timestamp"
    old = spark.createDataFrame([("p", "x", datetime(2024, 1, 1)), ("q", "x", datetime(2024, 1, 1))], schema)
    new = spark.createDataFrame([("p", "y", datetime(2024, 5, 1)), ("q", "z", datetime(2024, 1, 1))], schema)
    merged = scd2_merge(scd2_start(old, "k", now=F.lit("2030-01-01"), updated_at="updated_at"), new, "k", now=F.lit("2030-01-01"), updated_at="updated_at")
    assert rows(merged.select("k", "a", "valid_from", "valid_to"), "k", "valid_from") == [
        ("p", "x", datetime(2024, 1, 1), datetime(2024, 5, 1)), ("p", "y", datetime(2024, 5, 1), None), ("q", "x", datetime(2024, 1, 1), None)]
    with pytest.raises(ValueError):
        scd2_merge(old, new, "k", now=F.lit("2030-01-01"))


def test_backdating(spark):
    history = scd2_start(spark.createDataFrame([("1",), ("2",)], "k string"), "k", now=F.lit("2024-01-01"))
    created = spark.createDataFrame([("1", datetime(2020, 5, 5)), ("2", datetime(2025, 1, 1))], "id string, at timestamp")
    out = backdate_current(history, created, key="k", created_key="id", created_at="at")
    assert rows(out.select("k", "valid_from"), "k") == [("1", datetime(2020, 5, 5)), ("2", datetime(2024, 1, 1))]


def test_greatest_keeps_null(spark):
    df = spark.createDataFrame([(1, 2), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(greatest_or_null(F.col("a"), F.col("b"))).collect()] == [2, None]


# ---- Incremental --------------------------------------------------------------------------
def test_upsert_twice_is_once(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B", 9), (3, "C", 9)], "k int, v string, extra int")
    once = upsert(target, batch, ["k"])
    assert rows(once, "k") == [(1, "a", None), (2, "B", 9), (3, "C", 9)]
    assert rows(upsert(once, batch, ["k"]), "k") == rows(once, "k")


def test_cutoff(spark):
    target = spark.createDataFrame([(date(2024, 3, 20),)], "d date")
    source = spark.createDataFrame([(date(2024, 3, 5),), (date(2024, 3, 6),), (date(2024, 3, 30),)], "d date")
    assert rows(since_cutoff(source, target, "d", 14), "d") == [(date(2024, 3, 6),), (date(2024, 3, 30),)]
    assert since_cutoff(source, None, "d", 14).count() == 3
    assert source.filter(F.col("d") >= cutoff(target.limit(0), "d", 14)).count() == 3


# ---- JSON and text ------------------------------------------------------------------------
@pytest.mark.parametrize(
    ("payload", "total"),
    [('[{"kind":"refund","amount":"12.34"},{"kind":"refund","amount":1},{"kind":"sale","amount":"9"}]', "13.34"), ("[]", "0"), (None, "0"),
     ("not json", "0"), ('[{"kind":"refund","amount":"abc"}]', "0"), ('[{"kind":"refund"}]', "0")],
)
def test_payload_sum(spark, payload, total):
    df = spark.createDataFrame([(payload,)], "j string")
    out = df.select(sum_items(json_items("j", ("kind", "amount")), "amount", lambda e: e["kind"] == "refund")).first()[0]
    assert out == Decimal(total)


def test_payload_pivot(spark):
    df = spark.createDataFrame([('[{"name":"a","value":"1"},{"name":"a","value":"2"},{"name":"b","value":"x"}]',), ("broken",), (None,)], "j string")
    cols = pivot_items(json_items("j", ("name", "value")), "name", "value", ("a", "b", "c"))
    assert [tuple(r) for r in df.select(*[c.alias(n) for n, c in cols.items()]).collect()] == [("2", "x", None), (None,) * 3, (None,) * 3]


def test_masking(spark):
    salted, off = Params(as_of=date(2024, 1, 1), pii_salt="s"), Params(as_of=date(2024, 1, 1), pii_masking=False)
    df = spark.createDataFrame([(" Ann@X.com ", "ann@x.com")], "a string, b string")
    r = df.select(pii_hash("a", salted).alias("x"), pii_hash("b", salted).alias("y"), pii_hash("a", off).alias("z"), pii_null("a", salted).alias("n"), pii_null("a", off).alias("p")).first()
    assert r.x == r.y and len(r.x) == 64 and r.z == " Ann@X.com " and r.n is None and r.p == " Ann@X.com "


def test_loose_names(spark):
    df = spark.createDataFrame([("Robert", "Smith", "AB1 2C"), ("rob", "Smyth", "ab12c"), ("Bob", "Jones", "X"), (None, "Smith", "AB12C")], "f string, l string, z string")
    keys = [r[0] for r in df.select(loose_name_key(F.col("f"), F.col("l"), F.col("z"), PARAMS)).collect()]
    assert keys[0] == keys[1] != keys[2] and keys[3] is None


def test_refund_rules(spark):
    df = spark.createDataFrame([("Item BROKEN and wrong",), ("changed mind",), (None,), ("too late",)], "n string")
    assert [r[0] for r in df.select(C.refund_category(F.col("n"))).collect()] == ["damaged", "customer_change_of_mind", "other", "late_delivery"]
    amounts = spark.createDataFrame([(10.0, 10.005), (5.0, 10.0), (5.0, None)], "a double, b double")
    assert [r[0] for r in amounts.select(C.refund_type(F.col("a"), F.col("b"))).collect()] == ["full_refund", "partial_refund", "partial_refund"]


def test_unknown_status_is_not_counted(spark):
    df = spark.createDataFrame([("paid",), ("cancelled",), (None,)], "s string")
    assert df.filter(C.not_cancelled(F.col("s"))).count() == 1


# ---- Calendar -----------------------------------------------------------------------------
def test_calendar(spark):
    cal = dims.dim_date(spark, PARAMS, us_holidays(spark, 2024, 2026)).cache()
    assert cal.count() == 6209
    day = lambda d: cal.filter(F.col("date_actual") == F.lit(d)).first()
    leap = day(date(2024, 2, 29))
    assert leap.prior_year_date_actual == date(2023, 2, 28) and leap.prior_year_date_sk == 20230228
    assert day(date(2027, 1, 3)).week_of_year == 53 and day(date(2024, 12, 30)).week_of_year == 1
    assert day(date(2025, 11, 27)).holiday_name == "Thanksgiving Day" and not day(date(2025, 11, 27)).is_business_day
    assert day(date(2026, 5, 25)).holiday_name == "Memorial Day"
    assert day(date(2026, 8, 15)).is_today and day(date(2026, 8, 9)).is_last_7_days and not day(date(2026, 8, 8)).is_last_7_days
    short = dims.dim_date(spark, Params(as_of=date(2026, 8, 15), pii_salt="s", calendar_end_inclusive=False))
    assert short.count() == 6208


def test_fiscal_start(spark):
    df = spark.createDataFrame([(date(2024, 6, 30),), (date(2024, 7, 1),)], "d date")
    out = df.select(dims.fiscal_year(F.col("d"), 7), dims.fiscal_month(F.col("d"), 7), dims.fiscal_year(F.col("d"), 1)).collect()
    assert [tuple(r) for r in out] == [(2024, 12, 2024), (2025, 1, 2024)]


# ---- Quality ------------------------------------------------------------------------------
def test_checks(spark):
    df = spark.createDataFrame([(1, "a", date(2026, 8, 14)), (1, "z", None), (None, None, None)], "k int, v string, d date")
    parent = spark.createDataFrame([("a",), (None,)], "v string")
    checks = [Q.not_null("k"), Q.accepted_values("v", ("a",)), Q.accepted_range("d", "2026-01-01", "2026-08-01"), Q.expression_is_true("k_pos", "k > 1", "warn"),
              Q.unique("k"), Q.foreign_key("v", "parent", "v"), Q.recency("d", 1), Q.recency("d", 0)]
    out = {r.check_name: (r.failures, r.status) for r in Q.run_checks("t", df, checks, PARAMS, {"parent": parent}).collect()}
    assert out == {"not_null_k": (1, "fail"), "accepted_values_v": (1, "fail"), "accepted_range_d": (1, "fail"), "k_pos": (2, "warn"), "unique_k": (1, "fail"),
                   "relationship_v_parent": (1, "fail"), "recency_d_1d": (0, "pass"), "recency_d_0d": (1, "warn")}
    assert Q.failing_rows(df, checks[5], {"parent": parent}, PARAMS).first().v == "z"


def test_freshness(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),)], "at timestamp")
    status = lambda now: Q.freshness(df, "t", "at", 6, 24, F.lit(now)).first().status
    assert [status("2024-01-01 06:00:00"), status("2024-01-01 07:00:00"), status("2024-01-02 01:00:00")] == ["pass", "warn", "error"]
    assert Q.freshness(df.limit(0), "t", "at", 6, 24, F.lit("2024-01-01")).first().status == "error"


def test_expected_values(spark):
    actual = spark.createDataFrame([("a", 100.0), ("b", 101.0)], "metric string, value double")
    expected = spark.createDataFrame([("a", 100.0, 0.0), ("b", 100.0, 1.0), ("c", 1.0, 0.0)], "metric string, expected double, tolerance_pct double")
    assert rows(Q.expected_values(actual, expected).select("metric", "passed"), "metric") == [("a", True), ("b", True), ("c", False)]


def test_empty_rates_do_not_fail(spark):
    events = spark.createDataFrame([], "event_type string")
    assert kpis.email_engagement(events).first().engagement_rate == 0.0


def test_large_point_in_time_join(spark):
    """One key with a third of all facts and many versions; gaps, open ends, versions and facts at one instant, facts without key or time."""
    rng = random.Random(5)
    day = datetime(2024, 1, 1)
    versions, facts = [], []
    for k in ["hot", *map(str, range(8))]:
        at = day + timedelta(hours=rng.randrange(500))
        for i in range(300 if k == "hot" else rng.randrange(4)):
            end = at + timedelta(hours=rng.randrange(1, 60))
            last = rng.random() < 0.1
            versions.append((k, at, None if last else end, f"{k}v{i}"))
            if last and k != "hot":
                break
            at = end + timedelta(hours=rng.choice([0, 0, 0, 30]))
    versions = [(k, a, e if e is not None or k != "hot" else a + timedelta(hours=1), n) for k, a, e, n in versions]
    for i in range(900):
        k = "hot" if i % 3 == 0 else rng.choice([*map(str, range(9)), None])
        at = rng.choice([v[1] for v in versions]) if rng.random() < 0.2 else day + timedelta(hours=rng.randrange(9000))
        facts.append((i, k, None if rng.random() < 0.02 else at, "x"))
    f = spark.createDataFrame(facts, "i int, k string, at timestamp, note string")
    v = spark.createDataFrame(versions, "key string, valid_from timestamp, valid_to timestamp, name string")
    given = {"fact_key": "k", "version_key": "key", "at": "at", "take": {"name": "version"}}
    large = point_in_time_join_large(f, v, **given)
    assert large.columns == [*f.columns, "version"]
    plain = {r.i: r.version for r in point_in_time_join(f, v, **given).collect()}
    got = [tuple(r) for r in large.collect()]
    assert sorted(r[:4] for r in got) == sorted(facts) and {r[0]: r[4] for r in got} == plain and len(set(plain.values())) > 100
    assert point_in_time_join_large(f.limit(0), v, **given).count() == 0
    assert {r.version for r in point_in_time_join_large(f, v.limit(0), **given).collect()} == {None}
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan
