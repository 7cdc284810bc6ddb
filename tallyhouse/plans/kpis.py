"""Headline KPIs as one-row or per-period frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.plans.marts import countable


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """part / whole * scale as a double; NULL when the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * scale


def sales_kpis(orders: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """GMV, net revenue, order count, average order value and tax, in total or per key."""
    gmv = F.sum("gross_amount")
    return countable(orders).groupBy(*keys).agg(
        gmv.alias("gmv"),
        F.sum(F.col("gross_amount") - F.col("discount_amount") - F.col("refunded_amount")).alias("net_revenue"),
        F.count("*").alias("order_count"),
        ratio(gmv, F.count("*")).alias("aov"),
        F.sum("tax_amount").alias("tax_collected"),
    )


def discounted_gmv(orders: DataFrame) -> DataFrame:
    """GMV in the raw-data reading: subtotal less discounts over non-voided, non-test orders."""
    kept = orders.filter((F.col("financial_status") != "voided") & ~F.col("is_test_order"))
    total = F.sum(F.col("gross_amount") - F.col("discount_amount"))
    return kept.agg(total.alias("gmv"), F.count("*").alias("order_count"), ratio(total, F.count("*")).alias("aov"))


def customers_by_order_count(orders: DataFrame, customer: str = "customer_id") -> DataFrame:
    """New (exactly one order), repeat (two or more) and the repeat rate over the whole data set."""
    counts = orders.filter(F.col(customer).isNotNull()).groupBy(customer).agg(F.count("*").alias("n"))
    repeat = F.count_if(F.col("n") > 1)
    return counts.agg(
        F.count_if(F.col("n") == 1).alias("new_customers"),
        repeat.alias("repeat_customers"),
        ratio(repeat, F.count("*"), 100.0).alias("repeat_purchase_rate"),
    )


def repeat_rate(sales: DataFrame) -> DataFrame:
    """Repeat share per mart row: repeat / (new + repeat)."""
    return sales.withColumn(
        "repeat_purchase_rate", ratio(F.col("repeat_customers"), F.col("new_customers") + F.col("repeat_customers"))
    )


def revenue_growth(sales: DataFrame, period: str, revenue: str = "net_revenue") -> DataFrame:
    """Revenue per calendar period and its percent change on the period before.

    The window runs over the periods only, after aggregation.
    """
    per = sales.groupBy(F.trunc("order_date", period).alias("period")).agg(F.sum(revenue).alias("revenue"))
    prev = F.lag("revenue").over(W.orderBy("period"))
    return per.select("period", "revenue", prev.alias("prev_revenue")).withColumn(
        "growth_pct", ratio(F.col("revenue") - F.col("prev_revenue"), F.col("prev_revenue"), 100.0)
    )


def email_engagement(events: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(opened + clicked) / delivered, in percent."""
    n = lambda kind: F.count_if(F.col("event_type") == kind)
    return events.groupBy(*keys).agg(
        n("delivered").alias("delivered"), n("opened").alias("opened"), n("clicked").alias("clicked"),
        F.coalesce(ratio(n("opened") + n("clicked"), n("delivered"), 100.0), F.lit(0.0)).alias("engagement_rate"),
    )


def inventory_kpis(snapshot: DataFrame) -> DataFrame:
    """Stock value and stock-out rate per snapshot day; never add these up over days."""
    return snapshot.groupBy("snapshot_date").agg(
        F.sum("inventory_value").alias("inventory_value"),
        F.count("*").alias("positions"),
        F.count_if("is_out_of_stock").alias("out_of_stock"),
        ratio(F.count_if("is_out_of_stock"), F.count("*"), 100.0).alias("stockout_rate"),
    )


def sku_stockout_rate(feed: DataFrame) -> DataFrame:
    """Share of items with no stock anywhere they are counted, on the last day of the feed."""
    last = feed.agg(F.max("snapshot_date")).scalar()
    per_item = feed.filter(F.col("snapshot_date") == last).groupBy("inventory_item_id").agg(
        F.bool_or(F.coalesce(F.col("quantity_available") <= 0, F.lit(False))).alias("oos")
    )
    return per_item.agg(
        F.count("*").alias("sku_total"), F.count_if("oos").alias("sku_oos"),
        ratio(F.count_if("oos"), F.count("*"), 100.0).alias("stockout_rate"),
    )


def total_ad_spend(spend: DataFrame, column: str = "spend_amount") -> DataFrame:
    return spend.agg(F.sum(column).alias("total_spend"))


def source_distribution(orders: DataFrame, column: str = "utm_source", default: str = "(direct)") -> DataFrame:
    """Orders per traffic source and their share of all orders."""
    counts = orders.groupBy(F.coalesce(column, F.lit(default)).alias("source")).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", ratio(F.col("n"), counts.agg(F.sum("n")).scalar(), 100.0))


def peak_day(orders: DataFrame, day: str = "order_date") -> DataFrame:
    """Day with the most orders; the earliest one on a tie."""
    daily = orders.groupBy(F.col(day).alias("day")).agg(F.count("*").alias("n"))
    return daily.agg(F.max_by("day", F.struct("n", -F.unix_date("day"))).alias("peak_date"), F.max("n").alias("peak_orders"))


def month_multiplier(orders: DataFrame, month: int, baseline: tuple[int, ...], day: str = "order_date") -> DataFrame:
    """Orders in one calendar month against the mean of the baseline months."""
    m = F.month(day)
    base = F.count_if(m.isin(*baseline)) / F.lit(float(len(baseline)))
    return orders.agg(
        F.count_if(m == month).alias("month_orders"), base.alias("baseline_avg"),
        ratio(F.count_if(m == month), base).alias("multiplier"),
    )


def stockout_skus(feed: DataFrame, first: str, last: str) -> DataFrame:
    """Items out of stock at some time within a date range."""
    hit = feed.filter(F.col("snapshot_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")) & (F.col("quantity_available") <= 0))
    return hit.select("inventory_item_id").distinct().agg(F.count("*").alias("stockout_skus"))


def customer_order_stats(customers: DataFrame, orders: DataFrame, paid: tuple[str, ...] = ("paid", "partially_refunded", "refunded")) -> DataFrame:
    """Order count, spend and last order time written back to the customer rows."""
    stats = orders.filter(F.col("financial_status").isin(*paid)).groupBy("customer_id").agg(
        F.count("*").alias("_n"), F.sum("total_price").alias("_spent"), F.max("created_at").alias("_last")
    )
    return customers.join(stats.withColumnRenamed("customer_id", "_cid"), F.col("id") == F.col("_cid"), "left").withColumns({
        "orders_count": F.coalesce("_n", F.lit(0)),
        "total_spent": F.coalesce("_spent", F.lit(0)).cast("decimal(18,6)"),
        "updated_at": F.coalesce("_last", "updated_at"),
    }).drop("_cid", "_n", "_spent", "_last")


def variant_velocity(lines: DataFrame, orders: DataFrame, period_days: int) -> DataFrame:
    """Units sold per variant and their average per day of the period."""
    sold = lines.select("order_id", "variant_id", "quantity").join(orders.select("order_id"), "order_id", "left_semi")
    return sold.groupBy("variant_id").agg(
        F.sum("quantity").alias("units"), ratio(F.sum("quantity"), F.lit(period_days)).alias("daily_velocity")
    )
