"""KPI marts: aggregate first, then attach dimension attributes to the small result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.functions import classify as C
from tallyhouse.functions.keys import date_key, surrogate_key, with_audit
from tallyhouse.params import Params

DAILY_SALES_KEYS = ("order_date", "channel_sk", "geography_sk")
# What daily sales read of orders.
READ_BY_SALES = (*DAILY_SALES_KEYS, "customer_sk", "order_status", "is_test_order", "gross_amount", "discount_amount", "refunded_amount", "tax_amount",
                 "shipping_amount", "is_first_order", "is_repeat_order")


def countable(orders: DataFrame) -> DataFrame:
    """Orders that count for sales KPIs: neither cancelled (nor without status) nor tests."""
    return orders.filter(C.not_cancelled(F.col("order_status")) & ~F.col("is_test_order"))


def daily_sales(orders: DataFrame, keys: tuple[str, ...] = DAILY_SALES_KEYS, customer: str = "customer_sk") -> DataFrame:
    """Sales KPIs per day, channel and country.

    Distinct customers are counted in two grouped steps: first per customer within the group,
    where flags become maxima, then per group as plain sums. Orders are unique by id, so their
    count is a sum too. The unknown customer adds to amounts and never to customer counts.
    """
    flag = lambda c: F.max(F.col(c).cast("int"))
    per_customer = countable(orders).groupBy(*keys, customer).agg(
        F.sum("gross_amount").alias("gross"),
        F.sum("discount_amount").alias("discount"),
        F.sum("refunded_amount").alias("refunded"),
        F.sum("tax_amount").alias("tax"),
        F.sum("shipping_amount").alias("shipping"),
        F.count("*").alias("orders"),
        flag("is_first_order").alias("first"),
        flag("is_repeat_order").alias("repeat"),
    )
    known = F.col(customer).isNotNull()
    return per_customer.groupBy(*keys).agg(
        F.sum("gross").alias("gmv"),
        F.sum(F.col("gross") - F.col("discount") - F.col("refunded")).alias("net_revenue"),
        F.sum("orders").alias("order_count"),
        F.sum("tax").alias("tax_collected"),
        F.count_if(known & (F.col("first") == 1)).alias("new_customers"),
        F.count_if(known & (F.col("repeat") == 1)).alias("repeat_customers"),
        F.count_if(known).alias("unique_customers"),
        F.sum("discount").alias("total_discounts"),
        F.sum("shipping").alias("shipping_revenue"),
        F.sum("refunded").alias("total_refunds"),
    )


def _with_date(df: DataFrame, day: str, dim_date: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    attrs = dim_date.select(F.col("date_sk").alias("_dsk"), "date_sk", *cols)
    return df.join(attrs, date_key(day) == F.col("_dsk"), "left").drop("_dsk")


def _blank(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit("null"))


def mart_sales(
    orders: DataFrame, dim_date: DataFrame, dim_channel: DataFrame, dim_geography: DataFrame, params: Params
) -> DataFrame:
    """Sales KPIs with date, channel and country attributes."""
    dates = ("week_starting_date", "week_of_year", "month_number", "month_name", "month_short_name", "quarter_number",
             "quarter_name", "year", "is_weekend", "is_business_day", "is_holiday", "is_mtd", "is_qtd", "is_ytd")
    channel = ("channel_name", "channel_category", "channel_type", "is_paid")
    place = ("country_code", "country_name", "country_region")
    df = _with_date(daily_sales(orders), "order_date", dim_date, dates)
    df = df.join(dim_channel.select("channel_sk", *channel), "channel_sk", "left")
    df = df.join(dim_geography.select("geography_sk", *place), "geography_sk", "left")
    out = df.select(
        surrogate_key(list(DAILY_SALES_KEYS)).alias("mart_sales_sk"), "order_date", "date_sk", *dates, "channel_sk", *channel,
        "geography_sk", *place, "gmv", "net_revenue", "order_count", "tax_collected", "new_customers", "repeat_customers",
        "unique_customers", "total_discounts", "shipping_revenue", "total_refunds",
        F.lit(params.as_of).cast("timestamp").alias("loaded_at"),
    )
    return with_audit(out, params, model="mart_sales", source_system="shopify",
                      record_id=F.concat_ws("|", F.col("order_date").cast("string"), _blank("channel_sk"), _blank("geography_sk")),
                      business_columns=list(DAILY_SALES_KEYS), extracted_at=F.lit(params.as_of))


def daily_customer_state(state: DataFrame) -> DataFrame:
    """Customer KPIs per snapshot. The fact holds a customer once per snapshot, so flags just add up."""
    return state.groupBy("snapshot_date").agg(
        F.count_if("is_active_30d").alias("active_customers_30d"),
        F.count_if("is_active_90d").alias("active_customers_90d"),
        F.count("customer_id").alias("total_tracked_customers"),
        F.count_if("is_new_30d").alias("new_in_30d_window"),
        F.count_if("is_repeat_customer").alias("repeat_customers"),
        F.avg("lifetime_revenue").alias("avg_lifetime_revenue"),
        F.avg("lifetime_order_count").alias("avg_lifetime_orders"),
        F.sum("trailing_30d_revenue").alias("total_trailing_30d_revenue"),
        F.sum("trailing_90d_revenue").alias("total_trailing_90d_revenue"),
    )


def swept_customer_state(daily: DataFrame, people: DataFrame, days: DataFrame) -> DataFrame:
    """``daily_customer_state`` for a list of days, from changes instead of customers times days.

    ``daily`` holds a customer's orders per day (``n``, ``rev``), ``people`` the tracked customers and
    since when (``acquired``, NULL for always). A customer changes a KPI on few days: it is tracked from
    acquisition, active from an order until 30 or 90 days after the last one, a repeat customer from
    the second order. These changes are added up per day, and running sums give every snapshot.
    """
    start = F.coalesce("acquired", F.lit("0001-01-01").cast("date"))
    own = daily.join(people.select("customer_id", start.alias("start")), "customer_id")
    line = W.partitionBy("customer_id").orderBy("order_date")
    day = F.col("order_date")
    placed = own.select(
        "*", F.lag("order_date").over(line).alias("prev"), F.lead("order_date").over(line).alias("next"),
        F.sum("n").over(line.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("so_far"))
    names, none = ("active_30", "active_90", "tracked", "fresh", "loyal", "orders", "revenue", "rev_30", "rev_90"), F.lit(0)
    kind = {c: "decimal(38,4)" if c.startswith("rev") else "bigint" for c in names}

    def change(at: Column, when: Column, **values: Column) -> Column:
        """An array of one change on a day, or of none."""
        row = F.struct(at.alias("at"), *[values.get(c, none).cast(kind[c]).alias(c) for c in names])
        return F.filter(F.array(row), lambda _: when)

    changes = [
        # An order counts from its day, or from acquisition where that comes later.
        change(F.greatest(day, "start"), F.lit(True), orders=F.col("n"), revenue=F.col("rev")),
        change(F.greatest(day, "start"), (F.col("so_far") >= 2) & (F.col("so_far") - F.col("n") < 2), loyal=F.lit(1)),
    ]
    for span in (30, 90):
        ends, active, revenue = F.date_add(day, span), f"active_{span}", f"rev_{span}"
        seen = ends > F.col("start")
        changes += [
            change(F.greatest(day, "start"), seen, **{revenue: F.col("rev")}),
            change(ends, seen, **{revenue: -F.col("rev")}),
            # Windows that touch are one; what ends before acquisition was never seen.
            change(F.greatest(day, "start"), seen & (F.col("prev").isNull() | (day >= F.date_add("prev", span)) | (F.date_add("prev", span) <= F.col("start"))), **{active: F.lit(1)}),
            change(ends, seen & (F.col("next").isNull() | (F.col("next") >= ends)), **{active: F.lit(-1)}),
        ]
    of_orders = placed.select(F.inline(F.concat(*changes)))
    since = people.select("acquired", start.alias("start"))
    of_people = since.select(F.inline(F.concat(
        change(F.col("start"), F.lit(True), tracked=F.lit(1)),
        change(F.col("start"), F.col("acquired").isNotNull(), fresh=F.lit(1)),
        change(F.date_add("start", 31), F.col("acquired").isNotNull(), fresh=F.lit(-1)))))
    marks = days.select(F.col("snapshot_date").alias("at"), *[none.cast(kind[c]).alias(c) for c in names])
    per_day = of_orders.unionByName(of_people).groupBy("at").agg(*[F.sum(c).cast(kind[c]).alias(c) for c in names])
    # One row per calendar day with a change: what meets in one task is a calendar.
    so_far = W.orderBy("at").rangeBetween(W.unboundedPreceding, W.currentRow)
    line_of_days = per_day.withColumn("asked", F.lit(False)).unionByName(marks.withColumn("asked", F.lit(True)))
    sums = line_of_days.select("at", "asked", *[F.sum(c).over(so_far).alias(c) for c in names]).filter("asked and tracked > 0")
    return sums.select(
        F.col("at").alias("snapshot_date"), F.col("active_30").alias("active_customers_30d"), F.col("active_90").alias("active_customers_90d"),
        F.col("tracked").alias("total_tracked_customers"), F.col("fresh").alias("new_in_30d_window"), F.col("loyal").alias("repeat_customers"),
        (F.col("revenue").cast("decimal(28,4)") / F.col("tracked")).alias("avg_lifetime_revenue"), (F.col("orders") / F.col("tracked")).alias("avg_lifetime_orders"),
        F.col("rev_30").cast("decimal(38,4)").alias("total_trailing_30d_revenue"), F.col("rev_90").cast("decimal(38,4)").alias("total_trailing_90d_revenue"),
    )


def mart_customer(state: DataFrame, dim_date: DataFrame, params: Params) -> DataFrame:
    """Customer KPIs from the customer fact; counts are points in time and must not be summed over days."""
    return customer_kpis(daily_customer_state(state), dim_date, params)


def customer_kpis(by_day: DataFrame, dim_date: DataFrame, params: Params) -> DataFrame:
    """Customer KPIs per snapshot with date attributes."""
    dates = ("month_number", "month_name", "quarter_number", "quarter_name", "year", "is_mtd", "is_qtd", "is_ytd")
    df = _with_date(by_day, "snapshot_date", dim_date, dates)
    measures = ("active_customers_30d", "active_customers_90d", "total_tracked_customers", "new_in_30d_window",
                "repeat_customers", "avg_lifetime_revenue", "avg_lifetime_orders", "total_trailing_30d_revenue",
                "total_trailing_90d_revenue")
    out = df.select(surrogate_key(["snapshot_date"]).alias("mart_customer_sk"), "snapshot_date", "date_sk", *dates, *measures,
                    F.lit(params.as_of).cast("timestamp").alias("loaded_at"))
    return with_audit(out, params, model="mart_customer", source_system="generated", record_id="snapshot_date",
                      business_columns=["snapshot_date"], extracted_at=F.lit(params.as_of))


def mart_inventory(
    snapshot: DataFrame, dim_date: DataFrame, dim_product: DataFrame, dim_location: DataFrame, params: Params
) -> DataFrame:
    """Stock per item, location and day with product, location and date attributes."""
    dates = ("month_number", "month_name", "quarter_number", "year", "is_mtd", "is_ytd")
    product = dim_product.select(
        "product_sk", F.col("display_name").alias("product_display_name"), "product_title", "category", "subcategory", "vendor",
        F.col("is_active").alias("product_is_active"),
    )
    place = dim_location.select("location_sk", "location_name", "location_type", F.col("country_code").alias("location_country_code"))
    df = _with_date(snapshot, "snapshot_date", dim_date, dates).join(product, "product_sk", "left").join(place, "location_sk", "left")
    out = df.select(
        F.col("inventory_snapshot_sk").alias("mart_inventory_sk"), "snapshot_date", "date_sk", *dates, "product_sk", "sku",
        "product_display_name", "product_title", "category", "subcategory", "vendor", "product_is_active", "location_sk",
        "location_name", "location_type", "location_country_code", "quantity_available", "quantity_on_hand", "quantity_incoming",
        "unit_cost", "inventory_value", "days_of_supply", "is_out_of_stock", "is_low_stock", "is_overstock", "is_slow_mover",
        F.lit(params.as_of).cast("timestamp").alias("loaded_at"),
    )
    return with_audit(out, params, model="mart_inventory", source_system="shopify", record_id="mart_inventory_sk",
                      business_columns=["mart_inventory_sk"], extracted_at=F.lit(params.as_of))
