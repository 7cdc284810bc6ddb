"""Currency conversion against a table of dated rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.intervals import to_intervals

RATE = "decimal(18,8)"


def rate_intervals(rates: DataFrame, reporting_currency: str) -> DataFrame:
    """Rates into the reporting currency with the days each one is valid."""
    into = rates.filter(F.col("to_currency") == reporting_currency).select(
        "from_currency", "to_currency", F.col("rate_date").cast("date").alias("rate_date"), F.col("rate").cast(RATE).alias("rate")
    )
    return to_intervals(into, ["from_currency", "to_currency"], "rate_date").select(
        "from_currency", "valid_from", "valid_to", "rate"
    )


def with_fx_rate(
    facts: DataFrame, rates: DataFrame, *, currency: str, on: str, reporting_currency: str, out: str = "fx_rate"
) -> DataFrame:
    """Attach the rate valid on the given day.

    Closed intervals become one row per (currency, day) and the open last interval one row per
    currency, so each fact does two hash probes instead of testing every interval of its
    currency. The table of days holds currencies x days of rate history; whether it is broadcast
    is left to the planner's statistics. The reporting currency itself is 1; anything else unknown is NULL.
    """
    spans = rate_intervals(rates, reporting_currency)
    daily = spans.filter(F.col("valid_to") > F.col("valid_from")).select(
        F.col("from_currency").alias("_cur_d"),
        F.explode(F.sequence("valid_from", F.date_sub("valid_to", 1))).alias("_day"),
        F.col("rate").alias("_daily_rate"),
    )
    latest = spans.filter(F.col("valid_to").isNull()).select(
        F.col("from_currency").alias("_cur_l"), F.col("valid_from").alias("_from"), F.col("rate").alias("_last_rate")
    )
    code = F.upper(F.col(currency))
    joined = (
        facts.withColumns({"_code": code, "_on": F.col(on).cast("date")})
        .join(daily, (F.col("_code") == F.col("_cur_d")) & (F.col("_on") == F.col("_day")), "left")
        .join(latest, (F.col("_code") == F.col("_cur_l")) & (F.col("_on") >= F.col("_from")), "left")
    )
    same = F.when(F.col("_code") == reporting_currency, F.lit(1).cast(RATE))
    return joined.withColumn(out, F.coalesce("_daily_rate", "_last_rate", same).cast(RATE)).drop(
        "_code", "_on", "_cur_d", "_day", "_daily_rate", "_cur_l", "_from", "_last_rate"
    )
