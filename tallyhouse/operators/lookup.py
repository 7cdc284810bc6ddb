"""Reference lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WILDCARD = "*"


def lookup_with_wildcard(
    facts: DataFrame, mapping: DataFrame, *, fact_key: str, map_key: str, value: str, out: str
) -> DataFrame:
    """Exact match on the key, else the mapping's ``*`` row, else NULL.

    ``mapping`` must be unique on its key; the wildcard is one scalar, read once. The mapping is grouped
    by its key, so that the optimizer drops the lookup, and what its key is made of, where nothing reads it.
    """
    exact = mapping.filter(F.col(map_key) != WILDCARD).groupBy(F.col(map_key).alias("_mk")).agg(F.max(value).alias("_exact"))
    fallback = mapping.filter(F.col(map_key) == WILDCARD).agg(F.max(value)).scalar()
    return (
        facts.join(exact, F.col(fact_key) == F.col("_mk"), "left")
        .withColumn(out, F.coalesce("_exact", fallback))
        .drop("_mk", "_exact")
    )


def join_known(facts: DataFrame, other: DataFrame, key: str, spread: str) -> DataFrame:
    """Left join on ``key``, which much of ``facts`` may lack.

    Rows without the key would all hash to one task. They go by ``spread``, a column of many values,
    instead, and meet nothing: whether the key is there is part of the join.
    """
    here = facts.withColumns({"_by": F.coalesce(F.col(key).cast("string"), F.col(spread).cast("string")), "_has": F.col(key).isNotNull()})
    there = other.filter(F.col(key).isNotNull()).withColumnRenamed(key, "_there")
    return here.join(there, (F.col("_by") == F.col("_there").cast("string")) & F.col("_has"), "left").drop("_by", "_has", "_there")


def country_level(geography: DataFrame) -> DataFrame:
    """Only the whole-country rows of the geography dimension."""
    return geography.filter(F.col("state_or_region_code").isNull())


def override_channels(df: DataFrame, overrides: DataFrame, source: str, medium: str, out: str = "channel_id") -> DataFrame:
    """Set the channel for listed (source, medium) pairs, keep it elsewhere."""
    rules = overrides.select(F.col("source").alias("_s"), F.col("medium").alias("_m"), F.col("canonical_channel").alias("_c"))
    on = (F.lower(F.col(source)) == F.lower("_s")) & (F.lower(F.col(medium)) == F.lower("_m"))
    return df.join(rules, on, "left").withColumn(out, F.coalesce("_c", F.col(out))).drop("_s", "_m", "_c")
