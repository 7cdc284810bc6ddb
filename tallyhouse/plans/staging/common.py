"""Shared projection helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.keys import with_audit
from tallyhouse.params import Params

MONEY = "decimal(18,6)"


def text(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def stamp(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp")


def money(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(MONEY)


def flag(col: Column | str, default: bool | None = None) -> Column:
    col = (F.col(col) if isinstance(col, str) else col).cast("boolean")
    return col if default is None else F.coalesce(col, F.lit(default))


def cents(col: Column | str) -> Column:
    """Minor units to money; the division by 100 is exact at scale 6."""
    return (money(col) / 100).cast(MONEY)


def epoch(col: Column | str) -> Column:
    return F.timestamp_seconds(F.col(col) if isinstance(col, str) else col)


def project(
    raw: DataFrame, cols: dict[str, Column], params: Params, *, table: str, record_id: Column | str,
    business: list[str], extracted_at: Column,
) -> DataFrame:
    """Select the staged columns and append the audit footer."""
    system, name = table.split(".")
    staged = raw.select(*[c.alias(n) for n, c in cols.items()], extracted_at.alias("_extracted"))
    audited = with_audit(
        staged, params, model=f"stg_{system}__{name}", source_system=system, record_id=record_id,
        business_columns=business, extracted_at="_extracted",
    )
    return audited.drop("_extracted")
