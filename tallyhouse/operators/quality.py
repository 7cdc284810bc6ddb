"""Declarative data-quality checks.

A check is a small dataclass. ``run_checks`` folds all row-level checks of a table into one
aggregation (a single scan) and adds one grouped query per key and one anti join per foreign
key. Each result row holds the number of failing rows; ``failing_rows`` returns them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyhouse.functions.keys import packed, unpacked
from tallyhouse.params import Params

RESULT = ("table_name", "check_name", "severity", "failures", "status")


@dataclass(frozen=True)
class Check:
    name: str
    severity: str = "error"


@dataclass(frozen=True)
class RowCheck(Check):
    """Fails on rows for which the SQL condition ``broken`` is true; NULL is no failure.

    ``condition`` makes the same as a column where the text would not do, as with words that need quotes.
    """

    broken: str = "false"
    condition: Callable[[], Column] | None = field(default=None, compare=False)

    @property
    def bad(self) -> Column:
        return F.expr(self.broken) if self.condition is None else self.condition()


@dataclass(frozen=True)
class Unique(Check):
    keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class ForeignKey(Check):
    column: str = ""
    parent: str = ""
    parent_column: str = ""


@dataclass(frozen=True)
class Recent(Check):
    column: str = ""
    days: int = 1


def not_null(col: str, severity: str = "error") -> RowCheck:
    return RowCheck(f"not_null_{col}", severity, f"{col} is null", lambda: F.col(col).isNull())


def accepted_values(col: str, values: Sequence[str], severity: str = "error") -> RowCheck:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return RowCheck(f"accepted_values_{col}", severity, f"{col} not in ({listed})", lambda: ~F.col(col).isin(*values))


def accepted_range(col: str, low: object, high: object, severity: str = "error") -> RowCheck:
    kind = lambda v: F.lit(v).cast("date") if isinstance(v, str) else F.lit(v)
    text = lambda v: f"date '{v}'" if isinstance(v, str) else str(v)
    return RowCheck(f"accepted_range_{col}", severity, f"{col} not between {text(low)} and {text(high)}", lambda: ~F.col(col).between(kind(low), kind(high)))


def expression_is_true(name: str, expression: str, severity: str = "error") -> RowCheck:
    return RowCheck(name, severity, f"not ({expression})")


def unique(*keys: str, severity: str = "error") -> Unique:
    return Unique(f"unique_{'_'.join(keys)}", severity, keys)


def foreign_key(col: str, parent: str, parent_column: str, severity: str = "error") -> ForeignKey:
    return ForeignKey(f"relationship_{col}_{parent}", severity, col, parent, parent_column)


def recency(col: str, days: int, severity: str = "warn") -> Recent:
    return Recent(f"recency_{col}_{days}d", severity, col, days)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row; NULL keys are not compared. Text goes to the others of its kind as bytes."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    rows = df.filter(present).groupBy(*[(packed(k) if k in text else F.col(k)).alias(k) for k in keys]).agg(F.count("*").alias("n_rows"))
    return rows.filter("n_rows > 1").select(*[unpacked(k).alias(k) if k in text else F.col(k) for k in keys], "n_rows")


def orphans(df: DataFrame, col: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-NULL reference has no parent."""
    refs = parent.select(F.col(parent_column).alias("_ref")).filter(F.col("_ref").isNotNull())
    return df.filter(F.col(col).isNotNull()).join(refs, F.col(col) == F.col("_ref"), "left_anti")


def failing_rows(df: DataFrame, check: Check, parents: Mapping[str, DataFrame], params: Params) -> DataFrame:
    """The rows (or keys, or the stale maximum) that break one check."""
    if isinstance(check, RowCheck):
        return df.filter(check.bad)
    if isinstance(check, Unique):
        return duplicate_keys(df, check.keys)
    if isinstance(check, ForeignKey):
        return orphans(df, check.column, parents[check.parent], check.parent_column)
    if isinstance(check, Recent):
        newest = df.agg(F.max(F.col(check.column).cast("date")).alias("newest"))
        floor = F.date_sub(F.lit(params.as_of), check.days)
        return newest.filter(F.col("newest").isNull() | (F.col("newest") < floor))
    raise TypeError(f"unknown check: {check!r}")


def _as_result(failures: DataFrame, table: str, check: Check) -> DataFrame:
    bad = F.col("failures") > 0
    return failures.select(
        F.lit(table).alias("table_name"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        F.col("failures").cast("long").alias("failures"),
        F.when(bad, F.lit("fail" if check.severity == "error" else "warn")).otherwise(F.lit("pass")).alias("status"),
    )


class Watched:
    """Row and recency checks that ride along with the write of a model, so that they cost no scan.

    The model's frame is watched by an ``Observation``; once it is written, ``results`` has a row per
    check. Keys and references need a shuffle of their own: ``run_checks`` on the stored table.
    """

    def __init__(self, table: str, checks: Sequence[Check], params: Params) -> None:
        self.table, self.params = table, params
        self.checks = [c for c in checks if isinstance(c, (RowCheck, Recent))]
        self.observation = Observation(f"checks of {table}")

    def attach(self, df: DataFrame) -> DataFrame:
        if not self.checks:
            return df
        measures = [F.count_if(c.bad) if isinstance(c, RowCheck) else F.max(F.col(c.column).cast("date")) for c in self.checks]
        return df.observe(self.observation, *[m.alias(f"m{i}") for i, m in enumerate(measures)])

    def results(self) -> list[tuple]:
        """Rows in the layout of ``RESULT``; blocks until the frame has been written."""
        seen = self.observation.get if self.checks else {}
        out = []
        for i, c in enumerate(self.checks):
            value = seen.get(f"m{i}")
            stale = isinstance(c, Recent) and (value is None or value < self.params.as_of - timedelta(days=c.days))
            failures = int(stale) if isinstance(c, Recent) else int(value or 0)
            out.append((self.table, c.name, c.severity, failures, "pass" if not failures else "fail" if c.severity == "error" else "warn"))
        return out


def run_checks(
    table: str, df: DataFrame, checks: Sequence[Check], params: Params, parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One result row per check."""
    parents = parents or {}
    row_checks = [c for c in checks if isinstance(c, RowCheck)]
    recent = [c for c in checks if isinstance(c, Recent)]
    parts = []
    if row_checks or recent:
        floor = lambda c: F.date_sub(F.lit(params.as_of), c.days)
        newest = lambda c: F.max(F.col(c.column).cast("date"))
        measures = [F.count_if(c.bad).alias(f"m{i}") for i, c in enumerate(row_checks)]
        measures += [
            F.when(newest(c).isNull() | (newest(c) < floor(c)), 1).otherwise(0).cast("long").alias(f"m{len(row_checks) + i}")
            for i, c in enumerate(recent)
        ]
        scanned = [*row_checks, *recent]
        rows = F.array(
            *[
                F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.col(f"m{i}").alias("failures"))
                for i, c in enumerate(scanned)
            ]
        )
        flat = df.agg(*measures).select(F.inline(rows))
        verdict = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "error", "fail").otherwise("warn")
        parts.append(flat.select(F.lit(table).alias("table_name"), "check_name", "severity", "failures", verdict.alias("status")))
    for check in checks:
        if isinstance(check, Unique):
            bad = failing_rows(df, check, parents, params).agg(F.count("*").alias("failures"))
            parts.append(_as_result(bad, table, check))
        if isinstance(check, ForeignKey):  # rows of one reference are added up before they are sent to its parent
            refs = df.groupBy(check.column).agg(F.count("*").alias("n_rows"))
            bad = failing_rows(refs, check, parents, params).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("failures"))
            parts.append(_as_result(bad, table, check))
    return reduce(DataFrame.unionByName, parts)


def quarantine(
    df: DataFrame, table: str, checks: Sequence[Check], params: Params, parents: Mapping[str, DataFrame], schema: str
) -> list[str]:
    """Store what fails; returns the table names.

    Rows that break a condition or a reference go to one table, ``<table>__rows``, once for each
    check they break: the data is read once and written once, in a folder per check. Keys held
    more than once and stale maxima have other columns and a small table each.
    """
    names, tagged, broken = [], df, []
    for i, check in enumerate(checks):
        if isinstance(check, RowCheck):
            broken.append(F.when(check.bad, F.lit(check.name)))
        elif isinstance(check, ForeignKey):
            refs = parents[check.parent].select(F.col(check.parent_column).alias(f"_ref{i}")).distinct()
            tagged = tagged.join(refs, F.col(check.column) == F.col(f"_ref{i}"), "left")
            broken.append(F.when(F.col(check.column).isNotNull() & F.col(f"_ref{i}").isNull(), F.lit(check.name)))
        else:
            names.append(f"{schema}.{table}__{check.name}")
            failing_rows(df, check, parents, params).write.mode("overwrite").format("parquet").saveAsTable(names[-1])
    if broken:
        rows = tagged.select(*df.columns, F.explode(F.array_compact(F.array(*broken))).alias("check_name"))
        names.append(f"{schema}.{table}__rows")
        rows.write.mode("overwrite").format("parquet").partitionBy("check_name").saveAsTable(names[-1])
    return names


def freshness(df: DataFrame, table: str, loaded_at: str, warn_hours: int, error_hours: int | None, now: Column) -> DataFrame:
    """Age of the newest row against the warn and error limits, in hours."""
    newest = df.agg(F.max(F.col(loaded_at).cast("timestamp")).alias("newest"))
    age = (F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp("newest")) / 3600.0
    error = F.lit(False) if error_hours is None else (age > error_hours)
    status = F.when(F.col("newest").isNull() | error, "error").when(age > warn_hours, "warn").otherwise("pass")
    return newest.select(F.lit(table).alias("table_name"), "newest", age.alias("age_hours"), status.alias("status"))


def expected_values(actual: DataFrame, expected: DataFrame, tolerance_pct: str = "tolerance_pct") -> DataFrame:
    """(metric, value) pairs against (metric, expected, tolerance): exact at 0, else percent off."""
    pct_off = F.abs(F.col("value") - F.col("expected")) / F.greatest(F.abs("expected"), F.lit(1e-9)) * 100
    ok = F.when(F.col(tolerance_pct) == 0, F.col("value") == F.col("expected")).otherwise(pct_off <= F.col(tolerance_pct))
    return expected.join(actual, "metric", "left").select(
        "metric", "value", "expected", pct_off.alias("pct_off"), F.coalesce(ok, F.lit(False)).alias("passed")
    )


# ---- Business rules -----------------------------------------------------------------------
def monetary_imbalance(orders: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Orders whose net differs from gross - discount + tax + shipping + tip by more than allowed."""
    parts = F.col("gross_amount") - F.col("discount_amount") + F.col("tax_amount") + F.col("shipping_amount") + F.col("tip_amount")
    gap = F.abs(F.col("net_amount") - parts)
    return orders.select("order_id", "net_amount", parts.alias("computed_net"), gap.alias("discrepancy")).filter(
        F.col("discrepancy") > tolerance
    )


def wrong_sign_movements(movements: DataFrame) -> DataFrame:
    """Sales that add stock and returns that remove it."""
    qty = F.col("quantity_change")
    bad = ((F.col("movement_type") == "sale") & (qty >= 0)) | ((F.col("movement_type") == "return") & (qty <= 0))
    return movements.filter(bad).select("movement_id", "movement_type", "quantity_change")


def orders_without_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders that claim lines but have none in the line fact."""
    return orders.filter("line_item_count > 0").join(lines.select("order_id"), "order_id", "left_anti").select("order_id")


def refunds_without_orders(refunds: DataFrame, orders: DataFrame) -> DataFrame:
    return refunds.join(orders.select("order_id"), "order_id", "left_anti").select("refund_id")
