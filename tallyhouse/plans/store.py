"""A stored warehouse: tables of one run each, published together.

Every model of a run becomes a table of its own, named after the run. Facts keep their files by
month; a run writes only the months it touches and takes the others' folders over from the run
before. Nothing that readers see changes until all models are written: then one list of tables,
a view, is replaced, and the models' views follow it. A run that dies leaves the former run in
place; views it had not yet moved are set right when the store is opened again.

A fact's rows are replaced as a set: all rows under a touched parent (an order) or of a day in scope
leave, and the batch's rows come, so a row that is no longer made is gone.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection
from contextlib import ExitStack
from dataclasses import astuple, dataclass, fields
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.clustering import clustered, range_bounds
from tallyhouse.operators.key_summary import Part, key_ranges, key_words, may_hold
from tallyhouse.operators.stored import COMPRESSION, shuffles_dropped, staged

MONTH = "load_month"
PUBLISHED = "published"
PARTS = "value string, path string, words string, size int, low string, high string"
Scope = DataFrame | date | None


@dataclass(frozen=True)
class Merge:
    """How a fact is stored: files by the month of ``day``, rows replaced by ``parent``, laid out by ``cluster``.

    Without a parent the days themselves are replaced. ``keys`` name a row.
    """

    keys: tuple[str, ...]
    day: str
    cluster: tuple[str, ...]
    parent: str | None = None


MERGES = {
    "fact_orders": Merge(("order_id",), "order_date", ("order_date", "customer_id", "channel_sk"), "order_id"),
    "fact_order_lines": Merge(("line_item_id",), "order_date", ("order_date", "product_sk", "order_id"), "order_id"),
    "fact_refunds": Merge(("refund_id",), "refund_date", ("refund_date", "order_id"), "order_id"),
    "fact_inventory_movements": Merge(("movement_id",), "movement_date", ("movement_date", "sku", "movement_type"), "reference_order_id"),
    "fact_marketing_spend": Merge(("spend_sk",), "spend_date", ("spend_date", "campaign_sk")),
    "fact_web_sessions": Merge(("session_id",), "session_date", ("session_date", "user_pseudo_id", "channel_sk"), "session_id"),
    "int_web_sessions": Merge(("session_id",), "session_date", ("session_date", "user_pseudo_id"), "session_id"),
    "fact_email_engagement": Merge(("event_id",), "event_date", ("event_date", "event_type", "customer_sk")),
    "fact_customer_state_daily": Merge(("customer_id", "snapshot_date"), "snapshot_date", ("snapshot_date", "customer_id")),
    "fact_inventory_snapshot": Merge(("inventory_item_id", "location_id", "snapshot_date"), "snapshot_date", ("snapshot_date", "sku", "location_sk")),
}
HISTORIES = ("snap_customer", "snap_product", "snap_marketing_campaign")


def month_of(day: str):
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit("none"))


def touched_by(batch: DataFrame, merge: Merge, scope: DataFrame | None) -> DataFrame:
    """Parents, or days, whose rows a batch replaces: those in scope and its own."""
    on = merge.parent or merge.day
    own = batch.select(on)
    return (own if scope is None else scope.select(F.col(scope.columns[0]).alias(on)).union(own)).distinct()


def replace_scope(target: DataFrame, batch: DataFrame, merge: Merge, scope: Scope, touched: DataFrame | None = None) -> DataFrame:
    """``target`` without the rows in scope, plus the batch.

    Scope is a frame of touched parents (those of the batch count too), a frame of days, or the first
    day of an open range. Batch rows without a parent replace stored rows by their own keys.

    ``touched`` is ``touched_by`` where that is at hand, stored: its size then tells the planner whether
    the stored rows are to be shuffled at all. Days are few, as many as a calendar has.
    """
    if isinstance(scope, date):
        kept = target.filter((F.col(merge.day) < F.lit(scope)) | F.col(merge.day).isNull())
    else:
        on = merge.parent or merge.day
        if touched is None:
            touched = touched_by(batch, merge, scope)
        kept = target.join(touched if merge.parent else F.broadcast(touched), on, "left_anti")
    alone = batch.filter(F.col(merge.parent or merge.day).isNull())
    if not alone.isEmpty():  # a join planned in vain would still deal out the stored rows by key
        kept = kept.join(alone.select(*merge.keys).distinct(), list(merge.keys), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


class Store:
    """One run on a database of stored models: ``save`` writes a model, ``publish`` shows all of them.

    One run at a time may write. ``names`` limits what is stored; other models stay lazy.
    """

    def __init__(self, spark: SparkSession, database: str, names: Collection[str] | None = None) -> None:
        self.spark, self.database, self.names = spark, database, names
        self.run = f"run_{uuid.uuid4().hex}"
        self.location = spark.catalog.getDatabase(database).locationUri.rstrip("/")
        self.before = self._list()
        self._made: dict[str, str] = {}
        self._show(self.before)

    def _list(self) -> dict[str, str]:
        """Model to table, as last published; the tables themselves carry their run's name."""
        if not self.spark.catalog.tableExists(f"{self.database}.{PUBLISHED}"):
            return {}
        return {r.model: r.stored_in for r in self.spark.table(f"{self.database}.{PUBLISHED}").collect()}

    def read(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{self.before[name]}").drop(MONTH)

    def holding(self, name: str, keys: DataFrame) -> DataFrame:
        """The months of a stored model that may hold one of ``keys``, found by key summaries."""
        table = self.before[name]
        months = may_hold(keys, keys.columns[0], self.parts(table), MONTH)
        return self.spark.table(f"{self.database}.{table}").filter(F.col(MONTH).isin(months)).drop(MONTH)

    def state(self) -> dict[str, Any]:
        """``history``, ``existing`` and ``holding`` of a ``Warehouse``: what the last published run has stored."""
        there = {n: self.read(n) for n in self.before if n in MERGES or n in HISTORIES}
        return {"history": {n: there[n] for n in HISTORIES if n in there}, "existing": {n: there[n] for n in MERGES if n in there}, "holding": self.holding}

    def save(self, name: str, df: DataFrame, scope: Scope = None) -> DataFrame:
        if self.names is not None and name not in self.names:
            return df
        table = f"{name}__{self.run}"
        if name in MERGES:
            self._save_fact(name, table, df, scope)
        else:
            with shuffles_dropped(self.spark):
                df.write.format("parquet").option("compression", COMPRESSION).saveAsTable(f"{self.database}.{table}")
        self._made[name] = table
        return self.spark.table(f"{self.database}.{table}").drop(MONTH)

    def written(self) -> set[str]:
        """Models that this run has stored."""
        return set(self._made)

    # ---- Facts --------------------------------------------------------------------------
    def parts(self, table: str) -> list[Part]:
        """A fact table's partitions; as many as it has months."""
        return [Part(*r) for r in self.spark.table(f"{self.database}.{table}__parts").select(*[f.name for f in fields(Part)]).collect()]

    def touched_months(self, merge: Merge, old: list[Part], target: DataFrame, batch: DataFrame, scope: Scope, touched: DataFrame | None) -> list[str]:
        """Months of the batch and stored months with rows in scope. Only months whose key summary may
        hold a touched parent are looked into, and there only the parent column; those of the batch are touched anyway."""
        months = {r[0] for r in batch.select(MONTH).distinct().collect()}
        if isinstance(scope, date):
            return sorted(months | {p.value for p in old if p.value != "none" and p.value >= f"{scope:%Y-%m}"})
        if merge.parent is None:
            return sorted(months | {r[0] for r in touched.select(month_of(merge.day)).distinct().collect()})
        near = may_hold(touched, merge.parent, [p for p in old if p.value not in months], MONTH)
        if near:
            real = target.filter(F.col(MONTH).isin(near)).join(touched, merge.parent, "left_semi").select(MONTH).distinct()
            months |= {r[0] for r in real.collect()}
        return sorted(months)

    def _save_fact(self, name: str, table: str, df: DataFrame, scope: Scope) -> None:
        spark, merge, path = self.spark, MERGES[name], f"{self.location}/{name}/{self.run}"
        with ExitStack() as files:  # of the batch, which is in the table in the end
            batch = files.enter_context(staged(df.withColumn(MONTH, month_of(merge.day)), f"{name}_batch"))
            old, fresh = [], batch
            if name in self.before:
                old, target = self.parts(self.before[name]), spark.table(f"{self.database}.{self.before[name]}")
                touched = None if isinstance(scope, date) else files.enter_context(staged(touched_by(batch, merge, scope), "touched"))
                months = self.touched_months(merge, old, target, batch, scope, touched)
                fresh = replace_scope(target.filter(F.col(MONTH).isin(months)), batch, merge, scope, touched)
                old = [p for p in old if p.value not in months]
            layout = [c for c in fresh.columns if c != MONTH]
            bounds = range_bounds(batch, merge.cluster)
            with shuffles_dropped(spark):
                laid = clustered(fresh.select(*layout, MONTH), merge.cluster, (MONTH,), bounds)
                laid.write.option("compression", COMPRESSION).partitionBy(MONTH).parquet(f"{path}/rows")
            kinds = {f.name: f.dataType.simpleString() for f in fresh.schema.fields}
        ddl = ", ".join(f"`{c}` {kinds[c]}" for c in layout)
        written = spark.read.schema(f"{ddl}, {MONTH} string").parquet(f"{path}/rows")
        self._register(table, ddl, path, [*old, *self._summaries(merge, written, path)])

    def _summaries(self, merge: Merge, written: DataFrame, path: str) -> list[Part]:
        """The parts of the months just written, with the key summaries of those that are found by parent."""
        key = merge.parent or merge.keys[0]
        found = key_ranges(written, MONTH, key)
        if merge.parent is None or not found:
            return [Part(m, f"{path}/rows/{MONTH}={m}") for m in found]
        with shuffles_dropped(self.spark):
            key_words(written, MONTH, key, {m: x[0] for m, x in found.items()}).write.option("compression", COMPRESSION).parquet(f"{path}/words")
        return [Part(m, f"{path}/rows/{MONTH}={m}", f"{path}/words", *x) for m, x in found.items()]

    def _register(self, table: str, ddl: str, path: str, parts: list[Part]) -> None:
        spark = self.spark
        spark.createDataFrame([astuple(p) for p in parts], PARTS).coalesce(1).write.format("parquet").saveAsTable(f"{self.database}.{table}__parts")
        spark.sql(f"CREATE TABLE {self.database}.{table} ({ddl}, {MONTH} STRING) USING parquet PARTITIONED BY ({MONTH}) LOCATION '{path}/rows'")
        if parts:
            added = " ".join(f"PARTITION ({MONTH} = '{p.value}') LOCATION '{p.path}'" for p in parts)
            spark.sql(f"ALTER TABLE {self.database}.{table} ADD IF NOT EXISTS {added}")

    # ---- Publishing ---------------------------------------------------------------------
    def _show(self, models: dict[str, str]) -> None:
        for name, table in models.items():
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{name} AS SELECT * FROM {self.database}.{table}")

    def publish(self) -> None:
        """Show this run's models. The list is replaced in one step; models not made in this run stay as they were."""
        models = {**self.before, **self._made}
        rows = ", ".join(f"('{name}', '{table}')" for name, table in sorted(models.items()))
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{PUBLISHED} AS SELECT * FROM VALUES {rows} AS t(model, stored_in)")
        self._show(self._made)

    def retire(self) -> list[str]:
        """Drop the tables and delete the folders that neither the published run nor the one before it uses.

        Readers of the former run are still served. Returns the folders that were deleted.
        """
        shown = self._list()
        used = {*shown.values(), *self.before.values()}
        tables = [t.name for t in self.spark.catalog.listTables(self.database) if "__run_" in t.name]
        gone = [t for t in tables if t.removesuffix("__parts") not in used]
        held = [p for t in used if f"{t}__parts" in tables for p in self.parts(t)]
        live = {folder.split("/rows/")[0].removesuffix("/words") for p in held for folder in (p.path, p.words) if folder}
        runs = {p.path.split("/rows/")[0] for t in gone if t.endswith("__parts") for p in self.parts(t.removesuffix("__parts"))}
        for table in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.database}.{table}")
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for folder in sorted(runs - live):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
        return sorted(runs - live)
