"""CSV landing."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.registry import RawTable

NULL_TOKENS = ("", "NULL", "null")


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to the declared types: null tokens become NULL, a bad value is an error."""
    cols = []
    for f in schema.fields:
        text = F.col(f.name)
        cols.append(F.when(~text.isin(*NULL_TOKENS), text).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, trim: bool = False, multi_line: bool = False) -> DataFrame:
    """Header-matched scan: columns are found by name, in any order, missing ones are NULL.

    Files may name their columns in different orders: each file's header is read, files with the
    same header are scanned together, and every scan is lined up with the schema by name. Columns
    the schema does not know are ignored. Quotes are optional, blank lines skipped, and a malformed line aborts the read.
    Set ``multi_line`` only for files with line breaks inside quotes: such files cannot be split.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    reader = reader.option("mode", "FAILFAST").option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.text(path).inputFiles()):
        by_header.setdefault(tuple(reader.csv(file).columns), []).append(file)

    def scan(header: tuple[str, ...], files: list[str]) -> DataFrame:
        text = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in header])).csv(files)
        found = {c.strip().lower(): c for c in header}
        return text.select(*[
            (F.col(f"`{found[f.name.lower()]}`") if f.name.lower() in found else F.lit(None).cast("string")).alias(f.name)
            for f in schema.fields
        ])

    scans = [scan(header, files) for header, files in by_header.items()] or [spark.createDataFrame([], _as_text(schema))]
    return coerce(reduce(DataFrame.union, scans), schema)


def scan_csv_positional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Columns by position under a header line that is skipped; values are trimmed."""
    reader = spark.read.option("header", True).option("enforceSchema", True).option("mode", "FAILFAST")
    reader = reader.option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    return coerce(reader.schema(_as_text(schema)).csv(path), schema)


def with_sync_columns(df: DataFrame, synced_at: datetime) -> DataFrame:
    """Add when the row was synced and that it is not deleted at the source."""
    return df.withColumns({"_synced_at": F.lit(synced_at).cast("timestamp"), "_deleted": F.lit(False)})


def inferred_schema(schema: T.StructType) -> T.StructType:
    """Types by the loader's name rules: ``*_at``, ``datetime`` and sync columns are timestamps."""
    stamp = lambda n: n.endswith("_at") or n == "datetime"
    return T.StructType(
        [T.StructField(f.name, T.TimestampType() if stamp(f.name) and isinstance(f.dataType, T.StringType) else f.dataType) for f in schema.fields]
    )


def scan_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Undeclared CSV: types inferred from the data, then the timestamp name rules applied."""
    raw = spark.read.option("header", True).option("inferSchema", True).option("quote", '"').option("escape", '"').csv(path)
    wanted = inferred_schema(raw.schema)
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted.fields])


def json_column(df: DataFrame, column: str, strict: bool = True) -> DataFrame:
    """Text to VARIANT after the load; strict raises on bad JSON, otherwise it becomes NULL."""
    return df.withColumn(column, (F.parse_json if strict else F.try_parse_json)(F.col(column)))


def land(df: DataFrame, table: str, mode: str = "replace") -> None:
    """Write a raw table: ``replace`` rebuilds it, ``append`` adds rows."""
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown load mode: {mode}")
    df.write.mode("overwrite" if mode == "replace" else "append").format("parquet").saveAsTable(table)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, ordered by name."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


@dataclass
class LoadReport:
    loaded: list[str] = field(default_factory=list)
    errors: dict[str, str] = field(default_factory=dict)


def load_all(
    spark: SparkSession, paths: Mapping[str, str], tables: Mapping[str, RawTable], database: str, synced_at: datetime,
    mode: str = "replace",
) -> LoadReport:
    """Land every CSV. A failing critical table stops the run; other failures are collected."""
    report = LoadReport()
    for name in sorted(paths):
        raw = tables[name]
        try:
            df = scan_csv(spark, paths[name], raw.schema)
            land(with_sync_columns(df, synced_at), f"{database}.{name.replace('.', '__')}", mode)
            report.loaded.append(name)
        except Exception as error:
            report.errors[name] = str(error).splitlines()[0]
            if raw.critical:
                raise RuntimeError(f"critical table {name} failed to load") from error
    return report
