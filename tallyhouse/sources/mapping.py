"""Column overrides and declarative field mappings for connectors that name things differently."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Overrides = Mapping[str, Mapping[str, str]]

# Fields that are no column of their own and the column their value map reads.
DERIVED = {"order_status": "financial_status"}


def source_col(overrides: Overrides, table: str, name: str, default: str) -> Column:
    """The column that feeds a field: its default, or the override given for the table.

    ``a:b:c`` walks into a JSON text column ``a``.
    """
    target = overrides.get(table, {}).get(name, default)
    head, *path = target.split(":")
    if not path:
        return F.col(head)
    return F.get_json_object(F.col(head), "$." + ".".join(path))


@dataclass(frozen=True)
class TableMapping:
    """One mapping document: fields, filters, value maps and text clean-up."""

    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    fields: Mapping[str, str] = field(default_factory=dict)
    value_maps: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    value_sources: Mapping[str, str] = field(default_factory=dict)
    clean_text: tuple[str, ...] = ()
    exclude_test: bool = True
    exclude_archived: bool = False
    min_created_at: str | None = None

    @classmethod
    def from_document(cls, doc: Mapping) -> TableMapping:
        """Build from a parsed mapping file (a dict)."""
        rules, filters = doc.get("transformations", {}), doc.get("filters", {})
        return cls(
            required=tuple(doc.get("required_fields", ())),
            optional=tuple(doc.get("optional_fields", ())),
            fields=dict(doc.get("field_mappings", {})),
            value_maps={k: v["map_values"] for k, v in rules.items() if isinstance(v, Mapping) and "map_values" in v},
            value_sources={k: v["source"] for k, v in rules.items() if isinstance(v, Mapping) and "source" in v},
            clean_text=tuple(k for k, v in rules.items() if isinstance(v, list)),
            exclude_test=filters.get("exclude_test_orders", True),
            exclude_archived=filters.get("exclude_archived", False),
            min_created_at=filters.get("min_created_at"),
        )


def apply_mapping(df: DataFrame, mapping: TableMapping) -> DataFrame:
    """Filter and rename one raw table; a missing required field is an error, an optional one NULL."""
    missing = [c for c in mapping.required if c not in df.columns]
    if missing:
        raise ValueError(f"required fields missing: {missing}")
    df = df.withColumns({c: F.lit(None).cast("string") for c in mapping.optional if c not in df.columns})
    if mapping.exclude_test:
        if "test" in df.columns:
            df = df.filter(~F.coalesce(F.col("test"), F.lit(False)))
        if "tags" in df.columns:
            df = df.filter(~F.lower(F.coalesce("tags", F.lit(""))).contains("test"))
    if mapping.exclude_archived and "closed_at" in df.columns:
        df = df.filter(F.col("closed_at").isNull())
    if mapping.min_created_at:
        df = df.filter(F.col("created_at").cast("date") >= F.lit(mapping.min_created_at).cast("date"))
    names = set(df.columns)

    def pick(target: str, source: str) -> Column:
        head, _, path = source.partition(".")
        col = F.col(source) if source in names else F.get_json_object(F.col(head), f"$.{path}")
        if target in mapping.clean_text:
            col = F.lower(F.trim(col))
        return col.alias(target)

    mapped = [pick(t, s) for t, s in mapping.fields.items()]
    kept = [c for c in df.columns if c not in mapping.fields.values() and c not in mapping.fields]
    out = df.select(*mapped, *kept)
    for target, values in mapping.value_maps.items():
        source = mapping.value_sources.get(target) or (target if target in out.columns else DERIVED.get(target))
        if source not in out.columns:
            raise ValueError(f"value map of {target} has no source column")
        lookup = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
        out = out.withColumn(target, F.coalesce(F.try_element_at(lookup, F.col(source)), F.lit("unknown")))
    return out
