"""JSON payloads, read inside the row: no explode, no shuffle, no join back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_items(col: Column | str, fields: Sequence[str]) -> Column:
    """A JSON array of objects as array<struct<string...>>; bad JSON becomes NULL.

    All fields arrive as text, because payload numbers come quoted or bare.
    """
    col = F.col(col) if isinstance(col, str) else col
    ddl = "array<struct<" + ",".join(f"`{f}`:string" for f in fields) + ">>"
    return F.from_json(col.cast("string"), ddl)


def to_decimal(text: Column, precision: int, scale: int) -> Column:
    """Lenient cast: text that is no number becomes NULL."""
    return text.try_cast(f"decimal({precision},{scale})")


def sum_items(
    items: Column, amount: str, keep: Callable[[Column], Column] | None = None, scale: int = 6
) -> Column:
    """Sum one numeric field over the array entries for which ``keep`` is true; 0 when none."""
    kept = F.filter(items, keep) if keep is not None else items
    total = F.aggregate(
        kept,
        F.lit(0).cast(f"decimal(18,{scale})"),
        lambda acc, item: (
            acc + F.coalesce(to_decimal(item[amount], 18, scale), F.lit(0).cast(f"decimal(18,{scale})"))
        ).cast(f"decimal(18,{scale})"),
    )
    return F.coalesce(total, F.lit(0).cast(f"decimal(18,{scale})"))


def pivot_items(items: Column, name: str, value: str, wanted: Sequence[str]) -> dict[str, Column]:
    """Key/value entries to one column per wanted key; the greatest value wins on duplicates."""

    def column(key: str) -> Column:
        entries = F.filter(items, lambda e: e[name] == F.lit(key))
        return F.array_max(F.transform(entries, lambda e: e[value]))

    return {key: column(key) for key in wanted}


def text_at(col: Column | str, path: str) -> Column:
    """Text found at a JSON path, NULL when the document is bad or the path is absent."""
    col = F.col(col) if isinstance(col, str) else col
    return F.get_json_object(col.cast("string"), path)


def is_true(cond: Column) -> Column:
    """Three-valued to two-valued: NULL counts as false."""
    return F.coalesce(cond, F.lit(False))
