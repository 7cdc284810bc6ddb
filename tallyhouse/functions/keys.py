"""Surrogate keys and the audit footer."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.params import Params

NULL_TOKEN = "_null_"
SEPARATOR = "-"


def _text(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("string"), F.lit(NULL_TOKEN))


def surrogate_key(cols: Sequence[Column | str], valid_from: Column | str | None = None) -> Column:
    """MD5 over the natural key; history rows add the start of their validity."""
    parts: Iterable[Column | str] = cols if valid_from is None else [*cols, valid_from]
    return F.md5(F.concat_ws(SEPARATOR, *[_text(c) for c in parts]))


def packed(col: Column | str) -> Column:
    """Bytes from which ``unpacked`` restores the text: text that is lower-case hex, as keys and hashes are, takes half its length.

    For rows on their way through a shuffle. The first byte tells how the others are read, so any text comes back as it was.
    """
    col = F.col(col) if isinstance(col, str) else col
    raw = F.unhex(col)
    return F.when(F.lower(F.hex(raw)) == col, F.concat(F.lit(b"\x01"), raw)).otherwise(F.concat(F.lit(b"\x00"), col.cast("binary")))


def unpacked(col: Column | str) -> Column:
    """The text that ``packed`` was given."""
    col = F.col(col) if isinstance(col, str) else col
    rest = F.substring(col, 2, 2**31 - 1)
    return F.when(F.substring(col, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def date_key(day: Column | str) -> Column:
    """Integer yyyymmdd."""
    day = F.col(day) if isinstance(day, str) else day
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def with_audit(
    df: DataFrame,
    params: Params,
    *,
    model: str,
    source_system: str,
    record_id: Column | str,
    business_columns: Sequence[str],
    extracted_at: Column | str,
) -> DataFrame:
    """Append the eight audit columns. The load time is ``as_of``, so reruns are identical."""
    record_id = F.col(record_id) if isinstance(record_id, str) else record_id
    extracted_at = F.col(extracted_at) if isinstance(extracted_at, str) else extracted_at
    footer = {
        "_source_system": F.lit(source_system),
        "_source_record_id": record_id.cast("string"),
        "_extracted_at": extracted_at.cast("timestamp"),
        "_loaded_at": F.lit(params.as_of).cast("timestamp"),
        "_run_id": F.lit(params.run_id),
        "_model": F.lit(model),
        "_record_hash": surrogate_key(business_columns),
        "_is_deleted_at_source": F.lit(False),
    }
    return df.withColumns(footer)
