"""Masking of personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.params import Params


def pii_hash(col: Column | str, params: Params) -> Column:
    """Salted SHA-256 of the trimmed, lower-cased value; plain text when masking is off."""
    col = (F.col(col) if isinstance(col, str) else col).cast("string")
    if not params.pii_masking:
        return col
    return F.sha2(F.concat(F.lit(params.pii_salt), F.lower(F.trim(col))), 256)


def phone_hash(col: Column | str, params: Params) -> Column:
    """Hash of a phone number as given, or of its digits and plus sign, so that its spelling does not matter.

    In the second form a value without a digit is NULL.
    """
    if params.phone_format == "as_given":
        return pii_hash(col, params)
    col = (F.col(col) if isinstance(col, str) else col).cast("string")
    bare = F.regexp_replace(col, "[^0-9+]", "")
    return pii_hash(F.when(bare.rlike("[0-9]"), bare), params)


def pii_null(col: Column | str, params: Params) -> Column:
    """NULL while masking is on; the value itself when it is off."""
    col = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.lit(None).cast("string") if params.pii_masking else col


def loose_name_key(first: Column, last: Column, postal: Column, params: Params) -> Column:
    """Fuzzy name-and-address key: phonetic surname, first initial, bare postal code.

    Grouping by one derived key finds spelling variants without comparing pairs of people.
    NULL unless all three parts are present.
    """
    squeeze = lambda c: F.upper(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))
    surname, given, code = squeeze(last), squeeze(first), squeeze(postal)
    complete = (F.length(surname) > 0) & (F.length(given) > 0) & (F.length(code) > 0)
    key = F.concat_ws("|", F.soundex(surname), F.substring(given, 1, 1), code)
    return F.when(complete, F.sha2(F.concat(F.lit(params.pii_salt), key), 256))
