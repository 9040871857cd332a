"""Deterministic surrogate keys.

Three modes:

* ``md5``      - first 60 bits of md5 of the text form; portable to any SQL
                 engine (used by the DuckDB oracle).
* ``xxhash64`` - Spark's 64-bit xxHash; cheapest per row.
* ``parity``   - ``abs(hash(x)) % M`` with Murmur3, as the original notebooks
                 compute it, but widened to BIGINT before ``abs`` so the
                 minimum int cannot overflow under ANSI mode.

A NULL input maps to 42 in every mode (the Murmur3 / xxHash seed value for
NULL), so a dimension member with a NULL natural key still has a key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_KEY = 42
_MAX_LONG = 0x7FFFFFFFFFFFFFFF


def _md5_bits(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("string")), 1, 15), 16, 10).cast("bigint")


def surrogate_key(value: Column, modulus: int | None, mode: str = "md5") -> Column:
    """Non-negative BIGINT key of ``value``, reduced modulo ``modulus`` when given."""
    if mode == "md5":
        raw = _md5_bits(value)
        key = raw % modulus if modulus else raw
        return F.coalesce(key, F.lit(NULL_KEY).cast("bigint"))
    if mode == "xxhash64":
        h = F.xxhash64(value)
        return F.pmod(h, F.lit(modulus).cast("bigint")) if modulus else h.bitwiseAND(F.lit(_MAX_LONG))
    if mode == "parity":
        h = F.abs(F.hash(value).cast("bigint"))
        return h % modulus if modulus else h
    raise ValueError(f"unknown key mode {mode!r}")


def incident_key(dr_no: Column, mode: str = "md5") -> Column:
    """Fact surrogate key: full-width hash of the business key, no modulus."""
    return surrogate_key(dr_no, None, mode)
