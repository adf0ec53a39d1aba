"""Deterministic pseudo-randomness from md5, identical in Spark and DuckDB.

``rand()`` differs between engines and between runs after a lost
executor; an md5 of ``id:seed`` does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["md5_key", "md5_bucket", "md5_uniform", "md5_bucket_sql", "md5_uniform_sql"]


def md5_key(id_col: str | Column, seed: int) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))


def md5_bucket(id_col, seed: int, k: int, hex_chars: int = 4) -> Column:
    """conv(substr(md5(id:seed),1,4),16,10) % k."""
    h = F.substring(md5_key(id_col, seed), 1, hex_chars)
    return (F.conv(h, 16, 10).cast("long") % F.lit(k)).cast("int")


def md5_uniform(id_col, seed: int) -> Column:
    """Uniform in [0,1) from 8 hex chars of md5(id:seed)."""
    h = F.substring(md5_key(id_col, seed), 1, 8)
    return F.conv(h, 16, 10).cast("double") / F.lit(4294967296.0)


def md5_bucket_sql(id_sql: str, seed: int, k: int, hex_chars: int = 4) -> str:
    return (f"(CAST(('0x' || substr(md5(concat({id_sql}, ':{seed}')), 1, {hex_chars})) AS BIGINT) % {k})")


def md5_uniform_sql(id_sql: str, seed: int) -> str:
    return (f"(CAST(('0x' || substr(md5(concat({id_sql}, ':{seed}')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)")
