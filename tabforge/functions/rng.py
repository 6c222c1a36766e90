"""Reproducible pseudo-random numbers that depend only on a row id and a seed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def uniform(row_id: Column | str, seed: int | Column = 42) -> Column:
    """Uniform [0, 1) from the first 32 bits of ``md5(id:seed)``.

    Unlike ``rand`` or ``df.sample`` the value survives repartitioning, retries
    and engine changes, and two seeds are unrelated.
    """
    rid = F.col(row_id) if isinstance(row_id, str) else row_id
    seed_text = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    digest = F.md5(F.concat(rid.cast("string"), F.lit(":"), seed_text))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def uniform_sql(row_id: str, seed: int | str = 42) -> str:
    """The same number as a DuckDB expression, used by the oracle texts."""
    return f"(CAST('0x' || substr(md5(CAST({row_id} AS VARCHAR) || ':' || '{seed}'), 1, 8) AS BIGINT) / 4294967296.0e0)"
