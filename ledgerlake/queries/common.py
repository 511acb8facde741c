"""Output types that both engines hash alike: money as doubles of four places, counts as long."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame) -> DataFrame:
    """Decimals to doubles rounded to four places."""
    return df.select([F.round(F.col(c).cast("double"), 4).alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])


def money(*columns: str) -> str:
    """The same for SQL: a select list."""
    return ", ".join(f"round(cast({c} as double), 4) as {c.split('.')[-1]}" for c in columns)
