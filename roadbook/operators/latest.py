"""Keep the newest version of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, key: str, version: list[str]) -> DataFrame:
    """One row a key: the one with the greatest ``version``.

    An aggregate, not a window: copies collapse before the shuffle, so a key
    with very many versions costs no more than any other.
    """
    others = [c for c in df.columns if c != key]
    newest = df.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*version, *others)).alias("row"))
    return newest.select(key, "row.*").select(*df.columns)
