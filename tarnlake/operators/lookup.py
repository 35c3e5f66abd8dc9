"""Left lookup joins that stand a hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a key must have, whatever its share, to be hot.
HOT_LEAST = 50_000


def hot_keys(counts: DataFrame, key: str, n: str, total: int, share: int = 64, least: int | None = None) -> list:
    """Keys of ``counts`` (one row per key, ``n`` rows each) that hold over ``total / share`` rows.

    At most ``share`` keys can, so the list that reaches the driver is bounded whatever the data.
    """
    floor = max(HOT_LEAST if least is None else least, total // share)
    return [r[0] for r in counts.where(F.col(n) > floor).select(key).collect()]


def lookup_join(left: DataFrame, right: DataFrame, on: Column, left_key: str, right_key: str, hot: list, how: str = "left") -> DataFrame:
    """``left`` joined to the unique-keyed ``right``.

    Rows of ``left`` under a hot key stay where they are: the few rows of ``right`` they need (one per
    hot key) are broadcast. All others take the ordinary shuffle join, which adaptive execution
    may split further. With no hot keys this is one plain join.
    """
    if not hot:
        return left.join(right, on, how)
    is_hot = F.coalesce(F.col(left_key).isin(hot), F.lit(False))
    cold = left.where(~is_hot).join(right, on, how)
    warm = left.where(is_hot).join(F.broadcast(right.where(F.col(right_key).isin(hot))), on, how)
    return cold.unionByName(warm)
