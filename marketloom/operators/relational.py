"""Small relational idioms the analyses share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import same_text


def optional_equals(column: str, value: str, everything: str = "ALL") -> Column:
    """Match a text parameter, or anything when it says so."""
    return (F.lit(value) == everything) | same_text(column, F.lit(value))


def top_k(rows: DataFrame, k: int, *order) -> DataFrame:
    """The first k rows of an order; each task keeps k, then they are merged."""
    return rows.orderBy(*order).limit(k)


def top_n_per_key(rows: DataFrame, n: int, by: list[str], *order) -> DataFrame:
    """The first n rows of each key; tasks drop the rest before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("__place", place).filter(F.col("__place") <= n).drop("__place")


def upsert(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``changes`` replace those of ``base`` with the same key; new keys are added."""
    return base.join(changes.select(*keys), keys, "left_anti").select(*base.columns).unionByName(changes)
