"""Window functions over series too long for one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketloom.operators.keys import assign_ids

STRETCH_ROWS = 1_000_000


def over_stretches(
    rows: DataFrame,
    by: list[str],
    order: list[str],
    look_back: int,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    stretch_rows: int | None = None,
) -> DataFrame:
    """Applies ``compute(rows, window)`` to each series in stretches of limited length.

    Rows get their position in the overall order, which is cut into stretches of
    equal length; the last ``look_back`` rows of each are also shown to the next
    one, so every frame reaching no further back is complete. The results equal
    those of one window per series. ``by`` and ``order`` together must be unique,
    and ``compute`` must add columns only.
    """
    size = max(stretch_rows or STRETCH_ROWS, look_back)
    numbered = assign_ids(rows, [*by, *order], "__seq", start=0)
    own = F.floor(F.col("__seq") / size)
    shown_in = F.when(F.col("__seq") % size >= size - look_back, F.array(own, own + 1)).otherwise(F.array(own))
    placed = numbered.withColumn("__own", own).withColumn("__stretch", F.explode(shown_in))
    window = Window.partitionBy(*by, "__stretch").orderBy("__seq")
    done = compute(placed, window)
    return done.filter(F.col("__own") == F.col("__stretch")).drop("__seq", "__own", "__stretch")
