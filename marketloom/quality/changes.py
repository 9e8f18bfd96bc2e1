"""Key-aware changes: appending, deleting and renaming with the declared consequences.

Every function returns new relations and leaves its inputs as they are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators.keys import assign_ids, next_id
from marketloom.schema import TABLES, children

Tables = Mapping[str, DataFrame]


def append_rows(rows: DataFrame, new_rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Appends rows under the next free ids, in the given order."""
    numbered = assign_ids(new_rows, order, key, start=next_id(rows, key))
    return rows.unionByName(numbered.select(*rows.columns))


def _key(parent: str) -> str:
    return TABLES[parent].key[0]


def delete_cascade(tables: Tables, parent: str, keys: DataFrame) -> dict[str, DataFrame]:
    """The tables touched by deleting ``keys`` of ``parent``, dependents included.

    Keys that restricting children still use are not deleted.
    """
    allowed, _ = delete_restrict(tables, parent, keys)
    gone = allowed.select(F.col(_key(parent)).alias("gone"))
    changed = {parent: tables[parent].join(gone, F.col(_key(parent)) == F.col("gone"), "left_anti")}
    for table, ref in children(parent):
        if ref.on_delete == "cascade":
            rows = changed.get(table.name, tables[table.name])
            changed[table.name] = rows.join(gone, F.col(ref.column) == F.col("gone"), "left_anti")
    return changed


def delete_restrict(tables: Tables, parent: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits ``keys`` into (allowed, refused): refused ones still have restricting children."""
    wanted = keys.select(F.col(keys.columns[0]).alias(_key(parent))).distinct()
    used = None
    for table, ref in children(parent):
        if ref.on_delete == "restrict":
            held = tables[table.name].select(F.col(ref.column).alias(_key(parent)))
            used = held if used is None else used.unionByName(held)
    if used is None:
        return wanted, wanted.limit(0)
    used = used.distinct()
    return wanted.join(used, _key(parent), "left_anti"), wanted.join(used, _key(parent), "left_semi")


def update_cascade(tables: Tables, parent: str, renames: DataFrame) -> dict[str, DataFrame]:
    """The tables touched by renaming keys of ``parent``; ``renames`` holds (old, new)."""
    pairs = renames.select(F.col("old"), F.col("new"))

    def renamed(rows: DataFrame, column: str) -> DataFrame:
        joined = rows.join(pairs, F.col(column) == F.col("old"), "left")
        return joined.withColumn(column, F.coalesce("new", column)).select(*rows.columns)

    changed = {parent: renamed(tables[parent], _key(parent))}
    for table, ref in children(parent):
        changed[table.name] = renamed(changed.get(table.name, tables[table.name]), ref.column)
    return changed
