"""Row changes over immutable tables: upsert, insert-if-absent, child replacement, bad-row split.

Each function returns the new content of the table. It is written as a new version and then made
current (`shelfmark.sinks.tables`), because a path cannot be overwritten while it is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.series import first_by, latest_by


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           order_by: Sequence[str]) -> DataFrame:
    """Rows of `updates` replace target rows of the same key; the last update of a key wins.

    `order_by` may name columns that only `updates` has. Updates of one key are reduced before
    the shuffle, so a batch made of copies of one key does not meet in one task.
    """
    last = latest_by(updates, keys, order_by).select(*target.columns)
    return target.join(last.select(*keys), list(keys), "left_anti").unionByName(last)


def insert_missing(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                   order_by: Sequence[str] | None = None) -> DataFrame:
    """Adds update rows whose key is absent; existing rows stay as they are, the first update wins."""
    if order_by:
        rows = first_by(updates, keys, [F.col(c).asc_nulls_last() for c in order_by])
    else:
        rows = updates.dropDuplicates(list(keys))
    new = rows.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def replace_children(target: DataFrame, updates: DataFrame, parent: str = "item_id") -> DataFrame:
    """All children of a parent that occurs in `updates` are replaced by its rows there.

    A parent without rows in `updates` keeps its children.
    """
    touched = updates.select(parent).distinct()
    return target.join(touched, parent, "left_anti").unionByName(updates.select(*target.columns))


def split_bad(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with the names of the rules they break (a rule is true for a bad row)."""
    broken = F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(name))
                                       for name, rule in rules.items()]))
    tagged = df.withColumn("reasons", broken)
    return tagged.filter(F.size("reasons") == 0).drop("reasons"), tagged.filter(F.size("reasons") > 0)


def drop_children(children: DataFrame, bad: DataFrame, key: str = "item_id") -> DataFrame:
    """Children whose parent is not among the bad rows."""
    return children.join(bad.select(key).distinct(), key, "left_anti")
