"""A controlled copy of a source table (SNK6, SRC9).

The copy is made once and then belongs to its owner: a later run finds it and
leaves it alone, a run at the same time loses the switch and does too.
``drift`` tells how the source has moved away from the copy.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .versioned import ConcurrentRun, TableExists, VersionedTable


def create_once(table: VersionedTable, source: DataFrame) -> bool:
    """Copy ``source`` unless the copy exists; True if this run made it."""
    try:
        table.create(source)
    except (TableExists, ConcurrentRun):
        return False
    return True


def drift(copy: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """(key, change, columns): keys of the source that the copy lacks (added),
    keys that the source no longer has (vanished) and keys whose rows differ
    (changed, with the names of the differing columns in order).  Keys are
    unique and not null in both, as the suite's checks demand; columns that only
    one side has are not compared.  One full outer join on the key."""
    cols = [c for c in copy.columns if c in source.columns and c != key]
    here = lambda df, side: df.select(F.col(key).alias(f"_{side}"), F.struct(F.lit(1).alias("_there"), *cols).alias(side))
    j = here(copy, "old").join(here(source, "new"), F.col("_old") == F.col("_new"), "full_outer")
    differ = F.filter(F.array(*[F.when(~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")), F.lit(c)) for c in cols]),
                      lambda c: c.isNotNull()) if cols else F.array().cast("array<string>")
    change = reduce(lambda otherwise, case: F.when(case[0], case[1]).otherwise(otherwise),
                    [(F.col("_new").isNull(), "vanished"), (F.col("_old").isNull(), "added")],
                    F.when(F.size(differ) > 0, "changed"))
    return j.select(F.coalesce("_old", "_new").alias(key), change.alias("change"),
                    F.when(change == "changed", F.array_join(differ, ",")).alias("columns")).filter("change IS NOT NULL")
