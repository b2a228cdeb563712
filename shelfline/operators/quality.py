"""Data-quality checks (DQ1-DQ13) and source freshness (SRC13).

A check returns its failing rows; it passes with zero rows.  ``run_checks``
evaluates a whole list as one Spark job that counts a table's rows per key that
some check needs:

* where one key should not repeat (a unique key or a parent key), as in most
  tables, it has about as many values as the table has rows, so a map-side combine
  would only fill memory.  The rows are dealt by this key into tasks of
  ``ROWS_PER_TASK`` rows; failures of the row-level checks are counted beside it;
* other keys are counted in one aggregation over grouping sets, whose map-side
  combine bounds what is shuffled by the distinct keys.  With no key of the first
  kind, or several, this one has them too, and a set for the bits of the row-level
  checks that a row fails.

So a table is scanned once, or, with one unique key and child keys besides, once
for each kind's columns.  Repeated keys are read off these counts; child and
parent keys of the relationships meet in one more aggregation of the counts by
(check, key), with no join.  The result is a small table (check, table, severity,
n_failed, status).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expr as X

ROW_KINDS = ("not_null", "accepted_values", "between", "expression")


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    kind: str  # unique | not_null | relationships | unique_combination | accepted_values | between | expression
    columns: tuple[str, ...] = ()
    parent: str | None = None
    parent_column: str | None = None
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    expression: str | None = None  # SQL boolean that is true on a failing row
    severity: str = "error"
    tags: tuple[str, ...] = field(default_factory=tuple)


# ---- row predicates (true = failing row) -------------------------------------

def fail_condition(c: Check) -> Column:
    col = F.col(c.columns[0]) if c.columns else None
    if c.kind == "not_null":
        return col.isNull()
    if c.kind == "accepted_values":
        return col.isNotNull() & ~col.isin(*c.values)
    if c.kind == "between":
        ok = F.lit(True)
        if c.min_value is not None:
            ok = ok & (col >= F.lit(c.min_value))
        if c.max_value is not None:
            ok = ok & (col <= F.lit(c.max_value))
        return col.isNotNull() & ~ok
    if c.kind == "expression":
        return F.coalesce(F.expr(c.expression), F.lit(False))
    raise ValueError(c.kind)


def failing_rows(c: Check, tables: dict[str, DataFrame]) -> DataFrame:
    df = tables[c.table]
    if c.kind in ROW_KINDS:
        return df.filter(fail_condition(c))
    if c.kind in ("unique", "unique_combination"):
        keys = list(c.columns)
        nn = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]) \
            if c.kind == "unique" else F.lit(True)
        return (df.filter(nn).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"))
                  .filter(F.col("n_records") > 1))
    if c.kind == "relationships":
        child = df.filter(F.col(c.columns[0]).isNotNull())
        parent = tables[c.parent].select(F.col(c.parent_column).alias("_parent_key")).distinct()
        return child.join(parent, child[c.columns[0]] == parent["_parent_key"], "left_anti")
    raise ValueError(c.kind)


def status(n: Column, severity: Column) -> Column:
    return F.when(n == 0, "pass").when(severity == "warn", "warn").otherwise("fail")


#: keys of these types are compared as longs, others as text
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)
#: row-level checks whose failures fit the bits of one number
_BITS = 62
#: rows that a task counts by a key that should not repeat
ROWS_PER_TASK = 1_000_000


def _whole(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, _WHOLE)


def _counts(df: DataFrame, keys: list[tuple[str, ...]], rules: list[Column]) -> tuple[DataFrame, list[int]]:
    """Rows per value of each key and per combination of failed ``rules``
    (bits), in one aggregation over grouping sets; and the sets' grouping ids."""
    flags = [f"_flags{i}" for i in range(-(-len(rules) // _BITS))]
    for i, name in enumerate(flags):
        bits = [F.when(r, F.lit(1 << b)).otherwise(F.lit(0)).cast("bigint") for b, r in enumerate(rules[i * _BITS:(i + 1) * _BITS])]
        df = df.withColumn(name, reduce(lambda x, y: x + y, bits))
    sets = [list(k) for k in keys] + [[f] for f in flags]
    cols = list(dict.fromkeys(c for s in sets for c in s))
    ids = [sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s) for s in sets]
    counted = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols]).agg(
        F.grouping_id().cast("bigint").alias("_set"), F.count(F.lit(1)).alias("_rows"))
    return counted, ids


def _per_key(df: DataFrame, key: tuple[str, ...], rules: list[Column], n: int) -> DataFrame:
    """Rows and failures of each rule per value of a key that should not repeat,
    in ``n`` tasks."""
    dealt = df.select(*key, *[r.alias(f"_rule{i}") for i, r in enumerate(rules)]).repartition(n, *key)
    return dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"),
                                   *[F.count_if(f"_rule{i}").alias(f"_failed{i}") for i in range(len(rules))])


def _entry(check: int, rows: Column, key: Column | None = None, whole: bool = False, parent: bool = False) -> Column:
    key = F.lit(None) if key is None else key
    return F.struct(F.lit(check).alias("check"), (key if whole else F.lit(None)).cast("bigint").alias("whole"),
                    (F.lit(None) if whole else key).cast("string").alias("text"), rows.cast("bigint").alias("rows"),
                    F.lit(int(parent)).alias("parent"))


def _entries(table: str, checks: list[Check], tables: dict[str, DataFrame], rows: Callable[[str], int]) -> DataFrame:
    """(check, key, rows, parent) of one table: failures of its row and
    uniqueness checks, and its keys' counts for the relationships."""
    df = tables[table]
    own, child = [], []  # keys that should not repeat, and keys that do
    of_key = {}  # key: the entries that its counts give, as (needed, entry)
    rules = [(i, fail_condition(c)) for i, c in enumerate(checks) if c.table == table and c.kind in ROW_KINDS]

    def as_key(col, whole):
        dated = whole and isinstance(df.schema[col].dataType, T.DateType)
        return F.unix_date(F.col(col)) if dated else F.col(col)
    for i, c in enumerate(checks):
        if c.table == table:
            if c.kind in ("unique", "unique_combination"):
                known = F.lit(True) if c.kind == "unique_combination" else F.col(c.columns[0]).isNotNull()
                own.append(c.columns)
                of_key.setdefault(c.columns, []).append((known & (F.col("_rows") > 1), _entry(i, F.lit(1))))
            elif c.kind == "relationships":
                whole = _whole(df, c.columns[0]) and _whole(tables[c.parent], c.parent_column)
                child.append(c.columns[:1])
                of_key.setdefault(c.columns[:1], []).append((
                    F.col(c.columns[0]).isNotNull(), _entry(i, F.col("_rows"), as_key(c.columns[0], whole), whole)))
            elif c.kind not in ROW_KINDS:
                raise ValueError(c.kind)
        if c.kind == "relationships" and c.parent == table:
            whole = _whole(tables[c.table], c.columns[0]) and _whole(df, c.parent_column)
            own.append((c.parent_column,))
            of_key.setdefault((c.parent_column,), []).append((
                F.col(c.parent_column).isNotNull(), _entry(i, F.lit(0), as_key(c.parent_column, whole), whole, parent=True)))
    own = list(dict.fromkeys(own))
    parts = []  # counts and the entries read off their rows
    if len(own) == 1:
        counted = _per_key(df, own[0], [r for _, r in rules], max(1, -(-rows(table) // ROWS_PER_TASK)))
        found = of_key[own[0]] + [(F.col(f"_failed{j}") > 0, _entry(i, F.col(f"_failed{j}"))) for j, (i, _) in enumerate(rules)]
        parts.append((counted, [F.when(needed, entry) for needed, entry in found]))
        keys, rules = [k for k in dict.fromkeys(child) if k not in own], []
    else:
        keys = list(dict.fromkeys(own + child))
    if keys or rules:
        counted, ids = _counts(df, keys, [r for _, r in rules])
        found = [F.when((F.col("_set") == ids[at]) & needed, entry) for at, k in enumerate(keys) for needed, entry in of_key[k]]
        for j, (i, _) in enumerate(rules):
            at, bit = divmod(j, _BITS)
            failed = F.col(f"_flags{at}").bitwiseAND(F.lit(1 << bit)) != 0
            found.append(F.when((F.col("_set") == ids[len(keys) + at]) & failed, _entry(i, F.col("_rows"))))
        parts.append((counted, found))
    return reduce(DataFrame.unionByName, [
        counted.select(F.explode(F.filter(F.array(*found), lambda e: e.isNotNull())).alias("e")).select("e.*")
        for counted, found in parts])


def run_checks(checks: list[Check], tables: dict[str, DataFrame], rows: Callable[[str], int] | None = None) -> DataFrame:
    """All checks as one small result table.  ``rows`` gives a bound on a table's
    rows, from which its tasks are numbered; without it the tables are counted."""
    rows = rows or (lambda name: tables[name].count())
    names = dict.fromkeys(n for c in checks for n in (c.table, c.parent) if n is not None)
    entries = reduce(DataFrame.unionByName, [_entries(n, checks, tables, rows) for n in names])
    met = entries.groupBy("check", "whole", "text").agg(F.sum("rows").alias("rows"), F.max("parent").alias("parent"))
    total = met.groupBy("check").agg(F.sum("rows").alias("rows"),
                                     F.sum(F.when(F.col("parent") == 0, F.col("rows"))).alias("orphans"))
    listed = met.sparkSession.createDataFrame(
        [(i, c.name, c.table, c.severity, c.kind == "relationships") for i, c in enumerate(checks)],
        "check int, check_name string, table_name string, severity string, related boolean")
    failed = F.when(F.col("related"), F.col("orphans")).otherwise(F.col("rows"))
    out = listed.join(total, "check", "left").select(
        "check_name", "table_name", "severity", F.coalesce(failed, F.lit(0)).cast("long").alias("n_failed"))
    return out.withColumn("status", status(F.col("n_failed"), F.col("severity")))


# ---- SQL form of the same checks (used by the DuckDB oracle) ------------------

def _sql_lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else repr(v)


def check_sql(c: Check) -> str:
    """SELECT check_name, table_name, severity, n_failed for one check."""
    head = f"SELECT {_sql_lit(c.name)} AS check_name, {_sql_lit(c.table)} AS table_name, " \
           f"{_sql_lit(c.severity)} AS severity, CAST(count(*) AS BIGINT) AS n_failed"
    col = c.columns[0] if c.columns else None
    if c.kind == "not_null":
        return f"{head} FROM {c.table} WHERE {col} IS NULL"
    if c.kind == "accepted_values":
        vals = ", ".join(_sql_lit(v) for v in c.values)
        return f"{head} FROM {c.table} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals})"
    if c.kind == "between":
        conds = []
        if c.min_value is not None:
            conds.append(f"{col} >= {c.min_value!r}")
        if c.max_value is not None:
            conds.append(f"{col} <= {c.max_value!r}")
        return f"{head} FROM {c.table} WHERE {col} IS NOT NULL AND NOT ({' AND '.join(conds)})"
    if c.kind == "expression":
        return f"{head} FROM {c.table} WHERE coalesce({c.expression}, false)"
    if c.kind == "unique":
        return (f"{head} FROM (SELECT {col} FROM {c.table} WHERE {col} IS NOT NULL "
                f"GROUP BY {col} HAVING count(*) > 1)")
    if c.kind == "unique_combination":
        keys = ", ".join(c.columns)
        return f"{head} FROM (SELECT {keys} FROM {c.table} GROUP BY {keys} HAVING count(*) > 1)"
    if c.kind == "relationships":
        return (f"{head} FROM {c.table} ch WHERE ch.{col} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {c.parent} pa WHERE pa.{c.parent_column} = ch.{col})")
    raise ValueError(c.kind)


def checks_sql(checks: list[Check]) -> str:
    body = " UNION ALL ".join(check_sql(c) for c in checks)
    return (f"SELECT check_name, table_name, severity, n_failed, "
            f"CASE WHEN n_failed = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status "
            f"FROM ({body})")


# ---- freshness (SRC13 / DQ13) -------------------------------------------------

def freshness(df: DataFrame, table: str, ts_col: str, now: dt.datetime,
              warn_hours: int = 24, error_hours: int = 72) -> DataFrame:
    """Age of the newest ``ts_col`` relative to an explicit ``now``; stale when
    strictly older than the threshold."""
    return freshness_of(df.agg(F.max(ts_col).alias("max_loaded_at")), table, now, warn_hours, error_hours)


def freshness_of(newest: DataFrame, table: str, now: dt.datetime, warn_hours: int = 24, error_hours: int = 72) -> DataFrame:
    """``freshness`` of a one-row frame ``max_loaded_at`` (see ``sources.newest``)."""
    secs = X.whole_seconds_between(X.ntz(now), F.col("max_loaded_at"))
    return newest.select(
        F.lit(table).alias("table_name"), "max_loaded_at",
        secs.cast("long").alias("age_seconds"),
        F.when(F.col("max_loaded_at").isNull(), "error")
         .when(secs > error_hours * 3600, "error").when(secs > warn_hours * 3600, "warn")
         .otherwise("pass").alias("status"))
