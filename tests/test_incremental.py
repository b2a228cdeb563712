"""SNK4 / SNK5 / SNK9: partition overwrite with a 3-day lookback."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfline.operators import incremental

D = dt.date


def _src(spark, rows):
    return spark.createDataFrame(rows, "id long, order_date date, status string")


def _files(path):
    out = {}
    for root, _, files in os.walk(path):
        for f in files:
            if f.endswith(".parquet"):
                p = os.path.join(root, f)
                out[p] = os.path.getmtime(p)
    return out


def test_empty_target_means_full_load(spark, tmp_table):
    assert incremental.lookback_cutoff(spark, tmp_table, "order_date", 3) is None
    src = _src(spark, [(1, D(2001, 1, 1), "a"), (2, D(2001, 1, 5), "a")])
    cut = incremental.build_incremental(spark, lambda since: src, tmp_table, "order_date")
    assert cut is None and spark.read.parquet(tmp_table).count() == 2


def test_lookback_picks_up_late_rows_and_leaves_old_partitions(spark, tmp_table):
    rows = [(i, D(2001, 1, 1) + dt.timedelta(days=i), "old") for i in range(10)]
    src = _src(spark, rows)
    incremental.build_incremental(spark, lambda since: src, tmp_table, "order_date")
    before = _files(tmp_table)
    # max date 2001-01-10 -> cutoff 2001-01-07: the 3-day-late row is picked up, the 4-day-late not
    late = rows + [(100, D(2001, 1, 7), "late3"), (101, D(2001, 1, 6), "late4")]
    new = _src(spark, [(i, d, "new" if d >= D(2001, 1, 7) else s) for i, d, s in late])

    def build(since):
        return new.filter(F.col("order_date") >= F.lit(since)) if since else new
    cut = incremental.build_incremental(spark, build, tmp_table, "order_date", lookback_days=3)
    assert cut == D(2001, 1, 7)
    t = spark.read.parquet(tmp_table)
    ids = {r.id for r in t.collect()}
    assert 100 in ids and 101 not in ids
    # partitions before the cutoff are untouched (same files, same mtimes)
    after = _files(tmp_table)
    old = {p: m for p, m in before.items() if "order_date=2001-01-0" in p
           and p.split("order_date=")[1][:10] < "2001-01-07"}
    assert old and all(after.get(p) == m for p, m in old.items())
    assert t.filter("order_date < '2001-01-07'").select("status").distinct().collect()[0].status == "old"


def _evolved(spark, path, mode, first, then):
    """Columns and rows of a table after a run with other columns (re-read)."""
    a = spark.createDataFrame([(1, D(2001, 1, 1), "a")], f"id long, order_date date, {first} string")
    b = spark.createDataFrame([(2, D(2001, 1, 9), "b")], f"id long, order_date date, {then} string")
    incremental.build_incremental(spark, lambda since: a, path, "order_date")
    incremental.build_incremental(spark, lambda since: b, path, "order_date", on_schema_change=mode)
    t = incremental.read_table(spark, path)
    return set(t.columns), {r.id: r.asDict() for r in t.collect()}


def test_schema_modes_on_reread(spark, tmp_path):
    cols, rows = _evolved(spark, str(tmp_path / "append"), "append_new_columns", "old", "new")
    assert cols == {"id", "order_date", "old", "new"}
    assert (rows[1]["old"], rows[1]["new"], rows[2]["old"], rows[2]["new"]) == ("a", None, None, "b")
    cols, rows = _evolved(spark, str(tmp_path / "sync"), "sync_all_columns", "old", "new")
    assert cols == {"id", "order_date", "new"} and (rows[1]["new"], rows[2]["new"]) == (None, "b")
    for mode in ("fail", "ignore"):
        with pytest.raises(ValueError, match="removed"):
            _evolved(spark, str(tmp_path / mode), mode, "old", "new")


def test_ignore_keeps_the_stored_columns(spark, tmp_table):
    a = _src(spark, [(1, D(2001, 1, 1), "a")])
    incremental.build_incremental(spark, lambda since: a, tmp_table, "order_date")
    incremental.build_incremental(spark, lambda since: a.withColumn("extra", F.lit(1)), tmp_table, "order_date")
    assert incremental.read_table(spark, tmp_table).columns == a.columns
    assert "extra" not in spark.read.option("mergeSchema", "true").parquet(tmp_table).columns


def test_a_strange_folder_is_not_overwritten(spark, tmp_table):
    _src(spark, [(1, D(2001, 1, 1), "a")]).write.parquet(tmp_table)
    with pytest.raises(ValueError, match="not a table partitioned"):
        incremental.build_incremental(spark, lambda since: _src(spark, []), tmp_table, "order_date")
    assert spark.read.parquet(tmp_table).count() == 1


def test_change_to_old_order_is_missed_until_full_refresh(spark, tmp_table):
    """the lookback only reprocesses recent partitions."""
    rows = [(i, D(2001, 1, 1) + dt.timedelta(days=i), "Processing") for i in range(10)]
    incremental.build_incremental(spark, lambda since: _src(spark, rows), tmp_table, "order_date")
    changed = [(i, d, "Complete" if i == 2 else s) for i, d, s in rows]   # old order changes

    def build(since):
        df = _src(spark, changed)
        return df.filter(F.col("order_date") >= F.lit(since)) if since else df
    incremental.build_incremental(spark, build, tmp_table, "order_date")
    assert spark.read.parquet(tmp_table).filter("id = 2").first().status == "Processing"
    incremental.build_incremental(spark, build, tmp_table, "order_date", full_refresh=True)
    assert spark.read.parquet(tmp_table).filter("id = 2").first().status == "Complete"


def test_types_by_schema_version(spark, tmp_table):
    """int -> bigint -> string over three runs; each partition keeps its own version's files."""
    def run(day, value, kind, mode="sync_all_columns"):
        df = spark.createDataFrame([(day, D(2001, 1, day), str(value))], "id long, order_date date, v string") \
            .withColumn("v", F.col("v").cast(kind))
        incremental.build_incremental(spark, lambda since: df, tmp_table, "order_date", 0, on_schema_change=mode)
    rows = lambda: sorted(tuple(r) for r in incremental.read_table(spark, tmp_table).select("id", "v").collect())
    run(1, 7, "int")
    run(2, 1 << 40, "bigint")
    assert rows() == [(1, 7), (2, 1 << 40)]
    assert [p for _, p in incremental.schema_versions(spark, tmp_table)] == [None, ["2001-01-02"]]
    run(3, "x", "string")
    assert rows() == [(1, "7"), (2, str(1 << 40)), (3, "x")]
    run(3, "y", "string")
    run(2, "z", "string")  # an old partition is written again under the newest schema
    assert rows() == [(1, "7"), (2, "z"), (3, "y")]
    assert [p for _, p in incremental.schema_versions(spark, tmp_table)] == [None, [], ["2001-01-02", "2001-01-03"]]
    run(9, "w", "string")
    plan = incremental.read_table(spark, tmp_table).filter("order_date = DATE'2001-01-09'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and rows()[-1] == (9, "w")


def test_types_in_append_ignore_and_fail(spark, tmp_path):
    frame = lambda kind, value, day: spark.createDataFrame([(D(2001, 1, day), value)], "order_date date, v string") \
        .withColumn("v", F.col("v").cast(kind))

    def two(name, mode, first, then):
        path = str(tmp_path / name)
        for day, (kind, value) in enumerate((first, then), 1):
            incremental.build_incremental(spark, lambda since: frame(kind, value, day), path, "order_date", on_schema_change=mode)
        t = incremental.read_table(spark, path)
        return t.schema["v"].dataType.simpleString(), sorted(str(r.v) for r in t.collect())
    assert two("wider", "append_new_columns", ("int", "1"), ("bigint", "5000000000")) == ("bigint", ["1", "5000000000"])
    assert two("narrower", "append_new_columns", ("bigint", "5000000000"), ("int", "1")) == ("bigint", ["1", "5000000000"])
    assert two("decimal", "append_new_columns", ("decimal(5,1)", "1.5"), ("decimal(9,2)", "2.25")) == ("decimal(9,2)", ["1.50", "2.25"])
    assert two("ignore", "ignore", ("bigint", "1"), ("int", "2")) == ("bigint", ["1", "2"])
    with pytest.raises(ValueError, match="holds the other"):
        two("apart", "append_new_columns", ("int", "1"), ("boolean", "true"))
    with pytest.raises(ValueError, match="of another type"):
        two("fail", "fail", ("int", "1"), ("bigint", "2"))
