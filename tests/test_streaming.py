"""STR1: the streaming weekly event counts equal the batch aggregation."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from shelfline import streaming
from shelfline.plans import marts


def test_weekly_event_counts_stream_equals_batch(spark, tmp_path):
    rows = [(i, dt.datetime(2001, 7, 1) + dt.timedelta(hours=7 * i),
             ["cart", "purchase", "view"][i % 3]) for i in range(120)]
    ev = spark.createDataFrame(rows, "event_id long, created_at timestamp_ntz, event_type string")
    src = str(tmp_path / "events")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    out, ck = str(tmp_path / "weekly"), str(tmp_path / "ck")
    streaming.write_touched_weeks(streaming.weekly_event_counts(stream), out, ck).awaitTermination()
    got = spark.read.parquet(out)
    want = marts.weekly_events(ev)
    assert got.count() == want.count() > 1
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    # weeks start on Mondays
    assert {r.week_start_date.weekday() for r in got.collect()} == {0}


def test_late_events_over_several_batches(spark, tmp_path):
    """Late rows count up to the watermark; later ones don't."""
    schema = "event_id long, created_at timestamp_ntz, event_type string"
    mon = dt.datetime(2001, 7, 2)
    src, out, ck = (str(tmp_path / n) for n in ("events", "weekly", "ck"))
    batches = [[(1, mon, "cart"), (2, mon + dt.timedelta(days=15), "view")],
               [(5, mon + dt.timedelta(days=16), "cart")],
               # Spark refuses late rows by the watermark its previous batch ended with
               [(3, mon + dt.timedelta(days=13), "purchase"),   # 3 days late: its week is still open
                (4, mon + dt.timedelta(days=1), "view")]]       # two weeks late
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = streaming.write_touched_weeks(streaming.weekly_event_counts(stream), out, ck)
    q.awaitTermination()
    got = {r.week_start_date: (r.events_total, r.events_purchase, r.events_cart)
           for r in spark.read.parquet(out).collect()}
    week = lambda n: mon.date() + dt.timedelta(weeks=n)
    assert got == {week(0): (1, 0, 1), week(1): (1, 1, 0), week(2): (2, 0, 1)}


def test_upkeep_replaces_only_the_touched_dates(spark, tmp_path):
    """STR2 over two batches: a touched date is rebuilt whole, others keep their files."""
    facts = [(i, dt.date(2001, 1, 1 + i % 3), i * 10) for i in range(9)]
    full = spark.createDataFrame(facts, "id long, order_date date, amount long")
    src, out, ck = (str(tmp_path / n) for n in ("changes", "fact", "ck"))
    read = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src)

    def touched(batch):
        return batch.join(full, "id").select("order_date")

    def run(table):
        streaming.upkeep_partitions(read(), touched, lambda dates: table.join(dates, "order_date", "left_semi"),
                                    out, "order_date", ck).awaitTermination()
    for ids in ([0, 1], [2]):  # two batches touch all three dates
        spark.createDataFrame([(i,) for i in ids], "id long").coalesce(1).write.mode("append").parquet(src)
    run(full)
    assert sorted((r.id, r.order_date, r.amount) for r in spark.read.parquet(out).collect()) == facts
    kept = {f: os.path.getmtime(f) for f in map(str, (tmp_path / "fact").glob("order_date=2001-01-0[13]/*.parquet"))}
    spark.createDataFrame([(4,)], "id long").coalesce(1).write.mode("append").parquet(src)
    changed = full.withColumn("amount", full.amount + 1)
    run(changed)
    got = {r.id: r.amount for r in spark.read.parquet(out).collect()}
    assert got == {i: a + (d == dt.date(2001, 1, 2)) for i, d, a in facts}
    assert kept and all(os.path.getmtime(f) == m for f, m in kept.items())


def test_repeated_and_failed_batches(spark, tmp_path):
    """A batch in the ledger is left out; one that failed before it is written again."""
    full = spark.createDataFrame([(i, dt.date(2001, 1, 1 + i % 3)) for i in range(9)], "id long, order_date date")
    out, ledger = str(tmp_path / "fact"), streaming.BatchLedger(spark, str(tmp_path / "ledger"))
    runs = []

    def rebuild(dates, fail=False):
        runs.append(sorted(r.order_date.day for r in dates.collect()))
        if fail:
            raise RuntimeError("executor lost")
        return full.join(dates, "order_date", "left_semi")
    batch = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long").join(full, "id")
    one = lambda b, n, f=rebuild: streaming.upkeep_batch(b, n, lambda x: x, f, out, "order_date", ledger=ledger)
    assert one(batch(0), 0) and not one(batch(0), 0)
    with pytest.raises(RuntimeError):
        one(batch(1, 4), 1, lambda dates: rebuild(dates, True))
    assert not ledger.holds(1) and one(batch(1, 4), 1)
    assert runs == [[1], [2], [2]] and ledger.batches() == [0, 1]
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 3, 4, 6, 7]


def test_upkeep_reads_the_months_of_a_batch(spark, tmp_path):
    from shelfline.plans import slices
    days = [dt.date(2001, 1, 1) + dt.timedelta(days=7 * k) for k in range(50)]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id long, order_date date") \
        .withColumn("order_date_month", F.trunc("order_date", "month"))
    table = slices.lay_out(rows, str(tmp_path / "rows"), "order_date", "id")
    src, out, ck, plans = (str(tmp_path / n) for n in ("changes", "fact", "ck", "plans"))
    plans = []
    for part in (days[:3], days[30:33]):
        spark.createDataFrame([(d,) for d in part], "order_date date").coalesce(1).write.mode("append").parquet(src)

    def rebuild(dates):
        df = slices.on_days(table, "order_date", dates)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df.drop("order_date_month")
    stream = spark.readStream.schema("order_date date").option("maxFilesPerTrigger", 1).parquet(src)
    streaming.upkeep_partitions(stream, lambda b: b, rebuild, out, "order_date", ck).awaitTermination()
    assert sorted(r.order_date for r in spark.read.parquet(out).collect()) == days[:3] + days[30:33]
    folders = [re.search(r"PartitionFilters: \[(.*?)\], ", p).group(1) for p in plans]
    assert "2001-01-01" in folders[0] and "2001-08-01" not in folders[0]
    assert "2001-08-01" in folders[1] and "2001-01-01" not in folders[1]
