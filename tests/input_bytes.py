"""Bytes that the first and the second run of each incremental fact read.

    python tests/input_bytes.py [sf_dir]

Runs the registered runs' parts under a job group each and adds up the bytes
read by their tasks from Spark's event log.
"""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_by_group(events: str) -> dict[str, list[int]]:
    """{job group: [bytes read, records read]}"""
    group_of, out = {}, {}
    for path in glob.glob(f"{events}/**/*", recursive=True):
        if not os.path.isfile(path) or os.path.basename(path).startswith((".", "appstatus")):
            continue
        for line in open(path):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                for s in e["Stage IDs"]:
                    group_of[s] = e["Properties"].get("spark.jobGroup.id")
            elif e["Event"] == "SparkListenerTaskEnd" and group_of.get(e["Stage ID"]):
                m = (e.get("Task Metrics") or {}).get("Input Metrics", {})
                got = out.setdefault(group_of[e["Stage ID"]], [0, 0])
                got[0] += m.get("Bytes Read", 0)
                got[1] += m.get("Records Read", 0)
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    run = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    os.makedirs(f"{run}/events")
    from shelfline import registry as R
    from shelfline.operators import incremental
    from shelfline.params import DEFAULT as p
    from shelfline.plans import core
    from shelfline.session import build_session
    spark = build_session(shuffle_partitions=16, checkpoint_dir=f"{run}/ckpt", extra={
        "spark.sql.warehouse.dir": f"{run}/warehouse", "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"{run}/events",
        "spark.eventLog.compress": "false"})
    w, dated = R._wh(spark, sf), R._dated(spark, sf)
    w.fct_order_items, w.fct_orders  # noqa: B018  (landed before the runs)
    full_snapshot = lambda as_of: core.fct_inventory_snapshot(
        w.stg_inventory_items, p.window_start, as_of, p.calendar_start, p.calendar_end)
    before = p.as_of - dt.timedelta(days=10)
    facts = {
        "fct_order_items": ("order_date", lambda _: core.fct_order_items(w.order_items_enriched).filter(
            f"order_date <= DATE'{before}'"), lambda path: dated.fct_order_items),
        "fct_orders": ("order_date", lambda _: core.fct_orders(w.stg_orders, w.fct_order_items).filter(
            f"order_date <= DATE'{before}'"), lambda path: lambda cutoff: dated.fct_orders(w.fct_order_items, cutoff)),
        "fct_inventory_snapshot": ("snapshot_date", lambda _: full_snapshot(before), lambda path: lambda cutoff:
                                   dated.fct_inventory_snapshot(spark, path, cutoff, p.as_of, p.calendar_start, p.calendar_end)),
    }
    seconds = {}
    for name, (day, first, second) in facts.items():
        path = f"{run}/{name}"
        for k, build in (("1", first), ("2", second(path))):
            spark.sparkContext.setJobGroup(f"{name} run {k}", name)
            t0 = time.time()
            incremental.build_incremental(spark, build, path, day, p.lookback_days, on_schema_change="sync_all_columns")
            seconds[f"{name} run {k}"] = time.time() - t0
    spark.stop()
    for group, (size, records) in sorted(read_by_group(f"{run}/events").items()):
        print(f"{group:34s} {size / 1024:12.0f} KiB {records:10d} records {seconds[group]:7.1f} s")


if __name__ == "__main__":
    main()
