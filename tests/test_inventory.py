"""K3: event-based dense balances equal the grid formulation (MOD9, WIN5)."""

import datetime as dt

import pandas as pd

from shelfline.operators import inventory

D = dt.date
WS, ASOF = D(2001, 7, 1), D(2001, 7, 10)
CAL = (D(1994, 1, 1), D(2002, 12, 31))


def _brute(units, ws, as_of):
    """Reference grid: every pair x every day, opening at the window start."""
    days = pd.date_range(ws, as_of).date
    pairs = sorted({(u[0], u[1]) for u in units})
    out = []
    for p, c in pairs:
        mine = [u for u in units if (u[0], u[1]) == (p, c)]
        for day in days:
            n = sum(1 for u in mine if u[3] is not None and u[3] <= day) \
                - sum(1 for u in mine if u[4] is not None and u[4] <= day)
            cost = sum(u[2] for u in mine if u[3] is not None and u[3] <= day) \
                - sum(u[2] for u in mine if u[4] is not None and u[4] <= day)
            out.append((p, c, day, n, float(cost)))
    return sorted(out)


UNITS = [
    # product, centre, cost, in, out
    (1, 0, 10.0, D(2001, 6, 1), D(2001, 7, 5)),    # in before the window, out inside
    (1, 0, 12.0, D(2001, 5, 1), D(2001, 6, 15)),   # out before the window
    (1, 0, 11.0, D(2001, 7, 3), D(2001, 7, 3)),    # in and out the same day
    (2, 1, 5.0, D(2001, 7, 20), None),              # in after as_of
    (2, 1, 6.0, None, D(2001, 7, 4)),               # unknown in date, sold inside
    (3, 2, 7.0, D(2001, 7, 2), None),               # stays in stock
]


def test_daily_balances_equal_grid(spark):
    df = spark.createDataFrame(UNITS, "product_id long, distribution_center_id long, cost double, "
                                      "in_date date, out_date date")
    got = inventory.daily_balances(df, WS, ASOF, *CAL).collect()
    got = sorted((r.product_id, r.distribution_center_id, r.snapshot_date, r.units_on_hand,
                  float(r.inventory_cost_on_hand)) for r in got)
    assert got == _brute(UNITS, WS, ASOF)
    assert len(got) == 3 * 10


def test_latest_equals_last_day(spark):
    df = spark.createDataFrame(UNITS, "product_id long, distribution_center_id long, cost double, "
                                      "in_date date, out_date date")
    full = inventory.daily_balances(df, WS, ASOF, *CAL).filter(f"snapshot_date = '{ASOF}'")
    last = inventory.latest_balances(df, WS, ASOF, *CAL)
    assert full.exceptAll(last.select(*full.columns)).count() == 0
    assert last.count() == 3


def test_incremental_cutoff_is_exact(spark):
    """building from a later window start reproduces the tail of the full run."""
    df = spark.createDataFrame(UNITS, "product_id long, distribution_center_id long, cost double, "
                                      "in_date date, out_date date")
    cut = D(2001, 7, 6)
    full = inventory.daily_balances(df, WS, ASOF, *CAL).filter(f"snapshot_date >= '{cut}'")
    inc = inventory.daily_balances(df, cut, ASOF, *CAL)
    assert full.exceptAll(inc).count() == 0 and inc.exceptAll(full).count() == 0


def test_window_outside_calendar_is_empty(spark):
    df = spark.createDataFrame(UNITS, "product_id long, distribution_center_id long, cost double, "
                                      "in_date date, out_date date")
    assert inventory.daily_balances(df, D(2030, 1, 1), D(2030, 2, 1), *CAL).count() == 0
