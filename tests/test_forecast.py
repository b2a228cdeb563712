"""ML1-ML9: shape and sanity of the recursive forecast (no oracle)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from shelfline.plans import forecast


def _panel(spark, n_weeks=60, cats=("a", "b", "c")):
    rows = []
    start = dt.date(2000, 1, 3)
    for ci, c in enumerate(cats):
        hist = []
        for i in range(n_weeks):
            u = 20 + 10 * ci + (5 if i % 4 == 0 else 0)
            w = start + dt.timedelta(weeks=i)
            lag = lambda k: float(hist[-k]) if len(hist) >= k else None
            last4, last12 = hist[-4:], hist[-12:]
            m4 = sum(last4) / len(last4) if last4 else None
            m12 = sum(last12) / len(last12) if last12 else None
            s12 = (sum((x - m12) ** 2 for x in last12) / len(last12)) ** 0.5 if last12 else None
            rows.append((c, w, u, float(w.isocalendar()[1]), float(w.month), lag(1), lag(2), lag(4),
                         lag(8), m4, m12, s12, 100.0, 10.0, 5.0))
            hist.append(u)
    return spark.createDataFrame(rows, "category string, week_start_date date, units_sold long, "
                                       "week_of_year double, month_of_year double, lag_1w double, "
                                       "lag_2w double, lag_4w double, lag_8w double, roll_mean_4w double, "
                                       "roll_mean_12w double, roll_std_12w double, events_total double, "
                                       "events_purchase double, events_cart double")


def test_forecast_shape_and_non_negative(spark):
    panel = _panel(spark)
    fc = forecast.forecast_next(panel, horizon=4, p=forecast.GbtParams(max_iter=5))
    rows = fc.collect()
    assert len(rows) == 3 * 4
    assert all(r.predicted_units >= 0 for r in rows)
    assert {r.week_ahead for r in rows} == {1, 2, 3, 4}
    assert min(r.forecast_week for r in rows) == dt.date(2000, 1, 3) + dt.timedelta(weeks=60)


def test_step_one_features_equal_panel_features(spark):
    panel = _panel(spark)
    start = dt.date(2000, 1, 3) + dt.timedelta(weeks=30)
    state = forecast.history_state(panel, start)
    ev = forecast.recent_events(panel, start)
    feats = forecast.step_features(state, F.lit(start), ev).drop("hist", "forecast_week")
    want = panel.filter(F.col("week_start_date") == F.lit(start)).select(*feats.columns)
    for a, b in zip(sorted(feats.collect()), sorted(want.collect())):
        for x, y in zip(a, b):
            assert (x == y) or (isinstance(x, float) and abs(x - y) < 1e-9)


def test_backtest_beats_zero_forecast(spark):
    res = {r.horizon: r for r in forecast.backtest(_panel(spark), 4, forecast.GbtParams(max_iter=10)).collect()}
    assert set(res) == {"1", "2", "3", "4", "overall"}
    assert res["overall"].wape < 1.0 and res["overall"].n_points == 12


def test_metrics_file(spark, tmp_path):
    """SNK12: the shape of the published report."""
    panel = _panel(spark)
    start = forecast.held_out_start(panel, 4)
    scored = forecast.score(forecast.recent_mean(panel, start, 4), panel, start)
    path = str(tmp_path / "metrics")
    forecast.write_metrics(scored, path, 4, dt.datetime(2001, 8, 2, 7))
    [line] = [r.value for r in spark.read.text(path).collect()]
    got = json.loads(line)
    assert set(got) == {"per_horizon", "overall", "valid_start", "n_valid_points", "generated_at", "horizon"}
    assert [h["week_ahead"] for h in got["per_horizon"]] == [1, 2, 3, 4]
    assert set(got["per_horizon"][0]) == {"week_ahead", "mae", "wape"} and set(got["overall"]) == {"mae", "wape"}
    assert (got["valid_start"], got["n_valid_points"], got["horizon"]) == (start.isoformat(), 12, 4)
    assert got["generated_at"] == "2001-08-02T07:00:00"


def test_forecast_round_trip_feeds_recommendations(spark, tmp_path):
    """SNK11 -> SRC8: the written forecast reads back with the declared schema."""
    from shelfline import sources
    panel = _panel(spark)
    fc = forecast.forecast_next(panel, horizon=2, p=forecast.GbtParams(max_iter=3),
                                generated_at=dt.datetime(2001, 8, 2, 7))
    path = str(tmp_path / "ml_forecast_demand")
    forecast.write_forecast(fc, path)
    back = sources.read_forecast(spark, path)
    assert back.count() == 6 and back.filter("generated_at = '2001-08-02 07:00:00'").count() == 6


def _by_hand(step, panel, start, horizon, events):
    """The recursion in plain Python, one category after the other."""
    hist = {}
    for r in sorted(panel.collect(), key=lambda r: r.week_start_date):
        if r.week_start_date < start:
            hist.setdefault(r.category, []).append(float(r.units_sold))
    out = {}
    for c, h in hist.items():
        h = h[-12:]
        for k in range(horizon):
            week, last = start + dt.timedelta(weeks=k), h[-12:]
            mean = sum(last) / len(last)
            x = {"week_of_year": week.isocalendar()[1], "month_of_year": week.month, "lag_1w": h[-1], "lag_2w": h[-2],
                 "lag_4w": h[-4], "lag_8w": h[-8], "roll_mean_4w": sum(h[-4:]) / len(h[-4:]), "roll_mean_12w": mean,
                 "roll_std_12w": (sum((v - mean) ** 2 for v in last) / len(last)) ** 0.5, **events}
            p = max(0.0, step.intercept + sum(w * x[n] for n, w in step.weights))
            out[c, week, k + 1] = p
            h = h + [p]
    return out


def test_linear_recursion_by_hand_in_both_forms(spark):
    panel = _panel(spark, cats=("a", "b", "c", "d"))
    start, ev = dt.date(2000, 12, 11), panel.limit(1).selectExpr("50D AS events_total", "9D AS events_purchase", "4D AS events_cart")
    rising = forecast.LinearStep(60.25, forecast.BASELINE_STEP.weights)
    for step, clipped in ((forecast.BASELINE_STEP, True), (rising, False)):
        want = _by_hand(step, panel, start, 8, ev.first().asDict())
        assert any(p == 0 for p in want.values()) == clipped and any(want.values())
        for form in (forecast.recursive_forecast, forecast.recursive_sql):
            got = {(r.category, r.forecast_week, r.week_ahead): r.predicted_units for r in form(step, panel, start, 8, ev).collect()}
            assert got.keys() == want.keys()
            assert all(abs(got[k] - want[k]) <= 0.005 + 1e-9 for k in want)
