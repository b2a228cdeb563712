"""Hierarchical demand forecast (ML1-ML9) on Spark ML.

* one global gradient-boosted tree model (absolute loss) over the category x
  week panel; the category is a nominal feature (StringIndexer metadata);
* recursive multi-step forecast: the state is one row per category with its
  unit history as ``array<double>``; each step derives the features with
  array functions, predicts with ``model.transform``, clips at 0 and appends
  the *unrounded* prediction (F13).  The driver only loops over the step
  index; rows stay distributed, nothing is collected;
* temporal back-test (hold out the last H weeks) with MAE / WAPE per horizon.

Spark's trees are depth-wise (maxDepth) where the original model grew 31
leaves leaf-wise, so predictions are not numerically identical.  Lags a
category does not have yet (fewer than k weeks of history) are NaN at
predict time, as in the original; Spark's trees send NaN down the
right-hand branch.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators.versioned import VersionedTable
from ..session import materialize
from ..sources.schemas import SCHEMAS

NUMERIC_FEATURES = ("week_of_year", "month_of_year", "lag_1w", "lag_2w", "lag_4w", "lag_8w",
                    "roll_mean_4w", "roll_mean_12w", "roll_std_12w", "events_total",
                    "events_purchase", "events_cart")
FEATURES = ("category",) + NUMERIC_FEATURES
TARGET = "units_sold"
EVENT_COLS = ("events_total", "events_purchase", "events_cart")
TRAIN_ROWS_PER_TASK = 50_000


@dataclass(frozen=True)
class GbtParams:
    """Fixed values of the original model configuration; ``max_iter`` is the
    tree count (400 in the original)."""
    max_iter: int = 400
    step_size: float = 0.05
    max_depth: int = 5
    min_instances_per_node: int = 20
    subsampling_rate: float = 0.8
    feature_subset: str = "0.8"
    seed: int = 42
    max_bins: int = 64


def _complete(panel: DataFrame) -> DataFrame:
    """FLT12: training rows need every feature."""
    return panel.dropna(subset=list(FEATURES) + [TARGET])


def held_out_start(panel: DataFrame, horizon: int) -> dt.date:
    """First of the last H weeks, which the back-test holds out."""
    return panel.agg(F.max("week_start_date")).first()[0] - dt.timedelta(weeks=horizon - 1)


def training_rows(panel: DataFrame, before: dt.date) -> DataFrame:
    """ML3 / FLT12-13: the complete rows before the held-out weeks."""
    return _complete(panel.filter(F.col("week_start_date") < F.lit(before)))


def train(panel: DataFrame, p: GbtParams = GbtParams()) -> PipelineModel:
    """ML1 + ML2."""
    data = _complete(panel).select(*FEATURES, F.col(TARGET).cast("double").alias("label"))
    # every tree level is a job over these rows: as few tasks as they need
    data = data.coalesce(max(1, -(-panel.count() // TRAIN_ROWS_PER_TASK)))
    n_cat = panel.select("category").distinct().count()
    idx = StringIndexer(inputCol="category", outputCol="category_idx", handleInvalid="keep")
    vec = VectorAssembler(inputCols=["category_idx", *NUMERIC_FEATURES], outputCol="features",
                          handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol="label", lossType="absolute",
                       maxIter=p.max_iter, stepSize=p.step_size, maxDepth=p.max_depth,
                       minInstancesPerNode=p.min_instances_per_node,
                       subsamplingRate=p.subsampling_rate,
                       featureSubsetStrategy=p.feature_subset, seed=p.seed,
                       maxBins=max(p.max_bins, n_cat + 1))
    return Pipeline(stages=[idx, vec, gbt]).fit(data)


def recent_events(panel: DataFrame, before: dt.date | Column) -> DataFrame:
    """ML5 / AGG20: mean over the last 4 weeks before ``before`` of the
    per-week event counts (one row).  The panel is dense (one row per
    category and week), so the last 4 distinct weeks are the weeks after
    ``last - 28 days``; no global ordering is needed."""
    b = F.lit(before) if isinstance(before, dt.date) else before
    hist = panel.filter(F.col("week_start_date") < b)
    last = hist.select(F.max("week_start_date")).scalar()
    per_week = hist.filter(F.col("week_start_date") > F.date_sub(last, 28)) \
        .groupBy("week_start_date").agg(*[F.first(c).alias(c) for c in EVENT_COLS])
    return per_week.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in EVENT_COLS])


HISTORY_WEEKS = 12  # lags go back 8 weeks and the widest rolling frame is 12


def history_state(panel: DataFrame, start_week: dt.date | Column) -> DataFrame:
    """SRT7: per category, the last 12 weekly units before ``start_week`` in
    week order.  Only those feed the features, so the per-category state is
    bounded (12 values) however long the history is; the panel is dense, so
    the last 12 rows are the weeks after ``start - 12 weeks``."""
    s = F.lit(start_week) if isinstance(start_week, dt.date) else start_week
    recent = panel.filter((F.col("week_start_date") < s)
                          & (F.col("week_start_date") >= F.date_sub(s, 7 * HISTORY_WEEKS)))
    h = recent.groupBy("category").agg(
        F.array_sort(F.collect_list(F.struct("week_start_date", F.col(TARGET).cast("double")
                                             .alias("u")))).alias("_h"))
    return h.select("category", F.transform("_h", lambda x: x["u"]).alias("hist"))


def _mean(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / F.size(arr)


def step_features(state: DataFrame, week: Column, events: DataFrame) -> DataFrame:
    """FN21 + FN22: the feature row of one future week from the history."""
    h = F.col("hist")
    n = F.size(h)
    nan = F.lit(float("nan"))

    def lag(k):
        return F.when(n >= k, F.element_at(h, -k)).otherwise(nan)
    last4 = F.slice(h, F.greatest(n - 3, F.lit(1)), 4)
    last12 = F.when(n >= 1, F.slice(h, F.greatest(n - 11, F.lit(1)), 12)).otherwise(F.array(F.lit(0.0)))
    m12 = _mean(last12)
    var12 = F.aggregate(last12, F.lit(0.0), lambda a, x: a + (x - m12) * (x - m12)) / F.size(last12)
    ev = {c: events.select(c).scalar() for c in EVENT_COLS}  # one-row frame -> scalar subqueries
    return state.select(
        "category", "hist", week.alias("forecast_week"),
        F.weekofyear(week).cast("double").alias("week_of_year"),
        F.month(week).cast("double").alias("month_of_year"),
        lag(1).alias("lag_1w"), lag(2).alias("lag_2w"), lag(4).alias("lag_4w"), lag(8).alias("lag_8w"),
        F.when(n >= 1, _mean(last4)).otherwise(nan).alias("roll_mean_4w"),
        m12.alias("roll_mean_12w"), F.sqrt(var12).alias("roll_std_12w"),
        *[ev[c].alias(c) for c in EVENT_COLS])


@dataclass(frozen=True)
class LinearStep:
    """A step model with given weights: ``transform`` adds ``prediction`` to the
    feature rows, like a fitted model's.  The recursion around it has a plain
    SQL form (``recursive_sql``), which a tree model has not."""
    intercept: float
    weights: tuple[tuple[str, float], ...]

    def transform(self, features: DataFrame) -> DataFrame:
        p = F.lit(self.intercept)
        for name, w in self.weights:
            p = p + F.lit(w) * F.col(name)
        return features.withColumn("prediction", p)

    def sql(self) -> str:
        """The prediction over columns named like the features."""
        return " + ".join([f"CAST({self.intercept!r} AS DOUBLE)", *[f"CAST({w!r} AS DOUBLE) * {name}" for name, w in self.weights]])


#: fixed weights that let some predictions fall below 0
BASELINE_STEP = LinearStep(-2.2360679775, (
    ("week_of_year", -0.0173205081), ("month_of_year", 0.0264575131), ("lag_1w", 0.6180339887), ("lag_2w", -0.4142135623),
    ("lag_4w", 0.3166247903), ("lag_8w", -0.7320508075), ("roll_mean_4w", 0.9544511501), ("roll_mean_12w", -0.2360679775),
    ("roll_std_12w", 0.1231056256), ("events_total", 0.0001414213), ("events_purchase", -0.0004472136),
    ("events_cart", 0.0002645751)))


def recursive_sql(step: LinearStep, panel: DataFrame, start_week: dt.date, horizon: int, events: DataFrame) -> DataFrame:
    """``recursive_forecast`` of a linear step as one recursive common table
    expression: a row per category and step holds the last 12 weeks' units."""
    ev = {c: f"(SELECT {c} FROM {{events}})" for c in EVENT_COLS}
    lag = lambda k: f"CASE WHEN size(hist) >= {k} THEN element_at(hist, -{k}) ELSE DOUBLE('NaN') END"
    total = "aggregate({0}, CAST(0 AS DOUBLE), (a, x) -> a + x)"
    last4 = "slice(hist, greatest(size(hist) - 3, 1), 4)"
    feats = {"week_of_year": "CAST(weekofyear(week) AS DOUBLE)", "month_of_year": "CAST(month(week) AS DOUBLE)",
             **{f"lag_{k}w": lag(k) for k in (1, 2, 4, 8)},
             "roll_mean_4w": f"{total.format(last4)} / size({last4})", "roll_mean_12w": "m12",
             "roll_std_12w": "sqrt(aggregate(hist, CAST(0 AS DOUBLE), (a, x) -> a + (x - m12) * (x - m12)) / size(hist))", **ev}
    listed = ", ".join(f"{sql} AS {name}" for name, sql in feats.items())
    # a step's week and mean, then its features, then its prediction, from the row of the step before
    return panel.sparkSession.sql(f"""
        WITH RECURSIVE steps (category, step, hist, units) AS (
          SELECT category, 0, hist, CAST(NULL AS DOUBLE) FROM {{state}}
          UNION ALL
          SELECT category, step + 1,
                 concat(slice(hist, greatest(size(hist) - {HISTORY_WEEKS - 2}, 1), {HISTORY_WEEKS - 1}), array(p)), p
          FROM (SELECT category, step, hist, greatest({step.sql()}, CAST(0 AS DOUBLE)) AS p
                FROM (SELECT category, step, hist, {listed}
                      FROM (SELECT category, step, hist, date_add(DATE'{start_week}', 7 * step) AS week,
                                   {total.format('hist')} / size(hist) AS m12
                            FROM steps WHERE step < {horizon}))))
        SELECT category, date_add(DATE'{start_week}', 7 * (step - 1)) AS forecast_week, CAST(step AS BIGINT) AS week_ahead,
               round(units, 2) AS predicted_units
        FROM steps WHERE step > 0""", state=history_state(panel, start_week), events=events)


def recursive_forecast(model: PipelineModel | LinearStep, panel: DataFrame, start_week: dt.date, horizon: int,
                       events: DataFrame) -> DataFrame:
    """ML4: H recursive steps per category, all categories at once.  Each step
    (one row per category) is materialized, so no step runs twice."""
    state = history_state(panel, start_week)
    steps = []
    for h in range(horizon):
        week = F.date_add(F.lit(start_week), 7 * h)
        feats = step_features(state, week, events)
        pred = model.transform(feats).withColumn("_p", F.greatest(F.col("prediction"), F.lit(0.0)))
        pred = materialize(pred.select("category", "hist", "forecast_week", "_p"))
        steps.append(pred.select("category", "forecast_week", F.lit(h + 1).cast("long").alias("week_ahead"),
                                 F.round("_p", 2).alias("predicted_units")))
        appended = F.concat("hist", F.array("_p"))
        state = pred.select("category", F.slice(appended, F.greatest(F.size(appended) - (HISTORY_WEEKS - 1),
                                                                     F.lit(1)), HISTORY_WEEKS).alias("hist"))
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return out


def recent_mean(panel: DataFrame, start_week: dt.date, horizon: int) -> DataFrame:
    """Baseline: every week ahead takes the mean of the category's last 4 weeks."""
    state = history_state(panel, start_week)
    last4 = F.slice("hist", F.greatest(F.size("hist") - 3, F.lit(1)), 4)
    ahead = F.sequence(F.lit(1).cast("long"), F.lit(horizon).cast("long"))
    return state.select("category", F.round(_mean(last4), 2).alias("predicted_units"),
                        F.explode(ahead).alias("week_ahead")) \
        .withColumn("forecast_week", F.date_add(F.lit(start_week), 7 * (F.col("week_ahead").cast("int") - 1)))


def score(fc: DataFrame, panel: DataFrame, valid_start: dt.date) -> DataFrame:
    """ML6 / AGG19: MAE (2 dp) and WAPE (4 dp) of a forecast per horizon and
    overall, in one aggregation; no rows where nothing can be compared."""
    actual = panel.filter(F.col("week_start_date") >= F.lit(valid_start)).select(
        F.col("category").alias("_c"), F.col("week_start_date").alias("_w"), TARGET)
    m = fc.join(actual, (fc.category == actual._c) & (fc.forecast_week == actual._w), "inner")
    err = F.abs(F.col("predicted_units") - F.col(TARGET))
    return (m.select(F.col("week_ahead").cast("string").alias("horizon"), TARGET, err.alias("_err"))
            .rollup("horizon").agg(
                F.round(F.avg("_err"), 2).alias("mae"),
                F.round(F.sum("_err") / F.greatest(F.sum(TARGET), F.lit(1)), 4).alias("wape"),
                F.count(F.lit(1)).alias("n_points"))
            .withColumn("horizon", F.coalesce("horizon", F.lit("overall")))
            .withColumn("valid_start", F.lit(valid_start)))


def backtest(panel: DataFrame, horizon: int = 8, p: GbtParams = GbtParams()) -> DataFrame:
    """ML3 + ML6: train before the last H weeks, forecast them recursively, score."""
    valid_start = held_out_start(panel, horizon)
    model = train(training_rows(panel, valid_start), p)
    ev = recent_events(panel, valid_start)
    return score(recursive_forecast(model, panel, valid_start, horizon, ev), panel, valid_start)


def forecast_next(panel: DataFrame, horizon: int = 8, p: GbtParams = GbtParams(),
                  generated_at: dt.datetime | None = None, model_name: str = "spark_gbt_l1_v1") -> DataFrame:
    """ML7 + ML8: refit on all complete history, forecast the next H weeks and
    add the publishing columns (SNK11)."""
    model = train(panel, p)
    max_week = panel.agg(F.max("week_start_date")).first()[0]
    start = max_week + dt.timedelta(weeks=1)
    fc = recursive_forecast(model, panel, start, horizon, recent_events(panel, start))
    gen = X.ntz(generated_at) if generated_at is not None else F.lit(None).cast("timestamp_ntz")
    return fc.withColumn("generated_at", gen) \
             .withColumn("model", F.lit(model_name))


def write_forecast(fc: DataFrame, path: str) -> None:
    """SNK11: truncate-and-load.  The rows are staged in a folder of their own
    and the table is switched to them, so readers see the old forecast or the
    new one, and a failed run leaves the old one."""
    columns = SCHEMAS["ml_forecast_demand"]
    rows = fc.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns.fields])
    VersionedTable(fc.sparkSession, path).replace(lambda old: rows)


def metrics_report(metrics: DataFrame, horizon: int, generated_at: dt.datetime) -> DataFrame:
    """SNK12: the back-test's rows (one per horizon and one overall) as one
    nested row: per_horizon, overall, valid_start, n_valid_points,
    generated_at, horizon."""
    whole = F.col("horizon") == "overall"
    step = F.struct(F.expr("try_cast(horizon AS BIGINT)").alias("week_ahead"), "mae", "wape")
    return metrics.agg(
        F.array_sort(F.collect_list(F.when(~whole, step))).alias("per_horizon"),
        F.max(F.when(whole, F.struct("mae", "wape"))).alias("overall"),
        F.max("valid_start").cast("string").alias("valid_start"),
        F.max(F.when(whole, F.col("n_points"))).alias("n_valid_points"),
        F.lit(generated_at.isoformat()).alias("generated_at"),
        F.lit(horizon).cast("long").alias("horizon"))


def write_metrics(metrics: DataFrame, path: str, horizon: int, generated_at: dt.datetime) -> None:
    """SNK12: the report as one line of JSON."""
    metrics_report(metrics, horizon, generated_at).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The published report as one row per horizon and one overall."""
    report = spark.read.schema(METRICS_SCHEMA).json(path)
    whole = F.array(F.struct(F.lit(None).cast("bigint").alias("week_ahead"), F.col("overall.mae").alias("mae"),
                             F.col("overall.wape").alias("wape")))
    return report.select(F.explode(F.concat("per_horizon", whole)).alias("r"), "valid_start", "n_valid_points", "horizon") \
        .select("r.week_ahead", "r.mae", "r.wape", F.col("valid_start").cast("date").alias("valid_start"), "n_valid_points", "horizon")


#: declared schema of the published report
METRICS_SCHEMA = ("per_horizon array<struct<week_ahead: bigint, mae: double, wape: double>>, "
                  "overall struct<mae: double, wape: double>, valid_start string, n_valid_points bigint, "
                  "generated_at string, horizon bigint")
