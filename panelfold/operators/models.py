"""Spark ML regressors and classifier, their scores and their tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelfold.functions.scalars import category_rank, half_even
from panelfold.operators import forest as by_node
from panelfold.operators.features import assemble
from panelfold.operators.quantiles import exact_quantiles, order_statistics
from panelfold.session import scratch_dir, stage

# Model settings.
RIDGE_ALPHA = 1.0
FOREST = {"numTrees": 300, "maxDepth": 14, "seed": 42}
BOOSTED = {"maxIter": 300, "stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.85, "featureSubsetStrategy": "0.85", "seed": 42}
RISK_FOREST = {"numTrees": 200, "maxDepth": 10, "seed": 42}
RISK_LEVELS = ("Low", "Medium", "High", "Critical")
RISK_NAME = "RandomForest_RiskClassifier"
FORECAST_NAME = "Boosted_LifeExpectancyForecaster"

# Twice the smallest node that may be split: both halves keep at least this many rows.
MIN_ROWS_PER_NODE = 2

# How the work of a fit is cut.  Each task of a forest's fit sends on the histograms of every node, however few of its
# rows are there, so more tasks a fit are more work: they are as few as their rows allow, and several fits run at once.
FEW_ROWS = 10_000  # up to here a table is fitted as it lies, in one fit
TASK_ROWS = 1 << 18
FIT_TREES = 25
MANY_ROWS = 1 << 16  # beyond them a regression forest's nodes are grown where their rows are, by ``operators.forest``


@dataclass(frozen=True)
class Fitted:
    """A model with the feature names it was trained on."""

    name: str
    model: Model
    features: list[str]

    def predict(self, df: DataFrame) -> DataFrame:
        return self.model.transform(assemble(df, self.features)).drop("features")


class GrownForest(Fitted):
    """A forest whose trees are staged tables, read as Spark's model when that is asked for."""

    def __init__(self, name: str, trees: by_node.Grown, features: list[str]) -> None:
        self.__dict__.update(name=name, trees=trees, features=features)

    @cached_property
    def model(self) -> Model:
        return self.trees.model()


def _checkpointed(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch_dir(spark), f"ml-{uuid.uuid4().hex}"))


def _parts(rows: DataFrame, least: int = 1) -> int:
    """Tasks that ``rows`` are dealt to, ``least`` or more; 0 for a table of few rows, which stays as it lies."""
    n = rows.count()
    return 0 if n <= FEW_ROWS else max(least, -(-n // TASK_ROWS))


def _grown(forest: Estimator, rows: DataFrame) -> Model:
    """The model of ``forest``, whose trees are grown by several fits of FIT_TREES, each with a seed of its own.

    No tree depends on another, so as many fits run at once as their tasks leave cores idle; what a fit holds of a
    row grows with its own trees only.  All trees see all rows.
    """
    needed = [forest.getFeaturesCol(), forest.getLabelCol(), *([forest.getWeightCol()] if forest.isDefined("weightCol") else [])]
    wanted, parts = forest.getNumTrees(), _parts(rows)
    if not parts or wanted <= FIT_TREES:
        return forest.fit(rows)
    sc = rows.sparkSession.sparkContext
    dealt = rows.select(*needed).repartition(parts)
    sizes = [min(FIT_TREES, wanted - i) for i in range(0, wanted, FIT_TREES)]
    # far apart, as a task's own seed is the fit's and the task's number
    fits = [forest.copy({forest.numTrees: n, forest.seed: forest.getSeed() + 1_000_003 * i}) for i, n in enumerate(sizes)]
    grow = inheritable_thread_target(rows.sparkSession)(lambda f: f.fit(dealt))
    pool = ThreadPool(min(len(fits), max(1, sc.defaultParallelism // parts)))
    try:
        models = pool.map(grow, fits, chunksize=1)
    finally:
        pool.close()
    grown = [t for m in models for t in m._java_obj.trees()]
    first = models[0]._java_obj
    kind = reduce(getattr, grown[0].getClass().getName().split("."), sc._jvm)
    trees = JavaWrapper._new_java_array(grown, kind)
    sizes = [first.numFeatures(), *([first.numClasses()] if hasattr(models[0], "numClasses") else [])]
    made = JavaWrapper._new_java_obj(first.getClass().getName(), forest.uid, trees, *sizes)
    return forest._copyValues(type(models[0])(made))


def fit_ridge(train: DataFrame, features: Sequence[str], label: str, alpha: float = RIDGE_ALPHA) -> Fitted:
    """Ridge on already standardised features.

    Spark divides the loss by the rows and scales the label by its deviation, so the penalty is
    ``alpha * deviation / rows``.
    """
    n, sd = train.agg(F.count(label), F.stddev_pop(label)).first()
    reg = LinearRegression(
        labelCol=label,
        elasticNetParam=0.0,
        regParam=alpha * (sd or 0.0) / max(n, 1),
        solver="normal",
        standardization=False,
    )
    return Fitted("Ridge Regression", reg.fit(assemble(train, features)), list(features))


def fit_forest(train: DataFrame, features: Sequence[str], label: str, **settings) -> Fitted:
    _checkpointed(train.sparkSession)
    settings = {"minInstancesPerNode": MIN_ROWS_PER_NODE, **FOREST, **settings}
    reg = RandomForestRegressor(labelCol=label, cacheNodeIds=True, checkpointInterval=10, **settings)
    rows = assemble(train, features)
    if rows.count() > MANY_ROWS:
        return GrownForest("Random Forest", by_node.grow(reg, rows), list(features))
    return Fitted("Random Forest", _grown(reg, rows), list(features))


def fit_boosted(train: DataFrame, features: Sequence[str], label: str, **settings) -> Fitted:
    _checkpointed(train.sparkSession)
    reg = GBTRegressor(labelCol=label, checkpointInterval=10, **{**BOOSTED, **settings})
    rows = assemble(train, features)
    parts = _parts(rows, rows.sparkSession.sparkContext.defaultParallelism)
    if parts:  # every round waits for its fullest task
        rows = rows.select(label, "features").repartition(parts)
    return Fitted("Boosted Trees", reg.fit(rows), list(features))


def regression_scores(predicted: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """r2, rmse, mae and mape (percent) from one aggregation; NULL r2 for a constant label."""
    y, p = F.col(label), F.col(prediction)
    err = y - p
    eps = 2.220446049250313e-16
    return predicted.groupBy(*by).agg(
        (F.lit(1.0) - F.try_divide(F.sum(err * err), F.var_pop(y) * F.count(y))).alias("r2"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.avg(F.abs(err) / F.greatest(F.abs(y), F.lit(eps))) * 100.0).alias("mape"),
        F.count(y).alias("n"),
    )


def champion(scores: DataFrame, name: str = "model", score: str = "r2") -> DataFrame:
    """The best model; equal scores go to the first name."""
    best = F.max_by(F.struct(*scores.columns), F.struct(F.col(score)))
    ranked = scores.groupBy(score).agg(F.min_by(F.struct(*scores.columns), name).alias("r")).select("r.*")
    return ranked.agg(best.alias("r")).select("r.*")


def importance(fitted: Fitted, spark: SparkSession, top: int | None = None) -> DataFrame:
    """Share of each feature in percent: tree importance, or absolute coefficients over their sum."""
    if isinstance(fitted, GrownForest):
        shares = [v * 100.0 for v in fitted.trees.shares()]
    elif hasattr(fitted.model, "featureImportances"):
        raw = fitted.model.featureImportances.toArray()
        shares = [float(v) * 100.0 for v in raw]
    else:
        raw = [abs(float(v)) for v in fitted.model.coefficients.toArray()]
        total = sum(raw) or 1.0
        shares = [v / total * 100.0 for v in raw]
    out = spark.createDataFrame(list(zip(fitted.features, shares)), "feature string, importance_pct double")
    out = out.orderBy(F.col("importance_pct").desc(), "feature")
    return out if top is None else out.limit(top)


def prediction_table(
    predicted: DataFrame, keys: Sequence[str], label: str, prediction: str, dim: DataFrame, key: str, rounded: bool = True
) -> DataFrame:
    """Actual, predicted, error and absolute error with the entity's names.

    ``rounded`` takes the error from the two-digit prediction, otherwise from the raw one.
    """
    guess = half_even(prediction, 2) if rounded else F.col(prediction)
    rows = predicted.select(*keys, F.col(label).alias("actual"), guess.alias("predicted"))
    rows = rows.withColumn("error", half_even(F.col("actual") - F.col("predicted"), 2) if rounded else F.col("actual") - F.col("predicted"))
    return rows.withColumn("abs_error", F.abs("error")).join(dim, key, "left")


def residuals(predicted: DataFrame, label: str, prediction: str) -> DataFrame:
    return predicted.withColumn("residual", F.col(label) - F.col(prediction))


def risk_bounds(train: DataFrame, score: str) -> list[float] | None:
    """Quartiles of a score over the training rows; none without a known score."""
    row = exact_quantiles(train, [], [score], [0.25, 0.5, 0.75]).select("quantiles").first()
    return None if row is None else list(row[0])


def risk_labels(df: DataFrame, score: str, bounds: Sequence[float] | None, out: str = "risk") -> DataFrame:
    """Low, Medium, High or Critical by given quartiles.  The quartile rule is this library's choice."""
    if bounds is None:
        return df.withColumn(out, F.lit(None).cast("string"))
    q1, q2, q3 = bounds
    s = F.col(score)
    label = F.when(s <= q1, RISK_LEVELS[0]).when(s <= q2, RISK_LEVELS[1]).when(s <= q3, RISK_LEVELS[2]).when(s > q3, RISK_LEVELS[3])
    return df.withColumn(out, label)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight rows / (classes x rows of the class).  The classes are the risk levels, so one row each is collected."""
    counts = {r[0]: r[1] for r in df.where(F.col(label).isin(*RISK_LEVELS)).groupBy(label).count().collect()}
    total, classes = sum(counts.values()), len(counts)
    w: Column = F.lit(None).cast("double")
    for value, n in counts.items():
        w = F.when(F.col(label) == F.lit(value), F.lit(total / (classes * n))).otherwise(w)
    return df.withColumn(out, w)


def fit_risk(train: DataFrame, features: Sequence[str], risk: str = "risk", **settings) -> Fitted:
    """Random forest classifier with balanced class weights."""
    _checkpointed(train.sparkSession)
    rows = balanced_weights(train.withColumn("label", (category_rank(risk, RISK_LEVELS) - 1).cast("double")), risk)
    clf = RandomForestClassifier(labelCol="label", weightCol="weight", cacheNodeIds=True, **{**RISK_FOREST, **settings})
    return Fitted(RISK_NAME, _grown(clf, assemble(rows, features)), list(features))


def risk_table(fitted: Fitted, df: DataFrame, key: str) -> DataFrame:
    """Predicted category and its probability per row."""
    p = vector_to_array("probability")
    out = fitted.predict(df)
    names = F.array(*[F.lit(x) for x in RISK_LEVELS])
    return out.select(
        key,
        F.lit(RISK_NAME).alias("model_name"),
        F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted_risk_cat"),
        F.array_max(p).alias("risk_probability"),
    )


def classifier_scores(fitted: Fitted, df: DataFrame, risk: str = "risk") -> dict[str, float]:
    rows = fitted.predict(df.withColumn("label", (category_rank(risk, RISK_LEVELS) - 1).cast("double")))
    return label_scores(stage(rows.select("label", "prediction"), "judged"))  # read by each score


def label_scores(rows: DataFrame) -> dict[str, float]:
    """Accuracy and F1 (weighted by the classes' rows) of ``prediction`` against ``label``, both as class numbers."""
    ev = MulticlassClassificationEvaluator(labelCol="label")
    return {m: ev.evaluate(rows, {ev.metricName: m}) for m in ("accuracy", "f1")}


def forecast_frame(df: DataFrame, key: str, period: str, target: str) -> DataFrame:
    """Current value, those of one and two periods before, their change, and the next period's value as the label.

    Neighbours are by the calendar: across a gap they are NULL.  A repeated (key, period) fails the job, which
    also bounds the rows of a key.
    """
    w = Window.partitionBy(key).orderBy(period)
    p, v = F.col(period), F.col(target)
    again = F.lag(period).over(w) == p

    def at(distance: int, rows: int) -> Column:
        return F.when(F.lag(period, rows).over(w) == p - distance, F.lag(target, rows).over(w))

    out = df.withColumns(
        {
            period: F.when(again, F.raise_error(F.lit("repeated (key, period)")).cast(df.schema[period].dataType)).otherwise(p),
            f"{target}_lag1": at(1, 1),
            f"{target}_lag2": F.coalesce(at(2, 2), at(2, 1)),
            "next": F.when(F.lead(period).over(w) == p + 1, F.lead(target).over(w)),
        }
    )
    return out.withColumn(f"{target}_delta", v - F.col(f"{target}_lag1"))


def conformal_bounds(rows: DataFrame, by: Sequence[str] = (), residual: str = "residual", coverage: float = 0.95) -> DataFrame:
    """(by, n, low, high): the ends of residuals that a further one of the group falls between with the wanted chance.

    They are the group's own residuals at the ranks that hold for any distribution, if the rows are
    exchangeable: the floor((n + 1) a)-th and the ceil((n + 1) (1 - a))-th with a tail of a on each side.  NULL where the
    group has too few residuals for such a rank.
    """
    if not by:
        return conformal_bounds(rows.withColumn("__all", F.lit(0)), ["__all"], residual, coverage).drop("__all")
    tail = (1.0 - coverage) / 2.0
    low, high = lambda n: F.floor((n + 1) * tail + 1e-9) - 1, lambda n: F.ceil((n + 1) * (1.0 - tail) - 1e-9) - 1
    at = order_statistics(rows, by, [residual], lambda n: [low(n), high(n)])
    ends = at.select(*[F.col(b).alias(f"__{b}") for b in by], *[F.try_element_at("at", f(F.col("n")).cast("bigint")).alias(c) for c, f in (("low", low), ("high", high))])
    sizes = rows.groupBy(*by).agg(F.count(residual).alias("n"))
    same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by])
    return sizes.join(F.broadcast(ends), same, "left").select(*by, "n", "low", "high")  # one row a group


def coverage(rows: DataFrame, bounds: DataFrame, by: str, residual: str = "residual") -> DataFrame:
    """(by, n, inside): residuals, and how many of them lie within their group's bounds; an end that is NULL bounds nothing."""
    ends = bounds.select(F.col(by).alias("__by"), "low", "high")
    met = rows.join(F.broadcast(ends), F.col(by).eqNullSafe(F.col("__by")))  # one row a group
    r = F.col(residual)
    inside = F.coalesce(r >= F.col("low"), F.lit(True)) & F.coalesce(r <= F.col("high"), F.lit(True))
    return met.groupBy(by).agg(F.count(residual).alias("n"), F.count_if(inside & r.isNotNull()).alias("inside"))


def backtest(
    frame: DataFrame, period: str, origins: Sequence[int], fit: Callable[[DataFrame], Fitted], keep: Sequence[str] = (), label: str = "next"
) -> DataFrame:
    """(keep, period, label, prediction, residual) by a rolling origin.

    For each origin a model is fitted on the rows whose label was known by then and asked for the origin's own
    rows, so that no forecast has seen its own or a later period.  An origin without earlier rows is left out.
    """
    parts = []
    for origin in origins:
        known = frame.where(F.col(period) < origin)
        if known.head(1):
            asked = fit(known).predict(frame.where(F.col(period) == origin))
            parts.append(stage(residuals(asked, label, "prediction").select(*keep, period, label, "prediction", "residual"), "origin"))
    if not parts:
        empty = residuals(frame.withColumn("prediction", F.lit(None).cast("double")), label, "prediction").where(F.lit(False))
        return empty.select(*keep, period, label, "prediction", "residual")
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Forecaster:
    """A fitted forecaster, its interval's ends and its error, both from later periods than it has seen.

    ``bounds`` has the ends of each group of ``by``, where the forecaster was fitted with one.
    """

    fitted: Fitted
    low: float | None
    high: float | None
    rmse: float | None
    by: str | None = None
    bounds: DataFrame | None = None


def fit_forecast(
    df: DataFrame, key: str, period: str, target: str, features: Sequence[str], coverage: float = 0.95, by: str | None = None, **settings
) -> Forecaster:
    """Boosted trees for the next period on the first four fifths of the periods.

    The interval's ends are conformal bounds of the residuals in the later periods, so neighbouring periods of one key are
    not on both sides; with ``by`` each group has its own.  They are NULL where too few rows are left over.
    """
    inputs = [*features, target, f"{target}_lag1", f"{target}_lag2", f"{target}_delta"]
    frame = forecast_frame(df, key, period, target).where(F.col("next").isNotNull()).na.drop(subset=inputs)
    frame = stage(frame.select(key, period, "next", *inputs, *([by] if by and by not in inputs else [])), "forecast-rows")
    periods = sorted(r[0] for r in frame.select(period).distinct().collect())  # one a period
    cut = periods[-max(1, len(periods) // 5)] if len(periods) > 1 else None
    train, held = (frame, frame.where(F.lit(False))) if cut is None else (frame.where(F.col(period) < cut), frame.where(F.col(period) >= cut))
    boosted = fit_boosted(train, inputs, "next", **settings)
    fitted = Fitted(FORECAST_NAME, boosted.model, boosted.features)
    rest = stage(residuals(fitted.predict(held), "next", "prediction").select("residual", *([by] if by else [])), "residuals")
    ends = conformal_bounds(rest, coverage=coverage).first()
    low, high = (ends["low"], ends["high"]) if ends else (None, None)
    rmse = rest.agg(F.sqrt(F.avg(F.col("residual") * F.col("residual")))).first()[0]
    return Forecaster(fitted, low, high, rmse, by, conformal_bounds(rest, [by], coverage=coverage) if by else None)


def forecast_table(f: Forecaster, df: DataFrame, key: str, period: str, target: str, year: int) -> DataFrame:
    """Forecast of ``year`` + 1 with bounds, one row per key; NULL where the key lacks a value the model needs.

    A group that has no bounds of its own takes those of all.
    """
    frame = forecast_frame(df, key, period, target).where(F.col(period) == year).na.drop(subset=f.fitted.features)
    guess = f.fitted.predict(frame)
    ends = {c: F.lit(v).cast("double") for c, v in (("low", f.low), ("high", f.high))}
    if f.bounds is not None:
        own = f.bounds.select(F.col(f.by).alias("__by"), F.col("low").alias("__low"), F.col("high").alias("__high"))
        guess = guess.join(F.broadcast(own), F.col(f.by).eqNullSafe(F.col("__by")), "left")  # one row a group
        ends = {c: F.coalesce(f"__{c}", v) for c, v in ends.items()}
    p = F.col("prediction")
    guess = guess.select(key, p.alias("predicted_le_total"), (p + ends["low"]).alias("predicted_le_lower"), (p + ends["high"]).alias("predicted_le_upper"))
    names = ("predicted_le_total", "predicted_le_lower", "predicted_le_upper")
    return df.select(key).distinct().join(guess, key, "left").select(key, F.lit(f.fitted.name).alias("model_name"), *names)


def save_model(fitted: Fitted, path: str) -> None:
    """Persist a model as a pipeline."""
    PipelineModel([fitted.model]).write().overwrite().save(path)


def load_model(path: str, name: str, features: Sequence[str]) -> Fitted:
    return Fitted(name, PipelineModel.load(path).stages[0], list(features))


def score_models(models: Mapping[str, DataFrame], label: str, prediction: str = "prediction") -> DataFrame:
    """One row of scores per model, from one aggregation over the tagged predictions."""
    tagged = None
    for name, df in models.items():
        part = df.select(F.lit(name).alias("model"), label, prediction)
        tagged = part if tagged is None else tagged.unionByName(part)
    return regression_scores(tagged, label, prediction, by=["model"])
