"""Boosted trees on panel features, with cost-scored search and ablation."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions.calendar import calendar_fields, is_weekend
from ..functions.metrics import EVAL, EvalSpec
from ..plans.slabs import DEFAULT_SLAB
from ..spec import HORIZON, PANEL, PRICE_COLUMNS, PanelSpec, require_columns
from .clean import clip, require_features
from .evaluate import score
from .features import lag_features, outage_flag


def tree_features(df: DataFrame, spec: PanelSpec = PANEL, outages: bool = False,
                  size: int = DEFAULT_SLAB, minimum: int = 30) -> tuple[DataFrame, list[str]]:
    """Lag features, calendar numbers and optionally the outage flag; returns their names."""
    rich = lag_features(df, spec, size=size)
    fields = calendar_fields(spec.ts)
    rich = rich.select("*", *[e.cast("double").alias(n) for n, e in fields.items()],
                       is_weekend(spec.ts).cast("double").alias("is_weekend"))
    if outages:
        rich = outage_flag(rich, spec, minimum)
    known = {spec.entity, spec.ts, spec.idx, spec.y, *PRICE_COLUMNS, "data_subset"}
    names = [c for c in rich.columns if c not in known]
    return rich, names


def _with_unknowns(train: DataFrame, numbers: Sequence[str]) -> tuple[list, list[str]]:
    """A stage that makes unknown numbers visible to a tree, and the columns it adds.

    An unknown value lies below every known one of the training rows, so a split can tell it from each of them, and
    columns that have unknown training values also get an indicator.  NaN is unknown.
    """
    if not numbers:
        return [], []
    known = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in numbers}
    facts = train.agg(*[F.min(e).alias(f"low_{i}") for i, e in enumerate(known.values())],
                      *[F.count_if(e.isNull()).alias(f"gaps_{i}") for i, e in enumerate(known.values())]).first()
    parts, names = [], []
    for i, c in enumerate(numbers):
        low = facts[f"low_{i}"]
        below = -1.0 if low is None else low - max(1.0, abs(low))
        value = f"nullif(CAST(`{c}` AS DOUBLE), CAST('NaN' AS DOUBLE))"
        parts.append(f"coalesce({value}, {below!r}D) AS `{c}__known`")
        names.append(f"{c}__known")
        if facts[f"gaps_{i}"]:
            parts.append(f"CAST({value} IS NULL AS DOUBLE) AS `{c}__missing`")
            names.append(f"{c}__missing")
    return [SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")], names


def fit_trees(train: DataFrame, features: Sequence[str], label: str = "y", validation: str | None = None,
              categories: Sequence[str] = (), **params) -> PipelineModel:
    """Gradient-boosted trees with squared error.

    ``features`` are numbers, unknown ones included (:func:`_with_unknowns`).  ``categories`` (the entity, its
    attributes) become sparse indicators in one vector with the categories' names as its metadata; values not met
    in training share one indicator.  All of it is in the returned pipeline, which can be stored.  With ``validation``
    (a boolean column) boosting stops once the error on those rows no longer falls.
    """
    require_features(train, [*features, label])
    trees = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="pred",
                         lossType="squared", **params)
    if validation:
        trees = trees.setValidationIndicatorCol(validation)
    ready = train.filter(F.col(label).isNotNull())
    stages, inputs = _with_unknowns(ready, features)
    if categories:
        require_columns(train, categories)
        codes, sparse = [f"{c}__code" for c in categories], [f"{c}__is" for c in categories]
        stages += [StringIndexer(inputCols=list(categories), outputCols=codes, handleInvalid="keep",
                                 stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=codes, outputCols=sparse, dropLast=False)]
        inputs = [*inputs, *sparse]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol="features"), trees]).fit(ready)


def predict(model: PipelineModel, df: DataFrame, features: Sequence[str], keep: Sequence[str],
            categories: Sequence[str] = ()) -> DataFrame:
    """One-shot scoring; predictions are not negative."""
    ready = require_columns(require_features(df, features), categories)
    return model.transform(ready).select(*keep, clip("pred").alias("pred"))


class CostEvaluator(Evaluator):
    """Imbalance cost of the first ``horizon`` steps of each entity (lower is better)."""

    def __init__(self, spec: EvalSpec = EVAL, panel: PanelSpec = PANEL, horizon: int = HORIZON):
        super().__init__()
        self.spec, self.panel, self.horizon = spec, panel, horizon

    def _evaluate(self, dataset: DataFrame) -> float:
        first = dataset.groupBy(self.panel.entity).agg(F.min(self.panel.idx).alias("_a"))
        head = dataset.join(first, self.panel.entity).filter(
            F.col(self.panel.idx) < F.col("_a") + self.horizon)
        value = head.agg(M.money(self.spec)).first()[0]
        return float("inf") if value is None else float(value)

    def isLargerBetter(self) -> bool:
        return False


def random_trials(space: Mapping[str, Sequence], n: int, seed: int = 42) -> list[dict]:
    """``n`` distinct seeded draws from a grid."""
    rng, seen, out = random.Random(seed), set(), []
    size = 1
    for values in space.values():
        size *= len(values)
    while len(out) < min(n, size):
        pick = {k: rng.choice(list(v)) for k, v in space.items()}
        mark = tuple(sorted(pick.items()))
        if mark not in seen:
            seen.add(mark)
            out.append(pick)
    return out


def search_trees(train: DataFrame, val: DataFrame, features: Sequence[str],
                 space: Mapping[str, Sequence], trials: int, evaluator: CostEvaluator | None = None,
                 label: str = "y", seed: int = 42, categories: Sequence[str] = ()) -> tuple[PipelineModel, DataFrame]:
    """Random search by cost on validation; returns the best model and the trial table."""
    evaluator = evaluator or CostEvaluator()
    keep = [c for c in val.columns if c not in features]
    rows, best, best_cost = [], None, float("inf")
    for number, params in enumerate(random_trials(space, trials, seed)):
        model = fit_trees(train, features, label, categories=categories, seed=seed, **params)
        cost = evaluator.evaluate(predict(model, val, features, keep, categories))
        rows.append((number, repr(sorted(params.items())), cost))
        if best is None or cost < best_cost:
            best, best_cost = model, cost
    table = train.sparkSession.createDataFrame(rows, "trial int, params string, cost double")
    return best, table


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the places of the feature vector: numbers, ``<c>__missing``, and ``<c>=<value>`` of categories."""
    labels = {}
    for step in model.stages:
        if isinstance(step, StringIndexerModel):
            labels = dict(zip(step.getInputCols(), step.labelsArray))
    assembler = next(x for x in model.stages if isinstance(x, VectorAssembler))
    names = []
    for c in assembler.getInputCols():
        if c.endswith("__is"):
            names += [f"{c[:-4]}={v}" for v in [*labels[c[:-4]], "(other)"]]
        else:
            names.append(c.removesuffix("__known"))
    return names


def importances(model: PipelineModel) -> DataFrame:
    """Features by importance, largest first."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = sorted(zip(feature_names(model), map(float, weights)), key=lambda r: (-r[1], r[0]))
    from pyspark.sql import SparkSession
    return SparkSession.active().createDataFrame(
        [(i + 1, n, w) for i, (n, w) in enumerate(rows)], "rank int, feature string, importance double")


def ablation(train: DataFrame, val: DataFrame, features: Sequence[str], without: Sequence[str],
             spec: EvalSpec = EVAL, label: str = "y", categories: Sequence[str] = (), **params) -> DataFrame:
    """Scores of the same model with and without some features."""
    keep = [spec.y, spec.dam, spec.sell, spec.buy]
    fewer = [f for f in features if f not in without]
    parts = [predict(fit_trees(train, names, label, categories=categories, **params), val, names, keep, categories)
             .withColumn("variant", F.lit(v))
             for v, names in (("with", features), ("without", fewer))]
    return score(parts[0].unionByName(parts[1]).dropna(), ["variant"], spec)
