"""Tree classifiers on Spark ML: build, validate, align, score.

A pipeline carries all that scoring needs: the names and types of its features (``Contract``), the codes of categories and the scale of
numbers as they were fitted, and the classifier. A saved model is loaded with ``PipelineModel.load`` and applied to a raw table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from propensity.functions.scalars import non_finite_to_null
from propensity.operators.metrics import basic_metrics, confusion
from propensity.session import checkpoint_dir

NUMBER, TEXT = "double", "string"
#: Columns that stages of a pipeline hand to each other.
_PASSED = ("features", "rawPrediction", "_numbers", "_scaled")


class Contract(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The features a pipeline was built for and their types, kept with the model; brings a table into that form."""

    names = Param(Params._dummy(), "names", "feature names", TypeConverters.toListString)
    kinds = Param(Params._dummy(), "kinds", "double or string for each", TypeConverters.toListString)

    def __init__(self, features: Mapping[str, str] | None = None):
        super().__init__()
        if features is not None:
            self._set(names=list(features), kinds=list(features.values()))

    @property
    def features(self) -> dict[str, str]:
        return dict(zip(self.getOrDefault(self.names), self.getOrDefault(self.kinds)))

    def _transform(self, df: DataFrame) -> DataFrame:
        return align(df, self.features, kept=[n for n in df.columns if n not in self.features])


def _pipeline(features: Sequence[str], classifier, weight: str | None, scale: bool, encode: Sequence[str]) -> Pipeline:
    """Contract, codes of ``encode`` (values of the training part in order; others and NULL get the next number), scale, classifier."""
    if weight is not None:
        classifier = classifier.setWeightCol(weight)
    numbers = [n for n in features if n not in encode]
    stages = [Contract({n: TEXT if n in encode else NUMBER for n in features})]
    parts = list(numbers)
    if encode:
        codes = [f"_code_{i}" for i in range(len(encode))]
        stages.append(StringIndexer(inputCols=list(encode), outputCols=codes, handleInvalid="keep", stringOrderType="alphabetAsc"))
        # plain numbers: as categories they would be limited to the bins of a tree
        plain = ", ".join(f"{code} + 0 AS {code}_number" for code in codes)
        stages.append(SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__"))
        parts += [f"{code}_number" for code in codes]
    if scale and numbers:
        stages += [
            VectorAssembler(inputCols=numbers, outputCol="_numbers"),
            StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
        ]
        parts = ["_scaled", *parts[len(numbers) :]]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=parts, outputCol="features"), classifier])


def boosted_trees(
    features: Sequence[str],
    label: str,
    trees: int = 100,
    depth: int = 5,
    step: float = 0.1,
    seed: int = 42,
    weight: str | None = None,
    scale: bool = False,
    encode: Sequence[str] = (),
) -> Pipeline:
    """Gradient-boosted trees; ``setThresholds`` on the last stage moves the class cut.

    ``scale`` brings numbers to standard scores and ``encode`` names text features to be numbered, both as fitted with the model.
    """
    return _pipeline(
        features,
        GBTClassifier(
            labelCol=label, maxIter=trees, maxDepth=depth, stepSize=step, seed=seed, checkpointInterval=10
        ),
        weight,
        scale,
        encode,
    )


def random_forest(
    features: Sequence[str],
    label: str,
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
    weight: str | None = None,
    scale: bool = False,
    encode: Sequence[str] = (),
) -> Pipeline:
    return _pipeline(
        features,
        RandomForestClassifier(
            labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, checkpointInterval=10
        ),
        weight,
        scale,
        encode,
    )


def fit(estimator: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit with checkpoints in the shared folder, so a lost executor does not restart the boosting."""
    checkpoint_dir(train.sparkSession)
    return estimator.fit(train)


def contract(model: PipelineModel) -> dict[str, str]:
    """The features of a model and their types."""
    return model.stages[0].features


def features_of_model(model: PipelineModel) -> list[str]:
    return list(contract(model))


def _typed(features: Sequence[str] | Mapping[str, str]) -> Mapping[str, str]:
    return features if isinstance(features, Mapping) else {n: NUMBER for n in features}


def _as_number(df: DataFrame, name: str) -> Column:
    """A column as a number: text is read as one, which ``alignment`` reports; what is none is NULL."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    if isinstance(kind, (T.StringType, T.NullType)):
        return F.trim(column.cast("string")).try_cast("double")
    raise ValueError(f"feature '{name}' is a {kind.simpleString()}, which is no number")


def align(
    df: DataFrame, features: Sequence[str] | Mapping[str, str], kept: Sequence[str] = ("user_id",)
) -> DataFrame:
    """The kept columns, then the model's features in its order and types; missing numbers and NULLs are 0, missing texts NULL."""

    def column(name: str, kind: str) -> Column:
        if kind == TEXT:
            return F.col(f"`{name}`").cast("string") if name in df.columns else F.lit(None).cast("string")
        return F.coalesce(non_finite_to_null(_as_number(df, name)), F.lit(0.0)) if name in df.columns else F.lit(0.0)

    columns = [column(name, kind).alias(name) for name, kind in _typed(features).items()]
    return df.select(*[F.col(f"`{n}`") for n in kept if n in df.columns], *columns)


def alignment(
    df: DataFrame, features: Sequence[str] | Mapping[str, str], kept: Sequence[str] = ("user_id",)
) -> dict[str, str]:
    """Each feature's state: matched, cast (of another type than the model's), missing from the data, or extra there."""
    features, kinds = _typed(features), {f.name: f.dataType for f in df.schema}

    def state(name: str, kind: str) -> str:
        if name not in kinds:
            return "missing"
        fits = isinstance(kinds[name], T.StringType if kind == TEXT else T.NumericType)
        return "matched" if fits else "cast"

    states = {name: state(name, kind) for name, kind in features.items()}
    states.update({n: "extra" for n, kind in kinds.items() if isinstance(kind, T.NumericType) and n not in states and n not in kept})
    return states


def lost_values(df: DataFrame, features: Mapping[str, str]) -> dict[str, int]:
    """For each number feature that the data hold as text: values that are no numbers and so count as 0; one aggregation."""
    texts = [n for n, kind in features.items() if kind == NUMBER and n in df.columns and isinstance(df.schema[n].dataType, T.StringType)]
    if not texts:
        return {}
    lost = lambda n: (F.trim(F.col(f"`{n}`")) != "") & _as_number(df, n).isNull()
    return df.agg(*[F.count_if(lost(n)).alias(n) for n in texts]).first().asDict()


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``prediction`` (0/1) and ``probability`` of the positive class."""
    probability = vector_to_array(F.col("probability"))[1]
    scored = model.transform(df)
    passed = [n for n in scored.columns if n in _PASSED or n.startswith("_code_")]
    return (
        scored.withColumn("probability", probability)
        .withColumn("prediction", F.col("prediction").cast("int"))
        .drop(*passed)
    )


def cross_validate(df: DataFrame, estimator: Pipeline, label: str, folds: int = 5) -> DataFrame:
    """``fold, f1`` of the positive class; ``df`` has a ``fold`` column and is written out already."""
    results = []
    for fold in range(folds):
        model = fit(estimator, df.where(F.col("fold") != fold))
        scored = score(model, df.where(F.col("fold") == fold))
        results.append(
            basic_metrics(confusion(scored, label)).select(F.lit(fold).alias("fold"), "f1")
        )
    return reduce(DataFrame.unionByName, results)


def grid_search(
    df: DataFrame, estimator: Pipeline, label: str, grid: Mapping[str, Sequence], folds: int = 5
) -> CrossValidatorModel:
    """Try every combination of classifier parameters on the ``fold`` column, scored by F1."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getStages()[-1].getParam(name), list(values))
    checkpoint_dir(df.sparkSession)
    return CrossValidator(
        estimator=estimator,
        estimatorParamMaps=builder.build(),
        evaluator=MulticlassClassificationEvaluator(
            labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0
        ),
        numFolds=folds,
        foldCol="fold",
        parallelism=2,
    ).fit(df)
