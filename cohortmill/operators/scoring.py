"""Models that score by themselves: the codes of categories are a stage of the stored pipeline.

`learn.train_models` reads rows that are encoded already, and its codes lie beside the models. Here a model
is one stored pipeline: category codes (a value it hasn't seen is a category of its own), the
vector, the trees. A version is stored for each run date; `load` takes the newest up to a day, and `score`
needs the feature rows alone. So trials that have no outcome yet get a probability.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.operators import learn
from cohortmill.operators.features import TARGET, TRIAL_CATEGORICAL, TRIAL_FEATURES
from cohortmill.session import shared_folder
from cohortmill.sources import tables

# The values of a column are a list in the stored model.
MAX_VALUES = 100_000
_CODE = "_code"


def fit(
    name: str,
    train: DataFrame,
    features: list[str] | None = None,
    categorical: list[str] | None = None,
    label: str = TARGET,
    **params,
) -> PipelineModel:
    """Fit one of `learn.MODELS` on rows whose categories are texts; `params` override its fixed ones."""
    features = TRIAL_FEATURES if features is None else features
    categorical = TRIAL_CATEGORICAL if categorical is None else categorical
    values = train.agg(*(F.approx_count_distinct(c).alias(c) for c in categorical)).first() if categorical else ()
    if any(n > MAX_VALUES for n in values):
        raise ValueError(f"a category has more than {MAX_VALUES:,} values; encode it before (`features.write_label_codes`)")
    shared_folder(train.sparkSession)
    coded = [f"{c}{_CODE}" for c in categorical]
    stages = []
    if categorical:
        indexer = StringIndexer(inputCols=categorical, outputCols=coded, handleInvalid="keep", stringOrderType="alphabetAsc")
        stages.append(indexer.fit(train))
        most = max(len(labels) for labels in stages[0].labelsArray)
    else:
        most = 0
    stages.append(learn.assembler([f"{c}{_CODE}" if c in categorical else c for c in features]))
    trees = learn.classifier(name, label, **{"maxBins": max(learn.MIN_BINS, most + 2), **params})
    dealt = learn.spread(train).persist()
    try:
        if name == "random_forest":
            trees = trees.setWeightCol("w")
            weighed = learn.balanced_weights(dealt, label)
        else:
            weighed = dealt
        return learn.fit_trees(stages, trees, weighed)
    finally:
        dealt.unpersist()


def store(model: PipelineModel, root: str, name: str, run_date: str) -> str:
    path = f"{root}/scorers/{name}/{run_date}"
    model.write().overwrite().save(path)
    return path


def versions(spark: SparkSession, root: str, name: str) -> list[str]:
    """The run dates that have a stored version, oldest first."""
    return tables.children(spark, f"{root}/scorers/{name}")


def load(spark: SparkSession, root: str, name: str, run_date: str | None = None) -> PipelineModel:
    """The newest version, or the newest up to a run date."""
    known = [v for v in versions(spark, root, name) if run_date is None or v <= run_date]
    if not known:
        raise ValueError(f"no version of {name}" + (f" up to {run_date}" if run_date else ""))
    return PipelineModel.load(f"{root}/scorers/{name}/{known[-1]}")


def score(model: PipelineModel, rows: DataFrame, keep: list[str]) -> DataFrame:
    """`predicted_completed` and `completion_probability` of each row, after `keep`; no outcome is needed."""
    return model.transform(rows).select(
        *keep,
        F.col("prediction").cast("int").alias("predicted_completed"),
        vector_to_array("probability")[1].alias("completion_probability"),
    )
