"""A text classifier learned from labelled records, scored like any other predictor."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folianta.storage import shared_dir


def train_classifier(
    train: DataFrame,
    text: str = "text",
    label: str = "type",
    features: int = 1 << 14,
    max_iter: int = 20,
    regularization: float = 0.01,
) -> PipelineModel:
    """Hashed, frequency-weighted words into a logistic regression.

    The fitted model is stored in the shared folder and loaded back. A freshly fitted one
    carries a training summary that refers to the session and cannot be sent to executors
    once the session has observed a metric.
    """
    indexer = StringIndexer(
        inputCol=label, outputCol="_label", stringOrderType="alphabetAsc"
    ).fit(train)
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"(?U)\W+"),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features),
        IDF(inputCol="_counts", outputCol="_features"),
        indexer,
        LogisticRegression(
            featuresCol="_features",
            labelCol="_label",
            predictionCol="_predicted",
            rawPredictionCol="_raw",
            probabilityCol="_probability",
            maxIter=max_iter,
            regParam=regularization,
        ),
        IndexToString(inputCol="_predicted", outputCol="generated_text", labels=indexer.labels),
    ]
    path = shared_dir(train.sparkSession, "classifier")
    Pipeline(stages=stages).fit(train).write().save(path)
    return PipelineModel.load(path)


def classify(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds ``generated_text``, the predicted label, and the probability of it."""
    known = PipelineModel([stage for stage in model.stages if "StringIndexer" not in stage.uid])
    scored = known.transform(rows)
    best = F.array_max(vector_to_array("_probability"))
    return scored.select(*rows.columns, "generated_text", best.alias("confidence"))
