"""Gradient-boosted trees over the feature vector."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.features import FEATURES


def train(labelled: DataFrame, names: tuple[str, ...] = FEATURES, rounds: int = 100, depth: int = 8, rate: float = 0.1, seed: int = 42) -> PipelineModel:
    """Vectors are assembled once and trees grow level by level on the executors."""
    data = labelled.select(*names, F.col("label").cast("double").alias("label"))
    assemble = VectorAssembler(inputCols=list(names), outputCol="features")
    gbt = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=rate, maxBins=255, seed=seed, maxMemoryInMB=512, cacheNodeIds=False)
    return Pipeline(stages=[assemble, gbt]).fit(data)


def score(model: PipelineModel, vectors: DataFrame) -> DataFrame:
    """vectors with p, the probability of a match."""
    scored = model.transform(vectors)
    return scored.withColumn("p", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
