"""Random forest on the feature matrix."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FEATURES, TARGET
from ..session import exists
from .deep_forest import DeepForest, load_deep, predict_deep, save_deep, train_deep_forest

# Fixed values of the model.
TREES = 100
SEED = 42
# Without a depth, trees grow until their leaves are pure (see ``deep_forest``). With one, up to 30, they
# are Spark's: every level is a pass over the rows for as many nodes as the memory below holds.
DEPTH = None
BINS = 64  # candidate cuts a feature
MEMORY_MB = 1024  # of a task, for the statistics of nodes split in one pass


Forest = PipelineModel | DeepForest


def train_forest(
    train: DataFrame, trees: int = TREES, depth: int | None = DEPTH, seed: int = SEED
) -> Forest:
    """Fit on those of the nine features the table has."""
    names = [name for name in FEATURES if name in train.columns]
    if depth is None:
        return train_deep_forest(train, names, TARGET, trees, seed)
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    forest = RandomForestClassifier(
        labelCol=TARGET,
        numTrees=trees,
        maxDepth=depth,
        impurity="gini",
        featureSubsetStrategy="sqrt",
        seed=seed,
        maxBins=BINS,
        maxMemoryInMB=MEMORY_MB,
        cacheNodeIds=True,
        checkpointInterval=10,
    )
    return Pipeline(stages=[assembler, forest]).fit(train)


def predict(model: Forest, df: DataFrame) -> DataFrame:
    """Add the predicted class as ``prediction`` (int)."""
    if isinstance(model, DeepForest):
        return predict_deep(model, df)
    scored = model.transform(df.drop("prediction"))
    return scored.select(*df.columns, F.col("prediction").cast("int").alias("prediction"))


def save_model(model: Forest, path: str) -> None:
    if isinstance(model, DeepForest):
        save_deep(model, f"{path}/deep")
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> Forest:
    spark = SparkSession.getActiveSession()
    if exists(spark, f"{path}/deep"):
        return load_deep(spark, f"{path}/deep")
    return PipelineModel.load(path)
