"""Base of the models MLlib does not have: plain state, scored in Arrow batches."""

from __future__ import annotations

import inspect
import json

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def set_params(stage: Params) -> None:
    """Defaults from the signature of the constructor, values from its call."""
    signature = inspect.signature(type(stage).__init__).parameters.values()
    stage._setDefault(**{p.name: p.default for p in signature if p.default is not inspect.Parameter.empty})
    stage._set(**stage._input_kwargs)


class HasClassColumns(HasFeaturesCol, HasPredictionCol, HasProbabilityCol):
    """Feature, label and id columns of the learners in this package."""

    labelCol = Param(Params._dummy(), "labelCol", "label index column")
    idCol = Param(Params._dummy(), "idCol", "column that identifies a record")

    def _set_class_columns(self):
        self._setDefault(
            featuresCol="features", labelCol="label_index", idCol="doc_id", predictionCol="prediction", probabilityCol="probability"
        )

    def col(self, name: str) -> str:
        return self.getOrDefault(getattr(self, name))

    def rows(self, dataset: DataFrame, *extra: str) -> DataFrame:
        """``x`` (dense array) and ``y`` (int), with further columns."""
        return dataset.select(
            *extra, vector_to_array(self.col("featuresCol")).alias("x"), F.col(self.col("labelCol")).cast("int").alias("y")
        )


VALUES_PER_PARTITION = 1_000_000


def compacted(rows: DataFrame, count: int, width: int, mapped: int = 0) -> DataFrame:
    """Training rows spread over as many partitions as their size asks for.

    Iterative learners run many short jobs, whose cost on a small pool is the number of tasks. The rows are shuffled
    once; what comes before keeps its own partitioning. Rows that a learner maps to ``mapped`` features, a few at a time, are
    spread for its work over two partitions per core, but no wider: every partition sends sums as wide as the map.
    """
    parts = lambda w: -(-count * max(1, w) // VALUES_PER_PARTITION)
    spread = min(parts(mapped), max(parts(width) // 4, 2 * rows.sparkSession.sparkContext.defaultParallelism)) if mapped else parts(width)
    return rows.repartition(max(1, spread))


def matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, 0))


class ScoredModel(Model, HasClassColumns, MLReadable, MLWritable):
    """A model whose JSON-able ``state`` and function ``score(state, X) -> class shares`` say everything."""

    def __init__(self, state: dict | None = None):
        super().__init__()
        self._set_class_columns()
        self.state = state or {}

    @staticmethod
    def score(state: dict, x: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast(json.dumps(self.state))
        score = type(self).score
        cache: dict = {}

        @F.pandas_udf("array<double>")
        def shares(x: pd.Series) -> pd.Series:
            if "state" not in cache:
                cache["state"] = json.loads(shared.value)
            return pd.Series(list(score(cache["state"], matrix(x)))) if len(x) else pd.Series([], dtype=object)

        probability, prediction = self.col("probabilityCol"), self.col("predictionCol")
        best = F.array_position(F.col("_shares"), F.array_max("_shares")) - 1
        return (
            dataset.withColumn("_shares", shares(vector_to_array(self.col("featuresCol"))))
            .withColumn(prediction, best.cast("double"))
            .withColumn(probability, array_to_vector("_shares"))
            .drop("_shares")
        )

    def write(self):
        return _StateWriter(self)

    @classmethod
    def read(cls):
        return _StateReader(cls)


class _StateWriter(MLWriter):
    def __init__(self, model: ScoredModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        DefaultParamsWriter.saveMetadata(self.model, path, spark)
        rows = [(k, json.dumps(v)) for k, v in self.model.state.items()]
        spark.createDataFrame(rows, "key string, value string").coalesce(1).write.mode("overwrite").parquet(f"{path}/state")


class _StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        rows = spark.read.parquet(f"{path}/state").collect()
        model = self.cls({r.key: json.loads(r.value) for r in rows})
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
