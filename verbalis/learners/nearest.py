"""k nearest neighbours as an estimator."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbalis.learners.scored import HasClassColumns, matrix, set_params
from verbalis.operators import neighbours as Nb
from verbalis.session import Workspace

#: Rows of a batch that are compared at a time, and bytes of a row group of kept training rows.
QUERIES, GROUP_BYTES = 512, 16 << 20


class _HasK(HasClassColumns):
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    maxValues = Param(Params._dummy(), "maxValues", "most vector values of kept training rows, 0 for all rows", TypeConverters.toInt)
    shipped = Param(
        Params._dummy(), "shipped", "most vector values of training rows that are shipped; more are read from the shared folder", TypeConverters.toInt
    )


class KnnClassifier(Estimator, _HasK, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps the training rows: all of them, however many they are.

    Only ``maxValues``, if it is set, keeps a stratified sample of a table with more numbers: of every class the same share
    of rows, those whose hashed vector comes first. Ties between neighbours are broken by a number that rows get at fit, in
    the order of their ids of whatever type, then of their vectors.
    """

    @keyword_only
    def __init__(self, k=5, maxValues=0, shipped=Nb.BOUND):
        super().__init__()
        self._set_class_columns()
        set_params(self)

    def _fit(self, dataset: DataFrame) -> "KnnModel":
        id_col = self.col("idCol")
        known = [F.col(id_col).alias("id")] if id_col in dataset.columns else []
        rows = self.rows(dataset, *known)
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
        wanted = self.getOrDefault(self.maxValues) // max(1, size.d or 1)
        if self.getOrDefault(self.maxValues) and size.n > wanted:
            place = F.pmod(F.xxhash64("x", *(["id"] if known else [])), F.lit(1 << 30))
            rows = rows.filter(place < F.lit(int(wanted / size.n * (1 << 30))))
        order = [F.asc_nulls_last("id")] if known else []
        numbered = rows.orderBy(*order, "x", "y").select(
            F.monotonically_increasing_id().alias("number"), F.col("y").alias("label"), "x"
        )
        model = KnnModel()
        same = ("featuresCol", "predictionCol", "probabilityCol", "shipped")
        model._set(k=self.getOrDefault(self.k), **{p: self.col(p) for p in same})
        return model.with_table(numbered, size.n * (size.d or 0))


def kept_rows(files: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Labels and vectors of the rows in files of the shared folder, a few at a time, in the order of the files."""
    for file in files:
        system, path = pafs.FileSystem.from_uri(file)
        with system.open_input_file(path) as source:
            for batch in pq.ParquetFile(source).iter_batches(Nb.CHUNK, columns=["label", "x"]):
                if batch.num_rows:
                    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    yield batch.column("label").to_numpy(), x


class KnnModel(Model, _HasK, MLReadable, MLWritable):
    """The kept rows are shipped to the tasks, or read there from the shared folder, a few at a time, if they are many.

    Both give the same neighbours. Scoring moves no row, needs no id and works on streams.
    """

    def __init__(self):
        super().__init__()
        self._set_class_columns()
        self._setDefault(k=5, shipped=Nb.BOUND)
        self._kept = self._table = None

    def with_rows(self, labels, vectors) -> "KnnModel":
        if not len(labels):
            raise ValueError("no training rows")
        self._kept = np.asarray(labels, dtype=int), np.stack(vectors).astype(float)
        return self

    def with_table(self, numbered: DataFrame, values: int) -> "KnnModel":
        """Rows ``number, label, x`` with so many values; they lie in the order of their numbers."""
        if values <= self.getOrDefault(self.shipped):
            rows = numbered.toPandas().sort_values("number")
            return self.with_rows(rows["label"], [*rows["x"]])
        target = f"{Workspace(numbered.sparkSession).path}/neighbours"
        numbered.write.option("parquet.block.size", GROUP_BYTES).parquet(target)
        self._table = numbered.sparkSession.read.schema(numbered.schema).parquet(target)
        return self

    def _shares(self, spark: SparkSession):
        """A function from vectors to class shares."""
        k = self.getOrDefault(self.k)
        if self._table is None:
            shared = spark.sparkContext.broadcast(self._kept)
            classes = int(self._kept[0].max()) + 1
            parts = lambda: ((shared.value[0][at : at + Nb.CHUNK], shared.value[1][at : at + Nb.CHUNK]) for at in range(0, len(shared.value[0]), Nb.CHUNK))
        else:
            files, classes = sorted(self._table.inputFiles()), int(self._table.agg(F.max("label")).first()[0]) + 1
            parts = lambda: kept_rows(files)

        @F.pandas_udf("array<double>")
        def shares(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                best = [Nb.Nearest(matrix(batch.iloc[at : at + QUERIES]), k) for at in range(0, len(batch), QUERIES)]
                for labels, train in parts() if best else ():
                    for some in best:
                        some.see(train, labels)
                out = [row for some in best for row in np.eye(classes)[some.marks].mean(axis=1)]
                yield pd.Series(out) if out else pd.Series([], dtype=object)

        return shares

    def _transform(self, dataset: DataFrame) -> DataFrame:
        prediction, probability = self.col("predictionCol"), self.col("probabilityCol")
        shares = self._shares(dataset.sparkSession)
        best = F.array_position(F.col("_shares"), F.array_max("_shares")) - 1
        return (
            dataset.withColumn("_shares", shares(vector_to_array(self.col("featuresCol"))))
            .withColumn(prediction, best.cast("double"))
            .withColumn(probability, array_to_vector("_shares"))
            .drop("_shares")
        )

    def write(self):
        return _KnnWriter(self)

    @classmethod
    def read(cls):
        return _KnnReader()


class _KnnWriter(MLWriter):
    def __init__(self, model: KnnModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, SparkSession.getActiveSession())
        if self.model._table is not None:
            self.model._table.write.mode("overwrite").parquet(f"{path}/training")
            return
        labels, vectors = self.model._kept
        rows = [(i, int(y), x.tolist()) for i, (y, x) in enumerate(zip(labels, vectors))]
        table = SparkSession.getActiveSession().createDataFrame(rows, "number long, label int, x array<double>")
        table.write.mode("overwrite").parquet(f"{path}/training")


class _KnnReader(MLReader):
    def load(self, path: str) -> KnnModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = KnnModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        rows = spark.read.parquet(f"{path}/training")
        values = rows.agg(F.sum(F.size("x").cast("bigint"))).first()[0] or 0
        return model.with_table(rows.orderBy("number") if values > model.getOrDefault(model.shipped) else rows, values)
