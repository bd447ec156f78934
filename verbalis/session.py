"""Session helpers: a tuned local session, and tables kept in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", app: str = "verbalis") -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, use the cluster's own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores) if cores != "*" else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for kept tables: ``spark.checkpoint.dir`` if the session names one.

    A machine-local temporary folder is used only in local mode, where driver and executors share it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="verbalis-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


SPLIT_BYTES = 128 << 20


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` in enough partitions to use all cores for work on its texts.

    A table of few row groups is read by few tasks however long its texts take to process. Such a table is small enough
    to be shuffled by its key; a table with more than one scan split per core is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(2 * cores, key) if size < cores * SPLIT_BYTES else df


class Workspace:
    """Parquet tables of one run in the shared folder.

    Keeping a table cuts its lineage in a way that survives lost executors, gives the optimizer true sizes, and
    lets later steps read only the columns they need.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{checkpoint_folder(spark)}/run-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        target = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def drop(self, name: str | None = None) -> None:
        """Delete one table of this run, or all of them."""
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        fs = hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.delete(hadoop_path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.drop()
