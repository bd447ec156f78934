"""Reading labelled tables and writing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbalis.sources.workbooks import read_workbooks


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, types: dict[str, str] | None = None) -> DataFrame:
    """CSV with a header row, quoted line breaks and doubled quotes.

    Columns are strings unless ``types`` names another type, so no pass is spent on guessing types. Quoted line breaks
    make a file readable only as a whole; large inputs should come as many files.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("lineSep", "\n")
    df = reader.csv(path)
    if columns:
        df = df.select(*columns)
    for name, type_ in (types or {}).items():
        df = df.withColumn(name, F.col(name).cast(type_))
    return df


def write_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """Rows as CSV with normal quoting."""
    (
        df.write.mode("overwrite")
        .option("header", header)
        .option("escape", '"')
        .option("lineSep", "\n")
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_labelled(
    spark: SparkSession, path: str, text_col: str, label_col: str, id_col: str | None = None, fmt: str | None = None
) -> DataFrame:
    """The text and label columns (and the id, if named) of a csv, xlsx or parquet path.

    The format is the last suffix of the path unless ``fmt`` names it.
    """
    kind = (fmt or path.rstrip("/").rsplit(".", 1)[-1]).lower()
    columns = ([id_col] if id_col else []) + [text_col, label_col]
    if kind == "csv":
        return read_csv(spark, path, columns)
    if kind == "xlsx":
        return read_workbooks(spark, path, columns)
    if kind == "parquet":
        return spark.read.parquet(path).select(*columns)
    raise ValueError(f"cannot read files of type {kind!r}; use csv, xlsx or parquet")
