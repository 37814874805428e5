"""Readers with fixed layouts, so that no input is scanned to infer one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from forumlens import schemas


_MALFORMED = "_malformed"


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Repartition after input that cannot be split, such as one large gzip file."""
    return df.repartition(partitions) if partitions else df


def read_comments(
    spark: SparkSession, path: str | Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Comments as JSON lines, compressed or not; absent fields are null."""
    return _spread(spark.read.schema(schemas.COMMENTS).json(path), partitions)


def read_submissions(
    spark: SparkSession, path: str | Sequence[str], partitions: int | None = None
) -> DataFrame:
    return _spread(spark.read.schema(schemas.SUBMISSIONS).json(path), partitions)


def read_lines_apart(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = schemas.COMMENTS,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Records of JSON lines, and as ``file, line`` the lines that are none of that layout.

    A line is malformed if it is not one JSON object, is cut off, or has a field of another type;
    absent and unknown fields are not errors. All fields are tested, whichever are used, so that
    both tables are the same for every use. Lines of white space are neither. An empty input gives
    two empty tables. Each of the two is a scan of its own, without a shuffle.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _MALFORMED}
    tested = T.StructType([*schema.fields, T.StructField(_MALFORMED, T.StringType())])
    lines = _spread(spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value"), partitions)
    record = F.from_json("value", tested, options)
    parsed = lines.filter(F.trim("value", F.lit(" \t\r")) != "").withColumn("_record", record)
    is_record = F.col("_record").isNotNull() & F.col(f"_record.{_MALFORMED}").isNull()
    records = parsed.filter(is_record).select([F.col(f"_record.`{name}`") for name in schema.names])
    return records, parsed.filter(~is_record).select("file", F.col("value").alias("line"))


def _csv(spark: SparkSession, schema: T.StructType, multiline: bool):
    # A quote inside a field is written twice. multiLine keeps line breaks inside
    # fields, at the price of one task per file.
    return (
        spark.read.schema(schema).option("escape", '"').option("multiLine", multiline)
    )


def read_documents(
    spark: SparkSession,
    path: str | Sequence[str],
    partitions: int | None = None,
    multiline: bool = False,
    schema: T.StructType = schemas.DOCUMENTS,
) -> DataFrame:
    """Community documents, ``id, comments``, as CSV without a header."""
    return _spread(_csv(spark, schema, multiline).csv(path), partitions)


def read_pages(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Sequence[str] = ("comment_message",),
    multiline: bool = True,
) -> DataFrame:
    """The union of all pages' comments, from one CSV file or folder with a header per page.

    Columns are taken by name, as text, so that pages may hold others and in any order.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    pages = [reader.csv(path).select(*columns) for path in paths]
    return reduce(DataFrame.unionByName, pages)


def read_communities(
    spark: SparkSession, path: str | Sequence[str], partitions: int | None = None
) -> DataFrame:
    return _spread(spark.read.parquet(path), partitions)


def read_result(spark: SparkSession, directory: str, schema: T.StructType) -> DataFrame:
    """A result directory: only its ``part*.csv`` files."""
    return _csv(spark, schema, False).option("pathGlobFilter", "part*.csv").csv(directory)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a plain scan that has fewer splits; a larger one is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
