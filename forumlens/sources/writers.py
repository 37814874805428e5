"""Writers."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

_MANIFEST = "number long, version string, tables string"

SERVING_TABLES = (
    "comment_board",
    "ups_board",
    "lurker_board",
    "totals",
    "merged",
    "layout",
    "topic_layout",
    "topic_words",
)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """Comma-separated without a header; refuses an existing target unless told to overwrite."""
    mode = "overwrite" if overwrite else "errorifexists"
    df.write.mode(mode).option("sep", ",").option("escape", '"').csv(path)


def write_serving_tables(tables: dict[str, DataFrame], directory: str) -> None:
    """One parquet table per name below ``directory``."""
    for name, df in tables.items():
        write_parquet(df, f"{directory}/{name}")


def publish_tables(tables: dict[str, DataFrame], directory: str) -> str:
    """Write all tables below a new version and then name it as the newest one; returns its folder.

    A version is read only after all its tables are complete: the last step adds one file of one
    row to the ``manifest``. Whatever fails before leaves the version before it the newest.
    Readers of older versions are not disturbed, as nothing is overwritten. One job at a time
    may publish to a directory.
    """
    spark = next(iter(tables.values())).sparkSession
    version = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{directory}/versions/{version}/{name}")
    newest = _newest(spark, directory)
    number = newest["number"] + 1 if newest else 0
    row = spark.range(1).select(F.lit(number).cast("long").alias("number"), F.lit(version).alias("version"))
    row.withColumn("tables", F.lit(",".join(tables))).coalesce(1).write.mode("append").parquet(f"{directory}/manifest")
    return f"{directory}/versions/{version}"


def published_tables(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The tables of the newest complete version, all of the same one; none if there is none."""
    newest = _newest(spark, directory)
    if newest is None:
        return {}
    folder = f"{directory}/versions/{newest['version']}"
    return {name: spark.read.parquet(f"{folder}/{name}") for name in newest["tables"].split(",")}


def _newest(spark: SparkSession, directory: str) -> Row | None:
    """The manifest's row with the largest number; its file list is read anew."""
    try:
        manifest = spark.read.schema(_MANIFEST).parquet(f"{directory}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return manifest.orderBy(F.desc("number")).first()


def preview(df: DataFrame, rows: int = 20) -> None:
    df.show(rows, truncate=False)
