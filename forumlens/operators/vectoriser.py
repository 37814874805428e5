"""Spark's count vectoriser with its vocabulary as a table: neither the driver nor a task holds all terms."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from forumlens.operators.lookup import lookup_join
from forumlens.operators.ranking import with_position
from forumlens.operators.terms import word_counts
from forumlens.session import materialise, scratch_path

SHARED_TERMS = 20_000  # rows of the vocabulary that may go to all tasks: the frequent ones, or a small one


class TermTableModel(CountVectorizerModel):
    """Counts over ``terms``, a written table ``idx, term, n``; other terms are left out."""

    def __init__(self, terms: DataFrame, size: int, tokens: str, output: str):
        super().__init__()
        self.terms, self.size, self.tokens, self.output = terms, size, tokens, output

    def getInputCol(self) -> str:
        return self.tokens

    def getOutputCol(self) -> str:
        return self.output

    @property
    def vocabulary(self) -> list[str]:
        """All terms on the driver, for small vocabularies."""
        return [r["term"] for r in self.terms.orderBy("idx").collect()]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = materialise(dataset.withColumn("_row", F.monotonically_increasing_id()), "token-rows")
        tokens = rows.select("_row", F.explode(self.tokens).alias("term"))
        known = self.terms.select(F.col("term").alias("_term"), "idx", "n")
        found = lookup_join(tokens, known, "term", "_term", "n", max_rows=SHARED_TERMS).select("_row", "idx").filter("idx IS NOT NULL")
        every = found.unionByName(rows.select("_row", F.lit(None).cast("int").alias("idx")))  # also rows without a term
        counts = every.repartition("_row").groupBy("_row", "idx").agg(F.count("idx").cast("double").alias("n"))
        return rows.join(self._vectors(counts).hint("merge"), "_row").select(*dataset.columns, self.output)

    def _vectors(self, counts: DataFrame) -> DataFrame:
        """``_row`` and its vector. A file holds vectors by their own layout, so that a written struct is read as one."""
        entry = F.when(F.col("idx").isNotNull(), F.struct("idx", "n"))
        packed = counts.groupBy("_row").agg(F.sort_array(F.collect_list(entry)).alias("e"))
        layout = F.struct(
            F.lit(0).cast("byte").alias("type"),
            F.lit(self.size).alias("size"),
            F.col("e.idx").alias("indices"),
            F.col("e.n").alias("values"),
        )
        spark = counts.sparkSession
        path = scratch_path(spark, "token-vectors")
        packed.select("_row", layout.alias(self.output)).write.parquet(path)
        schema = T.StructType([T.StructField("_row", T.LongType()), T.StructField(self.output, VectorUDT())])
        return spark.read.schema(schema).parquet(path)


class TermVectoriser(Estimator):
    """The ``size`` most frequent terms of a column of tokens; ties in alphabetical order."""

    def __init__(self, tokens: str, output: str, size: int):
        super().__init__()
        self.tokens, self.output, self.size = tokens, output, size

    def getOutputCol(self) -> str:
        return self.output

    def _fit(self, dataset: DataFrame) -> TermTableModel:
        counts = word_counts(dataset, F.col(self.tokens)).filter("word IS NOT NULL")
        ranked = with_position(counts, [F.desc("n"), F.asc("word")], "idx").filter(F.col("idx") < self.size)
        terms = materialise(ranked.select(F.col("idx").cast("int").alias("idx"), F.col("word").alias("term"), "n"), "vocabulary")
        return TermTableModel(terms, terms.count(), self.tokens, self.output)
