"""The corpus pipeline: five operators in a row, each on all that the one before kept.

``STAGES`` has functions of ``(spark, docs, sf_dir)``; the result of each is written as parquet
and read as the next one's ``docs``. All but the last return the columns of ``documents``.
No stage can be written in SQL, so that the pipeline is tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from forumlens.llm import jaccard_join, mixing, packing, pseudonyms, toxicity
from forumlens.llm.queries import table, tokenizer
from forumlens.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold.

    Null and empty texts score 0 and stay. Repeated rows score alike. Without labelled documents
    of both kinds there is no model, and all stay. An empty table gives no row.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter(F.col("score") < toxicity.THRESHOLD).select(COLUMNS)

def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked ones: with the least doc_id (null last), then row hash.

    Equal texts are linked, so that repeated rows and rows with null or shared ids leave one too.
    Rows without a word are linked with nothing, and all stay. An empty table gives no row.
    """
    rows = materialise(docs.select(COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = jaccard_join.jaccard_components(rows.select(F.col("_row").alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias("_row"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64(*COLUMNS).alias("hash"), "_row")
    named = rows.select("_row", order.alias("order")).join(found, "_row")
    kept = named.groupBy("component_id").agg(F.min("order").alias("order")).select("order._row")
    return rows.join(kept, "_row", "left_semi").select(COLUMNS)

def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms by the session's key, or by the trial key if none is set.

    Null texts stay null and have a null ``n_chars``. Repeated rows stay alike, as equal values
    have equal pseudonyms. An empty table gives no row.
    """
    made = pseudonyms.pseudonymise(docs, pseudonyms.key_of(spark, pseudonyms.TRIAL_KEY))
    return made.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)

def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row for each round in which a document is used, with that text.

    Null texts and texts without a word give nothing to mix, and go. The null source is a source.
    Repeated rows are documents each. An empty table gives no row.
    """
    return mixing.mixed_documents(docs).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)

def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences, as ``op4_packing`` returns them.

    A null or empty text is its end token. Repeated rows and null ids are packed like all others.
    An empty table gives no row.
    """
    pieces = packing.cut(docs, tokenizer()).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(materialise(pieces, "pieces"))

STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("pseudonyms", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

ORACLE_SQL = None

def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
