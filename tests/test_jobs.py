from __future__ import annotations

import gzip
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from checks import tables as t
from forumlens import schemas
from forumlens.operators import communities as com
from forumlens.plans import (
    clean_documents,
    community_statistics,
    page_comments,
    prototypes,
    serving_tables,
    topic_model,
)
from forumlens.sources import readers, writers
from forumlens.sources.writers import SERVING_TABLES

COMMENTS = [
    {"subreddit": "cats", "body": "My cats like boxes. Cat box!", "ups": 3, "name": "t1_1", "id": "1"},
    {"subreddit": "cats", "body": "A cat, a \"box\" and\nwolves", "ups": 2, "name": "t1_2"},
    {"subreddit": "dogs", "body": "Dogs chase cats", "ups": 0, "name": "t1_3"},
    {"subreddit": "dogs", "body": None, "ups": None, "name": "t1_4"},
    {"subreddit": "empty", "body": "the of", "ups": -1, "name": "t1_5", "gilded": 1},
]


@pytest.fixture
def json_path(tmp_path):
    path = str(tmp_path / "comments.json.gz")
    with gzip.open(path, "wt") as out:
        out.write("\n".join(json.dumps(c) for c in COMMENTS))
    return path


def test_fixed_layouts():
    assert len(schemas.COMMENTS) == 21
    assert len(schemas.SUBMISSIONS) == 37
    assert schemas.COMMENTS["edited"].dataType.simpleString() == "string"
    assert schemas.SUBMISSIONS["edited"].dataType.simpleString() == "boolean"


def test_comments_reader(spark, json_path):
    read = readers.read_comments(spark, json_path, partitions=3)
    assert read.columns == schemas.COMMENTS.names
    assert read.rdd.getNumPartitions() == 3
    rows = {r["name"]: r for r in read.collect()}
    assert rows["t1_1"]["ups"] == 3
    assert rows["t1_1"]["gilded"] is None
    assert rows["t1_4"]["body"] is None
    assert rows["t1_5"]["gilded"] == 1


def test_only_used_fields_are_read(spark, json_path):
    narrow = com.select_comments(readers.read_comments(spark, json_path, partitions=3))
    plan = com.community_stats(narrow)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<subreddit:string,ups:bigint>" in plan


def test_csv_writer_refuses_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 'x, "y"\nz')], "id string, comments string")
    writers.write_csv(df, path, overwrite=False)
    with pytest.raises(AnalysisException):
        writers.write_csv(df, path, overwrite=False)
    writers.write_csv(df, path)
    assert readers.read_documents(spark, path, multiline=True).collect() == df.collect()


def test_result_reader_takes_parts_only(spark, tmp_path):
    path = tmp_path / "result"
    path.mkdir()
    (path / "part-0.csv").write_text("a,1\n")
    (path / "other.csv").write_text("b,2\n")
    (path / "part-1.txt").write_text("c,3\n")
    rows = readers.read_result(spark, str(path), schemas.UPS_BOARD).collect()
    assert [(r["id"], r["ups"]) for r in rows] == [("a", 1)]


def test_page_reader_unites_pages_by_column_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,comment_message\n1,"b\'x, ""y""\nz\'"\n')
    (tmp_path / "b.csv").write_text("comment_message,likes\nhello,3\n")
    read = readers.read_pages(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv")])
    assert sorted(r["comment_message"] for r in read.collect()) == ["b'x, \"y\"\nz'", "hello"]


def test_preview(spark, capsys):
    writers.preview(spark.range(1))
    assert "|0" in capsys.readouterr().out


def test_clean_documents(spark, json_path, tmp_path):
    out = str(tmp_path / "documents")
    clean_documents.run(spark, json_path, out, partitions=2)
    rows = {r["id"]: r["comments"] for r in readers.read_documents(spark, out).collect()}
    # Without a dictionary, a word is a lemma only if the comments have it too.
    assert rows == {"cats": "cat like box cat box cat box wolves", "dogs": "dogs chase cat"}


def test_clean_documents_with_dictionary(spark, json_path, tmp_path):
    nouns = spark.createDataFrame([(w,) for w in "cat box wolf dog".split()], "word string")
    out = str(tmp_path / "documents")
    clean_documents.run(spark, json_path, out, dictionary=nouns)
    rows = {r["id"]: r["comments"] for r in readers.read_documents(spark, out).collect()}
    assert rows == {"cats": "cat like box cat box cat box wolf", "dogs": "dog chase cat"}


@pytest.mark.parametrize("lemmas", [False, True])
def test_statistics_topics_and_serving(spark, small, tmp_path, lemmas):
    """The whole chain, from JSON to the serving tables."""
    paths = {
        n: str(tmp_path / n)
        for n in ("json", "documents", "counts", "ups", "ratios", "topics", "words", "serving")
    }
    records = t.comments(spark, small, True).select(
        F.col("key").cast("string").alias("name"),
        F.col("id").alias("subreddit"),
        F.col("comments").alias("body"),
        "ups",
    )
    records.write.json(paths["json"])
    community_statistics.run(
        spark, paths["json"], paths["documents"], paths["counts"], paths["ups"], paths["ratios"],
        lemmas=lemmas,
    )
    stats = com.community_stats(t.comments(spark, small, True))
    communities = stats.count()
    counts = readers.read_result(spark, paths["counts"], schemas.COUNT_BOARD)
    assert counts.exceptAll(stats.select("id", "comm_count")).count() == 0
    assert counts.count() == communities
    with pytest.raises(AnalysisException):
        community_statistics.run(
            spark, paths["json"], paths["documents"], paths["counts"], paths["ups"], paths["ratios"]
        )
    topic_model.run(
        spark, paths["documents"], paths["topics"], paths["words"], threshold=None, k=3, iterations=2
    )
    serving_tables.run(
        spark, paths["counts"], paths["ups"], paths["ratios"], paths["topics"], paths["words"],
        paths["serving"], k=3, excluded=["src0_en"],
    )
    tables = {n: spark.read.parquet(f"{paths['serving']}/{n}") for n in SERVING_TABLES}
    assert sorted(os.listdir(paths["serving"])) == sorted(SERVING_TABLES)
    assert tables["layout"].count() == communities
    assert tables["merged"].count() == communities - 1
    assert tables["totals"].first()["total_comments"] == "200"
    assert tables["topic_words"].count() == 3
    assert all(len(r["dists"]) == 3 for r in tables["topic_words"].collect())


@pytest.mark.parametrize("kind, bag", [("csv", "hashed"), ("json", "regex"), ("csv", "counts")])
def test_other_topic_inputs(spark, small, tmp_path, kind, bag):
    comments = t.comments(spark, small)
    source, out, words = (str(tmp_path / n) for n in ("source", "topics", "words"))
    if kind == "csv":
        one_line = comments.withColumn("comments", F.translate("comments", '\n",', "   "))
        writers.write_csv(com.community_text(one_line).select("id", "comments"), source)
    else:
        comments.select(F.col("id").alias("subreddit"), F.col("comments").alias("body")).write.json(source)
    topic_model.run(spark, source, out, words, kind, bag, threshold=None, k=3, iterations=1)
    rows = readers.read_result(spark, out, schemas.DISTRIBUTIONS).collect()
    assert len(rows) == 20
    for row in rows:
        assert sum(map(float, row["topicDistribution"].split(","))) == pytest.approx(1, abs=1e-4)
    if bag != "hashed":
        assert spark.read.parquet(words).count() == 3


def test_page_comments(spark, tmp_path):
    (tmp_path / "a.csv").write_text("comment_message\nb'Cats [[gif]] rock!'\nb'the 123'\n")
    (tmp_path / "b.csv").write_text("comment_message\nb'A cat'\n")
    out = str(tmp_path / "out")
    page_comments.run(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv")], out)
    rows = sorted(r["_c0"] for r in spark.read.csv(out).collect())
    assert rows == ["cat", "cat rock"]


def test_prototypes(spark, small, tmp_path):
    source = str(tmp_path / "json")
    t.comments(spark, small).select(
        F.col("key").cast("string").alias("name"),
        F.col("id").alias("subreddit"),
        F.col("comments").alias("body"),
    ).write.json(source)
    out = str(tmp_path / "out")
    prototypes.first_comment_topics(spark, source, out, iterations=1)
    rows = readers.read_result(spark, out, schemas.DISTRIBUTIONS).collect()
    assert len(rows) == 20
    assert all(len(r["topicDistribution"].split(",")) == 5 for r in rows)
    matrix, index = prototypes.indexed_topics(spark, source, k=3, iterations=2)
    assert index.count() == 20
    assert matrix.select("topic").distinct().count() == 3


LINES = [
    '{"name": "t1_1", "ups": 3, "subreddit": "a", "body": "one", "unknown": [1]}',
    '{"name": "t1_2", "ups": null}',
    "{}",
    '{"name": "t1_3", "ups": ',
    '{"name": "t1_4", "ups": "many"}',
    "no JSON at all",
    "null",
    "17",
    "",
    "  \t",
]


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "lines.json")
    with open(path, "w") as out:
        out.write("\n".join(LINES))
    records, malformed = readers.read_lines_apart(spark, path)
    assert records.schema.names == schemas.COMMENTS.names
    got = sorted((r["name"] or "", r["ups"]) for r in records.collect())
    assert got == [("", None), ("t1_1", 3), ("t1_2", None)]
    assert records.select("name").count() == 3  # the same for any columns
    assert sorted(r["line"] for r in malformed.collect()) == sorted(LINES[3:8])
    assert {os.path.basename(r["file"]) for r in malformed.collect()} == {"lines.json"}


def test_malformed_lines_of_nothing(spark, tmp_path):
    path = str(tmp_path / "none.json")
    open(path, "w").close()
    assert [df.count() for df in readers.read_lines_apart(spark, path)] == [0, 0]


def test_statistics_without_malformed_lines(spark, json_path, tmp_path):
    mixed = str(tmp_path / "mixed.json")
    with gzip.open(json_path, "rt") as whole, open(mixed, "w") as out:
        out.write(whole.read() + "\n" + "\n".join(LINES[3:8]))
    names = ("documents", "counts", "ups", "ratios")
    one, two = ([str(tmp_path / f"{k}-{name}") for name in names] for k in (1, 2))
    community_statistics.run(spark, json_path, *one)
    community_statistics.run(spark, mixed, *two, malformed=str(tmp_path / "malformed"))
    for first, second in zip(one[1:], two[1:], strict=True):
        rows = [sorted(map(tuple, spark.read.csv(path).collect()), key=str) for path in (first, second)]
        assert rows[0] == rows[1]
    assert spark.read.parquet(str(tmp_path / "malformed")).count() == 5


def test_published_versions(spark, tmp_path):
    directory = str(tmp_path / "served")
    assert writers.published_tables(spark, directory) == {}
    old = {"a": spark.range(3), "b": spark.range(4)}
    writers.publish_tables(old, directory)
    reading = writers.published_tables(spark, directory)
    broken = spark.range(5).select(F.raise_error(F.lit("no table")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no table"):
        writers.publish_tables({"a": spark.range(9), "b": broken}, directory)
    assert {k: df.count() for k, df in writers.published_tables(spark, directory).items()} == {"a": 3, "b": 4}
    writers.publish_tables({"a": spark.range(1), "b": spark.range(2)}, directory)
    assert {k: df.count() for k, df in writers.published_tables(spark, directory).items()} == {"a": 1, "b": 2}
    assert {k: df.count() for k, df in reading.items()} == {"a": 3, "b": 4}  # not disturbed
