from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from forumlens.functions import text
from forumlens.operators import communities as com, leaderboards as boards, ranking

SCHEMA = "id string, comments string, ups long, key long"
# One community holds most rows, another has no name.
ROWS = (
    [("hot", f"word{i} foo-bar", i % 3, i) for i in range(400)]
    + [("small", "alpha beta", 1, 1000), ("small", None, None, 1001), ("small", "", -1, 1002)]
    + [(None, "nameless text here", 2, 2000 + i) for i in range(50)]
    + [("zero", "gamma", 0, 3000), ("minus", "delta", -4, 3001), ("nothing", None, None, 3002)]
)


@pytest.fixture(scope="module")
def comments(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


def by_id(rows):
    groups = defaultdict(list)
    for id_, value, ups, key in rows:
        groups[id_].append((key, value, ups))
    return {k: sorted(v) for k, v in groups.items()}


EXPECTED = by_id(ROWS)


def test_small_limit_splits_only_large_communities(comments):
    rows = com.community_text(comments, part_chars=500).collect()
    parts = Counter(r["id"] for r in rows)
    assert parts["hot"] > 5
    assert parts[None] > 1
    assert parts["small"] == parts["zero"] == parts["nothing"] == 1
    words = {
        id_: sorted(w for r in rows if r["id"] == id_ for w in r["comments"].split())
        for id_ in parts
    }
    for id_, group in EXPECTED.items():
        assert words[id_] == sorted(w for _, value, _ in group for w in (value or "").split())


@pytest.mark.parametrize("part_chars", [1, 40, 500, 10_000_000])
def test_parts_in_order_are_the_document(comments, part_chars):
    rows = com.community_text(comments, part_chars=part_chars).orderBy("id", "part").collect()
    for id_, group in EXPECTED.items():
        before, parts = 0, defaultdict(list)
        for _, value, _ in group:
            parts[before // part_chars].append(value)
            before += len(value or "")
        want = [(p, " ".join(v for v in vs if v is not None)) for p, vs in sorted(parts.items())]
        assert [(r["part"], r["comments"]) for r in rows if r["id"] == id_] == want


def test_comments_without_keys_are_spread_over_their_parts(spark):
    rows = spark.createDataFrame([("a", f"text {i:04d}", None) for i in range(2000)], "id string, comments string, key string")
    sizes = [len(r["comments"]) for r in com.community_text(rows, part_chars=450).collect()]
    assert len(sizes) == 40
    assert max(sizes) < 600


def test_key_is_the_first_filled_field(spark):
    raw = spark.createDataFrame([("s", "b", 1, "n", "i"), ("s", "b", 1, None, "j")], "subreddit string, body string, ups long, name string, id string")
    assert sorted(r["key"] for r in com.select_comments(raw).collect()) == ["j", "n"]


def test_one_part_is_in_key_order(comments):
    rows = {r["id"]: r["comments"] for r in com.community_text(comments, ", ").collect()}
    for id_, group in EXPECTED.items():
        assert rows[id_] == ", ".join(v for _, v, _ in group if v is not None)


def test_empty_texts_can_be_left_out(comments):
    rows = {r["id"]: r["comments"] for r in com.community_text(comments, "|", drop_empty=True).collect()}
    assert rows["small"] == "alpha beta"
    assert "nothing" not in rows
    filtered = com.community_text(com.drop_empty(comments), "|").collect()
    assert rows == {r["id"]: r["comments"] for r in filtered}


def test_lookup_by_shuffle_gives_the_same_parts(comments):
    size = F.coalesce(F.length("comments"), F.lit(0))
    few, many = (
        sorted(
            (r["key"], r["part"])
            for r in com.with_parts(comments, "id", ["key"], size, 10, max_rows=n).collect()
        )
        for n in (100, 1)
    )
    assert few == many
    assert len(few) == len(ROWS)


@pytest.mark.parametrize("part_chars", [300, 10_000_000])
def test_documents_carry_the_totals_of_the_community(comments, part_chars):
    tokens = text.ascii_tokens(F.col("comments"))
    documents = com.community_documents(comments, tokens, part_chars=part_chars)
    collected = documents.collect()
    counted = Counter()
    for row in collected:
        group = EXPECTED[row["id"]]
        ups = [u for _, _, u in group if u is not None]
        assert row["ups"] == (sum(ups) if ups else None)
        assert row["comm_count"] == (len(group) if row["id"] is not None else 0)
        counted[row["id"]] += len(row["comments"])
    assert counted["hot"] == 400
    assert {r["id"]: (r["ups"], r["comm_count"]) for r in com.stats_of_documents(documents).collect()} == {
        r["id"]: (r["ups"], r["comm_count"]) for r in com.community_stats(comments).collect()
    }


def test_tokens_and_lists(comments):
    cleaned = comments.withColumn("comments", text.ascii_tokens(F.col("comments")))
    flat = {r["id"]: r["comments"] for r in com.community_tokens(cleaned).collect()}
    nested = {r["id"]: r["comments"] for r in com.community_token_lists(cleaned).collect()}
    assert flat == {k: [t for tokens in v for t in tokens] for k, v in nested.items()}
    assert flat["small"] == ["alpha", "beta"]
    assert flat["nothing"] == []
    assert len(nested["small"]) == 3


def test_first_comment(comments):
    first = {r["id"]: r["comments"] for r in com.first_comment(comments).collect()}
    assert first["small"] == "alpha beta"
    assert first["hot"] == "word0 foo-bar"


def test_selection(spark):
    raw = spark.createDataFrame([("s", "b", 1, "n", 9)], "subreddit string, body string, ups long, name string, gilded long")
    assert com.select_comments(raw).columns == ["id", "comments", "ups", "key"]
    assert com.select_comments(raw, ups=None, key=None).columns == ["id", "comments"]
    assert com.only_community(com.select_comments(raw), "x").count() == 0
    empty = spark.createDataFrame([("",), ("a",), (None,)], "comments string")
    assert [r["comments"] for r in com.drop_empty(empty).collect()] == ["a"]


def test_boards(comments):
    stats = com.with_ratio(com.community_stats(comments))
    named = stats.filter(F.col("id").isNotNull())
    ups = [r["ups"] for r in boards.by_ups(named).collect()]
    known = [u for u in ups if u is not None]
    assert known == sorted(known, reverse=True)
    assert len(ups) == named.count()
    ratios = [r["comm_ups_ratio"] for r in boards.by_ratio(named).collect()]
    assert ratios == sorted(ratios, reverse=True)  # numbers, not text
    assert {r["id"] for r in boards.positive_ratios(named).collect()} == {"hot"}
    lurkers = boards.lurkers(named)
    merged = boards.merged_board(named.select("id", "comm_count"), named.select("id", "ups"), lurkers)
    assert merged.count() == named.count()
    assert merged.filter(F.col("lurker").isNull()).count() == named.count() - 1
    top = boards.top_board(named.select("id", "comm_count"), "comm_count", 2)
    ids = boards.shown_ids(top, boards.top_board(lurkers, "lurker", 2))
    shown, hidden = boards.shown(merged, ids), boards.not_shown(merged, ids)
    assert {r["id"] for r in ids.collect()} == {"hot", "small"}
    everyone = sorted(r["id"] for r in shown.union(hidden).collect())
    assert everyone == sorted(r["id"] for r in merged.collect())
    assert boards.without_communities(merged, ["hot"]).count() == merged.count() - 1
    assert boards.leader(named, "comm_count").first()["id"] == "hot"
    totals = boards.totals_text(named).first()
    assert (totals["total_comments"], totals["total_communities"]) == ("406", "5")


def test_positions_are_dense_and_in_order(spark):
    df = spark.range(5000).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(97)))
    rows = ranking.with_position(df, [F.desc("v"), F.asc("id")]).orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(5000))
    assert [(-r["v"], r["id"]) for r in rows] == sorted((-r["v"], r["id"]) for r in rows)


def test_index_agrees_with_the_ml_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame([(c,) for c in "bbbaaaccd"], "id string")
    indexed = StringIndexer(inputCol="id", outputCol="index").fit(df).transform(df)
    ml = {r["id"]: int(r["index"]) for r in indexed.collect()}
    assert ml == {r["id"]: r["index"] for r in ranking.index_by_frequency(df).collect()}


@pytest.mark.parametrize("n", [0, 1, 37, 999, 1000, 5000])
def test_sample_is_exact_and_repeatable(spark, n):
    df = spark.range(1000)
    first = {r["id"] for r in ranking.seeded_sample(df, ["id"], n, seed=10).collect()}
    again = {r["id"] for r in ranking.seeded_sample(df.repartition(7), ["id"], n, seed=10).collect()}
    assert first == again
    assert len(first) == min(n, 1000)
    if n == 37:
        other = {r["id"] for r in ranking.seeded_sample(df, ["id"], n, seed=11).collect()}
        assert other != first


def test_top_rows(spark):
    rows = ranking.top_rows(spark.range(100), [F.desc("id")], 3).collect()
    assert [r["id"] for r in rows] == [99, 98, 97]


@pytest.mark.parametrize("n", [1, 3, 100])
def test_top_boards_in_one_pass(spark, n):
    """Ties, unknown values, the null community, and numbers that a double cannot tell apart."""
    big = 1 << 60
    rows = [(f"c{i}", i % 7, i % 5 - 2, round(i % 6 / 7, 3)) for i in range(200)]
    rows += [(None, 9, None, 0.5), ("x", 9, big + 1, None), ("y", 9, big, 0.5), ("z", None, big + 1, -1.0)]
    stats = spark.createDataFrame(rows, "id string, comm_count long, ups long, comm_ups_ratio double").repartition(7)
    got = boards.top_boards(stats, n)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1
    found = defaultdict(list)
    for r in got.orderBy("board", "place").collect():
        found[r["board"]].append((r["id"], r[r["board"]]))
    sources = {"comm_count": stats, "ups": stats, "lurker": boards.lurkers(stats)}
    for name, source in sources.items():
        wanted = boards.top_board(source.select("id", name), name, n).collect()
        assert found[name] == [(r["id"], r[name]) for r in wanted]
    assert not boards.top_boards(stats.limit(0), n).collect()
    with pytest.raises(ValueError):
        boards.top_boards(stats, 1_000_000)


def test_null_values_and_the_null_community_on_boards(spark):
    ups = spark.createDataFrame([("a", None), ("b", 3), (None, 3), ("c", 1)], "id string, ups long")
    assert boards.leader(ups, "ups").first()["id"] == boards.by_ups(ups).first()["id"]
    counts = ups.select("id", F.lit(1).alias("comm_count"))
    lurkers = ups.select("id", F.lit(0.5).alias("lurker")).limit(4)
    merged = boards.merged_board(counts, ups, lurkers)
    assert merged.count() == 4
    ids = boards.shown_ids(ups.filter("id IS NULL"))
    assert [r["id"] for r in boards.shown(merged, ids).collect()] == [None]
    assert sorted(r["id"] for r in boards.not_shown(merged, ids).collect()) == ["a", "b", "c"]


def test_content_sample_does_not_depend_on_splits(spark, monkeypatch):
    monkeypatch.setattr(ranking, "OCCURRENCES", 7)
    rows = [("hot", 1)] * 300 + [(f"row {k}", k % 3) for k in range(200)] + [(None, None)] * 5 + [("", None)]
    df = spark.createDataFrame(rows, "text string, _other int")
    samples = [
        sorted(map(tuple, ranking.content_sample(part, 100).collect()), key=str)
        for part in (df.coalesce(1), df.repartition(7), df.repartition(50, "text").orderBy(F.rand()))
    ]
    assert samples[0] == samples[1] == samples[2]
    assert len(samples[0]) == 100
    assert 30 < samples[0].count(("hot", 1)) < 85  # 59 of 100 are expected
    assert sorted(map(tuple, ranking.content_sample(df, 1000).collect()), key=str) == sorted(rows, key=str)
    assert samples[0] != sorted(map(tuple, ranking.content_sample(df, 100, seed=11).collect()), key=str)
    assert not ranking.content_sample(df.limit(0), 10).collect()
