"""One key may hold a third of all rows; results stay whole and no pairs are built."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recordqa.operators import batching, contract, cost, drift, duplicates, judging, metrics, profile

N = 60_000


@pytest.fixture(scope="module")
def skewed(spark):
    """60,000 results of one check in two runs; event ``hot`` holds a third of them."""
    i = F.col("id")
    return spark.range(N).select(
        "id",
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), i % 1000)).alias("event_id"),
        F.lit("semantic_accuracy").alias("check_name"),
        F.when(i % 2 == 0, "v1").otherwise("v2").alias("prompt_version"),
        F.when(i % 2 == 0, "r1").otherwise("r2").alias("run_id"),
        F.when(i % 5 == 0, "fail").otherwise("pass").alias("result"),
        (i % 10 / 10).alias("confidence"),
        F.timestamp_seconds(i).alias("created_at"),
    )


def test_all_pairs_are_counted_not_built(skewed):
    got = drift.drift_summary(skewed, null_mode="null_changed", dedupe=False).filter("check_name = 'semantic_accuracy'").first()
    counts = skewed.groupBy("event_id").agg(F.count_if(F.col("prompt_version") == "v1").alias("b"), F.count_if(F.col("prompt_version") == "v2").alias("c"))
    pairs = counts.agg(F.sum(F.col("b") * F.col("c"))).first()[0]
    assert got.common_rows == pairs >= 100_000_000
    hot = skewed.filter("event_id = 'hot'")
    n = {(r.prompt_version, r.result): r["count"] for r in hot.groupBy("prompt_version", "result").count().collect()}
    changed_hot = n["v1", "pass"] * n["v2", "fail"] + n["v1", "fail"] * n["v2", "pass"]
    assert got.decision_changed_count >= changed_hot > 0


def test_screen_examples_of_a_hot_event(skewed):
    got = drift.drift_examples_screen(skewed).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 11))
    assert all(r.event_id == "hot" and r.base_result != r.candidate_result for r in got)


def test_hot_event_in_groupings(skewed):
    assert metrics.kpi_points(skewed).first().total_points == skewed.select("event_id").distinct().count()
    last = drift.last_per_event(skewed).filter("event_id = 'hot'")
    assert rows(last, "run_id", "id") == [("r1", N - 6), ("r2", N - 3)]
    dup = profile.duplicate_ids(skewed, "event_id").filter("id = 'hot'").first()
    assert (dup.copies, dup.excess) == (N // 3, N // 3 - 1)
    both = contract.reconcile(skewed, skewed.filter("id > 0"), ("event_id",))
    assert rows(both) == [("hot", N // 3, N // 3 - 1, "missing")]


def test_hot_group_is_numbered_over_many_tasks(spark, skewed):
    got = batching.positions(skewed.select("id", "event_id"), ("id",), ("event_id",)).filter("event_id = 'hot'")
    assert got.agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first() == (0, N // 3 - 1, N // 3)
    assert got.filter(F.col("pos") != F.col("id") / 3).count() == 0


def test_hot_call_and_hot_answer(spark, skewed):
    calls = spark.createDataFrame([("hot", 20000.0, 2.0), ("e1", 10.0, None)], "call_id string, latency_ms double, cost_usd double")
    shared = cost.attribute_call(calls, skewed.select(F.col("event_id").alias("call_id"), "id"))
    assert shared.count() == N
    assert shared.filter("call_id = 'hot'").agg(F.max("latency_ms_per_row"), F.sum("cost_usd_per_row")).first() == (1.0, pytest.approx(2.0))
    answers = skewed.select(F.lit("c").alias("call_id"), "event_id", F.col("id").alias("position"), F.lit(1).cast("variant").alias("result"))
    best = judging.last_answer(answers)
    assert best.filter("event_id = 'hot'").first().position == N - 3


def test_hot_story(skewed):
    told = skewed.select("id", F.concat(F.lit("Same  STORY, "), "event_id").alias("article_sentence"), F.concat(F.lit("s"), F.col("id") % 7).alias("event_summary"))
    got = duplicates.dedupe_context(told).filter("id = 0").first().dedupe_context
    assert got.possible_duplicate_count == N // 3 - 1
    listed = duplicates.similar_summaries(told).filter(F.col("story") == got.story_key)
    assert listed.count() == 7


def test_rows_without_a_story_are_no_duplicates(spark):
    df = spark.createDataFrame([("1", None, "a"), ("2", "  ", "b"), ("3", "x", "c")], "event_id string, article_sentence string, event_summary string")
    got = duplicates.dedupe_context(df).orderBy("event_id").collect()
    assert [r.dedupe_context.possible_duplicate_count for r in got] == [0] * 3


def test_head_tokens_group_place_spellings(spark):
    df = spark.createDataFrame([("London, UK",), ("London",), ("london , United Kingdom",), ("Paris",)], "location string")
    got = profile.head_token_groups(df, "location").groupBy("head").count()
    assert rows(got) == [("london", 3), ("paris", 1)]
