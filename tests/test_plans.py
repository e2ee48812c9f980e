"""What the physical plans must look like, and must not."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from weftline.operators import changes, joins, leaderboard, limiter
from weftline.operators.ordered import OrderedGroups, top_per_group
from weftline.plans.registry import QUERIES
from weftline.streaming import windows

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["filter_compare"](spark, FOLDER))
    assert "GreaterThanOrEqual(c_acctbal,5000" in text
    assert re.search(r"ReadSchema: struct<c_custkey:bigint,c_acctbal:double,c_mktsegment:string>", text)


def test_parent_filter_is_pushed_below_the_join(spark):
    assert "EqualTo(c_mktsegment,MACHINERY)" in plan(QUERIES["join_filter_parent"](spark, FOLDER))


@pytest.mark.parametrize("name", ["topk_newest", "bottomk_oldest", "page_offset", "page_keyset", "leaderboard_top"])
def test_top_k_needs_no_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize("name", ["topn_per_group", "recent_n", "list_range", "hourly_topk", "topn_with_ties"])
def test_groups_are_limited_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(QUERIES[name](spark, FOLDER))


def test_scalar_is_not_a_join(spark):
    assert "Join" not in plan(QUERIES["cross_scalar"](spark, FOLDER))


def test_the_many_side_is_aggregated_before_the_join(spark):
    for name in ("cond_agg_case", "count_with_zero", "group_fd"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert text.index("Join") < text.index("HashAggregate"), name


# A whole table sorted, numbered or summed up without a key.
@pytest.mark.parametrize("name", ["win_running_global", "assign_ids", "leaderboard_rank"])
def test_no_single_task_holds_the_table(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for block in re.split(r"\n(?=[ :+\-]*Window)", text)[1:]:
        exchange = re.search(r"Exchange (\w+)", block)
        assert exchange is None or exchange.group(1) != "SinglePartition" or "__c_" in block.split("\n")[0]


def test_large_groups_are_shuffled_by_slice(spark):
    frame = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    done = OrderedGroups(frame, ["k"], ["id"], limit=50).running({"s": ("sum", "id")}).df
    assert re.search(r"hashpartitioning\(k#\w+, __slice#\d+", plan(done))


def test_slices_are_ranges_of_a_stored_table(spark):
    """The base is read to count and to part it; what follows reads the written ranges."""
    frame = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    text = plan(OrderedGroups(frame, ["k"], ["id"], limit=50).number("n").df)
    assert "Range (" not in text and "RangePartitioning" not in text and "FileScan parquet" in text


def test_limiter_has_one_exchange(spark):
    frame = spark.read.parquet(f"{FOLDER}/events.parquet")
    assert plan(limiter.limit_from_first_hit(frame, "user_id", "ts", "event_id", 2, 86_400).where("ts IS NOT NULL")).count("Exchange") == 1


def test_sessions_are_merged_before_the_shuffle(spark):
    """A key with very many rows sends one row per task and session."""
    frame = spark.range(20_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id")).alias("ts"))
    done = windows.sessions(frame, "ts", "1 minute", "0 seconds", ["k"], n=F.count(F.lit(1)))
    assert [r.n for r in done.collect()] == [20_000]
    text = plan(done)
    assert text.index("MergingSessions") < text.index("Exchange") < text.rindex("MergingSessions")


def test_a_hot_join_key_is_split(spark, tmp_path):
    """AQE cuts the partition of a hot key although an aggregate on the same key follows."""
    path = str(tmp_path / "facts")
    spark.range(400_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), "id").write.parquet(path)
    names = spark.range(400_000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = joins.lookup(spark.read.parquet(path), names.withColumnRenamed("k", "key"), "k", "key")
        done = joined.groupBy("k").agg(F.max("name").alias("name"), F.count("*").alias("n"))
        assert done.agg(F.sum("n")).first()[0] == 400_000
        done.collect()
        assert "skew=true" in plan(done)
    finally:
        for key in settings:
            spark.conf.unset(key)


from weftline.plans import catalog  # noqa: E402


def test_every_query_has_sql(spark):
    # All of the library's own; of the training-data queries SQL cannot express some.
    assert set(catalog.ORACLES) == set(catalog.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 150


def test_top_per_group_has_one_shuffle(spark):
    frame = spark.read.parquet(f"{FOLDER}/events.parquet")
    assert plan(top_per_group(frame, ["user_id"], ["-ts"], 2)).count("Exchange") == 1


def test_upsert_aggregates_on_the_map_side(spark):
    frame = spark.read.parquet(f"{FOLDER}/events.parquet").select("user_id", "ts", "event_id", "value")
    text = plan(changes.upsert_latest(frame, frame, ["user_id"], ["ts", "event_id"]))
    assert "partial_max_by" in text


def test_scores_add_up_on_the_map_side(spark):
    frame = spark.read.parquet(f"{FOLDER}/events.parquet")
    assert "partial_sum" in plan(leaderboard.scores(frame, "user_id", F.col("value")))
