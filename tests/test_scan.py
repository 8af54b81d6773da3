import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from mobility.operators.scan import _BUCKET, previous_value, running_count, with_buckets


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k string, t long, id long, flag int, v string").select(
        "k", F.timestamp_seconds("t").alias("ts"), "id", "flag", "v")


def _expected(df):
    w = Window.partitionBy("k").orderBy("ts", "id")
    return (df.withColumn("r", F.sum("flag").over(w.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("p", F.lag("v").over(w)))


rows_strategy = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 20_000),
                                   st.integers(0, 10_000), st.integers(0, 1), st.sampled_from(["x", "y", "z"])),
                         min_size=1, max_size=80, unique_by=lambda r: r[2])


@settings(max_examples=12, deadline=None)
@given(rows_strategy, st.integers(1, 40))
def test_bucketed_scans_equal_plain_windows(spark, rows, quota):
    df = _frame(spark, rows)
    got = running_count(df, "k", ["ts", "id"], "flag", "r", quota=quota)
    got = previous_value(got, "k", ["ts", "id"], "v", "p", quota=quota)
    assert sorted((r.id, r.r, r.p) for r in got.collect()) == \
        sorted((r.id, r.r, r.p) for r in _expected(df).collect())


def test_one_hot_instant_is_split(spark):
    # 3,000 rows of one key at one instant (a replayed burst) plus other keys:
    # no bucket may hold more than the quota, and the result stays exact.
    rows = [("hot", 100, i, random.randint(0, 1), random.choice("xyz")) for i in range(3000)]
    rows += [("hot", 5000 + i, 50_000 + i, 1, "x") for i in range(700)]
    rows += [(f"k{i % 7}", i, 10_000 + i, i % 2, "x") for i in range(600)]
    df = _frame(spark, rows)
    sizes = with_buckets(df, "k", ["ts", "id"], 500).groupBy("k", *_BUCKET).count().collect()
    assert max(r["count"] for r in sizes) <= 500
    got = running_count(df, "k", ["ts", "id"], "flag", "r", quota=500)
    got = previous_value(got, "k", ["ts", "id"], "v", "p", quota=500)
    assert sorted((r.id, r.r, r.p) for r in got.collect()) == \
        sorted((r.id, r.r, r.p) for r in _expected(df).collect())


def test_scans_stay_in_the_jvm_and_start_no_job(spark):
    df = _frame(spark, [("a", 1, 1, 1, "x")])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("scan-build", "")
    got = previous_value(running_count(df, "k", ["ts", "id"], "flag", "r"), "k", ["ts", "id"], "v", "p")
    assert tracker.getJobIdsForGroup("scan-build") == []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_rows_without_a_key_are_dropped_and_exclusive_counts_start_at_zero(spark):
    df = _frame(spark, [("a", 5, 1, 1, "x"), ("a", 6, 2, 1, "y"), (None, 7, 3, 1, "z")])
    got = running_count(df, "k", ["ts", "id"], "flag", "r", inclusive=False).collect()
    assert sorted((r.id, r.r) for r in got) == [(1, 0), (2, 1)]
