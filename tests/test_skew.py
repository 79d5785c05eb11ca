import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from docintake.operators import skew


@pytest.fixture(scope="module")
def hot_left(spark):
    """3,000 rows of which a third share one key and some have no key."""
    rows = [
        (n, "hot" if n % 3 == 0 else None if n % 50 == 1 else f"k{n % 40}") for n in range(3000)
    ]
    return spark.createDataFrame(rows, "id long, key string")


@pytest.fixture(scope="module")
def unique_right(spark):
    rows = [("hot", 1), (None, 2)] + [(f"k{n}", n) for n in range(0, 60, 2)]
    return spark.createDataFrame(rows, "key string, value long")


LOW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def low_thresholds(spark):
    for k, v in LOW.items():
        spark.conf.set(k, v)
    yield
    for k in LOW:
        spark.conf.unset(k)


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_key_join_equals_join(hot_left, unique_right, low_thresholds, how):
    got = skew.key_join(hot_left, unique_right, ["key"], how)
    assert Counter(got.collect()) == Counter(hot_left.join(unique_right, "key", how).collect())


@pytest.mark.parametrize("key", ["hot", None])
def test_a_third_of_the_rows_under_one_key_are_split(spark, unique_right, low_thresholds, key):
    hot = F.when(F.col("id") % 3 == 0, F.lit(key)).otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    left = spark.range(0, 60_000, 1, 8).select("id", hot.alias("key"), F.uuid().alias("payload"))
    joined = skew.key_join(left, unique_right, ["key"])
    assert joined.count() == 60_000
    rows = joined.select("id", "value", F.length("payload"))
    rows.collect()
    assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()


def test_a_side_is_broadcast_by_its_measured_size_only(spark, tmp_path):
    batch = spark.range(100).select("id", F.lit("u").alias("pdf_link"))
    wide = batch.select("pdf_link", F.repeat(F.lit("x"), 500_000).alias("title"))
    right = wide.groupBy("pdf_link").agg(F.max("title").alias("title"))
    joined = skew.key_join(batch, right, ["pdf_link"])
    assert "strategy=broadcast" not in joined._jdf.queryExecution().analyzed().toString()


def test_key_types_must_agree(spark, hot_left):
    other = spark.range(3).select(F.col("id").alias("key"))
    with pytest.raises(ValueError):
        skew.key_join(hot_left, other, ["key"])


def test_running_equals_a_window(spark):
    rnd = random.Random(1)
    rows = [
        (
            n,
            "hot" if n % 3 == 0 else None if n % 40 == 1 else f"k{rnd.randrange(30)}",
            rnd.randrange(50),
            rnd.random() < 0.4,
            rnd.choice((None, None, f"v{n}")),
        )
        for n in range(4000)
    ]
    df = spark.createDataFrame(rows, "id long, key string, ts int, flag boolean, value string")
    got = skew.running(
        df,
        ["key"],
        ["ts", "id"],
        "test",
        counts={"n": F.col("flag"), "every": F.lit(True)},
        lasts={"latest": F.col("value")},
    )
    w = (
        Window.partitionBy("key")
        .orderBy("ts", "id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    whole = Window.partitionBy("key")
    want = df.select(
        "*",
        F.sum(F.col("flag").cast("long")).over(w).alias("n"),
        F.count("*").over(w).alias("every"),
        F.sum(F.col("flag").cast("long")).over(whole).alias("n_total"),
        F.count("*").over(whole).alias("every_total"),
        F.last("value", ignorenulls=True).over(w).alias("latest"),
    )
    assert got.columns == want.columns
    assert Counter(got.collect()) == Counter(want.collect())


def test_running_cuts_a_large_key_into_slices(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(8000).select("id", F.lit("hot").alias("key"))
        got = skew.running(df, ["key"], ["id"], "slices", counts={"n": F.lit(True)})
        assert got.where(F.col("n") != F.col("id") + 1).count() == 0
        plan = got._jdf.queryExecution().executedPlan().toString()
        # The rows are shuffled once more, by key and slice; the rest is one row per slice.
        by_slice = [x for x in plan.splitlines() if "Exchange hash" in x and "_slice" in x]
        assert 2 <= len(by_slice) <= 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_running_without_a_key_numbers_all_rows(spark):
    df = spark.range(5000).select("id", F.md5(F.col("id").cast("string")).alias("draw"))
    got = skew.running(df, [], ["draw"], "all", counts={"n": F.lit(True)}).orderBy("n")
    rows = got.collect()
    assert [r["n"] for r in rows] == list(range(1, 5001))
    assert [r["draw"] for r in rows] == sorted(r["draw"] for r in rows)
