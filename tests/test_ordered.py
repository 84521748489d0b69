"""Cut windows give what plain windows give, whatever the sizes of the groups."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from compare import spark_rows
from snapline.operators import features, gold, tracking
from snapline.operators.ordered import PART, by_group_size, numbered_rows, over_parts, rows_since, with_part


def skewed(spark, rows=3000, seed=3):
    """One group holds a third of all rows, one key is NULL, many groups are tiny; times repeat."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", None] + [f"k{j}" for j in range(200)])
        data.append((key, rng.randrange(rows // 4), f"p{i:05d}", rng.randrange(-5, 60), rng.random() < 0.02))
    return spark.createDataFrame(data, "k string, t int, id string, v int, hit boolean")


COLUMNS = {
    "prev": lambda w: F.lag("v").over(w),
    "next": lambda w: F.lead("v").over(w),
    "sum20": lambda w: F.sum("v").over(w.rowsBetween(-20, -1)),
    "mean7": lambda w: F.round(F.avg("v").over(w.rowsBetween(-5, 2)), 6),
}


def plain(df, keys, order, columns):
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumns({name: column(window) for name, column in columns.items()})


@pytest.mark.parametrize("partitions", [1, 7, 150])
def test_cut_windows_equal_plain_windows(spark, partitions):
    df = skewed(spark)
    cut = over_parts(df, ["k"], ["t", "id"], COLUMNS, before=20, after=2, partitions=partitions)
    assert spark_rows(cut) == spark_rows(plain(df, ["k"], ["t", "id"], COLUMNS))


@pytest.mark.parametrize("group_rows", [10**6, 60, 0])
def test_only_large_groups_are_stored(spark, group_rows):
    """None, some and all groups go by stored ranges; the columns are the same."""
    df = skewed(spark)
    cut = over_parts(df, ["k"], ["t", "id"], COLUMNS, before=20, after=2, group_rows=group_rows)
    assert spark_rows(cut) == spark_rows(plain(df, ["k"], ["t", "id"], COLUMNS))
    since = rows_since(df, ["k"], ["t", "id"], "hit", "since", group_rows=group_rows)
    assert spark_rows(since) == spark_rows(rows_since(df, ["k"], ["t", "id"], "hit", "since", partitions=1))
    small, large = by_group_size(df, ["k"], group_rows)
    assert (large is None) == (group_rows == 10**6)
    if large is not None:
        assert small.count() + large.count() == 3000 and large.filter("k = 'hot'").count() == 1000


def test_parts_shorter_than_the_frame(spark):
    """Frames may reach over several parts."""
    df = skewed(spark, 1200)
    wide = {"sum100": lambda w: F.sum("v").over(w.rowsBetween(-100, 60))}
    cut = over_parts(df, ["k"], ["t", "id"], wide, before=100, after=60, partitions=150)
    assert spark_rows(cut) == spark_rows(plain(df, ["k"], ["t", "id"], wide))


def test_hot_group_is_cut_and_small_groups_are_not(spark):
    df = skewed(spark)
    sizes = {(r["k"], r[PART]): r["count"] for r in with_part(df, ["k"], ["t", "id"], 60).groupBy("k", PART).count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert sum(sizes.values()) == 3000
    assert len(hot) > 10 and max(hot) < 300
    assert sum(1 for (k, part) in sizes if part is None) > 100


def test_repeated_hour_of_a_zone_with_daylight_saving(spark):
    """Order by TIMESTAMP over the hour that clocks show twice."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        start = 1_730_606_400  # 2024-11-03 04:00 UTC; clocks go back at 06:00 UTC
        df = spark.range(6000).select(F.lit("g").alias("k"), F.timestamp_seconds(F.lit(start) + F.col("id") * 3).alias("t"), "id", (F.col("id") % 61).alias("v"))
        cut = over_parts(df, ["k"], ["t", "id"], COLUMNS, before=20, after=2, partitions=40)
        assert cut.count() == 6000
        assert spark_rows(cut.drop("t")) == spark_rows(plain(df, ["k"], ["t", "id"], COLUMNS).drop("t"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_upstream_runs_once(spark):
    """The plan after storing reads stored rows only, however many groups are cut."""
    df = skewed(spark)
    plan = over_parts(df, ["k"], ["t", "id"], COLUMNS, before=20, after=2, partitions=60)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan


def test_rows_since_crosses_parts(spark):
    df = skewed(spark)
    whole = rows_since(df, ["k"], ["t", "id"], "hit", "since", partitions=1)
    cut = rows_since(df, ["k"], ["t", "id"], "hit", "since", partitions=100)
    assert spark_rows(cut) == spark_rows(whole)
    assert whole.filter("k = 'hot' AND since > 20").count() > 0


def test_an_empty_table(spark):
    df = skewed(spark).limit(0)
    assert over_parts(df, ["k"], ["t", "id"], COLUMNS, before=20, after=2).count() == 0
    assert rows_since(df, ["k"], ["t", "id"], "hit", "since").count() == 0


def test_numbers_of_a_whole_table(spark):
    df = skewed(spark)
    found = [r["n"] for r in numbered_rows(df, [F.col("t").desc(), F.col("id").asc()], "n").orderBy(F.desc("t"), "id").collect()]
    assert found == list(range(1, 3001))


def test_operators_on_cut_groups(inputs):
    bronze = inputs.bronze.withColumn("defensive_pressure_rate", (F.col("yard_line") % 7) / 7)
    operators = [
        gold.win_probability,
        features.add_rolling_features,
        features.add_opponent_features,
        features.add_plays_since_turnover,
    ]
    for operator in operators:
        assert rounded_rows(operator(bronze, partitions=30)) == rounded_rows(operator(bronze, partitions=1)), operator.__name__


def test_tracking_of_one_long_play(spark, inputs):
    """A player with far more frames than a part holds."""
    frames = inputs.tracking.select(
        F.lit("G").alias("game_id"), F.lit("P").alias("play_id"), F.lit("X").alias("player_id"),
        "timestamp", (F.col("frame_id") + F.hash("player_id")).alias("frame_id"), "x_coord", "y_coord", "speed",
    ).limit(3000).persist()
    whole = tracking.derive_tracking(frames, partitions=1)
    cut = tracking.derive_tracking(frames, partitions=30)
    assert rounded_rows(cut) == rounded_rows(whole)


def rounded_rows(df):
    from snapline.plans.queries import rounded

    return spark_rows(rounded(df))
