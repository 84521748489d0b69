"""Hot keys, copies and crowded frames: exact results and plans without pair explosions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from compare import spark_rows
from conftest import SMALL
from snapline.operators import gold, quality, ranks, spatial, tracking
from snapline.plans.queries import queries, rounded


def frames(spark, players, plays=3, seed=1, spread=50):
    """(position, x, y) drawn on a coarse lattice, so that several players share a spot."""
    rng = random.Random(seed)
    rows = []
    for play in range(plays):
        for i in range(players):
            position = rng.choice(["WR", "TE", "RB", "DE", "DT", "LB", "DB", "QB"])
            x, y = rng.randrange(spread) / 2, rng.randrange(spread * 2) / 2
            for event in ("pass", "pass_arrived"):
                rows.append(("G", f"P{play}", 1 if event == "pass" else 2, f"p{i}", position, x, y, event))
    return spark.createDataFrame(
        rows, "game_id string, play_id string, frame_id int, player_id string, position string, x_coord double, y_coord double, event string"
    )


def brute_force(df):
    groups = {}
    for r in df.collect():
        groups.setdefault((r["play_id"], r["event"]), []).append(r)
    separation, pressure = {}, {}
    for (play, event), rows in groups.items():
        defenders = [r for r in rows if r["position"] in ("DE", "DT", "LB", "DB")]
        if event == "pass_arrived":
            receivers = [r for r in rows if r["position"] in ("WR", "TE", "RB")]
            near = [min(math.dist((a["x_coord"], a["y_coord"]), (b["x_coord"], b["y_coord"])) for b in defenders) for a in receivers]
            separation[play] = round(sum(near) / len(near), 6)
        else:
            qbs = [r for r in rows if r["position"] == "QB"]
            close = [
                any(math.dist((a["x_coord"], a["y_coord"]), (b["x_coord"], b["y_coord"])) <= 2 for b in qbs) for a in defenders
            ]
            pressure[play] = round(sum(close) / len(close), 6)
    return separation, pressure


@pytest.mark.parametrize("players, pairs_per_frame", [(22, 4096), (300, 4096), (300, 1), (60, 1)])
def test_distances_equal_brute_force(spark, players, pairs_per_frame):
    df = frames(spark, players)
    separation, pressure = brute_force(df)
    found = spatial.separation_nearest(df, pairs_per_frame=pairs_per_frame).collect()
    assert {r["play_id"]: round(r["separation_at_catch"], 6) for r in found} == separation
    found = spatial.pressure_radius(df).collect()
    assert {r["play_id"]: round(r["qb_pressure_rate"], 6) for r in found} == pressure


def test_far_away_defenders_are_found(spark):
    rows = [("G", "P", 2, "a", "WR", 0.0, 0.0, "pass_arrived"), ("G", "P", 2, "b", "DB", 53.0, 120.0, "pass_arrived"), ("G", "Q", 2, "a", "WR", 0.0, 0.0, "pass_arrived")]
    df = spark.createDataFrame(rows, frames(spark, 1).schema)
    for limit in (0, 4096):
        found = {r["play_id"]: r["separation_at_catch"] for r in spatial.separation_nearest(df, pairs_per_frame=limit).collect()}
        assert found["P"] == pytest.approx(math.hypot(53, 120)) and found["Q"] is None


def test_defenders_beyond_any_cell_are_found(spark):
    """Bad coordinates: far beyond the field, and negative."""
    rows = []
    for play, spots in {"P": [(600.0, 0.0)], "Q": [(511.0, 0.0), (-257.0, 0.0)], "R": [(-3000.0, 4000.0), (1e6, 1e6)]}.items():
        rows += [("G", play, 2, "a", "WR", 0.0, 0.0, "pass_arrived"), ("G", play, 2, "c", "TE", -7000.0, 0.0, "pass_arrived")]
        rows += [("G", play, 2, f"b{i}", "DB", x, y, "pass_arrived") for i, (x, y) in enumerate(spots)]
    df = spark.createDataFrame(rows, frames(spark, 1).schema)
    separation, _ = brute_force(df)
    for limit in (0, 4096):
        found = {r["play_id"]: round(r["separation_at_catch"], 6) for r in spatial.separation_nearest(df, pairs_per_frame=limit).collect()}
        assert found == separation, limit


def test_daily_stats_count_copies_as_a_join_would(inputs, spark):
    silver = inputs.silver.persist()
    effectiveness = gold.play_effectiveness(silver)
    wp = gold.win_probability(silver)
    pe, w = effectiveness.unionByName(effectiveness).unionByName(effectiveness), wp.unionByName(wp)
    joined = pe.join(w.select("game_id", "play_id", "win_prob_added"), ["game_id", "play_id"])
    direct = joined.groupBy(F.col("game_date").alias("stat_date"), F.col("possession_team").alias("team")).agg(
        F.count("*").alias("total_plays"),
        F.avg("yards_gained").alias("avg_yards_per_play"),
        F.sum("win_prob_added").alias("total_wpa"),
        F.sum(F.col("is_red_zone").cast("int")).alias("red_zone_plays"),
        F.avg(F.when(F.col("is_red_zone"), F.col("is_successful_play"))).alias("red_zone_success_rate"),
    )
    folded = gold.team_daily_stats(pe, w).select(*direct.columns)
    assert spark_rows(rounded(folded)) == spark_rows(rounded(direct))
    silver.unpersist()


def test_dense_rank_equals_a_whole_table_window(spark):
    rng = random.Random(2)
    values = [None, -0.0, 0.0, 1e6, -3.25, 0.5000001, 0.5000004] + [round(rng.uniform(-20, 80), rng.choice([0, 1, 6])) for _ in range(2000)] + [4.5] * 900
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    df.createOrReplaceTempView("rank_input")
    expected = spark.sql("SELECT id, v, CAST(dense_rank() OVER (ORDER BY v DESC) AS BIGINT) AS r FROM rank_input")
    assert spark_rows(ranks.dense_ranks_desc(df, {"v": "r"})) == spark_rows(expected)


def test_dense_ranks_have_no_gaps(inputs):
    from snapline.operators import history

    ranked = history.team_rankings(history.game_aggregates(inputs.silver)).persist()
    for name in ("yards_per_play_rank", "success_rate_rank"):
        found = sorted({r[name] for r in ranked.select(name).collect()})
        assert found == list(range(1, len(found) + 1))
    ranked.unpersist()


def test_copies_are_limited_before_the_shuffle(inputs):
    plan = quality.dedup_plays(inputs.plays)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_copies_of_a_play_do_not_multiply_frames(inputs):
    copies = inputs.plays.unionByName(inputs.plays).unionByName(inputs.plays)
    assert tracking.with_roles(inputs.tracking, copies).count() == inputs.tracking.count()


def run_skewed(spark, df):
    """Final plan of a run in which small partitions already count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        result = df()
        rows = spark_rows(rounded(result))
        result.write.format("noop").mode("overwrite").save()
        result.collect()
        return rows, result._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_play_is_split_in_the_role_join(spark, inputs):
    play = inputs.plays.first()["play_id"]
    hot = inputs.tracking.withColumn("play_id", F.when(F.hash("player_id", "frame_id") % 3 == 0, play).otherwise(F.col("play_id")))
    game = inputs.plays.filter(F.col("play_id") == play).first()["game_id"]
    hot = hot.withColumn("game_id", F.when(F.col("play_id") == play, game).otherwise(F.col("game_id"))).repartition(8).persist()
    expected = spark_rows(rounded(tracking.with_roles(hot, inputs.plays)))
    rows, plan = run_skewed(spark, lambda: tracking.with_roles(hot, inputs.plays))
    assert rows == expected and "skew=true" in plan
    hot.unpersist()


def test_hot_copies_are_split_in_the_silver_join(spark, inputs):
    from snapline.operators.silver import silver_plays

    first = inputs.bronze.orderBy("event_timestamp").limit(1)
    copies = first.select("*", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("col")
    plays = inputs.bronze.unionByName(copies).repartition(8).persist()
    frames = inputs.bronze_tracking.persist()
    expected = spark_rows(rounded(silver_plays(plays, frames)))
    rows, plan = run_skewed(spark, lambda: silver_plays(plays, frames))
    assert rows == expected and "skew=true" in plan
    plays.unpersist()
    frames.unpersist()


LAZY = [n for n in queries() if not n.startswith(("stream_", "sink_"))]


@pytest.mark.parametrize("name", LAZY)
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert node not in plan


@pytest.mark.parametrize("name", ["scan_date_range", "scan_yesterday", "scan_lookback", "check_freshness"])
def test_date_filters_reach_the_reader(spark, name):
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan


def test_columns_are_pruned(spark):
    plan = queries()["plays_since_turnover"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "value" not in plan.split("ReadSchema")[1].split("\n")[0]
