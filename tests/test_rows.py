"""Boundary rows of every CASE ladder, with NULLs."""

import pytest
from pyspark.sql import functions as F

from snapline.functions import plays as p
from snapline.operators import plays, quality


def one(spark, expression, **values):
    """Value of a column expression on one row."""
    types = {"play_type": "string", "is_red_zone": "boolean", "is_two_minute_drill": "boolean"}
    names = ["down", "yards_to_go", "yard_line", "quarter", "time_remaining", "yards_gained", "score_differential", *types]
    schema = ", ".join(f"{n} {types.get(n, 'int')}" for n in names)
    df = spark.createDataFrame([tuple(values.get(n) for n in names)], schema)
    return df.select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "down, need, gain, expected",
    [
        (1, 10, 4, True), (1, 10, 3, False), (2, 10, 6, True), (2, 10, 5, False), (3, 10, 10, True), (3, 10, 9, False),
        (4, 1, 1, True), (4, 1, 0, False), (5, 1, 9, False), (None, 1, 9, False), (1, None, 9, False), (1, 5, None, False),
        (1, 0, 0, True), (1, 0, -1, False),
    ],
)
def test_success(spark, down, need, gain, expected):
    assert one(spark, p.success(), down=down, yards_to_go=need, yards_gained=gain) is expected


@pytest.mark.parametrize(
    "red, drill, diff, expected",
    [
        (True, True, 40, "red_zone"), (False, True, 40, "two_minute_drill"), (False, False, 22, "garbage_time"),
        (False, False, -22, "garbage_time"), (False, False, 21, "normal"), (False, False, None, "normal"),
    ],
)
def test_situation(spark, red, drill, diff, expected):
    assert one(spark, p.situation(), is_red_zone=red, is_two_minute_drill=drill, score_differential=diff) == expected


@pytest.mark.parametrize(
    "line, expected",
    [(39, "own_territory"), (40, "midfield"), (60, "midfield"), (61, "opp_territory"), (None, "opp_territory")],
)
def test_field_zone(spark, line, expected):
    assert one(spark, p.field_zone(), yard_line=line) == expected


@pytest.mark.parametrize(
    "kind, down, expected",
    [("run", 3, 4.2), ("run", None, 4.2), ("pass", 1, 7.5), ("pass", 2, 6.8), ("pass", 4, 8.2), ("pass", None, 5.0), ("punt", 4, 5.0), (None, 1, 5.0)],
)
def test_expected_yards(spark, kind, down, expected):
    assert one(spark, p.expected_yards(), play_type=kind, down=down) == expected


@pytest.mark.parametrize(
    "values, expected",
    [
        (dict(down=1, quarter=1, yard_line=1, yards_to_go=0), True),
        (dict(down=4, quarter=5, yard_line=100, yards_to_go=99), True),
        (dict(quarter=1, yards_to_go=0), True),
        (dict(down=5, quarter=1, yard_line=1, yards_to_go=0), False),
        (dict(down=0, quarter=1, yard_line=1, yards_to_go=0), False),
        (dict(down=1, quarter=6, yard_line=1, yards_to_go=0), False),
        (dict(down=1, yard_line=1, yards_to_go=0), False),
        (dict(down=1, quarter=1, yard_line=101, yards_to_go=0), False),
        (dict(down=1, quarter=1, yard_line=1, yards_to_go=-1), False),
        (dict(down=1, quarter=1, yard_line=1), False),
    ],
)
def test_play_validity(spark, values, expected):
    assert one(spark, p.all_hold(p.play_rules()), **values) is expected


def test_clock_in_overtime(spark):
    assert one(spark, p.game_clock(), quarter=5, time_remaining=300) == -600
    assert one(spark, p.game_clock_with_overtime(), quarter=5, time_remaining=300) == 300
    assert one(spark, p.game_clock_with_overtime(), quarter=2, time_remaining=300) == 2100


@pytest.mark.parametrize(
    "x, y, speed, direction, loose, strict, outlier",
    [
        (0.0, 0.0, 0.0, 0.0, True, True, False), (53.3, 120.0, 25.0, 360.0, True, True, True), (53.4, 1.0, 1.0, 1.0, False, False, False),
        (1.0, 120.1, 1.0, 1.0, False, False, False), (1.0, 1.0, 25.1, 1.0, False, False, True), (1.0, 1.0, None, 1.0, True, False, False),
        (None, 1.0, 1.0, 1.0, False, False, False), (1.0, 1.0, 22.0, None, False, False, False), (1.0, 1.0, 22.1, 1.0, True, True, True),
    ],
)
def test_tracking_validity(spark, x, y, speed, direction, loose, strict, outlier):
    df = spark.createDataFrame(
        [(x, y, speed, direction, 0.0)], "x_coord double, y_coord double, speed double, direction double, orientation double"
    )
    row = quality.flag_tracking(df).first()
    assert (row["is_valid"], row["is_outlier_speed"]) == (loose, outlier)
    assert quality.flag_tracking(df, strict_speed=True).first()["is_valid"] is strict


def test_separation_quality_and_pressure(spark):
    rows = [(3.0, 0.3), (2.9, 0.31), (1.5, None), (1.4, 1.0), (None, 0.0)]
    df = spark.createDataFrame([(5.0, 4.0, s, r) for s, r in rows], "offense_avg_speed double, defense_avg_speed double, avg_receiver_separation double, defensive_pressure_rate double")
    found = [(r["separation_quality"], r["is_high_pressure"]) for r in plays.add_tracking_derived_features(df).collect()]
    assert found == [("open", 0), ("contested", 1), ("contested", 0), ("covered", 1), ("covered", 0)]


def test_division_is_guarded(spark):
    df = spark.createDataFrame([(2, 0), (3, -1), (3, None)], "down int, yards_to_go int")
    assert [r["down_distance_ratio"] for r in plays.add_down_distance_features(df).collect()] == [2.0, None, None]


def test_win_probability_stays_inside_zero_and_one(inputs):
    wp = inputs.win_probability
    for name in ("win_probability_before", "win_probability_after"):
        assert wp.filter((F.col(name) <= 0) | (F.col(name) >= 1)).count() == 0
    added = F.col("win_probability_after") - F.col("win_probability_before") - F.col("win_prob_added")
    assert wp.filter(F.abs(added) > 1e-12).count() == 0


def test_valid_rows_and_dead_letters_add_up(inputs):
    checked = quality.check_plays(quality.stamp(inputs.bronze.withColumn("raw_data", F.lit(""))))
    assert quality.accepted(checked).count() + quality.dead_letters(checked).count() == inputs.plays.count()
    assert quality.accepted(checked).filter("NOT is_valid").count() == 0


def test_malformed_and_partial_messages(spark):
    messages = spark.createDataFrame(
        [("{bad",), ('{"game_id":"G","play_id":"P","quarter":"x"}',), ('{"game_id":"G","play_id":"Q","event_timestamp":"2024-01-01T00:00:00.123456Z","quarter":1,"yards_to_go":3,"possession_team":"A","defensive_team":"B"}',)],
        "value string",
    )
    checked = quality.check_plays(quality.stamp(quality.parse_plays(messages)))
    letters = {r["play_id"]: r for r in quality.dead_letters(checked).collect()}
    assert "malformed_message" in letters[None]["error_message"] and letters[None]["raw_data"] == "{bad"
    assert "malformed_message" in letters["P"]["error_message"] and "missing_quarter" in letters["P"]["error_message"]
    good = quality.accepted(checked).collect()
    assert [r["play_id"] for r in good] == ["Q"]
    assert good[0]["event_timestamp"].microsecond == 123456


def test_empty_silver_fails_the_lag_check(inputs):
    import datetime as dt

    row = quality.check_lag(inputs.lagging, dt.date(2030, 1, 1)).first()
    assert row["max_lag_seconds"] is None and row["within_limit"] is False
    assert quality.check_freshness(inputs.bronze, dt.date(2030, 1, 1)).first()["is_fresh"] is False
