"""The registered queries in plain SQL, written apart from the DataFrame code and used only to check it.

Each text is built from the views below and runs on the given tables alone.
"""

from __future__ import annotations

# Test plays, one per event.
PLAYS = """
SELECT concat('G', CAST(user_id AS VARCHAR)) AS game_id,
  concat('P', CAST(event_id AS VARCHAR)) AS play_id,
  ts AS event_timestamp,
  concat('T', CAST((CASE WHEN event_id % 2 = 0 THEN user_id ELSE user_id + 1 + user_id % 7 END) % 16 AS VARCHAR)) AS possession_team,
  concat('T', CAST((CASE WHEN event_id % 2 = 1 THEN user_id ELSE user_id + 1 + user_id % 7 END) % 16 AS VARCHAR)) AS defensive_team,
  CAST(CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 29 = 0 THEN 5 ELSE 1 + (event_id * 11) % 4 END AS INT) AS down,
  CAST(CASE WHEN event_id % 31 = 0 THEN NULL ELSE (event_id * 7) % 15 END AS INT) AS yards_to_go,
  CAST(CASE WHEN event_id % 41 = 0 THEN NULL ELSE 1 + (event_id * 13) % 100 END AS INT) AS yard_line,
  CAST(1 + (event_id * 3) % 5 AS INT) AS quarter,
  CAST(CASE WHEN event_id % 37 = 0 THEN NULL ELSE (event_id * 41) % 901 END AS INT) AS time_remaining,
  CASE event_type WHEN 'view' THEN 'run' WHEN 'click' THEN 'pass' WHEN 'purchase' THEN 'pass' WHEN 'signup' THEN 'punt' ELSE 'field_goal' END AS play_type,
  CASE WHEN CAST(floor(value) AS BIGINT) % 40 > 8 THEN 'complete' ELSE 'incomplete' END AS play_result,
  CAST(CAST(floor(value) AS BIGINT) % 40 - 8 AS INT) AS yards_gained,
  event_id % 27 = 0 AS is_touchdown,
  event_id % 33 = 0 AS is_turnover,
  event_id % 20 = 0 AS is_penalty,
  CAST(CASE WHEN event_id % 20 = 0 THEN -5 * (1 + event_id % 3) ELSE 0 END AS INT) AS penalty_yards,
  CAST(event_id % 36 AS INT) AS score_home,
  CAST((event_id * 5) % 29 AS INT) AS score_away,
  CASE event_id % 3 WHEN 0 THEN 'shotgun' WHEN 1 THEN 'under_center' ELSE 'pistol' END AS formation,
  CASE event_id % 3 WHEN 0 THEN '11_personnel' WHEN 1 THEN '12_personnel' ELSE '21_personnel' END AS personnel_offense,
  CASE event_id % 4 WHEN 0 THEN '4-3' WHEN 1 THEN '3-4' WHEN 2 THEN 'nickel' ELSE 'dime' END AS personnel_defense
FROM events
"""

# Test tracking, 8 players x 3 frames per event.
TRACKING = """
SELECT concat('G', CAST(user_id AS VARCHAR)) AS game_id,
  concat('P', CAST(event_id AS VARCHAR)) AS play_id,
  CASE f WHEN 0 THEN ts WHEN 1 THEN ts + INTERVAL '100' MILLISECOND ELSE ts + INTERVAL '200' MILLISECOND END AS timestamp,
  CAST(f AS INT) AS frame_id,
  concat('P', CAST(event_id AS VARCHAR), '_', CAST(k AS VARCHAR)) AS player_id,
  concat('T', CAST((CASE WHEN (event_id + CASE WHEN k < 4 THEN 0 ELSE 1 END) % 2 = 0 THEN user_id ELSE user_id + 1 + user_id % 7 END) % 16 AS VARCHAR)) AS team,
  CAST(1 + (event_id + k * 11) % 99 AS INT) AS jersey_number,
  CASE k WHEN 0 THEN 'QB' WHEN 1 THEN 'WR' WHEN 2 THEN 'TE' WHEN 3 THEN 'RB' WHEN 4 THEN 'DE' WHEN 5 THEN 'DT' WHEN 6 THEN 'LB' ELSE 'DB' END AS position,
  CAST((event_id * 17 + k * (event_id % 30) + f * ((event_id + k * 3) % 40)) % 540 AS DOUBLE) / CAST(10 AS DOUBLE) AS x_coord,
  CAST((event_id * 19 + k * (event_id % 13) + f * 5) % 1201 AS DOUBLE) / CAST(10 AS DOUBLE) AS y_coord,
  CASE WHEN (event_id + k + f) % 43 = 0 THEN NULL ELSE CAST((event_id * 7 + k * 31 + f * 3) % 258 AS DOUBLE) / CAST(10 AS DOUBLE) END AS speed,
  CAST((event_id * 3 + k) % 80 - 40 AS DOUBLE) / CAST(10 AS DOUBLE) AS acceleration,
  CAST((event_id * 23 + k * 45) % 361 AS DOUBLE) AS direction,
  CAST((event_id * 29 + k * 30) % 361 AS DOUBLE) AS orientation,
  CASE f WHEN 0 THEN 'snap' WHEN 1 THEN 'pass' ELSE 'pass_arrived' END AS event
FROM (SELECT *, unnest(range(0, 3)) AS f FROM (SELECT *, unnest(range(0, 8)) AS k FROM events))
"""

PLAY_OK = """(down IS NULL OR down BETWEEN 1 AND 4) AND quarter BETWEEN 1 AND 5
  AND (yard_line IS NULL OR yard_line BETWEEN 1 AND 100) AND yards_to_go >= 0"""

SUCCESS = """CASE WHEN down = 1 AND yards_gained >= yards_to_go * CAST(0.4 AS DOUBLE) THEN 1
    WHEN down = 2 AND yards_gained >= yards_to_go * CAST(0.6 AS DOUBLE) THEN 1
    WHEN down IN (3, 4) AND yards_gained >= yards_to_go THEN 1 ELSE 0 END"""

BRONZE = f"""
SELECT *, CASE WHEN is_red_zone THEN 'red_zone' WHEN is_two_minute_drill THEN 'two_minute_drill'
    WHEN abs(score_differential) > 21 THEN 'garbage_time' ELSE 'normal' END AS game_situation
FROM (
  SELECT *, CASE WHEN {PLAY_OK} THEN true ELSE false END AS is_valid,
    CASE WHEN yard_line <= 20 THEN true ELSE false END AS is_red_zone,
    CASE WHEN time_remaining <= 120 THEN true ELSE false END AS is_two_minute_drill,
    {SUCCESS} = 1 AS play_success,
    score_home - score_away AS score_differential
  FROM plays)
"""

FRAME_OK = "x_coord BETWEEN 0 AND CAST(53.3 AS DOUBLE) AND y_coord BETWEEN 0 AND 120 AND {speed} AND direction BETWEEN 0 AND 360 AND orientation BETWEEN 0 AND 360"
FRAME_OK_LOOSE = FRAME_OK.format(speed="(speed IS NULL OR speed BETWEEN 0 AND 25)")
FRAME_OK_STRICT = FRAME_OK.format(speed="speed BETWEEN 0 AND 25")

MOTION = f"""
SELECT *, CASE WHEN time_delta > 0 THEN (final_speed - prev_speed) / time_delta ELSE 0 END AS calculated_acceleration
FROM (
  SELECT *, lag(final_speed) OVER (PARTITION BY game_id, play_id, player_id ORDER BY timestamp, frame_id) AS prev_speed
  FROM (
    SELECT *, coalesce(speed, calculated_speed) AS final_speed
    FROM (
      SELECT *, CASE WHEN time_delta > 0 THEN distance_traveled / time_delta ELSE 0 END AS calculated_speed
      FROM (
        SELECT *, sqrt((x_coord - prev_x) * (x_coord - prev_x) + (y_coord - prev_y) * (y_coord - prev_y)) AS distance_traveled,
          date_diff('microsecond', prev_timestamp, timestamp) / CAST(1000000 AS DOUBLE) AS time_delta
        FROM (
          SELECT *, CASE WHEN {FRAME_OK_LOOSE} THEN true ELSE false END AS is_valid,
            lag(x_coord) OVER w AS prev_x, lag(y_coord) OVER w AS prev_y, lag(timestamp) OVER w AS prev_timestamp
          FROM tracking
          WINDOW w AS (PARTITION BY game_id, play_id, player_id ORDER BY timestamp, frame_id))))))
"""

BRONZE_TRACKING = "SELECT * FROM motion WHERE is_valid"

# Five aggregates of one input and five joins: the published form, unlike the single pass under test.
MEASURES = """
SELECT p.game_id, p.play_id,
  o.s AS offense_avg_speed, o.m AS offense_max_speed, o.a AS offense_avg_acceleration, o.d AS offense_total_distance,
  d.s AS defense_avg_speed, d.m AS defense_max_speed, d.a AS defense_avg_acceleration, d.d AS defense_total_distance,
  qb.s AS qb_avg_speed, qb.m AS qb_max_speed, qb.a AS qb_pressure_indicator,
  r.d AS avg_receiver_separation, pr.pressure_count, pr.total_defenders,
  pr.pressure_count / CAST(pr.total_defenders AS DOUBLE) AS defensive_pressure_rate
FROM bronze p
LEFT JOIN (SELECT t.game_id, t.play_id, avg(final_speed) s, max(final_speed) m, avg(calculated_acceleration) a, sum(distance_traveled) d
  FROM bronze_tracking t JOIN plays b ON t.game_id = b.game_id AND t.play_id = b.play_id WHERE t.team = b.possession_team GROUP BY 1, 2) o
  ON p.game_id = o.game_id AND p.play_id = o.play_id
LEFT JOIN (SELECT t.game_id, t.play_id, avg(final_speed) s, max(final_speed) m, avg(calculated_acceleration) a, sum(distance_traveled) d
  FROM bronze_tracking t JOIN plays b ON t.game_id = b.game_id AND t.play_id = b.play_id WHERE t.team = b.defensive_team GROUP BY 1, 2) d
  ON p.game_id = d.game_id AND p.play_id = d.play_id
LEFT JOIN (SELECT game_id, play_id, avg(final_speed) s, max(final_speed) m, avg(CASE WHEN event = 'pass' THEN calculated_acceleration END) a
  FROM bronze_tracking WHERE position = 'QB' GROUP BY 1, 2) qb
  ON p.game_id = qb.game_id AND p.play_id = qb.play_id
LEFT JOIN (SELECT game_id, play_id, avg(distance_traveled) d
  FROM bronze_tracking WHERE position IN ('WR', 'TE', 'RB') AND event = 'pass_arrived' GROUP BY 1, 2) r
  ON p.game_id = r.game_id AND p.play_id = r.play_id
LEFT JOIN (SELECT game_id, play_id,
    count(CASE WHEN position IN ('DE', 'DT', 'LB', 'DB') AND distance_traveled < 2 THEN 1 END) pressure_count, count(player_id) total_defenders
  FROM bronze_tracking WHERE event = 'pass' GROUP BY 1, 2) pr
  ON p.game_id = pr.game_id AND p.play_id = pr.play_id
"""

WP_COLUMNS = """
  (4 - quarter) * 900 + time_remaining AS seconds_elapsed,
  CASE WHEN quarter > 4 THEN time_remaining ELSE (4 - quarter) * 900 + time_remaining END AS seconds_remaining,
  CASE WHEN score_differential > 0 THEN 1 ELSE 0 END AS is_offense_leading,
  100 - yard_line AS field_position_value,
  CASE WHEN yards_to_go > 0 THEN down / CAST(yards_to_go AS DOUBLE) ELSE 0 END AS down_distance_ratio
"""

MEASURE_NAMES = [
    "offense_avg_speed", "offense_max_speed", "offense_avg_acceleration", "offense_total_distance",
    "defense_avg_speed", "defense_max_speed", "defense_avg_acceleration", "defense_total_distance",
    "qb_avg_speed", "qb_max_speed", "qb_pressure_indicator", "avg_receiver_separation",
    "pressure_count", "total_defenders", "defensive_pressure_rate",
]

SILVER = f"""
SELECT b.*, {", ".join("m." + c for c in MEASURE_NAMES)}, {WP_COLUMNS}
FROM bronze b LEFT JOIN measures m ON b.game_id = m.game_id AND b.play_id = m.play_id
WHERE b.is_valid
"""

EXPECTED = """CASE WHEN play_type = 'run' THEN CAST(4.2 AS DOUBLE) WHEN play_type = 'pass' AND down = 1 THEN CAST(7.5 AS DOUBLE)
    WHEN play_type = 'pass' AND down = 2 THEN CAST(6.8 AS DOUBLE) WHEN play_type = 'pass' AND down IN (3, 4) THEN CAST(8.2 AS DOUBLE)
    ELSE CAST(5.0 AS DOUBLE) END"""

EFFECTIVENESS = f"""
SELECT game_id, play_id, CAST(event_timestamp AS DATE) AS game_date, possession_team, defensive_team, play_type, down,
  yards_to_go, yard_line, yards_gained, play_success, {EXPECTED} AS expected_yards_gained,
  yards_gained - {EXPECTED} AS yards_over_expected, {SUCCESS} AS is_successful_play,
  offense_avg_speed, defense_avg_speed, defensive_pressure_rate, avg_receiver_separation,
  game_situation, is_red_zone, is_two_minute_drill, score_differential
FROM silver
"""

SEQUENCES = """
SELECT *, lag(score_differential) OVER w AS prev_score_diff, lag(yard_line) OVER w AS prev_yard_line,
  lead(score_differential) OVER w AS next_score_diff
FROM bronze WHERE is_valid WINDOW w AS (PARTITION BY game_id ORDER BY event_timestamp, play_id)
"""

WIN_PROBABILITY = """
SELECT game_id, play_id, game_date, possession_team, play_type, before AS win_probability_before, after AS win_probability_after,
  after - before AS win_prob_added, play_success, yards_gained, game_situation, quarter
FROM (
  SELECT *, CAST(event_timestamp AS DATE) AS game_date,
    1 / (1 + exp(-(CAST(0.02 AS DOUBLE) * score_differential + CAST(0.01 AS DOUBLE) * (100 - yard_line)
      - CAST(0.001 AS DOUBLE) * (quarter * 900 - coalesce(time_remaining, 0)) + CAST(0.3 AS DOUBLE) * CASE WHEN down = 1 THEN 1 ELSE 0 END))) AS before,
    1 / (1 + exp(-(CAST(0.02 AS DOUBLE) * coalesce(next_score_diff, score_differential) + CAST(0.01 AS DOUBLE) * (100 - yard_line - yards_gained)
      - CAST(0.001 AS DOUBLE) * (quarter * 900 - coalesce(time_remaining, 0))))) AS after
  FROM sequences)
"""

DAILY = """
SELECT pe.game_date AS stat_date, pe.possession_team AS team, count(*) AS total_plays,
  CAST(sum(CASE WHEN pe.play_type = 'run' THEN 1 ELSE 0 END) AS BIGINT) AS run_plays,
  CAST(sum(CASE WHEN pe.play_type = 'pass' THEN 1 ELSE 0 END) AS BIGINT) AS pass_plays,
  avg(pe.yards_gained) AS avg_yards_per_play, avg(yards_over_expected) AS avg_yards_over_expected,
  avg(CAST(is_successful_play AS DOUBLE)) AS success_rate, sum(win_prob_added) AS total_wpa,
  avg(offense_avg_speed) AS avg_offense_speed, avg(defensive_pressure_rate) AS avg_pressure_rate_faced,
  CAST(sum(CASE WHEN is_red_zone THEN 1 ELSE 0 END) AS BIGINT) AS red_zone_plays,
  avg(CASE WHEN is_red_zone THEN CAST(is_successful_play AS DOUBLE) END) AS red_zone_success_rate
FROM effectiveness pe JOIN win_prob wp ON pe.game_id = wp.game_id AND pe.play_id = wp.play_id
GROUP BY 1, 2
"""

GAMES = """
SELECT game_id, possession_team, count(*) AS total_plays, CAST(sum(yards_gained) AS BIGINT) AS total_yards,
  avg(yards_gained) AS avg_yards_per_play,
  CAST(sum(CASE WHEN play_type = 'run' THEN 1 ELSE 0 END) AS BIGINT) AS run_plays,
  CAST(sum(CASE WHEN play_type = 'pass' THEN 1 ELSE 0 END) AS BIGINT) AS pass_plays,
  CAST(sum(CASE WHEN is_touchdown THEN 1 ELSE 0 END) AS BIGINT) AS touchdowns,
  CAST(sum(CASE WHEN is_turnover THEN 1 ELSE 0 END) AS BIGINT) AS turnovers,
  avg(CAST(CASE WHEN play_success THEN 1 ELSE 0 END AS DOUBLE)) AS success_rate,
  avg(offense_avg_speed) AS avg_offense_speed, avg(defensive_pressure_rate) AS avg_pressure_faced,
  avg(avg_receiver_separation) AS avg_separation,
  avg(CAST(CASE WHEN is_red_zone THEN 1 ELSE 0 END AS DOUBLE)) AS red_zone_pct,
  avg(CAST(CASE WHEN down = 3 THEN 1 ELSE 0 END AS DOUBLE)) AS third_down_attempts
FROM silver GROUP BY 1, 2
"""

WEEKS = """
SELECT CAST(date_trunc('week', event_timestamp) AS DATE) AS week_start, possession_team, count(*) AS total_plays,
  avg(yards_gained) AS avg_yards_per_play, avg(CAST(CASE WHEN play_success THEN 1 ELSE 0 END AS DOUBLE)) AS success_rate,
  avg(offense_avg_speed) AS avg_offense_speed
FROM silver GROUP BY 1, 2
"""

CONTEXT_COLUMNS = """
  (4 - quarter) * 900 + time_remaining AS time_remaining_total,
  CASE WHEN score_differential > 0 THEN 1 ELSE 0 END AS is_winning,
  CASE WHEN score_differential BETWEEN -7 AND 7 THEN 1 ELSE 0 END AS is_close_game,
  CASE WHEN (4 - quarter) * 900 + time_remaining < 300 AND score_differential BETWEEN -7 AND 7 THEN 1 ELSE 0 END AS is_clutch_time,
  CASE WHEN yard_line < 40 THEN 'own_territory' WHEN yard_line BETWEEN 40 AND 60 THEN 'midfield' ELSE 'opp_territory' END AS field_position_category
"""

DOWN_DISTANCE_COLUMNS = """
  CASE WHEN (down = 2 AND yards_to_go >= 7) OR (down = 3 AND yards_to_go >= 5) THEN 1 ELSE 0 END AS is_passing_down,
  CASE WHEN down IN (3, 4) AND yards_to_go <= 2 THEN 1 ELSE 0 END AS is_short_yardage
"""
FEATURE_RATIO = "down / CAST(yards_to_go + 1 AS DOUBLE)"

TRACKING_COLUMNS = """
  offense_avg_speed - defense_avg_speed AS speed_advantage,
  CASE WHEN avg_receiver_separation >= 3 THEN 'open' WHEN avg_receiver_separation >= 1.5 THEN 'contested' ELSE 'covered' END AS separation_quality,
  CASE WHEN defensive_pressure_rate > 0.3 THEN 1 ELSE 0 END AS is_high_pressure
"""

ROLLING_COLUMNS = """
  avg(yards_gained) OVER r5 AS rolling_avg_yards,
  avg(CAST(CASE WHEN play_success THEN 1 ELSE 0 END AS DOUBLE)) OVER r5 AS rolling_success_rate,
  avg(defensive_pressure_rate) OVER r5 AS rolling_pressure,
  CAST(sum(CASE WHEN is_turnover THEN 1 ELSE 0 END) OVER r5 AS BIGINT) AS turnovers_last_5
"""
R5 = "r5 AS (PARTITION BY possession_team ORDER BY event_timestamp, play_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"

OPPONENT_COLUMNS = """
  avg(yards_gained) OVER r20 AS opp_avg_yards_allowed,
  avg(CAST(CASE WHEN play_success THEN 1 ELSE 0 END AS DOUBLE)) OVER r20 AS opp_success_rate_allowed,
  avg(defensive_pressure_rate) OVER r20 AS opp_pressure_rate
"""
R20 = "r20 AS (PARTITION BY defensive_team ORDER BY event_timestamp, play_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"

FEATURES = f"""
SELECT game_id, play_id, event_timestamp, play_success, yards_gained, down, yards_to_go, yard_line, quarter,
  time_remaining_total, score_differential, is_winning, is_close_game, is_red_zone, is_two_minute_drill, is_clutch_time,
  field_position_category, game_situation, is_passing_down, is_short_yardage, {FEATURE_RATIO} AS down_distance_ratio,
  rolling_avg_yards, rolling_success_rate, rolling_pressure, turnovers_last_5 AS plays_since_turnover,
  speed_advantage, separation_quality, is_high_pressure, defensive_pressure_rate,
  opp_avg_yards_allowed, opp_success_rate_allowed, opp_pressure_rate,
  CAST(is_red_zone AS INT) * is_high_pressure AS redzone_pressure,
  is_clutch_time * is_high_pressure AS clutch_pressure,
  is_winning * CASE WHEN play_type = 'run' THEN 1 ELSE 0 END AS winning_conservative
FROM (SELECT *, {CONTEXT_COLUMNS}, {DOWN_DISTANCE_COLUMNS}, {TRACKING_COLUMNS}, {ROLLING_COLUMNS}, {OPPONENT_COLUMNS}
  FROM silver WINDOW {R5}, {R20})
"""

DISTANCE = "sqrt((a.x_coord - b.x_coord) * (a.x_coord - b.x_coord) + (a.y_coord - b.y_coord) * (a.y_coord - b.y_coord))"
SAME_FRAME = "a.game_id = b.game_id AND a.play_id = b.play_id AND a.frame_id = b.frame_id"
ON_DEFENSE = "IN ('DE', 'DT', 'LB', 'DB')"

SEPARATION = f"""
SELECT game_id, play_id, avg(nearest) AS separation_at_catch
FROM (SELECT a.game_id, a.play_id, a.player_id, a.frame_id, min({DISTANCE}) AS nearest
  FROM tracking a LEFT JOIN tracking b ON {SAME_FRAME} AND b.position {ON_DEFENSE}
  WHERE a.event = 'pass_arrived' AND a.position IN ('WR', 'TE', 'RB') GROUP BY 1, 2, 3, 4)
GROUP BY 1, 2
"""

PRESSURE = f"""
SELECT game_id, play_id, CAST(sum(near) AS BIGINT) AS defenders_near_qb, count(*) AS defenders, avg(CAST(near AS DOUBLE)) AS qb_pressure_rate
FROM (SELECT a.game_id, a.play_id, a.player_id, a.frame_id, max(CASE WHEN {DISTANCE} <= 2 THEN 1 ELSE 0 END) AS near
  FROM tracking a LEFT JOIN tracking b ON {SAME_FRAME} AND b.position = 'QB'
  WHERE a.event = 'pass' AND a.position {ON_DEFENSE} GROUP BY 1, 2, 3, 4)
GROUP BY 1, 2
"""

VIEWS = {
    "plays": PLAYS,
    "tracking": TRACKING,
    "bronze": BRONZE,
    "motion": MOTION,
    "bronze_tracking": BRONZE_TRACKING,
    "measures": MEASURES,
    "silver": SILVER,
    "effectiveness": EFFECTIVENESS,
    "sequences": SEQUENCES,
    "win_prob": WIN_PROBABILITY,
    "daily": DAILY,
    "games": GAMES,
    "weeks": WEEKS,
    "features": FEATURES,
    "separation": SEPARATION,
    "pressure": PRESSURE,
}
NEEDS = {
    "bronze": ["plays"],
    "motion": ["tracking"],
    "bronze_tracking": ["motion"],
    "measures": ["plays", "bronze", "bronze_tracking"],
    "silver": ["bronze", "measures"],
    "effectiveness": ["silver"],
    "sequences": ["bronze"],
    "win_prob": ["sequences"],
    "daily": ["effectiveness", "win_prob"],
    "games": ["silver"],
    "weeks": ["silver"],
    "features": ["silver"],
    "separation": ["tracking"],
    "pressure": ["tracking"],
}


def _with(views: list[str]) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in ordered) if ordered else ""


def r6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) + 0.0 AS {n.split('.')[-1]}" for n in names)


PLAY_NAMES = (
    "game_id, play_id, event_timestamp, possession_team, defensive_team, down, yards_to_go, yard_line, quarter, time_remaining, "
    "play_type, play_result, yards_gained, is_touchdown, is_turnover, is_penalty, penalty_yards, score_home, score_away, formation, "
    "personnel_offense, personnel_defense"
)
DERIVED_NAMES = "is_valid, is_red_zone, is_two_minute_drill, play_success, score_differential, game_situation"
MEASURES_R6 = r6(*[m for m in MEASURE_NAMES if m not in ("pressure_count", "total_defenders")]) + ", pressure_count, total_defenders"
SILVER_SELECT = (
    f"SELECT {PLAY_NAMES}, {DERIVED_NAMES}, {MEASURES_R6}, seconds_elapsed, seconds_remaining, is_offense_leading, "
    f"field_position_value, {r6('down_distance_ratio')} FROM silver"
)
BRONZE_SELECT = f"SELECT {PLAY_NAMES}, {DERIVED_NAMES} FROM bronze"
TRACKING_SELECT = (
    f"SELECT game_id, play_id, timestamp, frame_id, player_id, team, jersey_number, position, {r6('x_coord', 'y_coord')}, "
    f"{r6('direction', 'orientation')}, event, {r6('final_speed', 'calculated_acceleration', 'distance_traveled')} FROM bronze_tracking"
)
MOTION_SELECT = (
    "SELECT player_id, frame_id, prev_timestamp, "
    + r6("prev_x", "prev_y", "prev_speed", "distance_traveled", "time_delta", "calculated_speed", "final_speed", "calculated_acceleration")
    + " FROM motion"
)
GAME_R6 = r6(
    "avg_yards_per_play", "success_rate", "avg_offense_speed", "avg_pressure_faced", "avg_separation", "red_zone_pct", "third_down_attempts"
)
GAME_SELECT = f"game_id, possession_team, total_plays, total_yards, run_plays, pass_plays, touchdowns, turnovers, {GAME_R6}"
WEEK_SELECT = f"week_start, possession_team, total_plays, {r6('avg_yards_per_play', 'success_rate', 'avg_offense_speed')}"
EFFECTIVENESS_SELECT = (
    "SELECT game_id, play_id, game_date, possession_team, defensive_team, play_type, down, yards_to_go, yard_line, yards_gained, "
    "play_success, is_successful_play, game_situation, is_red_zone, is_two_minute_drill, score_differential, "
    + r6("expected_yards_gained", "yards_over_expected", "offense_avg_speed", "defense_avg_speed", "defensive_pressure_rate", "avg_receiver_separation")
    + " FROM effectiveness"
)
DAILY_R6 = r6(
    "avg_yards_per_play", "avg_yards_over_expected", "success_rate", "total_wpa", "avg_offense_speed", "avg_pressure_rate_faced",
    "red_zone_success_rate",
)


def _failed(rules: list[tuple[str, str]]) -> str:
    return "concat_ws(';', " + ", ".join(f"CASE WHEN ({ok}) IS NOT TRUE THEN '{name}' END" for name, ok in rules) + ")"


PLAY_RULES = [
    ("down_out_of_range", "down IS NULL OR down BETWEEN 1 AND 4"),
    ("quarter_out_of_range", "quarter BETWEEN 1 AND 5"),
    ("yard_line_out_of_range", "yard_line IS NULL OR yard_line BETWEEN 1 AND 100"),
    ("yards_to_go_negative_or_missing", "yards_to_go >= 0"),
]
FRAME_RULES = [
    ("x_out_of_field", "x_coord BETWEEN 0 AND CAST(53.3 AS DOUBLE)"),
    ("y_out_of_field", "y_coord BETWEEN 0 AND 120"),
    ("speed_out_of_range", "speed IS NULL OR speed BETWEEN 0 AND 25"),
    ("direction_out_of_range", "direction BETWEEN 0 AND 360"),
    ("orientation_out_of_range", "orientation BETWEEN 0 AND 360"),
]
REPORTED = ["game_id", "play_id", "event_timestamp", "possession_team", "defensive_team", "quarter", "down", "yard_line", "time_remaining"]
REPORT_RULES = [(f"missing_{c}", f"{c} IS NOT NULL") for c in REPORTED] + PLAY_RULES
REPORT = " UNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) FILTER (WHERE ({ok}) IS NOT TRUE) AS failed, count(*) AS total FROM plays" for name, ok in REPORT_RULES
)

EYG = """
SELECT p.game_id, p.play_id, h.e AS expected_yards_gained, h.n AS history_plays, p.yards_gained - h.e AS yards_over_expected
FROM classed p JOIN (SELECT pc, dc, sc, zc, avg(yards_gained) e, count(yards_gained) n FROM classed GROUP BY 1, 2, 3, 4) h
  ON p.pc = h.pc AND p.dc = h.dc AND p.sc = h.sc AND p.zc = h.zc
"""
CLASSED = """
SELECT *, play_type AS pc, CASE WHEN down BETWEEN 1 AND 4 THEN down ELSE 0 END AS dc,
  CASE WHEN yards_to_go <= 3 THEN 's' WHEN yards_to_go <= 7 THEN 'm' WHEN yards_to_go > 7 THEN 'l' ELSE 'n' END AS sc,
  CASE WHEN yard_line IS NULL THEN 'n' WHEN yard_line < 40 THEN 'o' WHEN yard_line <= 60 THEN 'm' ELSE 'p' END AS zc
FROM plays
"""


# The finest level with 20 plays or more; the mean of all else.
EYG_LEVELS = """
SELECT p.game_id, p.play_id, CAST(b.level AS INT) AS level, b.e AS expected_yards_gained, b.n AS history_plays, p.yards_gained - b.e AS yards_over_expected
FROM classed p, LATERAL (SELECT 4 AS level, avg(h.yards_gained) AS e, count(h.yards_gained) AS n FROM classed h WHERE h.pc = p.pc AND h.dc = p.dc AND h.sc = p.sc AND h.zc = p.zc
  UNION ALL SELECT 3, avg(h.yards_gained), count(h.yards_gained) FROM classed h WHERE h.pc = p.pc AND h.dc = p.dc AND h.sc = p.sc
  UNION ALL SELECT 2, avg(h.yards_gained), count(h.yards_gained) FROM classed h WHERE h.pc = p.pc AND h.dc = p.dc
  UNION ALL SELECT 1, avg(h.yards_gained), count(h.yards_gained) FROM classed h WHERE h.pc = p.pc
  UNION ALL SELECT 0, avg(h.yards_gained), count(h.yards_gained) FROM classed h) b
WHERE b.level = 0 OR b.n >= 20
QUALIFY row_number() OVER (PARTITION BY p.game_id, p.play_id ORDER BY b.level DESC) = 1
"""

# A play more than six hours after the one before it opens a session.
SESSIONS = """SELECT game_id, min(event_timestamp) AS session_start, min(event_timestamp) AS first_play, max(event_timestamp) AS last_play, count(*) AS plays,
  CAST(sum(yards_gained) AS BIGINT) AS yards, count(*) FILTER (is_touchdown) AS touchdowns
FROM (SELECT *, sum(opens) OVER (PARTITION BY game_id ORDER BY event_timestamp, play_id ROWS UNBOUNDED PRECEDING) AS session
  FROM (SELECT *, CASE WHEN event_timestamp - lag(event_timestamp) OVER (PARTITION BY game_id ORDER BY event_timestamp, play_id) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM plays))
GROUP BY game_id, session"""


def _texts() -> dict[str, tuple[list[str], str]]:
    """Name -> (views used, final SELECT)."""
    texts = {
        "scan_date_range": (["bronze"], f"{BRONZE_SELECT} WHERE CAST(event_timestamp AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"),
        "scan_lookback": (["bronze"], f"{BRONZE_SELECT} WHERE CAST(event_timestamp AS DATE) >= DATE '2024-01-31' - INTERVAL 10 DAY"),
        "scan_yesterday": (["bronze"], f"{BRONZE_SELECT} WHERE CAST(event_timestamp AS DATE) = DATE '2024-01-30'"),
        "sink_overwrite": (["games"], f"SELECT {GAME_SELECT} FROM games"),
        "sink_ctas": (["effectiveness"], EFFECTIVENESS_SELECT),
        "kv_team_stats": (
            ["daily"],
            f"""SELECT concat('team_stats:', team) AS cache_key, TIMESTAMP '2024-02-01 00:00:00' AS expires_at, stat_date, total_plays,
              {r6("avg_yards_per_play", "success_rate", "total_wpa")}
            FROM daily QUALIFY row_number() OVER (PARTITION BY team ORDER BY stat_date DESC) = 1""",
        ),
        "join_game_context": (
            ["bronze"],
            f"""SELECT b.game_id, b.play_id, b.game_situation, c.c_mktsegment AS venue, round(c.c_acctbal, 6) + 0.0 AS crowd_index
            FROM bronze b LEFT JOIN customer c ON b.game_id = concat('G', CAST(c.c_custkey AS VARCHAR))""",
        ),
        "parse_plays": (["plays"], f"SELECT {PLAY_NAMES} FROM plays"),
        "parse_tracking": (
            ["tracking"],
            f"""SELECT game_id, play_id, timestamp, frame_id, player_id, team, jersey_number, position,
              {r6("x_coord", "y_coord", "speed", "acceleration", "direction", "orientation")}, event FROM tracking""",
        ),
        "parse_json_props": ([], "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events"),
        "valid_plays": (["plays"], f"SELECT game_id, play_id, down, quarter, yard_line, yards_to_go FROM plays WHERE {PLAY_OK}"),
        "enrich_plays": (["bronze"], BRONZE_SELECT),
        "valid_tracking": (
            ["tracking"],
            f"""SELECT player_id, frame_id, ({FRAME_OK_LOOSE}) IS TRUE AS is_valid_frame, ({FRAME_OK_STRICT}) IS TRUE AS is_valid_strict,
              (speed > 22) IS TRUE AS is_outlier_speed FROM tracking""",
        ),
        "dlq_plays": (
            ["plays"],
            f"""SELECT * FROM (SELECT game_id, play_id, {_failed(PLAY_RULES)} AS error_message, CAST(quarter AS VARCHAR) AS raw_quarter FROM plays)
            WHERE error_message <> ''""",
        ),
        "dlq_tracking": (
            ["tracking"],
            f"""SELECT * FROM (SELECT game_id, play_id, {_failed(FRAME_RULES)} AS error_message, player_id AS raw_player FROM tracking)
            WHERE error_message <> ''""",
        ),
        "dq_required_report": (["plays"], REPORT),
        "dq_anomalies": (
            ["tracking"],
            """SELECT game_id, count(*) AS frames, count(*) FILTER (WHERE speed > 22) AS impossible_speed,
              count(*) FILTER (WHERE speed IS NULL) AS missing_speed,
              count(*) FILTER (WHERE x_coord IS NULL OR y_coord IS NULL) AS missing_coordinates,
              count(*) FILTER (WHERE x_coord < 0 OR x_coord > CAST(53.3 AS DOUBLE) OR y_coord < 0 OR y_coord > 120) AS outside_field
            FROM tracking GROUP BY game_id""",
        ),
        "dedup_plays": (["plays"], f"SELECT {PLAY_NAMES} FROM plays"),
        "bronze_tracking": (["bronze_tracking"], TRACKING_SELECT),
        "wp_features": (
            ["bronze"],
            f"""SELECT game_id, play_id, seconds_elapsed, seconds_remaining, is_offense_leading, field_position_value, {r6("down_distance_ratio")}
            FROM (SELECT *, {WP_COLUMNS} FROM bronze)""",
        ),
        "game_context": (["bronze"], f"SELECT game_id, play_id, {CONTEXT_COLUMNS} FROM bronze"),
        "down_distance": (
            ["plays"],
            f"SELECT game_id, play_id, {DOWN_DISTANCE_COLUMNS}, round({FEATURE_RATIO}, 6) + 0.0 AS down_distance_ratio FROM plays",
        ),
        "tracking_features": (
            ["silver"],
            f"""SELECT game_id, play_id, {r6("speed_advantage")}, separation_quality, is_high_pressure
            FROM (SELECT *, {TRACKING_COLUMNS} FROM silver)""",
        ),
        "interactions": (["features"], "SELECT game_id, play_id, redzone_pressure, clutch_pressure, winning_conservative FROM features"),
        "tracking_derived": (["motion"], MOTION_SELECT),
        "player_play_agg": (
            ["bronze_tracking"],
            f"""SELECT game_id, play_id, player_id, team, position, {r6("avg_speed", "speed_stddev", "avg_acceleration", "total_distance")}
            FROM (SELECT game_id, play_id, player_id, team, position, avg(final_speed) AS avg_speed, stddev_pop(final_speed) AS speed_stddev,
              avg(calculated_acceleration) AS avg_acceleration, sum(distance_traveled) AS total_distance
              FROM bronze_tracking GROUP BY 1, 2, 3, 4, 5)""",
        ),
        "play_tracking_agg": (
            ["measures"],
            f"""SELECT game_id, play_id, {MEASURES_R6} FROM measures
            WHERE (game_id, play_id) IN (SELECT (game_id, play_id) FROM bronze_tracking)""",
        ),
        "tracking_with_roles": (
            ["plays", "tracking"],
            """SELECT t.game_id, t.play_id, t.player_id, t.frame_id, p.possession_team, p.defensive_team,
              CASE WHEN t.team = p.possession_team THEN 'offense' WHEN t.team = p.defensive_team THEN 'defense' END AS side
            FROM tracking t JOIN plays p ON t.game_id = p.game_id AND t.play_id = p.play_id""",
        ),
        "silver_plays": (["silver"], SILVER_SELECT),
        "separation_nearest": (["separation"], f"SELECT game_id, play_id, {r6('separation_at_catch')} FROM separation"),
        "pressure_radius": (["pressure"], f"SELECT game_id, play_id, defenders_near_qb, defenders, {r6('qb_pressure_rate')} FROM pressure"),
        "game_aggregates": (["games"], f"SELECT {GAME_SELECT} FROM games"),
        "team_rankings": (
            ["games"],
            f"""SELECT {GAME_SELECT}, CAST(dense_rank() OVER (ORDER BY round(avg_yards_per_play, 6) DESC) AS BIGINT) AS yards_per_play_rank,
              CAST(dense_rank() OVER (ORDER BY round(success_rate, 6) DESC) AS BIGINT) AS success_rate_rank FROM games""",
        ),
        "weekly_aggregates": (["weeks"], f"SELECT {WEEK_SELECT} FROM weeks"),
        "weekly_moving_avg": (
            ["weeks"],
            f"""SELECT {WEEK_SELECT}, round(avg(avg_yards_per_play) OVER w, 6) + 0.0 AS ma3_yards_per_play,
              round(avg(success_rate) OVER w, 6) + 0.0 AS ma3_success_rate
            FROM weeks WINDOW w AS (PARTITION BY possession_team ORDER BY week_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
        ),
        "rolling_features": (
            ["silver"],
            f"""SELECT game_id, play_id, {r6("rolling_avg_yards", "rolling_success_rate", "rolling_pressure")}, turnovers_last_5
            FROM (SELECT *, {ROLLING_COLUMNS} FROM silver WINDOW {R5})""",
        ),
        "plays_since_turnover": (
            ["plays"],
            """SELECT game_id, play_id, n - last_value(CASE WHEN is_turnover THEN n END IGNORE NULLS) OVER
              (PARTITION BY possession_team ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS plays_since_turnover
            FROM (SELECT *, row_number() OVER (PARTITION BY possession_team ORDER BY event_timestamp, play_id) AS n FROM plays)""",
        ),
        "opponent_features": (
            ["silver"],
            f"""SELECT game_id, play_id, {r6("opp_avg_yards_allowed", "opp_success_rate_allowed", "opp_pressure_rate")}
            FROM (SELECT *, {OPPONENT_COLUMNS} FROM silver WINDOW {R20})""",
        ),
        "ml_features": (
            ["features"],
            f"""SELECT game_id, play_id, event_timestamp, play_success, yards_gained, down, yards_to_go, yard_line, quarter, time_remaining_total,
              score_differential, is_winning, is_close_game, is_red_zone, is_two_minute_drill, is_clutch_time, field_position_category,
              game_situation, is_passing_down, is_short_yardage, plays_since_turnover, separation_quality, is_high_pressure,
              redzone_pressure, clutch_pressure, winning_conservative,
              {r6("down_distance_ratio", "rolling_avg_yards", "rolling_success_rate", "rolling_pressure", "speed_advantage")},
              {r6("defensive_pressure_rate", "opp_avg_yards_allowed", "opp_success_rate_allowed", "opp_pressure_rate")}
            FROM features""",
        ),
        "play_sequences": (["sequences"], "SELECT game_id, play_id, prev_score_diff, prev_yard_line, next_score_diff FROM sequences"),
        "plays_ordered": (["plays"], "SELECT game_id, play_id, event_timestamp FROM plays ORDER BY game_id, event_timestamp, play_id"),
        "play_effectiveness": (["effectiveness"], EFFECTIVENESS_SELECT),
        "win_probability": (
            ["win_prob"],
            f"""SELECT game_id, play_id, game_date, possession_team, play_type, play_success, yards_gained, game_situation,
              {r6("win_probability_before", "win_probability_after", "win_prob_added")} FROM win_prob""",
        ),
        "team_daily_stats": (
            ["daily"],
            f"SELECT stat_date, team, total_plays, run_plays, pass_plays, red_zone_plays, {DAILY_R6} FROM daily",
        ),
        "wpa_by_play_type": (
            ["win_prob"],
            """SELECT play_type, round(avg(win_prob_added), 6) + 0.0 AS avg_wpa, count(*) AS play_count
            FROM win_prob WHERE quarter <= 4 AND game_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY play_type ORDER BY avg(win_prob_added) DESC, play_type""",
        ),
        "top_pressure": (
            ["plays", "pressure"],
            f"""SELECT p.game_id, p.play_id, {r6("r.qb_pressure_rate")}, p.play_result
            FROM plays p JOIN pressure r ON p.game_id = r.game_id AND p.play_id = r.play_id
            WHERE r.qb_pressure_rate > 0.6 ORDER BY r.qb_pressure_rate DESC, p.game_id, p.play_id LIMIT 100""",
        ),
        "eyg_historical": (
            ["plays", "classed"],
            f"SELECT game_id, play_id, history_plays, {r6('expected_yards_gained', 'yards_over_expected')} FROM ({EYG})",
        ),
        "check_freshness": (
            ["plays"],
            """SELECT count(*) AS row_count, count(*) > 0 AS is_fresh FROM plays WHERE CAST(event_timestamp AS DATE) = DATE '2024-01-30'""",
        ),
        "check_lag": (
            ["plays"],
            """SELECT CAST(max(score_home + score_away) AS BIGINT) AS max_lag_seconds, max(score_home + score_away) <= 60 AS within_limit
            FROM plays WHERE CAST(event_timestamp AS DATE) = DATE '2024-01-30'""",
        ),
        "check_gold": (
            ["daily"],
            """SELECT teams, round(p, 6) + 0.0 AS avg_plays, round(s, 6) + 0.0 AS avg_success_rate, teams > 0 AS has_teams, p > 50 AS enough_plays,
              s BETWEEN 0 AND 1 AS rate_in_range, teams > 0 AND p > 50 AND s BETWEEN 0 AND 1 AS passed
            FROM (SELECT count(DISTINCT team) AS teams, avg(total_plays) AS p, avg(success_rate) AS s FROM daily)""",
        ),
        "stream_bronze_plays": (["bronze"], f"{BRONZE_SELECT} WHERE is_valid"),
        "stream_bronze_tracking": (["bronze_tracking"], TRACKING_SELECT),
        "stream_tracking_derived": (["motion"], MOTION_SELECT),
        "stream_dedup": (["plays"], f"SELECT {PLAY_NAMES} FROM plays"),
        "stream_silver": (["silver"], SILVER_SELECT),
        "play_sessions": (["plays"], SESSIONS),
        "stream_play_sessions": (["plays"], SESSIONS),
        "stream_tracking_keyed": (["motion"], MOTION_SELECT),
        "daily_bucketed": (["daily"], f"SELECT stat_date, team, total_plays, run_plays, pass_plays, red_zone_plays, {r6('avg_yards_per_play', 'success_rate', 'red_zone_success_rate')} FROM daily"),
        "table_compacted": (["plays"], f"SELECT {PLAY_NAMES} FROM plays"),
        "log_replay": (["plays"], f"SELECT {PLAY_NAMES} FROM plays WHERE CAST(substring(play_id, 2) AS BIGINT) >= 100"),
        "snapshot_upsert": (["daily"], """SELECT concat('team_stats:', team) AS cache_key,
            CASE WHEN CAST(substring(team, 2) AS INT) % 2 = 0 THEN TIMESTAMP '2024-02-01 12:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS expires_at,
            max(stat_date) AS stat_date, max_by(total_plays, stat_date) AS total_plays FROM daily GROUP BY team"""),
        "stream_progress": ([], "SELECT 'bronze_plays' AS query, CAST(count(*) + 1 AS BIGINT) AS rows_read FROM events"),
        "eyg_backed_off": (["plays", "classed"], f"SELECT game_id, play_id, level, history_plays, {r6('expected_yards_gained', 'yards_over_expected')} FROM ({EYG_LEVELS})"),
    }
    same = {"games_from_days": "game_aggregates", "weeks_from_days": "weekly_moving_avg"}
    return texts | {name: texts[other] for name, other in same.items()}


VIEWS["classed"] = CLASSED
NEEDS["classed"] = ["plays"]


def oracle_sql() -> dict[str, str]:
    return {name: f"{_with(views)}\n{select}".strip() for name, (views, select) in _texts().items()}
