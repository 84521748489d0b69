"""Registered queries: each reads the given tables whole and returns a DataFrame.

Doubles are rounded to 6 digits at the edge, so that another engine's summation order does not matter.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.functions.plays import play_rules
from snapline.operators import features, gold, history, plays, quality, silver, spatial, tracking
from snapline.plans import derived
from snapline.schemas import BRONZE_TRACKING_COLUMNS, CLUSTER_BY, PLAY_KEY, PLAY_SCHEMA, REQUIRED_PLAY_COLUMNS, TRACKING_SCHEMA
from snapline.session import work_dir
from snapline.sources import compaction, log, tables
from snapline.sources.bucketed import write_bucketed_days
from snapline.streaming import bronze, replay, sessions

AS_OF = dt.date(2024, 1, 31)
DIGITS = 6
BUCKETS = 8
COMPACTED = [dt.date(2024, 1, 9), dt.date(2024, 1, 10), dt.date(2024, 1, 11)]
FROM_OFFSET = 100
EXACT = ["total_plays", "run_plays", "pass_plays", "avg_yards_per_play", "success_rate", "red_zone_plays", "red_zone_success_rate"]

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame) -> DataFrame:
    """Round doubles; + 0.0 turns -0.0 into 0.0. Timestamps lose their zone, dates and others stay."""

    def edge(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return (F.round(column, DIGITS) + 0.0).alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        return column

    return df.select(*[edge(f) for f in df.schema.fields])


class Inputs:
    """The derived tables of one data folder, each built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return derived.read_table(self.spark, self.sf_dir, name)

    @property
    def plays(self) -> DataFrame:
        return derived.plays(self.spark, self.sf_dir)

    @property
    def tracking(self) -> DataFrame:
        return derived.tracking(self.spark, self.sf_dir)

    @property
    def bronze(self) -> DataFrame:
        return plays.bronze_plays(self.plays)

    @property
    def valid_plays(self) -> DataFrame:
        """The plays that reach the bronze table; the others are dead letters."""
        return self.bronze.filter("is_valid")

    @property
    def motion(self) -> DataFrame:
        counted = derived.counted_tracking(self.spark, self.sf_dir)
        return tracking.derive_tracking(quality.flag_tracking(self.tracking), counted=counted)

    @property
    def bronze_tracking(self) -> DataFrame:
        kept = [c for c in BRONZE_TRACKING_COLUMNS if c != "processing_timestamp"]
        return self.motion.filter("is_valid").select(*kept)

    @property
    def silver(self) -> DataFrame:
        return silver.silver_plays(self.valid_plays, self.bronze_tracking)

    @property
    def win_probability(self) -> DataFrame:
        return gold.win_probability(self.valid_plays)

    @property
    def daily(self) -> DataFrame:
        # Win probability needs columns of the plays alone, so the tracking is aggregated once.
        return gold.team_daily_stats(gold.play_effectiveness(self.silver), self.win_probability)

    @property
    def lagging(self) -> DataFrame:
        """Plays whose ingest time lies some seconds after the event."""
        delay = F.make_dt_interval(secs=F.col("score_home") + F.col("score_away"))
        return self.plays.withColumn("processing_timestamp", F.col("event_timestamp") + delay)


# --- scans and sinks


def scan_date_range(i: Inputs) -> DataFrame:
    return tables.scan_date_range(i.bronze, dt.date(2024, 1, 8), dt.date(2024, 1, 21))


def scan_lookback(i: Inputs) -> DataFrame:
    return tables.scan_lookback(i.bronze, AS_OF, 10)


def scan_yesterday(i: Inputs) -> DataFrame:
    return tables.scan_yesterday(i.bronze, AS_OF)


def sink_overwrite(i: Inputs) -> DataFrame:
    path = f"{work_dir(i.spark, 'sink')}/gold_game_aggregates"
    games = history.game_aggregates(i.silver)
    tables.write_table(games, path)
    return tables.read_table(i.spark, path)


def sink_ctas(i: Inputs) -> DataFrame:
    path = f"{work_dir(i.spark, 'sink')}/gold_play_effectiveness"
    tables.write_days(gold.play_effectiveness(i.silver), path, "game_date", CLUSTER_BY["gold_play_effectiveness"])
    return tables.read_table(i.spark, path)


KV_FIELDS = ["stat_date", "total_plays", "avg_yards_per_play", "success_rate", "total_wpa"]


def kv_team_stats(i: Inputs) -> DataFrame:
    """The snapshot, with some of its JSON fields read back (number formats differ between engines)."""
    kv = tables.kv_snapshot(i.daily, dt.datetime(2024, 1, 31))
    fields = F.from_json("value_json", "stat_date date, total_plays bigint, avg_yards_per_play double, success_rate double, total_wpa double")
    return kv.withColumn("v", fields).select("cache_key", "expires_at", *[f"v.{f}" for f in KV_FIELDS])


def join_game_context(i: Inputs) -> DataFrame:
    context = i.table("customer").select(
        F.concat(F.lit("G"), F.col("c_custkey").cast("string")).alias("game_id"),
        F.col("c_mktsegment").alias("venue"),
        F.col("c_acctbal").alias("crowd_index"),
    )
    return gold.join_game_context(i.bronze.select(*PLAY_KEY, "game_situation"), context)


# --- decoding and quality


def parse_plays(i: Inputs) -> DataFrame:
    return quality.parse_plays(derived.as_messages(i.plays)).select(*PLAY_SCHEMA.fieldNames())


def parse_tracking(i: Inputs) -> DataFrame:
    return quality.parse_tracking(derived.as_messages(i.tracking)).select(*TRACKING_SCHEMA.fieldNames())


def parse_json_props(i: Inputs) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    events = i.table("events").select("event_id", F.from_json("props", schema).alias("p"))
    return events.select("event_id", "p.k")


def valid_plays(i: Inputs) -> DataFrame:
    return quality.flag_plays(i.plays).filter("is_valid").select(*PLAY_KEY, "down", "quarter", "yard_line", "yards_to_go")


def enrich_plays(i: Inputs) -> DataFrame:
    return i.bronze


def valid_tracking(i: Inputs) -> DataFrame:
    loose = quality.flag_tracking(i.tracking)
    strict = quality.flag_tracking(loose.withColumnRenamed("is_valid", "is_valid_frame"), strict_speed=True)
    return strict.select(
        "player_id", "frame_id", "is_valid_frame", F.col("is_valid").alias("is_valid_strict"), "is_outlier_speed"
    )


def dlq_plays(i: Inputs) -> DataFrame:
    checked = quality.check_plays(quality.flag_plays(quality.stamp(quality.parse_plays(derived.as_messages(i.plays)))))
    letters = quality.dead_letters(checked)
    return letters.select(*PLAY_KEY, "error_message", F.get_json_object("raw_data", "$.quarter").alias("raw_quarter"))


def dlq_tracking(i: Inputs) -> DataFrame:
    checked = quality.check_tracking(quality.stamp(quality.parse_tracking(derived.as_messages(i.tracking))))
    letters = quality.dead_letters(checked)
    return letters.select(*PLAY_KEY, "error_message", F.get_json_object("raw_data", "$.player_id").alias("raw_player"))


def dq_required_report(i: Inputs) -> DataFrame:
    return quality.required_report(i.plays, REQUIRED_PLAY_COLUMNS + ["down", "yard_line", "time_remaining"], play_rules())


def dq_anomalies(i: Inputs) -> DataFrame:
    return quality.anomalies(i.tracking)


def dedup_plays(i: Inputs) -> DataFrame:
    later = i.plays.withColumn("event_timestamp", F.col("event_timestamp") + F.make_dt_interval(secs=F.lit(1)))
    return quality.dedup_plays(i.plays.unionByName(later).unionByName(later))


def bronze_tracking(i: Inputs) -> DataFrame:
    return i.bronze_tracking


# --- row-level features


def wp_features(i: Inputs) -> DataFrame:
    added = plays.add_wp_features(i.bronze)
    return added.select(
        *PLAY_KEY, "seconds_elapsed", "seconds_remaining", "is_offense_leading", "field_position_value", "down_distance_ratio"
    )


def game_context(i: Inputs) -> DataFrame:
    added = plays.add_game_context_features(i.bronze)
    return added.select(
        *PLAY_KEY, "time_remaining_total", "is_winning", "is_close_game", "is_clutch_time", "field_position_category"
    )


def down_distance(i: Inputs) -> DataFrame:
    added = plays.add_down_distance_features(i.plays)
    return added.select(*PLAY_KEY, "is_passing_down", "is_short_yardage", "down_distance_ratio")


def tracking_features(i: Inputs) -> DataFrame:
    added = plays.add_tracking_derived_features(i.silver)
    return added.select(*PLAY_KEY, "speed_advantage", "separation_quality", "is_high_pressure")


def interactions(i: Inputs) -> DataFrame:
    added = plays.add_game_context_features(plays.add_tracking_derived_features(i.silver))
    return plays.add_interaction_features(added).select(
        *PLAY_KEY, "redzone_pressure", "clutch_pressure", "winning_conservative"
    )


# --- tracking


def tracking_derived(i: Inputs) -> DataFrame:
    return i.motion.select(
        "player_id", "frame_id", "prev_x", "prev_y", "prev_timestamp", "prev_speed", "distance_traveled",
        "time_delta", "calculated_speed", "final_speed", "calculated_acceleration",
    )


def player_play_agg(i: Inputs) -> DataFrame:
    return tracking.aggregate_player_play(i.bronze_tracking)


def play_tracking_agg(i: Inputs) -> DataFrame:
    return tracking.aggregate_play_tracking(i.bronze_tracking, i.plays)


def tracking_with_roles(i: Inputs) -> DataFrame:
    return tracking.with_roles(i.tracking, i.plays).select(
        *PLAY_KEY, "player_id", "frame_id", "possession_team", "defensive_team", "side"
    )


def silver_plays(i: Inputs) -> DataFrame:
    return i.silver


def separation_nearest(i: Inputs) -> DataFrame:
    return spatial.separation_nearest(i.tracking)


def pressure_radius(i: Inputs) -> DataFrame:
    return spatial.pressure_radius(i.tracking)


# --- history, features, gold


def game_aggregates(i: Inputs) -> DataFrame:
    return history.game_aggregates(i.silver)


def team_rankings(i: Inputs) -> DataFrame:
    return history.team_rankings(rounded(history.game_aggregates(i.silver)))


def weekly_aggregates(i: Inputs) -> DataFrame:
    return history.weekly_aggregates(i.silver)


def weekly_moving_avg(i: Inputs) -> DataFrame:
    return history.moving_averages(history.weekly_aggregates(i.silver))


def rolling_features(i: Inputs) -> DataFrame:
    added = features.add_rolling_features(i.silver, counted=i.valid_plays)
    return added.select(
        *PLAY_KEY, "rolling_avg_yards", "rolling_success_rate", "rolling_pressure", "turnovers_last_5"
    )


def plays_since_turnover(i: Inputs) -> DataFrame:
    return features.add_plays_since_turnover(i.plays).select(*PLAY_KEY, "plays_since_turnover")


def opponent_features(i: Inputs) -> DataFrame:
    added = features.add_opponent_features(i.silver, counted=i.valid_plays)
    return added.select(*PLAY_KEY, "opp_avg_yards_allowed", "opp_success_rate_allowed", "opp_pressure_rate")


def ml_features(i: Inputs) -> DataFrame:
    return features.ml_features(i.silver, counted=i.valid_plays)


def play_sequences(i: Inputs) -> DataFrame:
    added = gold.play_sequences(i.valid_plays)
    return added.select(*PLAY_KEY, "prev_score_diff", "prev_yard_line", "next_score_diff")


def plays_ordered(i: Inputs) -> DataFrame:
    return i.plays.select(*PLAY_KEY, "event_timestamp").orderBy("game_id", "event_timestamp", "play_id")


def play_effectiveness(i: Inputs) -> DataFrame:
    return gold.play_effectiveness(i.silver)


def win_probability(i: Inputs) -> DataFrame:
    return i.win_probability


def team_daily_stats(i: Inputs) -> DataFrame:
    return i.daily


def wpa_by_play_type(i: Inputs) -> DataFrame:
    return gold.wpa_by_play_type(gold.win_probability(i.valid_plays, quarter=True), dt.date(2024, 1, 1), AS_OF)


def top_pressure(i: Inputs) -> DataFrame:
    """Highest pressure by distance to the quarterback, the documented meaning of the rate."""
    rates = spatial.pressure_radius(i.tracking)
    return gold.top_pressure(i.plays.join(rates, PLAY_KEY), "qb_pressure_rate")


def eyg_historical(i: Inputs) -> DataFrame:
    history_table = gold.historical_expected_yards(i.plays)
    added = gold.add_historical_expected_yards(i.plays, history_table)
    return added.select(*PLAY_KEY, "expected_yards_gained", "history_plays", "yards_over_expected")


def eyg_backed_off(i: Inputs) -> DataFrame:
    added = gold.add_backed_off_expected_yards(i.plays, gold.historical_levels(i.plays))
    return added.select(*PLAY_KEY, "level", "expected_yards_gained", "history_plays", "yards_over_expected")


def daily_bucketed(i: Inputs) -> DataFrame:
    """Team statistics of effectiveness and win probability stored in buckets of the play key.

    Only measures whose sums are exact: the order of summation differs from the other form, and with it the last digit of the others.
    """
    folder = work_dir(i.spark, "bucketed")
    made = {"effectiveness": gold.play_effectiveness(i.silver), "win_probability": i.win_probability}
    names = []
    for name, df in made.items():
        names.append(f"{name}_{folder.rsplit('-', 1)[-1].lower()}".replace("-", "_"))
        write_bucketed_days(df, names[-1], f"{folder}/{name}", "game_date", BUCKETS)
    stats = gold.team_daily_stats(*[i.spark.table(name) for name in names])
    return stats.select("stat_date", "team", *EXACT)


def table_compacted(i: Inputs) -> DataFrame:
    """Plays in micro-batches, three days of them compacted before the last batch comes, read as one table."""
    path = f"{work_dir(i.spark, 'compacted')}/plays"
    rows = tables.with_event_date(i.plays)
    batch = F.pmod(F.hash("play_id"), F.lit(3))
    for number in range(3):
        bronze.write_batch(rows.filter(batch == number), path, number)
        if number == 1:
            for day in COMPACTED:
                compaction.compact_day(i.spark, path, day, CLUSTER_BY["bronze_plays"], files=2)
    return compaction.read_compacted(i.spark, path).select(*PLAY_SCHEMA.fieldNames())


def log_replay(i: Inputs) -> DataFrame:
    """Plays as messages of a log, streamed from an offset on and decoded."""
    folder = work_dir(i.spark, "log")
    events = i.table("events")
    numbered = derived.with_zone(derived.plays_from_events(events)).withColumn("offset", F.substring("play_id", 2, 20).cast("long"))
    messages = numbered.select("offset", derived.message(PLAY_SCHEMA.fieldNames()))
    log.write_segments(messages, f"{folder}/log", 8)
    stream = log.log_messages(i.spark, f"{folder}/log", FROM_OFFSET).select("value")
    out = f"{folder}/plays"
    bronze.start_append(quality.parse_plays(stream), out, f"{folder}/checkpoints", None).awaitTermination()
    return i.spark.read.parquet(out).select(*PLAY_SCHEMA.fieldNames())


def snapshot_upsert(i: Inputs) -> DataFrame:
    """A snapshot of all teams, then half a day later new entries for those with an even number."""
    path = f"{work_dir(i.spark, 'snapshot')}/kv"
    stats = i.daily.select("team", "stat_date", "total_plays")
    first, later = dt.datetime(2024, 1, 31), dt.datetime(2024, 1, 31, 12)
    tables.upsert_snapshot(tables.kv_snapshot(stats, first), path, first)
    even = stats.filter(F.substring("team", 2, 9).cast("int") % 2 == 0)
    tables.upsert_snapshot(tables.kv_snapshot(even, later), path, later)
    value = F.from_json("value_json", "stat_date date, total_plays bigint")
    return i.spark.read.parquet(path).select("cache_key", "expires_at", value.alias("v")).select("cache_key", "expires_at", "v.stat_date", "v.total_plays")


def games_from_days(i: Inputs) -> DataFrame:
    """Games merged from partial sums per day."""
    return history.games_from_partials(history.day_partials(i.silver))


def weeks_from_days(i: Inputs) -> DataFrame:
    return history.moving_averages(history.weeks_from_partials(history.day_partials(i.silver)))


def check_freshness(i: Inputs) -> DataFrame:
    return quality.check_freshness(i.bronze, dt.date(2024, 1, 30))


def check_lag(i: Inputs) -> DataFrame:
    return quality.check_lag(i.lagging, dt.date(2024, 1, 30))


def check_gold(i: Inputs) -> DataFrame:
    return quality.check_gold(i.daily)


# --- streams: replay the tables through a streaming query and read what it wrote


def stream_bronze_plays(i: Inputs) -> DataFrame:
    return replay.bronze_plays(i.spark, i.sf_dir).drop("processing_timestamp", "event_date", "batch_id")


def stream_bronze_tracking(i: Inputs) -> DataFrame:
    return replay.bronze_tracking(i.spark, i.sf_dir).drop("processing_timestamp", "event_date")


def stream_tracking_derived(i: Inputs) -> DataFrame:
    return replay.tracking_derived(i.spark, i.sf_dir).select(*tracking_derived_columns())


def stream_tracking_keyed(i: Inputs) -> DataFrame:
    return replay.tracking_derived(i.spark, i.sf_dir, keyed=True).select(*tracking_derived_columns())


def stream_play_sessions(i: Inputs) -> DataFrame:
    return replay.sessions(i.spark, i.sf_dir).drop("event_date")


def play_sessions(i: Inputs) -> DataFrame:
    return sessions.play_sessions(i.plays)


def stream_progress(i: Inputs) -> DataFrame:
    return replay.progress(i.spark, i.sf_dir).groupBy("query").agg(F.sum("rows_read").alias("rows_read"))


def tracking_derived_columns() -> list[str]:
    return [
        "player_id", "frame_id", "prev_x", "prev_y", "prev_timestamp", "prev_speed", "distance_traveled",
        "time_delta", "calculated_speed", "final_speed", "calculated_acceleration",
    ]


def stream_dedup(i: Inputs) -> DataFrame:
    return replay.dedup(i.spark, i.sf_dir).drop("event_date")


def stream_silver(i: Inputs) -> DataFrame:
    return replay.silver(i.spark, i.sf_dir).drop("event_date")


BUILDERS: list[Callable[[Inputs], DataFrame]] = [
    scan_date_range, scan_lookback, scan_yesterday, sink_overwrite, sink_ctas, kv_team_stats, join_game_context,
    parse_plays, parse_tracking, parse_json_props, valid_plays, enrich_plays, valid_tracking, dlq_plays, dlq_tracking,
    dq_required_report, dq_anomalies, dedup_plays, bronze_tracking,
    wp_features, game_context, down_distance, tracking_features, interactions,
    tracking_derived, player_play_agg, play_tracking_agg, tracking_with_roles, silver_plays, separation_nearest, pressure_radius,
    game_aggregates, team_rankings, weekly_aggregates, weekly_moving_avg,
    rolling_features, plays_since_turnover, opponent_features, ml_features,
    play_sequences, plays_ordered, play_effectiveness, win_probability, team_daily_stats, wpa_by_play_type,
    top_pressure, eyg_historical, check_freshness, check_lag, check_gold,
    stream_bronze_plays, stream_bronze_tracking, stream_tracking_derived, stream_dedup, stream_silver,
    play_sessions, stream_play_sessions, stream_tracking_keyed, stream_progress,
    eyg_backed_off, daily_bucketed, games_from_days, weeks_from_days, table_compacted, log_replay, snapshot_upsert,
]


def _query(build: Callable[[Inputs], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(build(Inputs(spark, sf_dir)))

    return run


def queries() -> dict[str, Query]:
    return {build.__name__: _query(build) for build in BUILDERS}
