"""Decoding, validity, dead letters, duplicates and checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.functions.plays import all_hold, holds, play_rules, tracking_rules
from snapline.schemas import (
    PLAY_KEY,
    PLAY_SCHEMA,
    REQUIRED_PLAY_COLUMNS,
    REQUIRED_TRACKING_COLUMNS,
    TRACKING_SCHEMA,
)
from snapline.sources.tables import scan_date_range

RAW = "raw_data"
MALFORMED = "malformed_text"


def parse_messages(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Decode one JSON object per message; the raw text stays beside the columns.

    ``malformed_text`` holds the text of messages that do not fit the schema, NULL otherwise. The message is unfolded
    from an array of one, so that each is decoded once: a filter on plain fields of it would be evaluated with one decoding
    for every use of a column.
    """
    with_error = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    decoded = F.from_json(RAW, with_error, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED})
    return (
        messages.select(F.col(value).cast("string").alias(RAW))
        .select(RAW, F.inline(F.array(decoded)))
        .select(*with_error.fieldNames(), RAW)
    )


def parse_plays(messages: DataFrame, value: str = "value") -> DataFrame:
    return parse_messages(messages, PLAY_SCHEMA, value)


def parse_tracking(messages: DataFrame, value: str = "value") -> DataFrame:
    return parse_messages(messages, TRACKING_SCHEMA, value)


def stamp(df: DataFrame) -> DataFrame:
    """Ingest time; one value per batch or micro-batch."""
    return df.withColumn("processing_timestamp", F.current_timestamp())


def flag_plays(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_valid": all_hold(play_rules()),
            "is_red_zone": holds(F.col("yard_line") <= 20),
            "is_two_minute_drill": holds(F.col("time_remaining") <= 120),
        }
    )


def flag_tracking(df: DataFrame, strict_speed: bool = False) -> DataFrame:
    return df.withColumns(
        {
            "is_valid": all_hold(tracking_rules(strict_speed)),
            "is_outlier_speed": holds(F.col("speed") > 22),
        }
    )


def _failures(rules: dict[str, Column], required: list[str], malformed: bool) -> Column:
    """Names of all failing rules, joined by ';' (empty if none fails)."""
    checks = {f"missing_{name}": F.col(name).isNotNull() for name in required} | rules
    if malformed:
        checks = {"malformed_message": F.col(MALFORMED).isNull()} | checks
    return F.concat_ws(";", *[F.when(~holds(ok), name) for name, ok in checks.items()])


def with_error_message(df: DataFrame, rules: dict[str, Column], required: list[str]) -> DataFrame:
    return df.withColumn("error_message", _failures(rules, required, MALFORMED in df.columns))


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("error_message") == "")


def dead_letters(df: DataFrame) -> DataFrame:
    return df.filter(F.col("error_message") != "").select(
        *PLAY_KEY, RAW, "error_message", "processing_timestamp"
    )


def check_plays(df: DataFrame) -> DataFrame:
    return with_error_message(df, play_rules(), REQUIRED_PLAY_COLUMNS)


def check_tracking(df: DataFrame, strict_speed: bool = False) -> DataFrame:
    return with_error_message(df, tracking_rules(strict_speed), REQUIRED_TRACKING_COLUMNS)


def required_report(df: DataFrame, required: list[str], rules: dict[str, Column] | None = None) -> DataFrame:
    """(rule, failed, total): one pass over the table whatever the number of rules."""
    checks = {f"missing_{name}": F.col(name).isNotNull() for name in required} | (rules or {})
    counts = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(~holds(ok)).alias(name) for name, ok in checks.items()],
    )
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("failed")) for name in checks])
    return counts.select("total", F.explode(rows).alias("r")).select("r.rule", "r.failed", "total")


def anomalies(tracking: DataFrame, max_speed: float = 22.0) -> DataFrame:
    """Suspicious frames per game."""
    missing = F.col("x_coord").isNull() | F.col("y_coord").isNull()
    outside = ~F.col("x_coord").between(0, 53.3) | ~F.col("y_coord").between(0, 120)
    return tracking.groupBy("game_id").agg(
        F.count("*").alias("frames"),
        F.count_if(F.col("speed") > max_speed).alias("impossible_speed"),
        F.count_if(F.col("speed").isNull()).alias("missing_speed"),
        F.count_if(missing).alias("missing_coordinates"),
        F.count_if(outside).alias("outside_field"),
    )


def dedup_plays(df: DataFrame, keys: list[str] = PLAY_KEY, order: str = "event_timestamp") -> DataFrame:
    """Keep the earliest row per key.

    The filter on row_number also runs before the shuffle (WindowGroupLimit), so each map task sends one
    row per key, however many copies a key has.
    """
    rest = [c for c in df.columns if c not in (*keys, order)]
    number = F.row_number().over(W.partitionBy(*keys).orderBy(order, *rest))
    return df.withColumn("__n", number).filter("__n = 1").drop("__n")


def _on_day(df: DataFrame, day: dt.date, column: str) -> DataFrame:
    return scan_date_range(df, day, day, column)


def check_freshness(silver: DataFrame, as_of: dt.date) -> DataFrame:
    """Does silver hold rows of the day ``as_of``?"""
    return _on_day(silver, as_of, "event_timestamp").agg(
        F.count("*").alias("row_count"), (F.count("*") > 0).alias("is_fresh")
    )


def check_lag(silver: DataFrame, as_of: dt.date, limit: int = 60) -> DataFrame:
    """Largest ingest lag in whole seconds; no rows at all counts as a failure."""
    lag = F.timestamp_diff("SECOND", F.col("event_timestamp"), F.col("processing_timestamp"))
    return (
        _on_day(silver, as_of, "event_timestamp")
        .agg(F.max(lag).alias("max_lag_seconds"))
        .withColumn("within_limit", holds(F.col("max_lag_seconds") <= limit))
    )


def check_gold(stats: DataFrame, min_plays: float = 50) -> DataFrame:
    """One row of verdicts on the daily team statistics."""
    measured = stats.agg(
        F.count_distinct("team").alias("teams"),
        F.avg("total_plays").alias("avg_plays"),
        F.avg("success_rate").alias("avg_success_rate"),
    )
    verdicts = {
        "has_teams": F.col("teams") > 0,
        "enough_plays": holds(F.col("avg_plays") > min_plays),
        "rate_in_range": holds(F.col("avg_success_rate").between(0, 1)),
    }
    passed = F.col("has_teams") & F.col("enough_plays") & F.col("rate_in_range")
    return measured.withColumns(verdicts).withColumn("passed", passed)
