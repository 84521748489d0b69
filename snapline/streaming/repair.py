"""Frames that came too late for the watermark of the motion stream, brought into bronze tracking afterwards.

``tracking_frames`` holds every frame with its keys; the motion stream drops those behind its watermark. A repair finds the players with accepted frames
that bronze lacks, or with refused frames that came after later ones (they count as predecessors, and only their motion would show that they lack), derives the motion of these players anew from all their frames, and stores them whole in ``bronze_tracking_repaired``.
``read_tracking`` takes these players from there and all others from ``bronze_tracking``, whose files, listed in the stream's commit log, are not touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snapline.operators.quality import flag_tracking
from snapline.operators.tracking import derive_tracking
from snapline.schemas import BRONZE_TRACKING_COLUMNS, PLAYER_KEY, TRACKING_SCHEMA
from snapline.session import work_dir
from snapline.sources.tables import read_table, remove_folder, table_exists
from snapline.streaming.bronze import BATCH
from snapline.streaming.tracking import ACCEPTED

PART = "player_part"
#: The last batch of frames that a repaired player has.
UPTO = "upto_batch"
FRAME = [*PLAYER_KEY, "timestamp", "frame_id"]


def repaired_path(root: str) -> str:
    return f"{root}/bronze_tracking_repaired"


def read_tracking(spark: SparkSession, root: str) -> DataFrame:
    """Bronze tracking with the repaired players in place of what the stream wrote of them."""
    rows = read_table(spark, f"{root}/bronze_tracking").select(*BRONZE_TRACKING_COLUMNS)
    if not table_exists(spark, repaired_path(root)):
        return rows
    repaired = read_table(spark, repaired_path(root))
    return rows.join(repaired.select(*PLAYER_KEY).distinct(), PLAYER_KEY, "left_anti").unionByName(repaired.select(*BRONZE_TRACKING_COLUMNS))


def repair_late_frames(spark: SparkSession, root: str, strict_speed: bool = False, gap_seconds: float = 30, parts: int = 64) -> int:
    """Repair all players that lack accepted frames; returns rows written. Run it for days that are closed: frames still in the stream's state lack too.

    Players lie in ``parts`` folders by hash; the folders of the players touched are written again with the players repaired before.
    """
    frames = read_table(spark, f"{root}/tracking_frames")
    # Copies of a frame are told apart by number.
    wanted = frames.filter(ACCEPTED).groupBy(*FRAME).agg(F.count("*").alias("sent"))
    held = read_tracking(spark, root).groupBy(*FRAME).agg(F.count("*").alias("held"))
    part = F.pmod(F.xxhash64(*PLAYER_KEY), F.lit(parts)).cast("int").alias(PART)
    late = wanted.join(held, FRAME, "left").filter(F.col("sent") > F.coalesce("held", F.lit(0))).select(*PLAYER_KEY)
    earlier = W.partitionBy(*PLAYER_KEY).orderBy(BATCH).rangeBetween(W.unboundedPreceding, -1)
    behind = frames.select(*PLAYER_KEY, ACCEPTED, "timestamp", BATCH).withColumn("_seen", F.max("timestamp").over(earlier))
    behind = behind.filter(~F.col(ACCEPTED) & (F.col("_seen") > F.col("timestamp"))).groupBy(*PLAYER_KEY).agg(F.max(BATCH).alias(BATCH))
    done = read_table(spark, repaired_path(root)).select(*PLAYER_KEY, UPTO).distinct() if table_exists(spark, repaired_path(root)) else None
    if done is not None:
        behind = behind.join(done, PLAYER_KEY, "left").filter(F.col(BATCH) > F.coalesce(UPTO, F.lit(-1)))
    late = late.unionByName(behind.select(*PLAYER_KEY)).select(*PLAYER_KEY, part).distinct()
    aside = work_dir(spark, "late-players")
    late.write.parquet(f"{aside}/late")
    players = late = spark.read.schema(late.schema).parquet(f"{aside}/late")
    if late.isEmpty():
        remove_folder(spark, aside)
        return 0
    if table_exists(spark, repaired_path(root)):
        before = read_table(spark, repaired_path(root)).select(*PLAYER_KEY, PART).distinct()
        players = late.unionByName(before.join(late.select(PART).distinct(), PART, "left_semi").select(*late.columns)).distinct()
        players.write.parquet(f"{aside}/players")  # read before it is written over
        players = spark.read.schema(late.schema).parquet(f"{aside}/players")
    whole = frames.join(players.select(*PLAYER_KEY), PLAYER_KEY, "left_semi")
    flagged = flag_tracking(whole.select(*TRACKING_SCHEMA.fieldNames(), ACCEPTED, "processing_timestamp"), strict_speed)
    last = whole.groupBy(*PLAYER_KEY).agg(F.max(BATCH).cast("long").alias(UPTO))
    rows = derive_tracking(flagged, gap_seconds=gap_seconds).filter(ACCEPTED).join(last, PLAYER_KEY).select(*BRONZE_TRACKING_COLUMNS, UPTO, part)
    rows.hint("rebalance", F.col(PART)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(repaired_path(root))
    written = read_table(spark, repaired_path(root)).join(players.select(*PLAYER_KEY), PLAYER_KEY, "left_semi").count()
    remove_folder(spark, aside)
    return written
