"""Compaction of closed days of tables that streams write batch by batch.

A stream-written table has a folder per micro-batch and day, thousands of small files a day. ``compact_day`` gathers a day's batches into files of one
size in a table beside it (``<table>_compact/event_date=D/upto=N``), put in place by one rename. ``read_compacted`` takes a day from there as far as
it goes and later batches from the table itself, so each row is read once, before, during and after a compaction. Streams that read the table never
see the compact files, which lie outside of it. ``remove_batches`` drops the small files once every given stream has committed them.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.sources.tables import PARTITION, folder_names, move_folder, read_table, remove_folder, table_exists

BATCH = "batch_id"
UPTO = "upto"


def compact_path(path: str) -> str:
    return f"{path.rstrip('/')}_compact"


def compacted_days(spark: SparkSession, path: str) -> dict[dt.date, int]:
    """Days with the last batch that their compact files hold: a few names per day, listed by the driver."""
    found = {}
    for day in folder_names(spark, compact_path(path)):
        if not day.startswith(f"{PARTITION}="):
            continue
        versions = [int(v.removeprefix(f"{UPTO}=")) for v in folder_names(spark, f"{compact_path(path)}/{day}") if v.startswith(f"{UPTO}=")]
        if versions:
            found[dt.date.fromisoformat(day.removeprefix(f"{PARTITION}="))] = max(versions)
    return found


def _compact_files(spark: SparkSession, path: str, days: dict[dt.date, int]) -> DataFrame:
    folders = [f"{compact_path(path)}/{PARTITION}={day}/{UPTO}={upto}" for day, upto in days.items()]
    return spark.read.option("basePath", compact_path(path)).parquet(*folders).drop(UPTO)


def _beyond(days: dict[dt.date, int]) -> Column:
    """Whether a batch's rows are not in the compact files of their day; a condition on partition columns, so folders are skipped."""
    if not days:
        return F.lit(True)
    upto = F.create_map(*[x for day, n in days.items() for x in (F.lit(day), F.lit(n))])
    held = F.try_element_at(upto, F.col(PARTITION))
    return held.isNull() | (F.col(BATCH) > held)


def read_compacted(spark: SparkSession, path: str) -> DataFrame:
    """The whole table, each row once, without the batch numbers."""
    days = compacted_days(spark, path)
    rows = read_table(spark, path).filter(_beyond(days)).drop(BATCH) if table_exists(spark, path) else None
    if not days:
        return rows
    files = _compact_files(spark, path, days)
    return files if rows is None else files.unionByName(rows)


def compact_day(spark: SparkSession, path: str, day: dt.date, cluster_by: list[str], files: int = 8) -> int | None:
    """Gather all batches of a day written so far, also those that came after an earlier compaction; the last batch, none if nothing is new.

    Rows are dealt out evenly to ``files`` files and sorted inside them. A crash leaves the day as it was: the new files appear by one rename, and
    older ones are removed after it.
    """
    done = compacted_days(spark, path).get(day)
    rows = read_table(spark, path).filter(F.col(PARTITION) == F.lit(day))
    rows = rows if done is None else rows.filter(F.col(BATCH) > done)
    # Batches that are written later are above this number, so what is read here does not change under way.
    upto = rows.agg(F.max(BATCH)).first()[0]
    if upto is None:
        return None
    rows = rows.filter(F.col(BATCH) <= upto).drop(BATCH, PARTITION)
    if done is not None:
        rows = rows.unionByName(_compact_files(spark, path, {day: done}).drop(PARTITION))
    aside = f"{compact_path(path)}/_staged/{day}"
    rows.repartition(files).sortWithinPartitions(*cluster_by).write.mode("overwrite").parquet(aside)
    place = f"{compact_path(path)}/{PARTITION}={day}"
    move_folder(spark, aside, f"{place}/{UPTO}={upto}")
    for version in folder_names(spark, place):
        if version != f"{UPTO}={upto}":
            remove_folder(spark, f"{place}/{version}")
    return upto


def consumed_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``file`` (from the batch folder on) of all files that the stream with this checkpoint has read in batches it has committed."""
    committed = [int(n) for n in _file_names(spark, f"{checkpoint}/commits") if n.isdigit()]
    none = spark.createDataFrame([], "file string")
    if not committed:
        return none
    # Two lines of header, then one per source.
    lines = [r["value"] for r in spark.read.text(f"{checkpoint}/offsets/{max(committed)}", wholetext=True).collect()][0].split("\n")[2:]
    parts = [none]
    for source, line in enumerate(lines):
        log = f"{checkpoint}/sources/{source}"
        if not table_exists(spark, log):
            continue
        entries = spark.read.text(log).select(F.from_json("value", "path string, batchId long").alias("e"))
        offset = F.get_json_object(F.lit(line), "$.logOffset").cast("long")
        read = entries.filter(F.col("e.path").isNotNull() & (F.col("e.batchId") <= offset))
        parts.append(read.select(_inner("e.path").alias("file")))
    return reduce(DataFrame.union, parts).distinct()


def _inner(path: str) -> Column:
    return F.regexp_extract(path, f"({BATCH}=.*)$", 1)


def _file_names(spark: SparkSession, path: str) -> list[str]:
    if not table_exists(spark, path):
        return []
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [f.getPath().getName() for f in jpath.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(jpath)]


def remove_batches(spark: SparkSession, path: str, day: dt.date, checkpoints: list[str]) -> int:
    """Remove a day's small files that its compact files hold; returns folders removed. Raises while a stream has not committed them all.

    ``checkpoints``: of every stream that reads the table.
    """
    upto = compacted_days(spark, path).get(day)
    if upto is None:
        raise ValueError(f"{day} of {path} has no compact files")
    held = read_table(spark, path).filter((F.col(PARTITION) == F.lit(day)) & (F.col(BATCH) <= upto))
    held = held.select(BATCH, _inner("_metadata.file_path").alias("file")).distinct()
    for checkpoint in checkpoints:
        left = held.join(consumed_files(spark, checkpoint), "file", "left_anti")
        if not left.isEmpty():
            raise ValueError(f"the stream of {checkpoint} has not read all of {day}")
    batches = [r[0] for r in held.select(BATCH).distinct().collect()]  # a day's micro-batches
    for batch in batches:
        remove_folder(spark, f"{path}/{BATCH}={batch}/{PARTITION}={day}")
    return len(batches)
