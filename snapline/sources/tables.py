"""Table scans and sinks.

Tables are Parquet with a day partition ``event_date`` (or the table's own date column) and rows sorted
by the cluster columns inside each file.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapline.session import work_dir

PARTITION = "event_date"


def scan_date_range(df: DataFrame, start: dt.date, end: dt.date, column: str = "event_timestamp") -> DataFrame:
    """Rows whose day lies in [start, end].

    The bounds are put on the timestamp itself, so they reach the Parquet reader, and on the partition
    column where there is one, so whole days are skipped.
    """
    after = end + dt.timedelta(days=1)
    type_ = df.schema[column].dataType.typeName()
    day = F.col(column)
    if type_ != "date":
        first, stop = F.lit(start.isoformat()).cast(type_), F.lit(after.isoformat()).cast(type_)
    else:
        first, stop = F.lit(start), F.lit(after)
    rows = df.filter((day >= first) & (day < stop))
    if PARTITION in df.columns:
        rows = rows.filter(F.col(PARTITION).between(F.lit(start), F.lit(end)))
    return rows


def scan_lookback(df: DataFrame, as_of: dt.date, days: int = 30, column: str = "event_timestamp") -> DataFrame:
    """Rows of the ``days`` days before ``as_of`` and after; no upper bound, as published."""
    first = as_of - dt.timedelta(days=days)
    rows = df.filter(F.col(column) >= F.lit(first.isoformat()).cast(df.schema[column].dataType.typeName()))
    return rows.filter(F.col(PARTITION) >= F.lit(first)) if PARTITION in df.columns else rows


def scan_yesterday(df: DataFrame, as_of: dt.date, column: str = "event_timestamp") -> DataFrame:
    day = as_of - dt.timedelta(days=1)
    return scan_date_range(df, day, day, column)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Preflight check of a table folder on whatever file system holds it."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder, on whatever file system holds it; the folder above the target is made."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    system = paths(source).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(paths(target).getParent())
    if not system.rename(paths(source), paths(target)):
        raise OSError(f"could not rename {source} to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(jpath)


def remove_folder(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def order_files(spark: SparkSession, path: str) -> int:
    """Give the files that one job wrote into a folder times in the order of its tasks, a second apart, and return how many there are.

    A stream reads files by their times, and tasks that run side by side end in any order. Raises where the file system keeps no times.
    """
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f for f in system.listStatus(jpath) if f.getPath().getName().startswith("part-")]
    last = max((f.getModificationTime() for f in found), default=0) // 1000 * 1000
    ordered = sorted((f.getPath() for f in found), key=lambda f: int(f.getName().split("-")[1]))
    for number, file in enumerate(ordered):
        time = last - 1000 * (len(ordered) - number)
        system.setTimes(file, time, -1)
        if system.getFileStatus(file).getModificationTime() != time:
            raise OSError(f"could not set the time of {file}")
    return len(ordered)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, none if it is not there."""
    if not table_exists(spark, path):
        return []
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(jpath)
    return [f.getPath().getName() for f in found if f.isDirectory()]


def with_event_date(df: DataFrame, column: str = "event_timestamp") -> DataFrame:
    return df.withColumn(PARTITION, F.to_date(column))


def write_table(df: DataFrame, path: str) -> int:
    """Overwrite a whole table; returns the row count, observed during the write (no second run)."""
    seen = Observation()
    df.observe(seen, F.count("*").alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def write_days(df: DataFrame, path: str, day: str, cluster_by: list[str]) -> int:
    """Write a day-partitioned, clustered table; replaces only the days present in ``df``.

    The rebalance hint gives files of the advisory size: one day may hold a large share of all rows, and
    the adaptive plan then splits it over several tasks.
    """
    seen = Observation()
    (
        df.observe(seen, F.count("*").alias("rows"))
        .hint("rebalance", F.col(day))
        .sortWithinPartitions(day, *cluster_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    return seen.get["rows"]


def kv_snapshot(stats: DataFrame, as_of: dt.datetime, ttl_seconds: int = 86_400) -> DataFrame:
    """Latest statistics per team as (cache_key, value_json, expires_at).

    Stays a distributed table that a key-value loader can read; nothing passes through the driver.
    """
    latest = stats.groupBy("team").agg(F.max_by(F.struct(*stats.columns), "stat_date").alias("s"))
    expires = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(ttl_seconds))
    return latest.select(
        F.concat(F.lit("team_stats:"), "team").alias("cache_key"),
        F.to_json("s").alias("value_json"),
        expires.alias("expires_at"),
    )


KEY_PART = "key_part"


def upsert_snapshot(updates: DataFrame, path: str, as_of: dt.datetime, parts: int = 16) -> dict[str, int]:
    """Merge entries (cache_key, value_json, expires_at) into a stored snapshot and drop those that have expired by ``as_of``.

    Keys lie in ``parts`` folders by hash. Only folders with an update or an expired entry are read whole and written again; the
    others keep their files. Of several updates of a key the one that expires last wins. The same call again changes nothing, so it
    may stand in ``foreachBatch``. New content is stored aside first, since a table cannot be read and replaced at once.
    """
    spark = updates.sparkSession
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    part = F.pmod(F.xxhash64("cache_key"), F.lit(parts)).cast("int").alias(KEY_PART)
    new = updates.select("cache_key", "value_json", F.col("expires_at").cast("timestamp_ntz").alias("expires_at"), part, F.lit(1).alias("_new"))
    touched = {r[0] for r in new.select(KEY_PART).distinct().collect()}  # at most ``parts``
    rows = new
    if table_exists(spark, path):
        held = spark.read.parquet(path).select(*new.columns[:-1], F.lit(0).alias("_new"))
        touched |= {r[0] for r in held.filter(F.col("expires_at") <= now).select(KEY_PART).distinct().collect()}
        rows = held.filter(F.col(KEY_PART).isin(sorted(touched))).unionByName(new)
    best = F.max_by(F.struct("value_json", "expires_at"), F.struct("_new", "expires_at", "value_json")).alias("s")
    merged = rows.groupBy(KEY_PART, "cache_key").agg(best).select("cache_key", "s.value_json", "s.expires_at", KEY_PART).filter(F.col("expires_at") > now)
    aside = work_dir(spark, "snapshot")
    merged.write.parquet(aside)
    staged = spark.read.schema(merged.schema).parquet(aside)
    counts = {r[0]: r[1] for r in staged.groupBy(KEY_PART).count().collect()}
    staged.repartition(KEY_PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(KEY_PART).parquet(path)
    for empty in touched - counts.keys():
        remove_folder(spark, f"{path}/{KEY_PART}={empty}")
    remove_folder(spark, aside)
    return {"parts": len(touched), "entries": sum(counts.values())}
