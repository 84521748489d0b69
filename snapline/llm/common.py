"""Helpers shared by the corpus operators: words, stored intermediate tables, distributed running sums."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapline.session import work_dir

BLANKS = r"[\x20\x09-\x0D]+"
#: Sides of a join with at most so many rows may be broadcast; beyond it the join is left to a shuffle.
BROADCAST_ROWS = 20_000


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; where it is installed this changes nothing."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared work folder and read back: cuts the lineage, survives lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, whatever the optimizer inlines."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """All runs of characters other than ASCII blanks; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a missing id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has been counted to be small, else as it is.

    Give a stored table: it is read once for the count.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def running(df: DataFrame, order: Sequence[str], sums: dict[str, str], name: str) -> DataFrame:
    """Running totals over the whole table in the order of the columns ``order`` (nulls last), without a single-task sort.

    Rows are range-partitioned and stored once; totals of the partitions are carried forward. ``sums`` maps the
    name of a total to its summand (a column); each total includes its own row. Rows equal in all ``order`` columns
    follow one another in any order.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    parts = stored(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), name)
    # One row per partition of the stored table, so this window is as small as the task list.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_part").agg(*[F.sum(c).alias(f"_sum_{t}") for t, c in sums.items()])
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_sum_{t}").over(before), F.lit(0)).alias(f"_before_{t}") for t in sums])
    inside = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    rows = parts.select("*", *[F.sum(c).over(inside).alias(f"_inside_{t}") for t, c in sums.items()])
    rows = rows.join(F.broadcast(offsets), "_part")
    return rows.select(*df.columns, *[(F.col(f"_inside_{t}") + F.col(f"_before_{t}")).alias(t) for t in sums])
