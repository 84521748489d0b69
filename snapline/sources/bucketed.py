"""Day tables stored in buckets of the play key, so that joins and folds on it need no exchange.

Rows of one play lie in the same bucket of every table with the same number of buckets. Spark then joins bucket with bucket. Meant for tables with
few rows per play (effectiveness, win probability, silver): a bucket is one task, so frames of a hot play are better left to the
adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.schemas import PLAY_KEY
from snapline.sources.tables import make_folder


def ensure_bucketed(spark: SparkSession, name: str, path: str, schema: T.StructType, day: str, buckets: int, keys: list[str] = PLAY_KEY) -> None:
    """Make the table known to the session's catalog; files that lie at ``path`` already belong to it."""
    if spark.catalog.tableExists(name):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    clustered = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE `{name}` ({columns}) USING parquet PARTITIONED BY (`{day}`) "
        f"CLUSTERED BY ({clustered}) SORTED BY ({clustered}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    make_folder(spark, path)
    spark.catalog.recoverPartitions(name)


def write_bucketed_days(df: DataFrame, name: str, path: str, day: str, buckets: int, keys: list[str] = PLAY_KEY) -> int:
    """Replace the days that ``df`` has in a bucketed table, made if it is not there; returns rows written.

    One shuffle on the keys before the write gives one file per bucket and day, whatever the number of tasks before it.
    """
    spark = df.sparkSession
    ensure_bucketed(spark, name, path, df.schema, day, buckets, keys)
    seen = Observation()
    rows = df.observe(seen, F.count("*").alias("rows")).repartition(buckets, *keys)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rows.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    return seen.get["rows"]
