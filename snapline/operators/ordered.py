"""Row-frame windows that do not put a huge group into one task.

Sixteen teams mean sixteen window tasks, whatever the size of the table, and one game may hold a third
of all rows. So the rows of each group are counted first, from the key columns alone:

- Groups of up to ``GROUP_ROWS`` rows fit into a task: a plain window over their keys, nothing is stored.
- The rows of larger groups are stored under the shared work folder, range-partitioned by (keys, order) from there and
  stored again with the number of their range; the upstream plan runs once for them, and what samples the ranges reads stored rows.
  Groups that lie in several ranges are cut there, the rows that a neighbour's frame reaches are copied to that neighbour,
  one window over (keys, part) computes the columns, and the copies are dropped.

Both ways give the same columns for any group, so the limit decides on the work alone. Rows are counted by hash slots of the keys first; only keys in slots above the limit are
counted one by one, so that the count does not shuffle every key. A given number of ``partitions`` sends
every group the second way.

The order columns must be unique within a group. Comparisons of keys and order stay inside Spark, so neither time zones
nor the driver's types touch them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from snapline.session import remove, work_dir

PART = "__part"
_COPY = "__copy"
_NUM = "__num"
#: Rows that one window task sorts at most, by spilling where it must.
GROUP_ROWS = 2_000_000
#: Hash slots whose rows are counted before those of single keys.
SLOTS = 16_384
#: Rows of one window task on average at most; above it there are more tasks than the session's shuffle partitions. Far below what
#: a task could hold: a few dozen MB are sorted in less than half the time per row that some hundred take.
TASK_ROWS = 250_000
#: Keys of larger groups that may be broadcast; beyond it they are joined by a shuffle.
BROADCAST_KEYS = 100_000


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key columns under other names, for the right side of a join."""
    return df.withColumnsRenamed({k: f"__k_{k}" for k in keys})


def _same(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])


def crowded_slots(df: DataFrame, keys: list[str], group_rows: int) -> tuple[int, list[int]]:
    """The number of rows, and the hash slots of keys that hold more than ``group_rows`` of them."""
    slots = df.groupBy(_slot(keys).alias("__slot")).agg(F.count("*").alias(_NUM))
    crowded = F.collect_list(F.when(F.col(_NUM) > group_rows, F.col("__slot")))
    total, found = slots.agg(F.coalesce(F.sum(_NUM), F.lit(0)), crowded).first()
    return total, found


def _slot(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(SLOTS))


def by_group_size(
    df: DataFrame, keys: list[str], group_rows: int, counted: DataFrame | None = None, *, dealt: bool = False
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of groups of at most ``group_rows`` rows, and those of larger groups (None without any).

    ``counted`` has as many rows of each key as ``df``, and is cheaper to run; only the work depends on it. With ``dealt`` the first
    rows are dealt to tasks by the keys, whatever their number.
    """
    spark = df.sparkSession
    counted = df if counted is None else counted
    total, slots = crowded_slots(counted, keys, group_rows)
    tasks = -(-total // TASK_ROWS)
    more = tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))

    def in_tasks(rows: DataFrame) -> DataFrame:
        return rows.repartition(tasks, *keys) if more else rows.repartition(*keys) if dealt else rows

    if not slots:
        return in_tasks(df), None
    path = work_dir(spark, "large-groups")
    counted = counted.filter(_slot(keys).isin(slots))
    large = _renamed(counted.groupBy(*keys).agg(F.count("*").alias(_NUM)).filter(F.col(_NUM) > group_rows).select(*keys), keys)
    large.write.parquet(path)
    stored = spark.read.schema(large.schema).parquet(path)
    number = stored.count()
    if not number:
        remove(spark, path)
        return in_tasks(df), None
    large = F.broadcast(stored) if number <= BROADCAST_KEYS else stored
    return in_tasks(df.join(large, _same(keys), "left_anti")), df.join(large, _same(keys), "left_semi")


def stored_in_ranges(df: DataFrame, keys: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """The rows in ranges of (keys, order), stored; ``PART`` numbers the ranges.

    ``partitions`` is left to the session (and to adaptive coalescing), unless given. Only the job's result depends on where
    the ranges lie: nothing does.
    """
    spark, by = df.sparkSession, [F.col(c) for c in (*keys, *order)]
    once, path = work_dir(spark, "rows"), work_dir(spark, "ranges")
    df.write.parquet(once)  # finding the ranges reads the rows a second time
    rows = spark.read.schema(df.schema).parquet(once)
    ranged = rows.repartitionByRange(*by) if partitions is None else rows.repartitionByRange(partitions, *by)
    ranged.withColumn(PART, F.spark_partition_id()).write.parquet(path)
    remove(spark, once)
    return spark.read.schema(df.withColumn(PART, F.lit(0)).schema).parquet(path)


def cut_groups(ranged: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the groups that lie in several ranges: fewer than ranges, so safe to broadcast."""
    return ranged.groupBy(*keys).agg(F.min(PART).alias("first"), F.max(PART).alias("last")).filter("first < last").select(*keys, F.lit(True).alias("__cut"))


def with_part(df: DataFrame, keys: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """Stored rows with the part of their group; NULL for groups in one piece."""
    ranged = stored_in_ranges(df, keys, order, partitions)
    cut = F.broadcast(_renamed(cut_groups(ranged, keys), keys))
    rows = ranged.join(cut, _same(keys), "left")
    return rows.select(*df.columns, F.when(F.col("__cut"), F.col(PART)).alias(PART))


def _border_copies(parts: DataFrame, keys: list[str], order: list[str], before: int, after: int) -> DataFrame:
    """Rows that a neighbouring part's frame reaches, tagged with that part.

    Only border rows of cut groups take part, at most parts x (before + after). The row_number filters
    run before the shuffle as well (WindowGroupLimit), so a part never travels for its border.
    """
    cut = parts.filter(F.col(PART).isNotNull())
    copies = []
    for reach, ahead in ((before, False), (after, True)):
        if not reach:
            continue
        inward = [F.asc(c) if ahead else F.desc(c) for c in order]
        border = cut.withColumn(
            _NUM, F.row_number().over(W.partitionBy(*keys, PART).orderBy(*inward))
        ).filter(F.col(_NUM) <= reach)
        # Number the border rows of a group so that a part's own rows come right after the rows it needs.
        outward = [F.desc(c) if ahead else F.asc(c) for c in order]
        border = border.withColumn(_NUM, F.row_number().over(W.partitionBy(*keys).orderBy(*outward)))
        first = F.col("first")
        needs = (
            border.groupBy(*keys, PART)
            .agg(F.min(_NUM).alias("first"))
            .select(*keys, F.col(PART).alias("__to"), F.explode(F.sequence(first - reach, first - 1)).alias("__need"))
            .filter("__need > 0")
        )
        found = border.join(_renamed(needs, keys), _same(keys) & (F.col(_NUM) == F.col("__need")))
        copies.append(found.withColumn(PART, F.col("__to")).select(*parts.columns))
    return reduce(DataFrame.unionByName, copies)


def over_parts(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: dict[str, Callable[[WindowSpec], Column]],
    *,
    before: int = 0,
    after: int = 0,
    partitions: int | None = None,
    group_rows: int = GROUP_ROWS,
    counted: DataFrame | None = None,
    together: list[str] | None = None,
) -> DataFrame:
    """Add window ``columns`` whose frames reach at most ``before`` rows back and ``after`` rows ahead.

    ``columns`` maps a name to a function of the window specification; later ones may use earlier ones. ``counted``: see ``by_group_size``.
    ``together``: some of the keys, by which rows are dealt to tasks and counted. Rows that lie near each other stay so, which the sort
    is faster on, and a later grouping by these keys needs no shuffle.
    """

    def added(rows: DataFrame, *part: str) -> DataFrame:
        window = W.partitionBy(*keys, *part).orderBy(*order)
        return reduce(lambda out, name: out.withColumn(name, columns[name](window)), columns, rows)

    def over_ranges(large: DataFrame) -> DataFrame:
        parts = with_part(large, keys, order, partitions)
        copies = _border_copies(parts, keys, order, before, after)
        rows = parts.withColumn(_COPY, F.lit(False)).unionByName(copies.withColumn(_COPY, F.lit(True)))
        return added(rows, PART).filter(~F.col(_COPY)).drop(PART, _COPY)

    if partitions is not None:
        return over_ranges(df)
    small, large = by_group_size(df, together or keys, group_rows, counted, dealt=together is not None)
    return added(small) if large is None else added(small).unionByName(over_ranges(large))


def rows_since(
    df: DataFrame, keys: list[str], order: list[str], event: str, name: str, *, partitions: int | None = None, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Add the number of rows since the last earlier row of the group where ``event`` is true.

    1 right after such a row, NULL before the first one. The frame is unbounded, so a cut group carries
    two numbers per part forward (rows so far, last position) instead of copied rows.
    """
    mark = F.when(F.col(event), F.col(_NUM))

    def numbered(rows: DataFrame, *part: str) -> DataFrame:
        window = W.partitionBy(*keys, *part).orderBy(*order)
        return rows.withColumn(_NUM, F.row_number().over(window).cast("bigint")).withColumn(
            "__last", F.max(mark).over(window.rowsBetween(W.unboundedPreceding, -1))
        )

    def over_ranges(large: DataFrame) -> DataFrame:
        rows = numbered(with_part(large, keys, order, partitions), PART)
        # One row per part of a cut group: fewer than twice the ranges.
        earlier = W.partitionBy(*keys).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
        totals = (
            rows.filter(F.col(PART).isNotNull())
            .groupBy(*keys, PART)
            .agg(F.count("*").alias("rows"), F.max(mark).alias("last"))
            .withColumn("start", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
            .withColumn("carried", F.max(F.col("start") + F.col("last")).over(earlier))
            .select(*keys, F.col(PART).alias("__to"), "start", "carried")
        )
        match = _same(keys) & (F.col(PART) == F.col("__to"))
        since = F.coalesce(F.col(_NUM) - F.col("__last"), F.col("start") + F.col(_NUM) - F.col("carried"))
        return rows.join(F.broadcast(_renamed(totals, keys)), match, "left").withColumn(name, since).select(*df.columns, name)

    if partitions is not None:
        return over_ranges(df)
    small, large = by_group_size(df, keys, group_rows)
    found = numbered(small).withColumn(name, F.col(_NUM) - F.col("__last")).select(*df.columns, name)
    return found if large is None else found.unionByName(over_ranges(large))


def numbered_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the place of each row (from 1) in the order of the whole table, without a single-task sort."""
    path = work_dir(df.sparkSession, "numbered")
    df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()).write.parquet(path)
    ranged = df.sparkSession.read.schema(df.withColumn(PART, F.lit(0)).schema).parquet(path)
    # One row per range meets in one task.
    lower = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    starts = ranged.groupBy(PART).agg(F.count("*").alias("rows")).select(F.col(PART).alias("__to"), F.coalesce(F.sum("rows").over(lower), F.lit(0)).alias("start"))
    inside = F.row_number().over(W.partitionBy(PART).orderBy(*order))
    rows = ranged.withColumn(_NUM, inside).join(F.broadcast(starts), F.col(PART) == F.col("__to"))
    return rows.withColumn(name, F.col(_NUM) + F.col("start")).select(*df.columns, name)
