"""Dense rank over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapline.operators.ordered import numbered_rows
from snapline.session import work_dir


def dense_ranks_desc(df: DataFrame, ranks: dict[str, str]) -> DataFrame:
    """Add the dense rank of each metric, largest first, NULL last. Values are compared exactly.

    ``ranks`` maps a metric to the name of its rank. ``df`` is computed once and stored. Equal values are folded first, so a
    value that many rows share costs one row; the distinct values are numbered range by range and joined back.
    """
    path = work_dir(df.sparkSession, "ranked")
    df.write.parquet(path)
    ranked = stored = df.sparkSession.read.schema(df.schema).parquet(path)
    for metric, name in ranks.items():
        value = f"__{metric}"
        # + 0.0 makes -0.0 and 0.0 one value, as comparisons have it.
        values = stored.select((F.col(metric) + 0.0).alias(value)).distinct()
        values = numbered_rows(values, [F.col(value).desc_nulls_last()], name)
        ranked = ranked.join(values, (F.col(metric) + 0.0).eqNullSafe(F.col(value)), "left").drop(value)
    return ranked
