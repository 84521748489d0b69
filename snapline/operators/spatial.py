"""Distances between players of one frame.

Neither measure pairs everyone with everyone: players on the same spot are folded, and players are
paired only inside neighbouring grid cells (or inside frames checked to be small).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapline.functions.tracking import gap, is_defender, is_receiver
from snapline.schemas import PLAY_KEY
from snapline.session import ensure_checkpoint_dir

FRAME_KEY = [*PLAY_KEY, "frame_id"]
PAIRS_PER_FRAME = 4096
COARSEST_CELL = 256.0
FIELD_AREA = 53.3 * 120


def _cell(size: float) -> list[Column]:
    return [F.floor(F.col(c) / size).alias(name) for c, name in (("x_coord", "cx"), ("y_coord", "cy"))]


def _around() -> Column:
    """The 3 x 3 cells around (cx, cy)."""
    step = [-1, 0, 1]
    return F.explode(F.array(*[F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")) for i in step for j in step]))


def _spots(frames: DataFrame, prefix: str) -> DataFrame:
    """Distinct positions per frame with their number of rows; folds copies on the map side."""
    return frames.groupBy(*FRAME_KEY, "x_coord", "y_coord").agg(F.count("*").alias(f"{prefix}_n"))


def _first_cell(players: int) -> float:
    """Cell width, a power of two, at which so many players spread over the field meet one per cell."""
    return min(1.0, 2.0 ** math.floor(math.log2(math.sqrt(FIELD_AREA / max(players, 1)))))


def _nearest_by_grid(receivers: DataFrame, defenders: DataFrame, size: float) -> DataFrame:
    """Exact nearest defender for frames with many positions.

    Cells start at ``size``, chosen by the largest crowd, and double in size from pass to pass. Whatever lies within one cell width is in the 3 x 3 cells
    around a receiver, so a distance of at most the width is final; the others go on to wider cells.
    Crowded frames are settled by the small cells, where few players are neighbours. Receivers without a defender
    within ``COARSEST_CELL`` (bad coordinates, or no defenders) meet all defenders of their frame in a last pass. Both
    sides of a pass are checkpointed, since the next pass reads them again.
    """
    spot = [*FRAME_KEY, "x_coord", "y_coord"]
    done: list[DataFrame] = []
    open_ = receivers
    while True:
        last = size > COARSEST_CELL
        cells = defenders.select(*FRAME_KEY, F.col("x_coord").alias("dx"), F.col("y_coord").alias("dy"), *_cell_of("dx", "dy", size))
        if last:
            near = open_.join(cells, FRAME_KEY, "left")
        else:
            around = open_.select("*", *_cell(size)).withColumn("cell", _around()).drop("cx", "cy").select("*", "cell.*")
            near = around.join(cells, [*FRAME_KEY, "cx", "cy"], "left")
        best = (
            near.groupBy(*spot, "receiver_n")
            .agg(F.min(gap(F.col("x_coord"), F.col("y_coord"), F.col("dx"), F.col("dy"))).alias("nearest"))
            .checkpoint()
        )
        settled = best.filter(F.col("nearest") <= size) if not last else best
        done.append(settled.select(*spot, "receiver_n", "nearest"))
        if last:
            break
        open_ = best.filter(F.col("nearest").isNull() | (F.col("nearest") > size)).drop("nearest")
        if open_.isEmpty():
            break
        size *= 2
    return reduce(DataFrame.unionByName, done)


def _cell_of(x: str, y: str, size: float) -> list[Column]:
    return [F.floor(F.col(x) / size).alias("cx"), F.floor(F.col(y) / size).alias("cy")]


def nearest_defender(tracking: DataFrame, event: str = "pass_arrived", pairs_per_frame: int = PAIRS_PER_FRAME) -> DataFrame:
    """Distance of each receiver position to the nearest defender of its frame (NULL without defenders)."""
    at = tracking.filter(F.col("event") == event)
    receivers = _spots(at.filter(is_receiver()), "receiver")
    defenders = _spots(at.filter(is_defender()), "defender")
    sizes = at.groupBy(*FRAME_KEY).agg(
        F.count_if(is_receiver()).alias("receivers"), F.count_if(is_defender()).alias("defenders")
    )
    crowded = sizes.filter(F.col("receivers") * F.col("defenders") > pairs_per_frame)
    largest = crowded.agg(F.max(F.col("receivers") + F.col("defenders")).alias("n")).first()["n"]
    has_crowded = largest is not None
    crowded = crowded.select(*FRAME_KEY)

    def small(df: DataFrame) -> DataFrame:
        return df.join(crowded, FRAME_KEY, "left_anti") if has_crowded else df

    spots = small(defenders).select(*FRAME_KEY, F.col("x_coord").alias("dx"), F.col("y_coord").alias("dy"))
    found = (
        small(receivers)
        .join(spots, FRAME_KEY, "left")
        .groupBy(*FRAME_KEY, "x_coord", "y_coord", "receiver_n")
        .agg(F.min(gap(F.col("x_coord"), F.col("y_coord"), F.col("dx"), F.col("dy"))).alias("nearest"))
    )
    if not has_crowded:
        return found
    ensure_checkpoint_dir(tracking.sparkSession)
    crowded = crowded.checkpoint()
    large = [df.join(crowded, FRAME_KEY, "left_semi").checkpoint() for df in (receivers, defenders)]
    return found.unionByName(_nearest_by_grid(*large, _first_cell(largest)))


def separation_nearest(tracking: DataFrame, event: str = "pass_arrived", pairs_per_frame: int = PAIRS_PER_FRAME) -> DataFrame:
    """Mean over receivers of the distance to the nearest defender when the pass arrives."""
    nearest = nearest_defender(tracking, event, pairs_per_frame)
    total = F.sum(F.col("nearest") * F.col("receiver_n"))
    number = F.sum(F.when(F.col("nearest").isNotNull(), F.col("receiver_n")))
    return nearest.groupBy(*PLAY_KEY).agg(F.try_divide(total, number).alias("separation_at_catch"))


def pressure_radius(tracking: DataFrame, event: str = "pass", radius: float = 2.0) -> DataFrame:
    """Share of defenders within ``radius`` yards of the quarterback at the pass.

    Defenders on one spot are folded. Each spot meets only quarterback positions of the neighbouring cells and learns whether one
    is near, in an existence join: no pair comes out, and defenders are read once for both numbers.
    """
    at = tracking.filter(F.col("event") == event)
    defenders = _spots(at.filter(is_defender()), "defender").select("*", *_cell(radius))
    qbs = (
        _spots(at.filter(F.col("position") == "QB"), "qb")
        .select(*FRAME_KEY, F.col("x_coord").alias("qx"), F.col("y_coord").alias("qy"), *_cell(radius))
        .withColumn("cell", _around())
        .select(
            *[F.col(k).alias(f"qb_{k}") for k in FRAME_KEY], "qx", "qy", F.col("cell.cx").alias("qcx"), F.col("cell.cy").alias("qcy")
        )
    )
    # Names of their own: a plain name may also stand for a column that the inner side has dropped.
    defenders = defenders.withColumnsRenamed({c: f"own_{c}" for c in (*FRAME_KEY, "cx", "cy", "x_coord", "y_coord")})
    own = {c: F.col(f"own_{c}").outer() for c in (*FRAME_KEY, "cx", "cy", "x_coord", "y_coord")}
    same = [own[k] == F.col(f"qb_{k}") for k in FRAME_KEY] + [own["cx"] == F.col("qcx"), own["cy"] == F.col("qcy")]
    close = gap(own["x_coord"], own["y_coord"], F.col("qx"), F.col("qy")) <= radius
    near = qbs.where(reduce(lambda a, b: a & b, same) & close).exists()
    pressed, every = F.col("defenders_near_qb"), F.col("defenders")
    return (
        defenders.select(*[F.col(f"own_{k}").alias(k) for k in PLAY_KEY], "defender_n", near.alias("near"))
        .groupBy(*PLAY_KEY)
        .agg(F.sum(F.when(F.col("near"), F.col("defender_n")).otherwise(0)).alias("defenders_near_qb"), F.sum("defender_n").alias("defenders"))
        .select(*PLAY_KEY, pressed, every, (pressed / every).alias("qb_pressure_rate"))
    )
