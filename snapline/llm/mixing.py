"""Mixing of sources to target weights by capped water-filling and seeded repetitions.

Defined results: a missing text has size 0; a missing source is a source of its own, last in order; a source
without words has target 0 and nothing is taken from it; repeated rows are told apart by count, so that the cut can fall between
them; missing ids are drawn by text; no rows, no result. Only the columns ``doc_id``, ``text`` and ``source`` are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from functools import reduce

from snapline.llm.common import running, small_side, stored, table, words

SEED = 20_260
CYCLE = (1, 2, 3)
MAX_EPOCHS = 3
#: Steps of the seeded order; the sum of a source is held per step, its rows are ordered in one step only.
STEPS = 1 << 14


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def draw_of(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """The seeded place of a document in its source's order, 0 to 2**62 - 1; rows with other texts have other places."""
    return F.xxhash64(F.lit(seed), doc_id, text).bitwiseAND((1 << 62) - 1)


def step_of(draw: Column) -> Column:
    return F.shiftrightunsigned(draw, 62 - 14).cast("int")


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """``sources`` with column ``weight``: the cycle, in the sources' order by code point, null last."""
    ranked = running(sources.withColumn("_one", F.lit(1)), ["source"], {"_rank": "_one"}, "mix-order")
    values = F.array(*[F.lit(float(w)) for w in cycle])
    return ranked.withColumn("weight", values[((F.col("_rank") - 1) % len(cycle)).cast("int")]).drop("_one", "_rank")


def water_level(sources: DataFrame, max_epochs: float = MAX_EPOCHS) -> float | None:
    """The words per unit of weight at which clamped and free sources sum to the words there are.

    Sources whose share exceeds ``max_epochs`` times their size are clamped there and the excess goes to the free ones
    by weight, again and again until none is above. Each round is one aggregate with two numbers for a result.
    """
    cap = max_epochs * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    if not total:
        return None
    clamped, level = F.lit(False), None
    while True:
        held, free = sources.agg(
            F.sum(F.when(clamped, cap).otherwise(F.lit(0.0))), F.sum(F.when(clamped, F.lit(0.0)).otherwise(F.col("weight")))
        ).first()
        if not free:
            return level
        rest = (float(total) - held) / free
        if level is not None and rest <= level:
            return level
        level = rest
        clamped = F.lit(level) * F.col("weight") > cap


KEY = ["source", "draw", "doc_id", "size"]


def _same_rows(right: str = "_") -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{right}{c}")) for c in KEY])


def source_plan(sizes: DataFrame, weights: DataFrame | None = None, max_epochs: int = MAX_EPOCHS) -> tuple[DataFrame, DataFrame]:
    """What to take of each source.

    ``sizes``: stored rows of (source, doc_id, size, draw). ``weights``: (source, weight), else the cycle. Returns one row per
    source: source_size, target, whole (repetitions of all), edge_step and edge (the documents repeated once more are those of
    earlier steps, and in the edge step those up to ``edge`` in order of draw); and at most two rows per source of equal documents of
    which only some are repeated: their KEY, ``take`` of them, ``of`` all.
    """
    sources = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    if weights is None:
        weighted = stored(cycled_weights(sources), "mix-weights")
    else:
        joined = sources.join(small_side(weights.select(F.col("source").alias("_source"), "weight")), F.col("source").eqNullSafe(F.col("_source")), "left")
        weighted = stored(joined.select("source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight")), "mix-weights")
    level = water_level(weighted, max_epochs)
    cap = (F.lit(float(max_epochs)) * F.col("source_size")).cast("double")
    share = F.lit(0.0 if level is None else level) * F.col("weight")
    aims = weighted.withColumn("target", F.least(share, cap))
    aims = aims.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    aims = stored(aims.withColumn("_rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")

    steps = sizes.groupBy("source", step_of(F.col("draw")).alias("step")).agg(F.sum("size").alias("_words"))
    up_to = Window.partitionBy("source").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("_upto", F.sum("_words").over(up_to)).withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    edges = aims.join(steps, same).filter((F.col("_upto") - F.col("_words") <= F.col("_rest")) & (F.col("_rest") < F.col("_upto")))
    edges = stored(edges.select("source", "step", (F.col("_upto") - F.col("_words")).alias("_before"), "_rest"), "mix-edges")

    # Only the rows of the edge step are put in order: one in STEPS of a source, however hot it is. Equal rows are folded first.
    near = sizes.withColumn("_step", step_of(F.col("draw"))).withColumnRenamed("source", "_source")
    near = near.join(small_side(edges), same & (F.col("_step") == F.col("step")))
    near = near.groupBy("source", "step", "_before", "_rest", "draw", "doc_id", "size").agg(F.count("*").alias("of"))
    order = Window.partitionBy("source").orderBy("draw", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("_upto", F.col("_before") + F.sum(F.col("size") * F.col("of")).over(order))
    row = F.struct("draw", "doc_id", "size")
    within, cut = F.col("_upto") <= F.col("_rest"), F.col("_upto") > F.col("_rest")
    left = F.col("_rest") - F.col("_upto") + F.col("size") * F.col("of")  # before the rows at the cut
    plan = near.groupBy(F.col("source").alias("_source"), F.col("step").alias("edge_step")).agg(
        F.max(F.when(within, row)).alias("edge"),
        F.min(F.when(cut, F.struct("draw", "doc_id", "size", "of", F.floor(left / F.col("size")).alias("take"), left.alias("left")))).alias("_cut"),
    )
    plan = stored(plan.withColumn("_left", F.col("_cut.left") - F.col("_cut.take") * F.col("_cut.size")), "mix-cuts")

    # What is left of a target is filled by one more document beyond the cut, the one whose size comes nearest.
    beyond = sizes.join(small_side(plan.select("_source", "edge_step", "edge", "_left")), same).filter(~_before_cut())
    miss = F.abs(F.col("size") - F.col("_left"))
    best = beyond.filter(miss < F.col("_left")).groupBy("_source").agg(F.min(F.struct(miss, row.alias("row"))).alias("_best"))
    chosen = plan.select(F.col("_source").alias("source"), "_cut.draw", "_cut.doc_id", "_cut.size", F.col("_cut.take").alias("take"))
    chosen = chosen.union(best.select("_source", "_best.row.draw", "_best.row.doc_id", "_best.row.size", F.lit(1)))
    chosen = stored(chosen.groupBy(*KEY).agg(F.sum("take").alias("take")).filter("take > 0"), "mix-chosen")
    renamed = chosen.withColumnsRenamed({c: f"_{c}" for c in KEY})
    counted = sizes.join(small_side(renamed), _same_rows()).groupBy(*[f"_{c}" for c in KEY], "take").agg(F.count("*").alias("of"))
    parts = stored(counted.withColumn("_group", F.monotonically_increasing_id()), "mix-parts")
    plan = aims.join(plan, F.col("source").eqNullSafe(F.col("_source")), "left")
    return stored(plan.select("source", "source_size", "target", "whole", "edge_step", "edge"), "mix-plan"), parts


def _before_cut() -> Column:
    """Whether a row of draw, doc_id and size lies before its source's cut (``edge_step`` and ``edge``)."""
    step = step_of(F.col("draw"))
    at_edge = F.coalesce(F.struct("draw", "doc_id", "size") <= F.col("edge"), F.lit(False))
    return F.coalesce((step < F.col("edge_step")) | ((step == F.col("edge_step")) & at_edge), F.lit(False))


def with_repetitions(docs: DataFrame, plan: DataFrame, parts: DataFrame) -> DataFrame:
    """``docs`` with a source, doc_id, size and draw gain source_size, target and ``reps``; no row is dropped.

    Equal documents of which only some are repeated once more are stored and numbered, in ranges of any size; all others are
    told by the plan alone.
    """
    joined = docs.join(small_side(plan.withColumnRenamed("source", "_plan")), F.col("source").eqNullSafe(F.col("_plan")), "left")
    joined = joined.join(small_side(parts), _same_rows(), "left")

    def result(rows: DataFrame, extra: Column) -> DataFrame:
        reps = F.when(F.col("source_size") > 0, F.col("whole") + extra.cast("int")).otherwise(0)
        return rows.select(*docs.columns, "source_size", "target", reps.alias("reps"))

    some = F.coalesce(F.col("take") < F.col("of"), F.lit(False))
    rows = result(joined.filter(~some), _before_cut() | F.col("take").isNotNull())
    if parts.filter("take < of").isEmpty():
        return rows
    numbered = stored(joined.filter(some).withColumn("_tie", F.monotonically_increasing_id()).withColumn("_one", F.lit(1)), "mix-ties")
    numbered = stored(running(numbered, ["_group", "_tie"], {"_nth": "_one"}, "mix-tie-order"), "mix-numbered")
    first = numbered.groupBy(F.col("_group").alias("_of_group")).agg(F.min("_nth").alias("_first"))
    numbered = numbered.join(small_side(stored(first, "mix-tie-starts")), F.col("_group") == F.col("_of_group"))
    return rows.unionByName(result(numbered, F.col("_nth") - F.col("_first") < F.col("take")))


def measured(docs: DataFrame, seed: int = SEED) -> DataFrame:
    return docs.withColumn("size", size_of(F.col("text"))).withColumn("draw", draw_of(F.col("doc_id"), F.col("text"), seed))


def mix(docs: DataFrame, weights: DataFrame | None = None, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken words of each document."""
    sizes = stored(measured(docs.select("doc_id", "text", "source"), seed).drop("text"), "mix-sizes")
    rows = with_repetitions(sizes, *source_plan(sizes, weights, max_epochs))
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.col("reps") * F.col("size")).alias("taken"))


def repeat_rows(docs: DataFrame, weights: DataFrame | None = None, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns it came with. Texts are not shuffled."""
    sizes = stored(measured(docs.select("doc_id", "text", "source"), seed).drop("text"), "mix-sizes")
    plan, parts = source_plan(sizes, weights, max_epochs)
    inner = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), "doc_id", "text", "source")
    rows = with_repetitions(measured(inner, seed).drop("text"), plan, parts).filter("reps > 0")
    return rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("reps"))).alias("_copy")).select("_row.*")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")
