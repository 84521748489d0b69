"""Quality rules: one table of thresholds compiled into one projection of built-in functions.

Defined results: a missing or empty text has no words and all counts 0; it fails the base rules. Texts are read whole at any
length; the state per row is a few times the text. Repeated rows give equal results; no rows, no result. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.llm.common import bound, table, words

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
# Function words of the four languages; fixed values.
STOP_WORDS = (
    "the of and to in is that it for was with on as be by this are at from or "
    "le la les de et des un une du que qui en est dans pour sur au avec ce il "
    "der die das und in zu den mit von ist nicht ein eine auf für im dem sich auch als "
    "el los las y del se por con no una su para es al lo como más o"
).split()

#: (measure, operator, limit): a text is kept if every row holds. Ratios of a text without words are 0.
RULES = (
    ("n_words", ">=", 20.0),
    ("n_words", "<=", 1_000_000.0),
    ("word_length", ">=", 2.0),
    ("word_length", "<=", 20.0),
    ("symbols_per_word", "<=", 0.3),
    ("marks_per_word", "<=", 0.5),
    ("capitals_per_char", "<=", 0.5),
    ("stop_word_share", ">=", 0.01),
    ("dup_line_share", "<=", 0.5),
    ("repeat_word_share", "<=", 0.3),
)


def window_hashes(w: Column) -> Column:
    """The hash of each ``WINDOW``-word window, from hashes of its halves, so that a word is hashed once."""

    def doubling(reach: int):
        return lambda h: F.zip_with(h, F.slice(h, F.lit(reach + 1), F.size(h)), lambda a, b: F.xxhash64(a, b))

    hashes = F.transform(w, lambda x: F.xxhash64(x))
    for reach in (1, 2, 4):  # window lengths that are joined with the ones right behind them
        hashes = bound(hashes, doubling(reach))
    return F.slice(hashes, F.lit(1), F.greatest(F.size(w) - WINDOW + 1, F.lit(0)))


def repeat_words(w: Column) -> Column:
    """Words inside ``WINDOW``-word windows that occur twice or more in the same array of words.

    Only where hashes repeat, windows are ordered by hash, so that equal ones are neighbours, and compared word by word.
    """

    def covered(windows: Column) -> Column:
        def twin(i: Column, other: Column) -> Column:
            a, b = windows[i], F.get(windows, other)
            return (a["h"] == b["h"]) & (F.slice(w, a["p"], WINDOW) == F.slice(w, b["p"], WINDOW))

        n = F.size(windows)
        places = F.filter(F.sequence(F.lit(0), n - 1), lambda i: ((i > 0) & twin(i, i - 1)) | ((i < n - 1) & twin(i, i + 1)))
        places = F.sort_array(F.transform(places, lambda i: windows[i]["p"]))
        start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
        step = lambda acc, p: F.struct((p + WINDOW).alias("upto"), (acc["n"] + p + WINDOW - F.greatest(p, acc["upto"])).alias("n"))
        return F.aggregate(places, start, step, lambda acc: acc["n"])

    def counted(hashes: Column) -> Column:
        windows = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("p")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bound(F.sort_array(windows), covered))

    return F.when(F.size(w) < WINDOW + 1, F.lit(0)).otherwise(bound(window_hashes(w), counted))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and all counts and ratios of the text, in one projection."""
    text = F.coalesce("text", F.lit(""))

    def counts(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            bound(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("lines"),
            repeat_words(w).cast("long").alias("n_repeat_words"),
            F.length(F.regexp_replace(text, "[^!?]+", "")).alias("marks"),
            F.length(F.regexp_replace(text, r"\P{Lu}+", "")).alias("capitals"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(*dict.fromkeys(STOP_WORDS)))).alias("stop_words"),
        )

    m = docs.select("doc_id", bound(words(F.col("text")), counts).alias("m"))
    per_word = lambda c: F.when(F.col("m.n_words") > 0, c / F.col("m.n_words")).otherwise(F.lit(0.0))
    return m.select(
        "doc_id", "m.n_words", "m.word_chars", "m.n_symbols",
        F.col("m.lines.dup").cast("long").alias("n_dup_lines"),
        "m.n_repeat_words",
        per_word(F.col("m.word_chars")).alias("word_length"),
        per_word(F.col("m.n_symbols")).alias("symbols_per_word"),
        per_word(F.col("m.marks")).alias("marks_per_word"),
        F.when(F.col("m.word_chars") > 0, F.col("m.capitals") / F.col("m.word_chars")).otherwise(F.lit(0.0)).alias("capitals_per_char"),
        per_word(F.col("m.stop_words")).alias("stop_word_share"),
        F.when(F.col("m.lines.n") > 0, F.col("m.lines.dup") / F.col("m.lines.n")).otherwise(F.lit(0.0)).alias("dup_line_share"),
        per_word(F.col("m.n_repeat_words")).alias("repeat_word_share"),
    )


def compiled(rules: tuple[tuple[str, str, float], ...]) -> Column:
    """One boolean column for a table of thresholds."""
    tests = {">=": lambda m, x: F.col(m) >= x, "<=": lambda m, x: F.col(m) <= x}
    return reduce(lambda a, b: a & b, [tests[op](m, x) for m, op, x in rules], F.lit(True))


def quality(docs: DataFrame, rules: tuple[tuple[str, str, float], ...] = RULES) -> DataFrame:
    """All measures, ``base_failed`` and ``kept`` of each document."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measures(docs).withColumn("base_failed", failed).withColumn("kept", ~failed & compiled(rules))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
