"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

Learning uses labelled documents that are not held out, at most about SAMPLE of them, drawn by hash of doc_id. A lexicon of words
and word beginnings that mark toxic texts is learned from them. The trees see lexicon features that come from the half of the
sample a document is not in, so that they learn what the lexicon is worth on new texts; the isotonic step is fitted on a
quarter of the sample that the trees did not see.

Features per text: densities and counts of strong and weak lexicon hits, hits near a second-person word, hits after undoing
disguises, and the rates of second-person words, capitals, shouted words, punctuation and disguised words.

Defined results: a missing text counts as empty and is scored like one; without usable labels of both kinds every score is the
share of label 1 (0 without labels); a document with several labels is toxic if one says so; repeated rows get equal scores; no
rows, no result. Texts are read whole. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.llm.common import held_out, stored, table

#: Labelled documents that are learned from, about.
SAMPLE = 16_000
#: Entries of the lexicon at most, those with the strongest evidence.
LEXICON = 4_000
TREES, DEPTH, SEED = 30, 4, 20_260
#: Least evidence (log-likelihood ratio) of a strong and of a weak entry.
STRONG, WEAK = 30.0, 10.0
NEAR = 3
REMEMBERED = 300_000

# Second-person words of the four languages; fixed values.
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine deinen euch euer ihr sie usted ustedes ti tuyo su vosotros".split())
# Signs that stand for letters in disguised words; fixed values.
DISGUISES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, "_": None, "-": None, ".": None})
EDGES = ".,;:!?\"'()[]{}<>|*#$%&-_"
INNER = re.compile(r"\w[^\w\s'’-]+\w|[^\W\d_]\d|\d[^\W\d_]")
CAPITALS, MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!?"
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FEATURES = 14


def entries_of(word: str) -> list[str]:
    """A word's lexicon entries: itself and its beginnings."""
    return [word] + [f"{word[:n]}~" for n in (4, 5) if len(word) > n]


def entry_counts(rows: DataFrame) -> DataFrame:
    """(entry, n00, n01, n10, n11): documents with the entry by half and label. ``rows``: (text, label, half)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, label, half in zip(*[c.to_pylist() for c in batch.columns]):
                for entry in {e for w in set((text or "").lower().split()) for e in entries_of(w.strip(EDGES))}:
                    counts.setdefault(entry, [0, 0, 0, 0])[2 * half + label] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *[pa.array([c[i] for c in counts.values()], pa.int64()) for i in range(4)]], ["entry", "n00", "n01", "n10", "n11"])

    counted = rows.select("text", "label", "half").mapInArrow(count, "entry string, n00 long, n01 long, n10 long, n11 long")
    return counted.groupBy("entry").agg(*[F.sum(c).alias(c) for c in ("n00", "n01", "n10", "n11")]).filter("n01 + n11 >= 2 AND entry <> ''")


def lexicon(counts: list[tuple[str, int, int]], clean: int, toxic: int, size: int = LEXICON) -> dict[str, float]:
    """entry -> evidence, of (entry, documents without, documents with label 1) that speak for label 1."""
    out = {}
    for entry, a, b in counts:
        if b >= 2 and b / toxic > 3 * a / max(clean, 1):
            rate = (a + b) / (clean + toxic)
            evidence = 2 * (b * math.log(b / (toxic * rate)) + (a * math.log(a / (clean * rate)) if a else 0.0))
            if evidence >= WEAK:
                out[entry] = evidence
    return dict(sorted(out.items(), key=lambda x: (-x[1], x[0]))[:size])


class Words(dict):
    """Word -> (evidence, number of its entry, second person, shouted, disguised, evidence after undoing a disguise)."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon, self.numbers = lexicon, {e: i for i, e in enumerate(lexicon)}

    def best(self, word: str) -> tuple[float, int]:
        found = [e for e in entries_of(word) if e in self.lexicon]
        entry = max(found, key=self.lexicon.__getitem__, default=None)
        return (0.0, -1) if entry is None else (self.lexicon[entry], self.numbers[entry])

    def __missing__(self, raw: str) -> tuple:
        if len(self) > REMEMBERED:
            self.clear()
        word = raw.strip(EDGES)
        low = word.lower()
        disguised = bool(INNER.search(word))
        evidence, number = self.best(low)
        undone = self.best(raw.lower().translate(DISGUISES).strip(EDGES))[0] if disguised or any(c in raw for c in "*@$") else 0.0
        value = self[raw] = (evidence, number, low in SECOND_PERSON, len(word) > 1 and word.isupper(), disguised, undone)
        return value

    def features(self, text: str | None) -> list[float]:
        text = text or ""
        words = text.split()
        n = max(1, len(words))
        raw = text.encode("utf-8", "surrogatepass")
        chars = max(1, len(raw))
        seen = [self[w] for w in words]
        strong = [i for i, s in enumerate(seen) if s[0] >= STRONG]
        weak = sum(1 for s in seen if 0 < s[0] < STRONG)
        undone = sum(1 for s in seen if s[5] >= STRONG and s[0] < STRONG)
        second = [i for i, s in enumerate(seen) if s[2]]
        people = set(second)
        near = sum(1 for i in strong if any(j in people for j in range(i - NEAR, i + NEAR + 1)))
        return [
            100 * len(strong) / n, float(min(len(strong), 50)), float(len({seen[i][1] for i in strong})),
            100 * weak / n, float(min(weak, 50)), max((s[0] for s in seen), default=0.0),
            float(near), 100 * len(second) / n, 100 * undone / n, 100 * sum(s[4] for s in seen) / n,
            100 * sum(s[3] for s in seen) / n, 100 * (len(raw) - len(raw.translate(None, CAPITALS))) / chars,
            100 * (len(raw) - len(raw.translate(None, PUNCTUATION))) / chars, math.log1p(len(words)),
        ]


def featured(rows: DataFrame, lexicons: list[dict[str, float]]) -> DataFrame:
    """``rows`` (doc_id, text, which) become doc_id, x: features by the lexicon numbered ``which``."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicons)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [Words(x) for x in shared.value]
        for batch in batches:
            x = [words[w].features(t.as_py()) for t, w in zip(batch.column(1), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    return rows.select(F.col("doc_id").cast("long"), "text", "which").mapInArrow(read, "doc_id long, x array<double>")


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text, label, half and part (0: for calibration, else for trees) of the sample."""
    marks = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("label"))
    marks = marks.filter(~held_out(F.col("_id")))
    rate = sample / max(1, marks.count())
    place = lambda name: F.xxhash64(F.lit(name), "_id").bitwiseAND((1 << 53) - 1) / float(1 << 53)
    marks = stored(marks.filter(place("sample") < rate), "toxic-labels")
    # At most about ``sample`` rows, by the line above.
    rows = docs.select("doc_id", "text").join(F.broadcast(marks), F.col("doc_id") == F.col("_id"))
    return rows.select("doc_id", "text", "label", (place("half") * 2).cast("int").alias("half"), (place("part") * 4).cast("int").alias("part"))


class Model:
    """Lexicon, trees and calibration; ``trees`` None: every score is ``share``."""

    def __init__(self, words: dict[str, float], trees, calibration, share: float):
        self.words, self.trees, self.calibration, self.share = words, trees, calibration, share


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = stored(training_rows(docs, labels, sample), "toxic-sample")
    sizes = {(r[0], r[1]): r[2] for r in rows.groupBy("half", "label").count().collect()}
    clean, toxic = [[sizes.get((h, y), 0) for h in (0, 1)] for y in (0, 1)]
    share = sum(toxic) / max(1, sum(clean) + sum(toxic))
    if not (min(toxic) and sum(clean)):
        return Model({}, None, None, share)
    # Entries in two toxic documents of the sample at least, so bounded by the sample.
    counts = [tuple(r) for r in entry_counts(rows).toLocalIterator()]
    halves = [lexicon([(c[0], c[1 + 2 * h], c[2 + 2 * h]) for c in counts], clean[h], toxic[h]) for h in (0, 1)]
    whole = lexicon([(c[0], c[1] + c[3], c[2] + c[4]) for c in counts], sum(clean), sum(toxic))
    x = featured(rows.withColumn("which", 1 - F.col("half")), halves)
    rows = x.join(rows.select("doc_id", "label", "part").distinct(), "doc_id")
    rows = stored(rows.select("doc_id", "part", F.col("label").cast("double").alias("label"), "x"), "toxic-features")
    rows = rows.withColumn("features", array_to_vector("x"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=SEED, minInstancesPerNode=2, maxMemoryInMB=64).fit(rows.filter("part <> 0"))
    judged = trees.transform(rows.filter("part = 0")).select("label", vector_to_array("probability")[1].alias("p"))
    calibration = None
    if judged.select("label").distinct().count() == 2:
        calibration = IsotonicRegression(featuresCol="p", labelCol="label").fit(judged)
    return Model(whole, trees, calibration, share)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each document."""
    if model.trees is None:
        return docs.select("doc_id", F.lit(model.share).alias("score"))
    rows = featured(docs.withColumn("which", F.lit(0)), [model.words]).withColumn("features", array_to_vector("x"))
    rows = model.trees.transform(rows).select("doc_id", vector_to_array("probability")[1].alias("p"))
    if model.calibration is None:
        return rows.withColumnRenamed("p", "score")
    # Among texts of one calibrated level the trees' own order is kept.
    level = model.calibration.setPredictionCol("level").transform(rows)
    return level.select("doc_id", F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.98 * F.col("level") + 0.02 * F.col("p"))).alias("score"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = score(docs, learn(docs, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
