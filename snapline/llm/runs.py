"""Periodic runs: stretches of words that repeat with a smallest period, found by seeds on diagonals.

A run of period q has max(LEAST, REPEATS * q) words or more, so at lag q it matches itself over at least that many words less q.
Lags are searched in octaves: in the octave from ``low`` to ``2 * low - 1`` every run holds grams of 3 * low words (5 at lag 1) that
occur again one lag later.

1. Grams are numbered by doubling: a gram's number is that of the pair of shorter grams it is made of. Grams that occur once in
   the text are left out at each step, so texts without repetition are done after the first.
2. A seed is an occurrence of a gram with its next one, at a lag of the octave. A gram is at least as long as the octave's lags, so within
   a run the next occurrence is exactly one smallest period away: seeds grow with the text, not with the pairs of occurrences.
3. Each seed is extended along its diagonal, word by word, to both sides. A table holds how far each lag has been covered; a seed below
   that is skipped.

Defined results: a missing or empty text has no words, no run and an empty collapsed text; repeated rows give equal results; a
document without an id is not altered by ``planted``; no rows, no result. Texts are read whole. Columns may have any name;
only ``text`` (and ``doc_id`` in ``planted``) are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.llm.common import bound, table, words

LEAST = 6
REPEATS = 4
#: Words whose numbers a task remembers from text to text.
REMEMBERED = 1_000_000
#: Bytes of collapsed texts gathered before they are handed on.
HANDED_ON = 1 << 23

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class WordNumbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def repeated_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of the pairs (a[i], b[i]); -1 where a part is -1 or the pair occurs once. ``b`` may be shorter."""
    out = np.full(len(b), -1, np.int64)
    both = np.flatnonzero((a[: len(b)] >= 0) & (b >= 0))
    if len(both):
        second = b[both]
        _, number, count = np.unique(a[both] * (second.max() + 1) + second, return_inverse=True, return_counts=True)
        out[both] = np.where(count[number] > 1, number, -1)
    return out


def octaves(w: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(least lag, length of grams, number of the gram at each place) for each octave in which a run can lie."""
    two = repeated_pairs(w, w[1:])
    four = repeated_pairs(two, two[2:])
    if (four >= 0).any():
        yield 1, LEAST - 1, repeated_pairs(four, w[4:])
    low, size, grams = 2, 6, repeated_pairs(four, two[4:])
    while REPEATS * low <= len(w) and (grams >= 0).any():
        yield low, size, grams
        grams = repeated_pairs(grams, grams[size:])
        low, size = 2 * low, 2 * size


def seeds(grams: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of occurrences whose next one is ``low`` to ``2 * low - 1`` words away, in this order.

    Of places that follow one another at the same lag the first is enough.
    """
    at = np.flatnonzero(grams >= 0)
    at = at[np.argsort(grams[at], kind="stable")]
    lag = np.diff(at)
    near = (grams[at[1:]] == grams[at[:-1]]) & (lag >= low) & (lag < 2 * low)
    place, lag = at[:-1][near], lag[near]
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    first = np.ones(len(place), bool)
    first[1:] = (np.diff(place) != 1) | (np.diff(lag) != 0)
    return lag[first], place[first]


def matched(w: np.ndarray, place: int, lag: int, size: int) -> tuple[int, int]:
    """The stretch around ``place`` .. ``place + size`` (which matches) whose words equal those one lag later, in growing steps."""
    end, step = place + size, 64
    while end + lag < len(w):
        most = min(step, len(w) - lag - end)
        other = np.flatnonzero(w[end : end + most] != w[end + lag : end + lag + most])
        if len(other):
            end += int(other[0])
            break
        end, step = end + most, 2 * step
    start, step = place, 64
    while start > 0:
        most = min(step, start)
        other = np.flatnonzero(w[start - most : start] != w[start - most + lag : start + lag])
        if len(other):
            start += int(other[-1]) + 1 - most
            break
        start, step = start - most, 2 * step
    return start, end


def runs_of(w: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in numbered words, by start, then period."""
    found, covered = [], {}
    for low, size, grams in octaves(w):
        for lag, place in zip(*[x.tolist() for x in seeds(grams, low)]):
            if place < covered.get(lag, 0):
                continue
            start, end = matched(w, place, lag, size)
            covered[lag] = end
            if end - start + lag >= max(LEAST, REPEATS * lag):
                found.append((start, end - start + lag, lag))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(text: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The text with one period left of each run."""
    if not runs:
        return b" ".join(text)
    keep = np.ones(len(text), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([text[i] for i in np.flatnonzero(keep)])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc`` (the columns of ``docs`` without ``text``), n_words, runs (start, length, period) and collapsed text of each row."""
    own = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[docs[c] for c in own]).alias("doc"), docs["text"].cast("binary").alias("text"))
    schema = rows.select("doc", F.lit(0).cast("long").alias("n_words"), F.array().cast(RUNS).alias("runs"), F.lit(b"").alias("collapsed")).schema

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = WordNumbers()
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        for batch in batches:
            first, counts, runs, texts, held = 0, [], [], [], 0
            for i, text in enumerate(batch.column(1)):
                if len(numbers) > REMEMBERED:
                    numbers.clear()
                # bytes.split() parts at exactly the six ASCII blanks.
                w = (text.as_py() or b"").split()
                found = runs_of(np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)))
                counts.append(len(w))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                texts.append(collapsed(w, found))
                held += len(texts[-1])
                if held > HANDED_ON or i + 1 == batch.num_rows:
                    parts = [batch.column(0).slice(first, i + 1 - first), pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.binary())]
                    yield pa.RecordBatch.from_arrays(parts, ["doc", "n_words", "runs", "collapsed"])
                    first, counts, runs, texts, held = i + 1, [], [], [], 0

    return rows.mapInArrow(read, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` with a period written into the texts of one id in ten, from a place and with a length that the id's checksum gives."""
    h = F.crc32(docs["doc_id"].cast("string").cast("binary"))
    g = F.floor(h / 10)

    def altered(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return bound(
            F.struct(a.cast("int").alias("a"), p.cast("int").alias("p")),
            lambda v: F.array_join(F.transform(w, lambda x, i: F.when(i < v["a"], x).otherwise(F.get(w, v["a"] + (i - v["a"]) % v["p"]))), " "),
        )

    text = F.when((h % 10 == 0) & docs["text"].rlike(r"[^\x20\x09-\x0D]"), bound(words(docs["text"]), altered)).otherwise(docs["text"])
    return docs.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(planted(table(spark, sf_dir, "documents").select("doc_id", "text")))
    # Equal quotients are equal doubles, and different ones differ for all lengths that a text can have.
    best = F.array_max(F.transform("runs", lambda r: F.struct((r["length"] / r["period"]).alias("e"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r["length"].alias("l"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = rows.withColumn("best", best)
    return rows.select(
        "doc.doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"), F.col("best.l").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.l div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
