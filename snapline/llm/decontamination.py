"""Benchmark decontamination: Wu-Manber search of item windows over the words of each document.

Words are runs of ASCII letters (A-Z lower-cased), digits and all characters beyond ASCII. A window is ten consecutive words of
an item, or a whole shorter item.

Defined results: a missing or empty text has no words and no hits; an item without words or without text has no window; an
item without an id hits but is not listed; repeated items are listed once; no rows, no result. Texts are searched whole. Only
the columns named in ``find_hits`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.llm.common import stored, table

WINDOW = 10
BLOCK = 2
#: Windows held by a task at once; more are searched for in as many passes as it takes.
WINDOWS_PER_PASS = 200_000

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# UTF-8 bytes from 0x80 on belong to characters beyond ASCII, so words of bytes are words of characters.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def word_list(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode("utf-8", "surrogatepass").translate(LOWER)) if text else []


class WuManber:
    """Patterns of ``length`` words: shifts by the last block of words, buckets of patterns by their last block."""

    def __init__(self, length: int, patterns: list[tuple[tuple[bytes, ...], int]]):
        self.length, self.block = length, min(BLOCK, length)
        self.jump = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for pattern, number in patterns:
            for end in range(self.block, length + 1):
                key = self.key(pattern, end)
                self.shift[key] = min(self.shift.get(key, self.jump), length - end)
            self.buckets.setdefault(self.key(pattern, length), []).append((pattern[0], list(pattern), number))

    def key(self, words, end: int):
        return words[end - 1] if self.block == 1 else (words[end - 2], words[end - 1])

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(start, pattern number) of every occurrence."""
        end, n, length, jump, shift, one = self.length, len(words), self.length, self.jump, self.shift.get, self.block == 1
        while end <= n:
            key = words[end - 1] if one else (words[end - 2], words[end - 1])
            skip = shift(key, jump)
            if skip:
                end += skip
                continue
            first = words[end - length]
            for head, pattern, number in self.buckets[key]:
                if head == first and words[end - length : end] == pattern:
                    yield end - length, number
            end += 1


def windows_of(items: DataFrame) -> DataFrame:
    """Distinct (words, item_id as text) of all windows; words are joined by blanks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = word_list(text)
                size = min(WINDOW, len(w))
                found += [(b" ".join(w[i : i + size]), item) for i in range(len(w) - size + 1) if size]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())], ["words", "item"])

    return items.select(F.col("item_id").cast("string"), "text").mapInArrow(cut, "words binary, item string").distinct()


def search_tables(rows: list[tuple[bytes, list[str]]]) -> tuple[list[WuManber], list[list[str]]]:
    by_length: dict[int, list] = {}
    for number, (joined, _) in enumerate(rows):
        pattern = tuple(bytes(joined).split(b" "))
        by_length.setdefault(len(pattern), []).append((pattern, number))
    return [WuManber(k, p) for k, p in sorted(by_length.items())], [items for _, items in rows]


def find_hits(docs: DataFrame, items: DataFrame, per_pass: int = WINDOWS_PER_PASS) -> DataFrame:
    """``docs`` (any columns, with ``text``) with n_words, hits (word ranges start, end, start, end ...) and items (ids as text).

    The windows are counted first. As many as a task may hold are sent to the tasks; if there are more, further passes follow
    over the stored result of the one before.
    """
    windows = stored(windows_of(items), "benchmark-windows")
    grouped = windows.groupBy("words").agg(F.collect_set("item").alias("items"))
    passes = max(1, -(-grouped.count() // per_pass))
    own = docs.columns
    rows = docs.select(F.struct(*[docs[c] for c in own]).alias("doc"), docs["text"].alias("text"))
    rows = rows.select("doc", "text", F.lit(0).alias("n_words"), F.array().cast("array<int>").alias("hits"), F.array().cast("array<string>").alias("items"))
    for number in range(passes):
        chosen = grouped.filter(F.pmod(F.xxhash64("words"), F.lit(passes)) == number)
        tables = search_tables([(r[0], r[1]) for r in chosen.collect()])
        shared = docs.sparkSession.sparkContext.broadcast(tables)
        rows = rows.mapInArrow(_searcher(shared), rows.schema)
        if number + 1 < passes:
            rows = stored(rows, "decontamination-pass")
    return rows.drop("text").select("doc", "n_words", "hits", "items")


def _searcher(shared):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches, ids = shared.value
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            counts, hits, items = [], [], []
            for text, old_hits, old_items in zip(columns["text"], columns["hits"].to_pylist(), columns["items"].to_pylist()):
                w = word_list(text.as_py())
                counts.append(len(w))
                found = [(s, s + search.length, number) for search in searches for s, number in search.find(w)]
                if found:
                    ranges = sorted([f[:2] for f in found] + list(zip(old_hits[::2], old_hits[1::2])))
                    merged = [list(ranges[0])]
                    for s, e in ranges[1:]:
                        if s > merged[-1][1]:
                            merged.append([s, e])
                        else:
                            merged[-1][1] = max(merged[-1][1], e)
                    old_hits = [x for r in merged for x in r]
                    old_items = sorted(set(old_items).union(*[ids[f[2]] for f in found]))
                hits.append(old_hits)
                items.append(old_items)
            columns |= {"n_words": pa.array(counts, pa.int32()), "hits": pa.array(hits, pa.list_(pa.int32())), "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return search


def decontaminate(docs: DataFrame, items: DataFrame, per_pass: int = WINDOWS_PER_PASS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each document."""
    rows = find_hits(docs.select("doc_id", "text"), items, per_pass).select("doc.doc_id", "n_words", "hits", "items")
    hit = F.aggregate(F.sequence(F.lit(1), F.size("hits")), F.lit(0), lambda n, i: n + F.col("hits")[i - 1] * F.when(i % 2 == 0, 1).otherwise(-1))
    hit = F.when(F.size("hits") > 0, hit).otherwise(0).cast("long")
    return rows.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a hit, with the columns they came with."""
    return find_hits(docs, items).filter(F.size("hits") == 0).select("doc.*")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
