"""Ranked lexical search: for each item the documents with the highest weighted term scores.

Terms are runs of ASCII letters (A-Z lower-cased), digits and all characters beyond ASCII.

1. One pass over the texts keeps of each document its number of terms and the counts of the items' terms, as a short posting row.
2. Numbers of documents and terms, and document frequencies, come from these rows.
3. Tasks read posting rows in batches. For each item, a bitmap per term marks the documents that hold it; together they give each
   document's mask, and documents are grouped by mask. The most that a mask can score is the sum of its terms' greatest contributions
   in the batch. Masks are evaluated from the highest such sum down, until it lies below the lowest of the TOP scores that the task holds for the item.
4. Each task gives out TOP rows per item at most; they are ranked in one window per item.

Items are searched for in blocks, ITEMS_PER_PASS at once, each block in a pass of its own, so that what the tasks hold is bounded by
the block. A mask with more than 64 terms takes several words.

Defined results: a missing text, of a document or an item, has no terms; an item without a term that any document holds has no rows;
repeated items are searched for one by one and give equal rows; repeated documents are ranked one by one; equal scores are ordered by id, missing ids last; no rows, no
result. Only ``doc_id``, ``item_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapline.llm.common import running, stored, table
from snapline.llm.decontamination import word_list

TOP = 50
#: Weight of a document's length against that of the average, in percent.
LENGTH_SHARE = 50
ITEMS_PER_PASS = 2_000
#: Masks evaluated before the bound is looked at again.
MASKS_AT_ONCE = 64


def item_terms(items: DataFrame) -> DataFrame:
    """``number`` (from 1) and distinct ``terms`` of each item with its item_id, stored."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted({w.decode("utf-8", "surrogatepass") for w in word_list(t.as_py())}) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.string()))], ["item_id", "terms"])

    rows = stored(items.select("item_id", "text").mapInArrow(read, items.select("item_id", F.array().cast("array<string>").alias("terms")).schema), "search-terms")
    return stored(running(rows.withColumn("_one", F.lit(1)), ["item_id", "terms"], {"number": "_one"}, "search-order").drop("_one"), "search-items")


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms of the document), terms (numbers in ``vocabulary``) and counts of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column(1):
                w = word_list(text.as_py())
                seen = Counter(w)
                held = seen.keys() & known.keys()
                sizes.append(len(w))
                terms.append([known[t] for t in held])
                counts.append([seen[t] for t in held])
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, "doc_id long, n long, terms array<int>, counts array<long>")


class Batch:
    """Documents of one batch, inverted: for each term the documents that hold it and what it adds to their scores."""

    def __init__(self, sizes: np.ndarray, ends: np.ndarray, terms: np.ndarray, counts: np.ndarray, weights: np.ndarray, docs: int, total: int):
        self.size = len(sizes)
        place = 100 - LENGTH_SHARE + (LENGTH_SHARE * sizes * docs) // max(total, 1)
        held = np.diff(ends)
        doc = np.repeat(np.arange(self.size), held)
        adds = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * np.repeat(place, held)))
        order = np.argsort(terms, kind="stable")
        self.doc, self.adds, terms = doc[order], adds[order], terms[order]
        self.first = np.searchsorted(terms, np.arange(len(weights) + 1))

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        s = slice(self.first[term], self.first[term + 1])
        return self.doc[s], self.adds[s]

    def best(self, terms: list[int], top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (places in the batch) and scores that can be among the ``top``, all of them with at least ``floor``."""
        held = [(d, a) for d, a in map(self.of, terms) if len(d)]
        nothing = np.zeros(0, np.int64)
        if sum(int(a.max()) for _, a in held) < floor or not held:
            return nothing, nothing
        # Bitmaps, 64 terms to a word, one word per document; then one number for each distinct mask.
        masks = np.zeros((self.size, -(-len(held) // 64)), np.uint64)
        for t, (d, _) in enumerate(held):
            masks[d, t // 64] |= np.uint64(1 << (t % 64))
        live = np.flatnonzero(masks.any(axis=1))
        group = np.zeros(len(live), np.int64)
        for column in masks[live].T:
            word = np.unique(column, return_inverse=True)[1]
            group = np.unique(group * (word.max() + 1) + word, return_inverse=True)[1]
        order = np.argsort(group, kind="stable")
        starts = np.searchsorted(group[order], np.arange(group.max() + 2))
        distinct = masks[live[order[starts[:-1]]]]
        most = np.zeros(len(distinct), np.int64)
        for t, (_, a) in enumerate(held):
            most += np.where(distinct[:, t // 64] >> np.uint64(t % 64) & np.uint64(1), a.max(), 0)
        descending = np.argsort(-most, kind="stable")
        docs, scores = nothing, nothing
        for at in range(0, len(descending), MASKS_AT_ONCE):
            some = descending[at : at + MASKS_AT_ONCE]
            if most[some[0]] < max(floor, 1):
                break
            chosen = np.sort(live[np.concatenate([order[starts[g] : starts[g + 1]] for g in some])])
            docs, scores = np.concatenate([docs, chosen]), np.concatenate([scores, self.scores(chosen, held)])
            if len(scores) >= top:
                floor = max(floor, int(np.partition(scores, -top)[-top]))
        fair = scores >= max(floor, 1)
        return docs[fair], scores[fair]

    @staticmethod
    def scores(chosen: np.ndarray, held: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Exact scores of documents, given in order."""
        sums = np.zeros(len(chosen), np.int64)
        for docs, adds in held:
            at = np.minimum(np.searchsorted(docs, chosen), len(docs) - 1)
            sums += np.where(docs[at] == chosen, adds[at], 0)
        return sums


class TopRows:
    """The best rows of one item that a task has seen: scores with ids, missing ids last."""

    def __init__(self, top: int):
        self.top, self.floor = top, 1
        self.scores, self.ids, self.missing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        scores, ids, missing = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids]), np.concatenate([self.missing, missing])
        order = np.lexsort((ids, missing, -scores))[: self.top]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]
        if len(order) == self.top:
            self.floor = max(1, int(self.scores[-1]))


def candidates(posted: DataFrame, items: list[tuple[int, list[int]]], weights: list[int], docs: int, total: int, top: int) -> DataFrame:
    """number (of the item), doc_id and score: the best rows of each task for each item."""
    shared = posted.sparkSession.sparkContext.broadcast((items, np.array(weights, np.int64)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weight = shared.value
        best = {number: TopRows(top) for number, _ in wanted}
        for batch in batches:
            ids = batch.column(0)
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            terms, counts = batch.column(2), batch.column(3)
            ends = terms.offsets.to_numpy().astype(np.int64)
            held = Batch(batch.column(1).to_numpy(), ends, terms.flatten().to_numpy(), counts.flatten().to_numpy(), weight, docs, total)
            for number, own in wanted:
                found, scores = held.best(own, top, best[number].floor)
                if len(found):
                    best[number].add(scores, ids[found], missing[found])
        for number, rows in best.items():
            if len(rows.scores):
                columns = [pa.array(np.full(len(rows.scores), number)), pa.array(rows.ids, pa.int64(), mask=rows.missing), pa.array(rows.scores)]
                yield pa.RecordBatch.from_arrays(columns, ["number", "doc_id", "score"])

    return posted.select("doc_id", "n", "terms", "counts").mapInArrow(search, "number long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` documents of each item."""
    items = item_terms(items)
    last = items.agg(F.max("number")).first()[0] or 0
    ranked = None
    for first in range(1, max(last, 1) + 1, per_pass):
        block = items.filter(F.col("number").between(first, first + per_pass - 1))
        rows = [(r["number"], r["terms"]) for r in block.select("number", "terms").collect()]  # one block at a time
        vocabulary = {t.encode("utf-8", "surrogatepass"): i for i, t in enumerate(sorted({t for _, own in rows for t in own}))}
        posted = stored(postings(docs, vocabulary), "search-postings")
        n_docs, total = posted.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = {r[0]: r[1] for r in posted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}  # the block's terms
        weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(i, 0) + 1))) for i in range(len(vocabulary))]
        wanted = [(number, [vocabulary[t.encode("utf-8", "surrogatepass")] for t in own]) for number, own in rows]
        found = candidates(posted, wanted, weights, n_docs, total, top)
        order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        found = stored(found, "search-ranked")
        ranked = found if ranked is None else ranked.union(found)
    names = items.select(F.col("number").alias("_number"), "item_id")
    return ranked.join(names, F.col("number") == F.col("_number")).select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
