"""Near copies by MinHash: posting lists under signature coordinates, collision counts, exact confirmation.

A text's set holds the distinct windows of five words (A-Z lower-cased), as 64-bit fingerprints; a shorter text is one window.
Texts with the same words form a class, and one document stands for it, so exact copies are never compared.

1. Each class gets a signature of COORDINATES minima and is posted under each (coordinate, value).
2. Values held by one class alone cannot collide. A pair that is to collide MATCHES times must share one of the
   ``shared - MATCHES + 1`` rarest values of each of both, so only these lists are merged; the longer ones are skipped.
3. Merging a list gives pairs of its members with its hub, the member that shares most values with others: one pair per member, not
   all pairs of a group. A pair's collisions in the skipped lists are looked up in the signatures; it must have MATCHES
   in all, and is confirmed on the full sets.
4. Lists whose members are still in different components are merged in full: members of different components that collide MATCHES
   times are confirmed inside the join. Each set is told by the hub's set, so that the full intersection is counted without
   reading the sets again.

SIMILAR and MATCHES are what ``similar`` and ``matches`` are unless given. Two sets with similarity 0.85 collide in fewer than 15 of 32 coordinates with probability below 1e-7; that is the only
way to lose a link. No list, group or number of partners is capped.

Aggregates that are joined back are stored first: then both sides of the join have a shuffle of their own, and the adaptive plan can
split a hot value, window or component.

Defined results: a text without words, or a missing one, has an empty set and is linked with nothing; repeated rows
belong to one class; missing ids are ignored when the smallest id of a component is taken (all missing: none); no rows, no
result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.llm.common import stored, table
from snapline.llm.components import components

SHINGLE = 5
SIMILAR = 85  # percent of the union
COORDINATES = 32
MATCHES = 15
#: Words whose hashes a task remembers.
REMEMBERED = 1_000_000

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_random = np.random.default_rng(20_260)
FACTORS = _random.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 2**63, COORDINATES, dtype=np.uint64)
#: The upper 6 bits of a posted value are its coordinate.
PLACES = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(58)
STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def word_list(text: str | None) -> list[bytes]:
    """bytes.split() parts at exactly the six ASCII blanks."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def shingles(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Sorted distinct fingerprints of the five-word windows."""
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(h))
    x = h[: len(h) - size + 1].copy()
    for i in range(1, size):
        x *= STEP
        x += h[i : len(h) - size + 1 + i]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return np.unique(x)


def signature(x: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, np.uint64(2**64 - 1))
    for i in range(0, len(x), 4096):  # long texts in pieces
        least = np.minimum(least, (x[i : i + 4096, None] * FACTORS + SHIFTS).min(axis=0))
    return (least >> np.uint64(6)) | PLACES


def exact_text() -> Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, exact (digest of the text as it is), n (set size), cls (class, none for an empty set) and sig of each row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, classes, signatures = [], [], []
            for text in batch.column(1):
                words = word_list(text.as_py())
                x = shingles(words, hashes)
                sizes.append(len(x))
                classes.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                signatures.append(signature(x).view(np.int64) if words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(signatures, pa.list_(pa.int64()))],
                ["doc_id", "exact", "n", "cls", "sig"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text", exact_text().alias("exact")).mapInArrow(read, "doc_id long, exact binary, n long, cls binary, sig array<long>")


def class_sets(docs: DataFrame) -> DataFrame:
    """cls and set (fingerprints as bytes) of each row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            words = [word_list(t.as_py()) for t in batch.column(0)]
            sets = [shingles(w, hashes).tobytes() for w in words]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(b" ".join(w)) for w in words], pa.binary()), pa.array(sets, pa.binary())], ["cls", "set"])

    return docs.select("text").mapInArrow(read, "cls binary, set binary")


def prefix_posts(classes: DataFrame, matches: int) -> DataFrame:
    """(value, cls, n, shared) of the rarest values of each class that can collide ``matches`` times; ``shared`` counts all it shares."""
    posts = classes.select("cls", "n", F.explode("sig").alias("value"))
    lengths = stored(posts.groupBy("value").agg(F.count("*").alias("length")).filter("length > 1"), "neardup-lengths")
    held = posts.join(lengths.hint("merge"), "value").groupBy("cls").agg(F.any_value("n").alias("n"), F.sort_array(F.collect_list(F.struct("length", "value"))).alias("held"))
    shared = F.size("held")
    return held.filter(shared >= matches).select(F.explode(F.slice("held.value", 1, shared - matches + 1)).alias("value"), "cls", "n", shared.alias("shared"))


def posting_lists(classes: DataFrame, matches: int) -> DataFrame:
    """(value, cls, n, hub) of the merged lists, those with two members or more."""
    posts = stored(prefix_posts(classes, matches), "neardup-posts")
    hubs = posts.groupBy("value").agg(F.count("*").alias("length"), F.max(F.struct("shared", "cls")).alias("best"))
    hubs = stored(hubs.filter("length > 1").select("value", F.col("best.cls").alias("hub")), "neardup-hubs")
    return stored(posts.join(hubs.hint("merge"), "value").select("value", "cls", "n", "hub"), "neardup-lists")


def listed_sets(docs: DataFrame, classes: DataFrame, lists: DataFrame) -> DataFrame:
    """cls, n, sig and set of the classes in the lists."""
    chosen = classes.join(lists.select("cls").distinct().hint("merge"), "cls", "left_semi").select("cls", "n", "sig", "id")
    chosen = stored(chosen, "neardup-chosen")
    # The texts of the documents that stand for them; the join is the same at any size.
    ids = chosen.select(F.col("id").alias("_id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    sets = class_sets(texts).dropDuplicates(["cls"])
    return chosen.drop("id").join(sets.hint("merge"), "cls")


def collisions(a: str, b: str) -> Column:
    """In how many coordinates two signatures agree."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)


def overlaps(pairs: DataFrame, sets: DataFrame, similar: int, matches: int) -> DataFrame:
    """For each pair (a, b): ``linked``, and a's set told by b's: ``bits`` (which windows of b are in a) and ``rest`` (the others); a's ``sig``.

    A pair is linked if it collides ``matches`` times and is similar on the full sets.
    """
    left = sets.select(F.col("cls").alias("a"), F.col("sig").alias("sig_a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("cls").alias("b"), F.col("sig").alias("sig_b"), F.col("set").alias("set_b"))
    whole = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    whole = whole.select("a", "b", collisions("sig_a", "sig_b").alias("collisions"), "set_a", "set_b", "sig_a")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, bits, rest = [], [], []
            for count, x, y in zip(*[batch.column(i).to_pylist() for i in (2, 3, 4)]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                held = np.isin(y, x, assume_unique=True)
                both = int(held.sum())
                linked.append(count >= matches and 100 * both >= similar * (len(x) + len(y) - both))
                packed = np.packbits(held)
                bits.append(np.pad(packed, (0, -len(packed) % 8)).view(np.int64))
                rest.append(np.setdiff1d(x, y, assume_unique=True).view(np.int64))
            columns = [batch.column(0), batch.column(1), pa.array(linked, pa.bool_()), pa.array(bits, pa.list_(pa.int64())), pa.array(rest, pa.list_(pa.int64())), batch.column(5)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "linked", "bits", "rest", "sig"])

    return whole.mapInArrow(compare, "a binary, b binary, linked boolean, bits array<long>, rest array<long>, sig array<long>")


def open_links(lists: DataFrame, told: DataFrame, labels: DataFrame, similar: int, matches: int) -> DataFrame:
    """Links between members of a list that are in different components and collide ``matches`` times.

    Both sets are told by the list's hub, so their full intersection is counted inside the join, from the bits and the
    rests; only links come out of it.
    """
    named = lists.join(labels.hint("merge"), F.col("cls") == F.col("node"), "left").select("value", "cls", "n", "hub", F.coalesce("label", "cls").alias("label"))
    mixed = named.groupBy("value").agg(F.min("label").alias("first"), F.max("label").alias("last")).filter("first <> last")
    mixed = stored(mixed.select("value"), "neardup-open-lists")
    sets = told.select(F.col("a").alias("cls"), F.col("b").alias("hub"), "bits", "rest", "sig")
    live = named.join(mixed.hint("merge"), "value", "left_semi").join(sets.hint("merge"), ["cls", "hub"])
    live = stored(live.select("value", "cls", "n", "label", "bits", "rest", "sig"), "neardup-open")
    a, b = live.alias("a"), live.alias("b")
    fair = (F.col("a.value") == F.col("b.value")) & (F.col("a.cls") < F.col("b.cls")) & (F.col("a.label") != F.col("b.label"))
    fair = fair & (similar * F.greatest("a.n", "b.n") <= 100 * F.least("a.n", "b.n")) & (collisions("a.sig", "b.sig") >= matches)
    in_hub = F.aggregate(F.zip_with("a.bits", "b.bits", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda n, x: n + x)
    both = in_hub + F.size(F.array_intersect("a.rest", "b.rest"))
    fair = fair & (100 * both >= similar * (F.col("a.n") + F.col("b.n") - both))
    return a.join(b.hint("merge"), fair).select(F.col("a.cls").alias("a"), F.col("b.cls").alias("b")).distinct()


def class_components(docs: DataFrame, prints: DataFrame, similar: int = SIMILAR, matches: int = MATCHES) -> DataFrame:
    """(cls, component): the smallest class linked with each class that has a link."""
    classes = prints.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("id"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig"))
    classes = stored(classes, "neardup-classes")
    lists = posting_lists(classes, matches)
    sets = stored(listed_sets(docs, classes, lists), "neardup-sets")
    pairs = lists.select(F.col("cls").alias("a"), F.col("hub").alias("b")).distinct()
    told = stored(overlaps(pairs, sets, similar, matches), "neardup-told")
    links = stored(told.filter("linked AND a <> b").select("a", "b"), "neardup-first-links")
    labels = components(links, "neardup-first")
    more = stored(open_links(lists, told, labels, similar, matches), "neardup-more")
    if not more.isEmpty():
        labels = components(stored(links.union(more), "neardup-links"), "neardup-all")
    return labels.select(F.col("node").alias("cls"), F.col("label").alias("component"))


def component_rows(docs: DataFrame, similar: int, matches: int) -> DataFrame:
    """doc_id, exact, n, cls and component (a key, none for an empty set) of each row, stored."""
    prints = stored(fingerprints(docs), "neardup-prints")
    linked = stored(class_components(docs, prints, similar, matches), "neardup-components")
    rows = prints.select("doc_id", "exact", "n", "cls")
    rows = rows.join(linked.withColumnRenamed("cls", "_cls").hint("merge"), F.col("cls") == F.col("_cls"), "left")
    return stored(rows.select("doc_id", "exact", "n", "cls", F.coalesce("component", "cls").alias("component")), "neardup-rows")


def near_copies(docs: DataFrame, similar: int = SIMILAR, matches: int = MATCHES) -> DataFrame:
    """doc_id, n_shingles, component (a key, none for an empty set) and component_id of each row."""
    rows = component_rows(docs, similar, matches).select("doc_id", "n", "component")
    least = rows.filter("component IS NOT NULL").groupBy(F.col("component").alias("_component")).agg(F.min("doc_id").alias("least"))
    least = stored(least, "neardup-least")
    rows = rows.join(least.hint("merge"), F.col("component") == F.col("_component"), "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def distinct_documents(docs: DataFrame, similar: int = SIMILAR, matches: int = MATCHES) -> DataFrame:
    """One document of each component, that with the smallest id (missing ids last, then by class), with the columns it came with.

    Rows that repeat its id with the same text are copies too; only one of them is kept. The decision comes back by id and exact
    text, so other rows with a missing or repeated id are not touched by it. Rows with an empty set all stay.
    """
    alike = component_rows(docs, similar, matches).groupBy("component", "doc_id", "cls", "exact").agg((F.count("*") > 1).alias("again"))
    alike = stored(alike, "neardup-alike")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "cls", "exact", "again")).alias("best")
    chosen = alike.filter("component IS NOT NULL").groupBy("component").agg(best).select("best.doc_id", "best.exact", "best.again")
    kept = chosen.union(alike.filter("component IS NULL").select("doc_id", "exact", F.lit(False)))
    kept = stored(kept.toDF("_id", "_exact", "_again"), "neardup-kept")

    def held(ids: DataFrame) -> DataFrame:
        # Packed, so that columns of any name can come along.
        rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs["doc_id"].cast("long").alias("doc_id"), "text", exact_text().alias("_text"))
        return rows.join(ids.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_text").eqNullSafe(F.col("_exact")), "left_semi")

    # A second pass, and a shuffle of these texts, only if there are such rows.
    again = kept.filter("_again")
    rows = held(kept) if again.isEmpty() else held(kept.filter("NOT _again")).unionByName(held(again).dropDuplicates(["doc_id", "text"]))
    return rows.select("_row.*")


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_copies(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
