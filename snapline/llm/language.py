"""Language identification by prediction by partial matching over bytes.

Per language, counts of bytes in their contexts of 0 to ORDER bytes are learned from a bounded sample of labelled documents
and then frozen. The code length of a byte is -log2 of its probability in its longest known context; a context that does not
know the byte costs its escape (method C: distinct bytes / (bytes + distinct bytes)) and hands over to the next shorter one; below
order 0 all 256 bytes cost 8 bits. A text gets the language that codes it shortest.

Defined results: ``und`` with score 0 for a missing text, one without a letter, or when nothing could be learned; ties go to the
first language by name; repeated rows get equal results; no rows, no result. Whole texts are scored in pieces, so a
long one needs no more memory than a piece. Only ``doc_id``, ``text`` and ``lang`` are read, the last one for learning alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.llm.common import held_out, small_side, stored, table

ORDER = 4
#: Documents per language that the statistics are learned from, about; the sample is drawn by hash of doc_id.
TRAIN_DOCS = 1500
#: Bytes scored at once.
PIECE = 1 << 20
LETTER = re.compile(r"[^\W\d_]")
#: The same as a Java pattern.
JAVA_LETTER = r"[\p{L}\p{Nl}\p{No}]"


def grams(data: bytes, order: int = ORDER) -> np.ndarray:
    """Each byte with the ``order`` bytes before it, as one number; ``data`` begins with ``order`` bytes of context."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    out = np.zeros(max(0, len(raw) - order), np.uint64)
    for i in range(order + 1):
        out = (out << np.uint64(8)) | raw[i : len(raw) - order + i]
    return out


def pieces(text: str, size: int = PIECE, order: int = ORDER) -> Iterator[bytes]:
    """The text's bytes in pieces, each after the bytes before it (zeros before the first)."""
    data = bytes(order) + text.encode("utf-8", "surrogatepass")
    for start in range(order, max(len(data), order + 1), size):
        yield data[start - order : start + size]


def training_rows(docs: DataFrame, per_language: int = TRAIN_DOCS) -> DataFrame:
    """text and lang of the sample: documents not held out, about ``per_language`` of each language."""
    fair = docs.select("doc_id", "text", "lang").filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = stored(fair.groupBy("lang").count(), "lang-sizes")
    place = F.xxhash64(F.lit("lang"), "doc_id").bitwiseAND((1 << 53) - 1) / float(1 << 53)
    rates = small_side(sizes.select(F.col("lang").alias("_lang"), (per_language / F.col("count")).alias("_rate")))
    return fair.join(rates, F.col("lang") == F.col("_lang")).filter(place < F.col("_rate")).select("text", "lang")


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each byte follows each context of ORDER bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list] = {}
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                for piece in pieces(text.as_py()):
                    by_lang.setdefault(lang, []).append(grams(piece))
            for lang, parts in by_lang.items():
                g, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(g.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class ContextTree:
    """Frozen counts of one language, one sorted table per order."""

    def __init__(self, gram: np.ndarray, n: np.ndarray, order: int = ORDER):
        self.levels = []
        for k in range(order + 1):
            keys, inverse = np.unique(gram & np.uint64((1 << (8 * (k + 1))) - 1), return_inverse=True)
            counts = np.bincount(inverse, weights=n)
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, distinct = np.bincount(of, weights=counts), np.bincount(of).astype(float)
            known = -np.log2(counts / (total + distinct)[of])
            self.levels.append((keys, known, contexts, -np.log2(distinct / (total + distinct))))

    def bits(self, gram: np.ndarray) -> np.ndarray:
        """Code length of each gram's last byte after its other bytes."""
        out, open_ = np.zeros(len(gram)), np.arange(len(gram))
        for k in range(len(self.levels) - 1, -1, -1):
            keys, known, contexts, escapes = self.levels[k]
            g = gram[open_] & np.uint64((1 << (8 * (k + 1))) - 1)
            at = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
            hit = keys[at] == g
            out[open_[hit]] += known[at[hit]]
            open_, g = open_[~hit], g[~hit] >> np.uint64(8)
            if not len(open_):
                return out
            at = np.minimum(np.searchsorted(contexts, g), len(contexts) - 1)
            out[open_] += np.where(contexts[at] == g, escapes[at], 0.0)
        out[open_] += 8.0
        return out


class Model:
    """Context trees of all languages, and the code lengths of all grams that any of them knows."""

    def __init__(self, trees: dict[str, ContextTree]):
        self.langs = sorted(trees)
        self.trees = [trees[x] for x in self.langs]
        if trees:
            self.keys = np.unique(np.concatenate([t.levels[-1][0] for t in self.trees]))
            self.costs = self.all_bits(self.keys)

    def all_bits(self, gram: np.ndarray) -> np.ndarray:
        return np.stack([t.bits(gram) for t in self.trees], axis=1).astype(np.float32)

    def lookup(self, gram: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, gram), len(self.keys) - 1)
        out = self.costs[at]
        new = self.keys[at] != gram
        if new.any():
            out[new] = self.all_bits(gram[new])
        return out

    def text_bits(self, texts: list[str]) -> np.ndarray:
        """Code length of each text in each language."""
        out = np.zeros((len(texts), len(self.langs)))
        held: list[tuple[int, bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            for piece in pieces(text):
                held.append((i, piece))
                size += len(piece)
                if size >= PIECE:
                    self._add(held, out)
                    held, size = [], 0
        self._add(held, out)
        return out

    def _add(self, held: list[tuple[int, bytes]], out: np.ndarray) -> None:
        held = [(i, p) for i, p in held if len(p) > ORDER]
        if not held:
            return
        sizes = np.array([len(p) for _, p in held])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        every = grams(b"".join(p for _, p in held))
        # Grams that reach from one text into the next are cut out.
        bounds = np.stack([starts, starts + sizes - ORDER], axis=1).ravel()
        unique, inverse = np.unique(every, return_inverse=True)
        costs = self.lookup(unique)
        for column in range(len(self.langs)):
            flow = np.concatenate([costs[:, column].astype(np.float64)[inverse], [0.0]])
            sums = np.add.reduceat(flow, bounds[:-1] if bounds[-1] == len(flow) else bounds)[::2]
            np.add.at(out[:, column], [i for i, _ in held], sums)


def learn(docs: DataFrame, per_language: int = TRAIN_DOCS) -> Model:
    """The model; its tables are bounded by the sample."""
    counts = gram_counts(training_rows(docs, per_language)).toArrow()
    lang, gram, n = (counts.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "gram", "n"))
    gram = gram.astype(np.uint64)
    trees = {}
    for name in sorted(set(lang.tolist())):
        own = lang == name
        trees[name] = ContextTree(gram[own], n[own])
    return Model(trees)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (with ``text``) as column ``doc``, with lang_pred, score and bits (code length per byte)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["text"].alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            fair = [i for i, t in enumerate(texts) if model.langs and t is not None and LETTER.search(t)]
            pred, p, rate = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts)
            if fair:
                bits = model.text_bits([texts[i] for i in fair])
                best = bits.argmin(axis=1)
                least = bits.min(axis=1)
                share = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
                for j, i in enumerate(fair):
                    pred[i], p[i], rate[i] = model.langs[best[j]], float(share[j]), float(least[j]) / len(texts[i].encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred), pa.array(p, pa.float64()), pa.array(rate, pa.float64())], ["doc", "lang_pred", "score", "bits"])

    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, lang_pred string, score double, bits double"
    return rows.mapInArrow(predict, schema)


def known_documents(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents that get a language, with the columns they came with.

    Where no language could be learned, none is rejected for lack of one: only texts without a letter and missing ones go.
    """
    model = model or learn(docs)
    if not model.langs:
        return docs.filter(docs["text"].rlike(JAVA_LETTER))
    return score(docs, model).filter("lang_pred <> 'und'").select("doc.*")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = score(docs.select("doc_id", "text"), learn(docs))
    return rows.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "lang_pred", "score")
