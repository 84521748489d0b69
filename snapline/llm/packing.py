"""Packing of token sequences: best-fit decreasing with a segment tree over remaining capacity.

Documents become token ids with a closing id. A document longer than a window is cut into full windows first; what is left is at most one window
long. Best-fit decreasing treats pieces of one length alike, so it is run over the counts of lengths, at most WINDOW numbers whatever
the table: for each length, from the longest, the segment tree gives the tightest open windows with room, and a whole range of windows
that are filled alike takes pieces at once. This is the same packing as piece by piece. It gives blocks (ranks of pieces of
one length, first window, place), fewer than a few thousand; the pieces themselves are ranked by length in Spark and look up their
block in the tasks.

Defined results: a missing text counts as empty, and an empty text is the closing id alone; repeated rows are packed one by one; pieces
are ranked by length, then id (missing last), then place, so ties do no harm; no rows, no result. Texts are read whole. Strings that look like special tokens are
ordinary text. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.llm.common import running, stored, table

WINDOW = 1024
CLOSING = 0
VOCABULARY = "byte_bpe_50k.json"
#: Chunks that are encoded at once.
CHUNKS = 512
#: Chunks whose ids a worker remembers; beyond it only those of the last texts.
REMEMBERED = 1_000_000
#: Bytes of texts that are encoded together.
TOGETHER = 1 << 24
WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed vocabulary package has the file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class TextIds:
    """Token ids of many texts at once; equal chunks of the texts are encoded once.

    The pattern of byte-level vocabularies never joins white space to what stands before it, and of a run of white space followed by something
    visible it leaves the last character to that. So texts are cut before each run and before its last character: a chunk is
    at most one white-space character with what is visible after it, or the rest of a run. That holds for ASCII white space; texts in which
    other white space stands beside a cut are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        # How this kind of vocabulary writes the six white-space bytes: 0x20 and 0x09 to 0x0D, moved up by 256.
        self.opens = np.array([name.startswith(tuple(map(chr, [0x120, *range(0x109, 0x10E)]))) for name in names])
        self.known = pa.array([], pa.binary())
        self.ids, self.begin, self.count = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def of(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts as bytes, the i-th from ``ends[i]`` to ``ends[i + 1]`` -> all ids, and their ends in the same way."""
        first = np.zeros(len(data) + 1, bool)
        first[ends] = True
        white = WHITE[data]
        opens, closes = white.copy(), white & ~first[1:]
        opens[1:] &= ~white[:-1]
        closes[:-1] &= ~white[1:]
        starts = np.flatnonzero(first[:-1] | opens | closes).astype(np.int32)
        offsets = pa.py_buffer(np.append(starts, np.int32(len(data))))
        coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        number = coded.indices.to_numpy()
        place = pc.index_in(coded.dictionary, value_set=self.known).fill_null(-1).to_numpy().copy()
        new = np.flatnonzero(place < 0)
        chunks = coded.dictionary.take(pa.array(new))
        odd = np.zeros(len(place), bool)
        odd[new] = [_odd(c) for c in chunks.to_pylist()]
        at = np.searchsorted(starts, ends)
        if odd.any():
            return self._apart(data, ends, np.add.reduceat(np.append(odd[number], False), at[:-1]) * (np.diff(at) > 0) > 0)
        place[new] = len(self.known) + np.arange(len(new))
        ids, begin, count = self._chunk_ids(chunks.to_pylist())
        self.begin, self.count = np.append(self.begin, len(self.ids) + begin), np.append(self.count, count)
        self.ids, self.known = np.append(self.ids, ids), pa.concat_arrays([self.known, chunks])
        if len(self.known) > REMEMBERED:
            ids = _gathered(self.ids, self.begin[place], self.count[place])
            self.known, self.count, self.ids = coded.dictionary, self.count[place], ids
            self.begin = np.cumsum(self.count) - self.count
            place = np.arange(len(place))
        number = place[number]
        held = self.count[number]
        return _gathered(self.ids, self.begin[number], held), np.concatenate([[0], np.cumsum(held)])[at]

    def _chunk_ids(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin, count): where the ids of each chunk lie.

        Chunks of one white-space character and something visible are encoded together, as a token that opens with such a character opens a
        chunk; a word that a text begins with is encoded after a newline, which is then left out.
        """
        begin, count, parts, total = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64), [], 0
        blank = [c.isspace() for c in chunks]
        plain = [i for i, b in enumerate(blank) if not b]
        for k in range(0, len(plain), CHUNKS):
            some = plain[k : k + CHUNKS]
            bare = np.array([not WHITE[chunks[i][0]] for i in some])
            ids = self.encoded(b"".join([b"\n" + chunks[i] if b else chunks[i] for i, b in zip(some, bare)]).decode("utf-8", "replace"))
            opens = np.flatnonzero(self.opens[ids])
            if len(opens) != len(some):
                raise ValueError("this vocabulary does not keep white space at the beginning of tokens")
            begin[some] = total + opens + bare
            count[some] = np.diff(np.append(opens, len(ids))) - bare
            parts.append(ids)
            total += len(ids)
        for i, b in enumerate(blank):
            if b:
                parts.append(self.encoded(chunks[i].decode()))
                begin[i], count[i], total = total, len(parts[-1]), total + len(parts[-1])
        return np.concatenate(parts) if parts else np.zeros(0, "<u4"), begin, count

    def _apart(self, data: np.ndarray, ends: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Odd texts whole, the others together."""
        texts = [data[s:e] for s, e in zip(ends, ends[1:])]
        plain = [t for t, o in zip(texts, odd) if not o]
        ids, upto = self.of(np.concatenate([np.zeros(0, np.uint8), *plain]), np.cumsum([0, *map(len, plain)]))
        others = iter(zip(upto, upto[1:]))
        found = [self.encoded(t.tobytes().decode("utf-8", "replace")) if o else ids[slice(*next(others))] for t, o in zip(texts, odd)]
        return np.concatenate([np.zeros(0, "<u4"), *found]), np.cumsum([0, *map(len, found)])


def _gathered(ids: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The stretches of ``ids`` that lie at ``begin``, one after the other."""
    before = np.cumsum(count) - count
    return ids[np.repeat(begin - before, count) + np.arange(count.sum())]


def _odd(chunk: bytes) -> bool:
    """Whether white space other than the six ASCII characters stands beside a cut."""
    inner = chunk.strip()
    if not inner or (0x20 < inner[0] < 0x80 and 0x20 < inner[-1] < 0x80):
        return False
    text = inner.decode("utf-8", "replace")
    return text[0].isspace() or text[-1].isspace()


@lru_cache(maxsize=2)
def text_ids(path: str) -> TextIds:
    """Read once in each worker, whose tasks have a core each."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return TextIds(path)


def pieces(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, doc_tokens and ids (32 bits each, little-endian) of each piece: full windows first, then the rest."""
    path = path or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_ids(path)
        closing = np.array([CLOSING], "<u4").tobytes()
        for batch in batches:
            first, texts, held = 0, [], 0
            for i, text in enumerate(batch.column(1)):
                texts.append(text.as_py() or b"")
                held += len(texts[-1])
                if held < TOGETHER and i + 1 < batch.num_rows:
                    continue
                ids, ends = encoder.of(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
                rows = []
                for doc, s, e in zip(batch.column(0).slice(first, len(texts)).to_pylist(), ends.tolist(), ends[1:].tolist()):
                    data, n = ids[s:e].tobytes() + closing, e - s + 1
                    rows += [(doc, p, min(window, n - p), n, data[4 * p : 4 * (p + window)]) for p in range(0, n, window)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["doc_id", "start", "length", "doc_tokens", "ids"])
                first, texts, held = i + 1, [], 0

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(cut, "doc_id long, start long, length long, doc_tokens long, ids binary")


class OpenWindows:
    """Ranges of windows filled alike, by remaining capacity, with a segment tree that finds the tightest one with room."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.most = [-1] * (2 * self.leaves)  # largest capacity with an open window below each node
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]

    def _set(self, room: int, value: int) -> None:
        node = room + self.leaves
        self.most[node] = value
        while node > 1:
            node //= 2
            self.most[node] = max(self.most[2 * node], self.most[2 * node + 1])

    def put(self, room: int, first: int, count: int) -> None:
        if room and count:
            if not self.ranges[room]:
                self._set(room, room)
            self.ranges[room].append((first, count))

    def take(self, room: int) -> tuple[int, int]:
        found = self.ranges[room].pop()
        if not self.ranges[room]:
            self._set(room, -1)
        return found

    def tightest(self, length: int) -> int | None:
        """The least capacity of an open window that is at least ``length``."""
        node = length + self.leaves
        if self.most[node] >= length:
            return length
        while node > 1:
            if node % 2 == 0 and self.most[node + 1] >= 0:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.most[2 * node] >= 0 else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


@dataclass(frozen=True)
class Block:
    """Pieces of one length, by rank: ``each`` of them go to a window, from ``place`` on, in windows that follow one another."""

    length: int
    rank: int
    window: int
    each: int
    place: int


def best_fit(counts: dict[int, int], window: int = WINDOW) -> list[Block]:
    """Best-fit decreasing over counts of lengths; ranks begin at 0 for each length."""
    open_, blocks, windows = OpenWindows(window), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = open_.tightest(length)
            if room is None:
                room, first, count = window, windows, -(-left // (window // length))
                windows += count
            else:
                first, count = open_.take(room)
            # A window that took a piece is the tightest for the next one, as long as there is room.
            each = room // length
            full = min(count, left // each)
            if full:
                blocks.append(Block(length, rank, first, each, window - room))
                rank, left = rank + full * each, left - full * each
                open_.put(room - each * length, first, full)
            if left and full < count:  # fewer than ``each`` pieces are left: they share one window
                blocks.append(Block(length, rank, first + full, left, window - room))
                open_.put(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            open_.put(room, first + full, count - full)
    return blocks


def packed(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """``cut`` (stored pieces with doc_id, start and length) with ``sequence_id`` and ``offset``."""
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most ``window`` rows
    below, total = {}, 0
    for length in sorted(counts):
        below[length], total = total, total + counts[length]
    blocks = sorted(best_fit(counts, window), key=lambda b: below[b.length] + b.rank)
    columns = [[below[b.length] + b.rank for b in blocks], [b.window for b in blocks], [b.each for b in blocks], [b.place for b in blocks]]
    shared = cut.sparkSession.sparkContext.broadcast([np.array(c, np.int64) for c in columns])
    keys = cut.select("length", "doc_id", "start", F.monotonically_increasing_id().alias("_row"), F.lit(1).alias("_one"), F.struct(*cut.columns).alias("_piece"))
    ranked = running(keys, ["length", "doc_id", "start", "_row"], {"_nth": "_one"}, "pack-order").select("_piece", "length", "_nth")
    schema = ranked.select("_piece", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, windows, each, places = shared.value
        for batch in batches:
            length, nth = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))
            block = np.searchsorted(ranks, nth - 1, side="right") - 1
            at = nth - 1 - ranks[block]
            ids = windows[block] + at // each[block]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids), pa.array(places[block] + at % each[block] * length)], schema.names)

    return ranked.mapInArrow(place, schema).select("_piece.*", "sequence_id", "offset")


def sequences(packed_pieces: DataFrame, window: int = WINDOW, padding: int = CLOSING) -> DataFrame:
    """sequence_id, tokens (number) and ids, padded to the window unless the number is a power of two. Needs ``ids`` of the pieces.

    A group is one window, so no group outgrows a task.
    """
    held = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = packed_pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), held.alias("held"))
    joined = F.aggregate("held", F.lit(b""), lambda acc, h: F.concat(acc, h["ids"]))
    pad = F.unhex(F.repeat(F.lit(np.array([padding], "<u4").tobytes().hex()), (F.lit(window) - F.col("tokens")).cast("int")))
    return rows.select("sequence_id", "tokens", F.when(F.bit_count("tokens") == 1, joined).otherwise(F.concat(joined, pad)).alias("ids"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = pieces(table(spark, sf_dir, "documents"))
    cut = stored(cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"), "pack-pieces")
    return packed(cut)
