"""Periodic runs, packing and lexical search against brute force and round trips, with nulls, long texts, ties and clashing names."""

import math
import random
import zlib
from collections import Counter
from functools import lru_cache

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import compare
from llm_fixtures import SMALL, odd_docs, workers_can_import  # noqa: F401
from snapline.llm import decontamination, oracle, packing, queries, runs, search
from snapline.llm.common import table


def brute_runs(w):
    """By the definition: every maximal stretch at every lag, unless a smaller period holds all of it."""
    n, long = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                long.append((i, j - i + q, q))
            i = j + 1
    return sorted((s, k, q) for s, k, q in long if not any(p < q and t <= s and t + m >= s + k for t, m, p in long))


def repetitive(rng, n):
    """Random words over few letters with repeated stretches inside one another."""
    w = []
    while len(w) < n:
        unit = [rng.choice("abc") for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 40, 64]))]
        w += (unit * 9)[: rng.randrange(1, 9 * len(unit) + 1)]
        if len(w) > 30 and rng.random() < 0.3:
            w += w[-rng.randrange(1, 30) :] * rng.randrange(2, 6)
    return w[:n]


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for trial in range(400):
        w = repetitive(rng, rng.choice([0, 1, 5, 6, 7, 20, 90, 300])) if trial % 3 else [rng.choice("ab") for _ in range(rng.randrange(200))]
        numbers = np.array([ord(x) for x in w], np.int64)
        assert runs.runs_of(numbers) == brute_runs(w), w


def test_runs_of_a_long_period_without_rare_grams():
    """Every short gram of the period occurs in it several times."""
    rng = random.Random(5)
    unit = [rng.choice("ab") for _ in range(3000)]
    w = ["x"] * 3 + unit * 5 + unit[:70] + ["y"]
    found = runs.runs_of(np.array([ord(x) for x in w], np.int64))
    assert (3, 5 * 3000 + 70, 3000) in found
    assert [r for r in found if r[2] < 200] == [r for r in brute_runs_up_to(w, 200)]


def brute_runs_up_to(w, most):
    long = []
    for q in range(1, most):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                long.append((i, j - i + q, q))
            i = j + 1
    return sorted((s, k, q) for s, k, q in long if not any(p < q and t <= s and t + m >= s + k for t, m, p in long))


def test_one_word_for_ever_takes_linear_work(monkeypatch):
    """A text of equal words: one extension per octave at most, though all its grams occur everywhere."""
    calls = []
    plain = runs.matched
    monkeypatch.setattr(runs, "matched", lambda *a: calls.append(a) or plain(*a))
    assert runs.runs_of(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)] and len(calls) == 1


def test_runs_of_odd_documents(spark, odd_docs):
    rows = runs.periodic_runs(odd_docs)
    assert rows.count() == odd_docs.count() and runs.periodic_runs(odd_docs.limit(0)).count() == 0
    assert rows.select("doc.*").columns == [c for c in odd_docs.columns if c != "text"]
    found = {r["doc"]["doc_id"]: r for r in rows.collect()}
    assert [(found[i]["n_words"], found[i]["runs"], found[i]["collapsed"]) for i in (3, 5, 6)] == [(0, [], "")] * 3
    assert found[7]["n_words"] == 32_000 and [tuple(r) for r in found[7]["runs"]] == [(0, 32_000, 977 * 4)]
    assert len(found[7]["collapsed"].split()) == 977 * 4
    same = runs.planted(odd_docs)
    assert same.columns == odd_docs.columns and same.count() == odd_docs.count()
    assert same.filter("doc_id IS NULL").exceptAll(odd_docs.filter("doc_id IS NULL")).isEmpty()


def brute_query(doc_id, text):
    w = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_planted_periods_equal_plain_python(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["a", "b", "cc", "dé"]) for _ in range(rng.randrange(0, 60)))) for i in range(600)] + [(601, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["text"] or "").encode().split() for r in runs.planted(df).collect()}
    assert found == {i: brute_query(i, t) for i, t in rows}
    assert sum(found[i] != (t or "").encode().split() for i, t in rows) > 20


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op13_lexical_search"])
def test_query_equals_sql_on_repeated_rows(spark, tmp_path, name):
    rng = random.Random(9)
    docs = [(i % 70, " ".join(repetitive(rng, rng.randrange(0, 80)))) for i in range(120)] + [(80, None), (81, ""), (82, "A a. A? Éa a-b"), (82, "A a. A? Éa a-b")]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/d")
    spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (3, "zz Éa"), (4, "C c, c")], "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/b")
    con = duckdb.connect()
    for view, at in (("documents", "d"), ("benchmark", "b")):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{tmp_path}/{at}/*.parquet')")
        spark.read.parquet(f"{tmp_path}/{at}").write.parquet(f"{tmp_path}/{view}.parquet")
    twin = {"op11_periodic_runs": oracle.OP11, "op13_lexical_search": oracle.OP13}[name]
    assert compare.difference(queries.queries()[name](spark, str(tmp_path)), con, twin) is None


# Packing


@lru_cache
def plain_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    tokenizer.encode_special_tokens = True
    return tokenizer


def plain_ids(text):
    return plain_tokenizer().encode(text or "", add_special_tokens=False).ids


def brute_best_fit(lengths, window):
    """How full the windows are, piece by piece; of windows with the same room any may be taken."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= length]
        if fits:
            _, i = min(fits)
        else:
            rooms.append(window)
            i = len(rooms) - 1
        rooms[i] -= length
    return Counter(window - r for r in rooms)


def test_best_fit_over_counts_equals_piece_by_piece():
    rng = random.Random(3)
    for trial in range(300):
        window = rng.choice([1, 2, 7, 16, 64, 100])
        lengths = [rng.randrange(1, window + 1) if trial % 2 else min(window, 1 + int(rng.expovariate(5 / window))) for _ in range(rng.randrange(0, 200))]
        windows = {}
        counts = Counter(lengths)
        taken = {k: [False] * n for k, n in counts.items()}
        blocks = packing.best_fit(dict(counts), window)
        for block, after in zip(blocks, [*blocks[1:], None]):
            end = after.rank if after and after.length == block.length else counts[block.length]
            for rank in range(block.rank, end):
                assert not taken[block.length][rank]
                taken[block.length][rank] = True
                at = rank - block.rank
                windows.setdefault(block.window + at // block.each, {})[block.place + at % block.each * block.length] = block.length
        assert all(map(all, taken.values()))
        for held in windows.values():  # no gap, no overlap, nothing beyond the window
            end = 0
            for place, length in sorted(held.items()):
                assert place == end
                end += length
            assert end <= window
        assert Counter(sum(h.values()) for h in windows.values()) == brute_best_fit(lengths, window)
        assert sorted(windows) == list(range(len(windows)))


def test_ids_of_chunks_equal_plain_ids(monkeypatch):
    texts = ["", " ", "a", " a", "a ", "a  b", "a \n b", "a  b", "x" * 5000, "it's we'll 你好 Été <|endoftext|> Ġx", "\t\tdef f(x):\n    return  x\n\n", "a" + " " * 300 + "b", "  a \x1f b \x85 c", "1 22 333 4,444.5 !!! ... ?!", "a\t\n b", "a\t b", "\n\na\n\nb\n", "!\x1c a", "a\x85 b", "x " * 40 + " " * 200_000 + "\n" + "y"]
    rng = random.Random(8)
    texts += ["".join(rng.choice(["a", "B", "1", ".", " ", " ", "\n", "é", "你", "'s", " ", "\x1c", "Ġ"]) for _ in range(200)) for _ in range(200)]
    encoder = packing.TextIds(packing.vocabulary_path())
    for some in (texts, texts[:1], [], *[[t] for t in texts[:20]], texts[::-1]):
        monkeypatch.setattr(packing, "CHUNKS", 512 if some is texts else 7)
        monkeypatch.setattr(packing, "REMEMBERED", 5_000 if some is texts else 50)
        data = [t.encode() for t in some]
        ids, ends = encoder.of(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
        assert len(ends) == len(some) + 1 and ends[-1] == len(ids)
        for text, s, e in zip(some, ends, ends[1:]):
            assert ids[s:e].tolist() == plain_ids(text), repr(text)


def test_packing_round_trip(spark, odd_docs):
    cut = packing.stored(packing.pieces(odd_docs.withColumn("_row", F.lit(1))), "test-pieces")
    rows = packing.packed(cut).collect()
    docs = {r["doc_id"]: r["text"] for r in odd_docs.filter("doc_id IS NOT NULL").collect()}
    whole = {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and 0 < r["length"] <= 1024
        whole.setdefault(r["doc_id"], Counter())[(r["start"], bytes(r["ids"]))] += 1
    for doc_id, text in docs.items():
        times = 2 if doc_id == 1 else 1
        assert set(whole[doc_id].values()) == {times}
        joined = b"".join(part for _, part in sorted(whole[doc_id]))
        assert np.frombuffer(joined, "<u4").tolist() == [*plain_ids(text), 0]
    windows = {}
    for r in rows:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], bytes(r["ids"])))
    for held in windows.values():
        assert [o for o, _, _ in sorted(held)] == np.cumsum([0, *[n for _, n, _ in sorted(held)]]).tolist()[:-1]
    made = {r["sequence_id"]: (r["tokens"], bytes(r["ids"])) for r in packing.sequences(spark.createDataFrame(rows, packing.packed(cut).schema)).collect()}
    assert made.keys() == windows.keys()
    for k, (tokens, ids) in made.items():
        assert ids[: 4 * tokens] == b"".join(part for _, _, part in sorted(windows[k]))
        assert len(ids) == 4 * (tokens if tokens & (tokens - 1) == 0 else 1024) and not any(ids[4 * tokens :])
    empty = packing.stored(packing.pieces(odd_docs.limit(0)), "test-pieces")
    assert packing.packed(empty).count() == 0


def test_packing_query(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()}
    rows = queries.queries()["op12_packing"](spark, SMALL).collect()
    ids = {i: np.array([*plain_ids(t), 0], "<u4") for i, t in docs.items()}
    assert sorted((r["doc_id"], r["start"], r["length"]) for r in rows) == sorted((i, s, min(1024, len(x) - s)) for i, x in ids.items() for s in range(0, len(x), 1024))
    assert all(r["doc_tokens"] == len(ids[r["doc_id"]]) and r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) for r in rows)
    fill = Counter()
    for r in rows:
        fill[r["sequence_id"]] += r["length"]
    assert Counter(fill.values()) == brute_best_fit([r["length"] for r in rows], 1024)


# Search


def brute_search(docs, items, top):
    terms = [Counter(decontamination.word_list(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in terms]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for c in terms for t in c)
    found = []
    for item, text in items:
        scored = []
        for (doc, _), c, n in zip(docs, terms, sizes):
            score = 0
            for t in set(decontamination.word_list(text)) & c.keys():
                m = 100 - 50 + 50 * n * n_docs // total
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        found += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scored)[:top], 1)]
    return Counter(found)


@pytest.mark.parametrize(("per_pass", "top"), [(2_000, 50), (3, 4)])
def test_search_equals_brute_force(spark, odd_docs, per_pass, top):
    rng = random.Random(6)
    words = [f"t{i}" for i in range(150)]
    weights = [1 / (i + 1) for i in range(150)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(0, 80)))) for i in range(400)]
    docs += [(1000 + i, "t1 t2 T3, t4") for i in range(90)]  # ties
    items = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 3, 20, 200])))) for i in range(8)]
    items += [(9, None), (10, "..."), (11, "unheard of"), (None, "t1 t2"), (3, "t5 t6"), (3, "t5 t6"), (12, " ".join(words))]
    df = spark.createDataFrame(docs, "doc_id long, text string").unionByName(odd_docs, allowMissingColumns=True).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("number", F.lit(1)).withColumn("score", F.lit("x"))
    found = Counter(map(tuple, search.search(df, asked, top, per_pass).collect()))
    everything = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert found == brute_search(everything, items, top)


def test_masks_below_the_floor_are_not_evaluated(spark):
    """Documents with the rare terms settle it; those with a common one are never scored."""
    n = 5_000
    counts = np.ones(n + 60, np.int64)
    terms = np.concatenate([np.zeros(n, np.int64), np.ones(60, np.int64)])
    batch = search.Batch(np.full(n + 60, 10), np.arange(n + 61), terms, counts, np.array([1, 5_000]), n + 60, 10 * (n + 60))
    seen = []
    batch.scores = lambda chosen, held: seen.extend(chosen) or search.Batch.scores(chosen, held)
    search_at_once, search.MASKS_AT_ONCE = search.MASKS_AT_ONCE, 1
    try:
        docs, scores = batch.best([0, 1], 50, 1)
    finally:
        search.MASKS_AT_ONCE = search_at_once
    assert sorted(docs) == list(range(n, n + 60)) == sorted(seen) and len(set(scores)) == 1


def test_search_of_empty_tables(spark, odd_docs):
    items = spark.createDataFrame([(1, "the cat")], "item_id long, text string")
    assert search.search(odd_docs.limit(0), items).count() == 0
    assert search.search(odd_docs, items.limit(0)).count() == 0
    assert search.search(odd_docs, items).count() == 4
