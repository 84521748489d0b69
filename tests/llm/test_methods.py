"""The methods against brute force, exact round trips and held-out accuracy."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SMALL, workers_can_import  # noqa: F401
from snapline.llm import components, decontamination, language, mixing, neardup, queries, quality, secrets, sharding, toxicity, urls
from snapline.llm.common import table

MEDIUM = "/root/testdata/sf0.01"


def test_wu_manber_finds_what_comparison_finds():
    rng = random.Random(1)
    for length in (1, 2, 3, 10):
        text = [rng.choice([b"a", b"b", b"c"]) for _ in range(400)]
        starts = [rng.randrange(400 - length) for _ in range(15)]
        patterns = {tuple(text[s : s + length]) for s in starts} | {tuple(rng.choice([b"a", b"b", b"d"]) for _ in range(length)) for _ in range(15)}
        numbered = [(p, i) for i, p in enumerate(sorted(patterns))]
        expected = {(s, i) for s in range(400 - length + 1) for p, i in numbered if tuple(text[s : s + length]) == p}
        assert set(decontamination.WuManber(length, numbered).find(text)) == expected


def brute_components(docs, similar=85):
    sets = {i: set(zip(*[t[j:] for j in range(5)])) if len(t) >= 5 else ({tuple(t)} if t else set()) for i, t in docs.items()}
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= similar * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_copies_equal_brute_force(spark):
    """Groups of copies around a lost original, chains, one group with a third of all rows, and a passage that many share."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    passage = [rng.choice(words) for _ in range(60)]
    docs = {}
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([6, 40, 120, 300]))]
        for _ in range(90 if g == 0 else 12):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs[len(docs)] = copy
    for _ in range(60):
        docs[len(docs)] = [rng.choice(words) for _ in range(rng.randrange(1, 80))] + passage
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs.items()], "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_copies(df).collect()}
    assert found == brute_components(docs)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(f"{i:04d}", f"{i + 1:04d}") for i in range(0, 300)] + [("x", "y")], "a string, b string")
    found = {r["node"]: r["label"] for r in components.components(links, "chain").collect()}
    assert {v for k, v in found.items() if k < "x"} == {"0000"} and found["y"] == "x" and len(found) == 303


def brute_bits(training, text, order=language.ORDER):
    """Code length by plain dictionaries."""
    counts = [{} for _ in range(order + 1)]
    for t in training:
        data = bytes(order) + t.encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts[k].setdefault(data[i - k : i], Counter())[data[i]] += 1
    total, data = 0.0, bytes(order) + text.encode()
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = counts[k].get(data[i - k : i])
            if seen is None:
                continue
            n = sum(seen.values()) + len(seen)
            if data[i] in seen:
                total -= math.log2(seen[data[i]] / n)
                break
            total -= math.log2(len(seen) / n)
        else:
            total += 8
    return total


def test_code_lengths_equal_plain_counts(spark):
    training = ["the cat and the hat", "a cat sat there"]
    tree_counts = language.gram_counts(spark.createDataFrame([(t, "en") for t in training], "text string, lang string")).collect()
    tree = language.ContextTree(np.array([r["gram"] for r in tree_counts], np.uint64), np.array([r["n"] for r in tree_counts]))
    model = language.Model({"en": tree})
    texts = ["the cat", "a hat sat", "quite new: ÄÖ", "t", "the cat and " * 50]
    for text, bits in zip(texts, model.text_bits(texts)[:, 0]):
        assert bits == pytest.approx(brute_bits(training, text), rel=1e-5)


def test_long_texts_are_scored_in_pieces(spark, monkeypatch):
    model = language.learn(table(spark, SMALL, "documents"))
    texts = ["the of and that with this " * 400, "der die das und nicht " * 300, "x"]
    whole = model.text_bits(texts)
    monkeypatch.setattr(language, "PIECE", 1000)
    monkeypatch.setattr(language.pieces, "__defaults__", (1000, language.ORDER))
    assert np.allclose(model.text_bits(texts), whole, rtol=1e-6)


def test_languages_held_out(spark):
    docs = table(spark, MEDIUM, "documents").select("doc_id", "lang")
    rows = queries.queries()["op10_language_id"](spark, MEDIUM).filter("held_out").join(docs, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows) > 0


def test_toxicity_held_out(spark):
    labels = table(spark, MEDIUM, "labels").select("doc_id", "toxic")
    rows = queries.queries()["op4_toxicity"](spark, MEDIUM).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["toxic"] == r["predicted"] for r in held) >= 0.9 * len(held) > 0
    toxic, clean = [[r["score"] for r in rows if r["toxic"] == y] for y in (1, 0)]
    assert sum(toxic) / len(toxic) > 0.5 > 0.1 > sum(clean) / len(clean)


def brute_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, used, room = (low + high) // 2, 1, (low + high) // 2
        for s in sizes:
            if s > room:
                used, room = used + 1, mid
            room -= s
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


def test_shards_have_the_smallest_capacity(spark):
    rng = random.Random(7)
    for texts in ([rng.choice("xyz") * rng.randrange(1, 900) for _ in range(300)], ["a" * 500] * 80 + ["b" * i for i in range(160)]):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        rows = sharding.shard(df).collect()
        loads = Counter()
        for r in rows:
            loads[r["shard"]] += r["size"]
        groups = {}
        for t in texts:
            groups[t] = groups.get(t, 0) + len(t) + 1
        assert max(loads.values()) == brute_capacity(list(groups.values()), 8)
        assert len({(r["text_crc32"], r["shard"]) for r in rows}) == len(groups)


def test_water_filling(spark):
    sizes = {"a": 10, "b": 1000, "c": 2000, None: 300}
    words = [(f"{s}{i}", s, 1) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame([(i, "w", s) for i, (_, s, _) in enumerate(words)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 5.0), ("b", 1.0), ("c", 0.0), (None, 2.0)], "source string, weight double")
    got = {r["source"]: (r["target"], r["t"]) for r in mixing.mix(df, weights).groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("t")).collect()}
    assert got == {"a": (30.0, 30), "b": (2380.0, 2380), "c": (0.0, 0), None: (900.0, 900)}
    assert sorted(map(tuple, mixing.mix(df, weights).collect()), key=repr) == sorted(map(tuple, mixing.mix(df, weights).collect()), key=repr)
    assert mixing.repeat_rows(df, weights).count() == 30 + 2380 + 900


def test_entropy_of_sliding_windows(spark):
    secret = "q7Zp4LxV9sKe2RtYb8NwQ3mD"
    texts = {1: f"key {secret} end", 2: "aaaaaaaaaaaaaaaaaaaaaaaa1B", 3: "de305d54-75b4-431b-adb2-eb6b9e546014", 4: "AnOrdinaryLongIdentifierOfWords", 5: f"{'Z' * 30}{secret}{'Z' * 30}"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: [(s["start"], s["finish"]) for s in r["added"]] for r in secrets.scan(df).collect()}
    assert found[1] == [(4, 28)] and found[2] == found[3] == found[4] == []
    (start, finish), text = found[5][0], texts[5]

    def bits(window):
        return -sum(n / 20 * math.log2(n / 20) for n in Counter(window).values())

    high = [i for i in range(len(text) - 19) if bits(text[i : i + 20]) >= 3.7]
    assert (start, finish) == (high[0], high[-1] + 20)


def test_colliding_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda text, seed: len(text) % 2)
    names = urls.DigestArray.write(str(tmp_path), [("net/", "block"), ("example.net/", "allow"), ("org/a", "block")])
    assert urls.DigestArray(names).find([b"net/", b"example.net/", b"org/a", b"com/", b"xyz/b"]) == [1, 0, 1, None, None]


def test_repeated_windows(spark):
    rng = random.Random(3)
    texts = ["", "a b c", "a b c d e f g h", " ".join("abcdefgh" * 3)] + [" ".join(rng.choice("ab") for _ in range(rng.randrange(8, 60))) for _ in range(40)]

    def brute(text):
        w = text.split()
        seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        return len({j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)})

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["n_repeat_words"] for r in quality.measures(df).collect()} == {i: brute(t) for i, t in enumerate(texts)}


def test_pipeline_equals_plain_stages(spark):
    """The whole pipeline against its stages told apart: what stays, how often, and where."""
    import corpus_pipeline

    t = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text", "source"]).to_pydict()
    docs = {i: (x, s) for i, x, s in zip(t["doc_id"], t["text"], t["source"]) if x and any(c.isalpha() for c in x)}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    copies = brute_components({i: x.translate(lower).split() for i, (x, _) in docs.items()}, 80)
    docs = {i: d for i, d in docs.items() if copies[i][1] == i}
    items = pq.read_table(f"{SMALL}/benchmark.parquet").to_pydict()["text"]
    windows = {tuple(w[i : i + 10]) for w in map(decontamination.word_list, items) for i in range(max(1, len(w) - 9))}

    def clean(text):
        w = decontamination.word_list(text)
        return not any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))

    docs = {i: d for i, d in docs.items() if clean(d[0])}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    times = Counter(r["doc_id"] for r in rows)
    assert set(times) <= set(docs) and max(times.values()) <= 3
    mixed = mixing.mix(spark.createDataFrame([(i, x, s) for i, (x, s) in docs.items()], "doc_id long, text string, source string"))
    assert times == Counter({r["doc_id"]: r["taken"] // r["size"] for r in mixed.collect() if r["taken"]})
    loads = Counter()
    for r in rows:
        loads[r["shard"]] += r["size"]
    groups = {}
    for i in sorted(times):
        groups[docs[i][0]] = groups.get(docs[i][0], 0) + times[i] * (len(docs[i][0].encode()) + 1)
    assert max(loads.values()) == brute_capacity(list(groups.values()), 8)
