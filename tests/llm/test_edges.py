"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns: defined results everywhere."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_fixtures import odd_docs, workers_can_import  # noqa: F401
from snapline.llm import chat, decontamination, language, mixing, neardup, quality, secrets, sharding, toxicity, urls

ITEMS = [(1, "looked at the moon for a long while and the"), (1, "looked at the moon for a long while and the"), (2, "sat on the mat"), (3, None), (4, "!!"), (None, "cat sat")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def by_id(df):
    return {r["doc_id"]: r for r in df.filter("doc_id IS NOT NULL").collect()}


def test_quality(odd_docs):
    rows = quality.quality(odd_docs).drop("lines")
    assert rows.count() == odd_docs.count() and quality.quality(odd_docs.limit(0)).count() == 0
    found = by_id(rows)
    assert (found[3]["n_words"], found[3]["base_failed"], found[3]["kept"]) == (0, True, False)
    assert found[6]["n_words"] == 0 and found[7]["n_words"] == 32_000 and found[7]["base_failed"]


def test_secrets(odd_docs):
    rows = secrets.scan(odd_docs)
    assert rows.count() == odd_docs.count() and secrets.scan(odd_docs.limit(0)).count() == 0
    hits = rows.filter("size(base) > 0").collect()
    assert [s["hit"] for r in hits for s in r["base"]] == ["token = 'abcdef123456"]


def test_mixing(odd_docs):
    rows = mixing.mix(odd_docs)
    assert rows.count() == odd_docs.count() and mixing.mix(odd_docs.limit(0)).count() == 0
    found = rows.collect()
    assert all(r["taken"] <= 3 * r["size"] for r in found)
    assert {r["target"] for r in found if r["source"] is None} == {3.0 * 16}
    again = mixing.repeat_rows(odd_docs)
    assert again.columns == odd_docs.columns and again.count() > 0
    assert mixing.repeat_rows(odd_docs.limit(0)).count() == 0
    assert mixing.mix(odd_docs.filter("text IS NULL")).agg(F.sum("taken")).first()[0] == 0


def test_toxicity(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, 0, 0), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    for marks in (labels, labels.limit(0)):
        rows = toxicity.score(odd_docs, toxicity.learn(odd_docs, marks))
        assert rows.count() == odd_docs.count() and rows.filter("score NOT BETWEEN 0 AND 1 OR score IS NULL").isEmpty()
    assert toxicity.score(odd_docs.limit(0), toxicity.learn(odd_docs.limit(0), labels)).count() == 0


def test_near_copies(odd_docs):
    rows = neardup.near_copies(odd_docs)
    assert rows.count() == odd_docs.count() and neardup.near_copies(odd_docs.limit(0)).count() == 0
    found = by_id(rows)
    assert {i: r["component_id"] for i, r in found.items()} == {1: 1, 2: 1, 3: 3, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9, 10: 10, 11: 10}
    assert found[3]["n_shingles"] == found[6]["n_shingles"] == 0 and found[10]["n_shingles"] == 1
    kept = neardup.distinct_documents(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id IS NOT NULL").collect()) == [1, 3, 5, 6, 7, 8, 9, 10]


def test_urls(spark):
    pages = [(1, "http://A.Example.NET/en/x?y"), (2, "http://b.net/"), (3, None), (4, "no url"), (5, "x://net"), (6, "http://"), (7, "http://spam-farm.org/de/"), (7, "http://spam-farm.org/de/"), (None, "http://k.org/fr/" + "p" * 100_000)]
    df = spark.createDataFrame(pages, "page_id long, url string").withColumn("rule", F.lit("clash")).withColumn("host", F.lit(1))
    rules = spark.createDataFrame([*urls.RULES, (None, "block"), ("net/", "allow")], "rule string, verdict string")
    expected = {1: ("example.net/en/", "allow"), 2: ("net/", "block"), 3: (None, "allow"), 4: (None, "allow"), 5: (None, "allow"), 6: (None, "allow"), 7: (None, "block"), None: ("org/fr/", "allow")}
    for limit in (1000, 0):  # the array, and the join beyond it
        rows = urls.judge(df, rules, limit).collect()
        assert len(rows) == 9 and {r["page_id"]: (r["rule"], r["verdict"]) for r in rows} == expected
        assert urls.judge(df.limit(0), rules, limit).count() == 0
        ties = spark.createDataFrame([("net/abc", "block"), ("b.net/a", "allow")], "rule string, verdict string")
        assert [r["rule"] for r in urls.judge(spark.createDataFrame([(1, "x://b.net/abc")], "page_id long, url string"), ties, limit).collect()] == ["b.net/a"]
    assert {r["verdict"] for r in urls.judge(df, rules.limit(0)).collect()} == {"allow", "block"}


def test_decontamination(odd_docs, items):
    for per_pass in (1000, 2):
        rows = decontamination.decontaminate(odd_docs, items, per_pass)
        assert rows.count() == odd_docs.count()
        found = by_id(rows)
        assert (found[1]["n_hit"], found[1]["n_items"], found[3]["n_words"], found[6]["n_words"]) == (5, 1, 0, 0)
    assert decontamination.decontaminate(odd_docs.limit(0), items).count() == 0
    assert decontamination.decontaminate(odd_docs, items.limit(0)).filter("contaminated").isEmpty()
    clean = decontamination.clean_documents(odd_docs, items)
    assert clean.columns == odd_docs.columns and 1 not in by_id(clean) and 7 in by_id(clean)


def test_chat(spark):
    calls = [
        ("c", 1, "a", "search", '{"query":"x","limit":1}', None), ("c", 3, "b", "search", '{"limit":2, "query":"y"}', "a"), ("c", 2, "d", "search", "{bad", "b"),
        ("c", 5, "x", "plan", None, "y"), ("c", 6, "y", None, '{"q":1,"q":2}', "x"), ("c", 7, "z", "search", '["query"]', "lost"), ("c", 1, "a", "search", '{"query":"x","limit":1}', None),
        (None, None, None, None, None, None),
    ]
    results = [("c", 2, "a", "first"), ("c", 9, "a", "second"), ("c", 4, "o", None), ("c", 0, "b", "early"), (None, 1, None, "n")]
    df = spark.createDataFrame(calls, "conv_id string, turn long, call_id string, name string, arguments string, after string").withColumn("depth", F.lit(0))
    answers = spark.createDataFrame(results, "conv_id string, turn long, call_id string, content string").withColumn("errors", F.lit(0))
    rows = chat.link(df, answers).collect()
    c = {r["call_id"]: r for r in rows if r["conv_id"] == "c"}
    assert [k for k, r in sorted(c.items(), key=lambda x: x[1]["position"])] == ["a", "z", "b", "d", "x", "y", "o"]
    assert c["a"]["errors"] == "id is used again; answered again" and c["b"]["errors"] == "answered before the call"
    assert c["b"]["message"] == '{"arguments":{"limit":2,"query":"y"},"id":"b","name":"search","result":"early"}'
    assert c["d"]["errors"] == "arguments are no object" and c["d"]["message"].startswith('{"arguments":"{bad",')
    assert "needs itself" in c["x"]["errors"] and "needs an unknown call" in c["z"]["errors"] and c["o"]["status"] == "orphan"
    assert [r["status"] for r in rows if r["conv_id"] is None] == ["linked"]
    assert chat.link(df.limit(0), answers.limit(0)).count() == 0


def test_sharding(odd_docs):
    rows = sharding.shard(odd_docs)
    found = rows.collect()
    assert len(found) == odd_docs.count() and sharding.shard(odd_docs.limit(0)).count() == 0
    places = {}
    for r in found:
        places.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in places.values())
    assert {(r["size"], r["text_crc32"]) for r in found if r["doc_id"] == 3} == {(1, None)}
    assert len({r["shard"] for r in found if r["doc_id"] in (10, 11)}) == 1


def test_language(odd_docs):
    rows = language.score(odd_docs, language.learn(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    und = {r["doc"]["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert {3, 5, 6, 8} <= und and not {1, 9, 10} & und
    assert all(0 <= r["score"] <= 1 for r in rows)
    empty = odd_docs.limit(0)
    assert language.score(empty, language.learn(empty)).count() == 0
    assert {r["lang_pred"] for r in language.score(odd_docs, language.learn(empty)).collect()} == {"und"}


def test_pipeline_stages(spark, odd_docs, tmp_path, items):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs.columns, stage(spark, docs, str(tmp_path))
        assert name == "sharding" or docs.columns == before
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() > 0
