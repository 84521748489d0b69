"""Every query with a SQL form against it, on whole tables; and what the registry holds."""

import pytest

import __spark_entry__ as entry
import compare
import corpus_pipeline
from llm_fixtures import SMALL, workers_can_import  # noqa: F401
from snapline.llm import oracle, queries

SQL = oracle.oracle_sql()


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, name):
    assert compare.difference(queries.queries()[name](spark, SMALL), compare.connect(SMALL), SQL[name]) is None


def test_registry():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(names) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "source_mixing", "sharding"]


def test_mix_targets_equal_sql(spark):
    rows = queries.queries()["op2_source_mixing"](spark, SMALL).persist()
    assert compare.difference(rows.drop("taken"), compare.connect(SMALL), oracle.OP2) is None
    assert rows.filter("taken > 3 * size OR taken % greatest(size, 1) <> 0").isEmpty()
    rows.unpersist()


@pytest.mark.parametrize("name", ["op1_quality_rules", "op3_secret_scan", "op8_chat_format", "op9_sharding"])
def test_native_plans_have_no_python(spark, name):
    plan = queries.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
