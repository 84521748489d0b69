"""Registered queries of the corpus operators: each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snapline.llm import chat, decontamination, language, mixing, neardup, packing, quality, runs, search, secrets, sharding, toxicity, urls
from snapline.llm.common import importable

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: tuple[Query, ...] = (
    quality.op1_quality_rules,
    mixing.op2_source_mixing,
    secrets.op3_secret_scan,
    toxicity.op4_toxicity,
    neardup.op5_minhash_dedup,
    urls.op6_url_filter,
    decontamination.op7_decontamination,
    chat.op8_chat_format,
    sharding.op9_sharding,
    language.op10_language_id,
    runs.op11_periodic_runs,
    packing.op12_packing,
    search.op13_lexical_search,
)


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {q.__name__: _ready(q) for q in _QUERIES}
