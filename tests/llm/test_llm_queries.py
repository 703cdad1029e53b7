"""The registered queries against their SQL, and the stages of the pipeline on their own input."""

from __future__ import annotations

import corpus_pipeline
import pytest
from oracle_check import compare, connect

from eavcube.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert compare(df, connect(FOLDER), name) is None
    if name == "op1_mix_sources":
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) - set(ORACLES) == {"op7_remove_repeats", "op8_quality_scores", "op9_find_personal_data",
                                            "op13_extract_main_text"}


def test_pipeline_stages_keep_columns_and_shrink(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, FOLDER))
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= seen and ids
        assert docs.columns == (columns if name != "mix" else [*columns, "copy"])
        seen = ids
    empty = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0
