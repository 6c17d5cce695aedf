"""Physical plans: what is scanned, shuffled and broadcast."""

import pytest

import __spark_entry__ as entry
from marea.operators.drift import align_schema
from marea.plans import tabular_queries, text_queries
from marea.plans.inputs import DRIFT_EXPECTED

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - {"train_logistic", "train_forest", "run_log", "batch_score"}))
def test_no_pairs_and_no_single_task_sort(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for line in text.splitlines():
        if " Window [" in line or " Window " in line:
            assert "], [" in line      # every window is partitioned


@pytest.mark.parametrize("name", ["split_paragraphs", "filter_paragraphs", "chunk_documents", "html_to_text", "embed_hash"])
def test_text_operators_do_not_shuffle(spark, name, monkeypatch):
    monkeypatch.setattr("marea.plans.inputs.spread", lambda scan: scan)
    text = plan(text_queries.QUERIES[name](spark, SF_DIR))
    assert "Exchange" not in text
    assert text.count("md5(") <= 2 and text.count("split(") <= 1      # nothing is computed twice


def test_chunking_reads_two_columns(spark):
    text = plan(text_queries.chunk_documents(spark, SF_DIR))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_top_k_shuffles_only_the_best(spark):
    text = plan(text_queries.vector_topk(spark, SF_DIR))
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning") < text.index("MapInArrow")
    assert text.count("Exchange") == 1 and "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in text


def test_champion_limits_before_the_shuffle(spark):
    text = plan(tabular_queries.champion_run(spark, SF_DIR))
    assert text.count("WindowGroupLimit") == 2


def test_split_does_not_shuffle_rows(spark):
    text = plan(tabular_queries.stratified_split(spark, SF_DIR))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_alignment_is_one_projection(spark):
    customers = spark.read.parquet(f"{SF_DIR}/customer.parquet").withColumnRenamed("c_custkey", "cust_id")
    text = plan(align_schema(customers, DRIFT_EXPECTED))
    assert text.count("Project") == 1 and "Exchange" not in text


def test_duplicates_shuffle_digests(spark):
    text = plan(tabular_queries.duplicate_rows(spark, SF_DIR))
    assert "sha2" in text and "partial_count" in text
