"""What the plans must look like to hold on large data."""

import pytest
from pyspark.sql import functions as F

from foldloom.operators import checks
from foldloom.operators.dedup import dedup_first, with_order_key
from foldloom.operators.folds import dedup_and_fold
from foldloom.operators.pools import few_shot, rotate
from foldloom.plans.corpus import build_corpus
from foldloom.plans.registry import SPECS
from foldloom.operators.sinks import write_pools
from foldloom.sources.pools import parse_lines, pool_rows, record_facts, scan_lines

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def docs(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return with_order_key(rows.select(F.col("doc_id").alias("row_id"), "text", F.col("lang").alias("label")))


@pytest.mark.parametrize("rule", ["contiguous", "stratified"])
def test_folds_have_no_global_sort_and_no_product(docs, rule):
    text = plan(dedup_and_fold(docs, rule, fits=True))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "rangepartitioning", "Python", "Pandas"):
        assert bad not in text
    # What is gathered in one task is a count per prefix or per class, never a row.
    for i, line in enumerate(text.splitlines()):
        if "SinglePartition" in line:
            assert "HashAggregate" in text.splitlines()[i + 1] or "SortAggregate" in text.splitlines()[i + 1]


def test_dedup_limits_copies_before_the_shuffle(docs):
    text = plan(dedup_first(docs))
    assert text.count("WindowGroupLimit") == 2 and text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_dedup_without_text_does_not_shuffle_it(docs):
    for df in (dedup_first(docs).select("row_id"), dedup_first(docs).select("order_key", "label")):
        exchange = plan(df).split("Exchange")[1].split("Project")[1].split("\n")[0]
        assert "text#" not in exchange.split("unhex")[0]


def test_scan_reads_only_the_columns_in_use(docs):
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(dedup_first(docs).select("row_id"))


def test_rotation_is_narrow(docs):
    folded = dedup_and_fold(docs)
    assert plan(rotate(folded)).count("Exchange") == plan(folded).count("Exchange")


def test_few_shot_cuts_folds_before_rotating(docs):
    text = plan(few_shot(dedup_and_fold(docs), 4))
    # A plan is printed from its end to its start.
    assert text.index("WindowGroupLimit [k#") < text.index("Generate explode") < text.index("WindowGroupLimit [fold#")


def test_presence_checks_shuffle_digests(docs):
    pools = rotate(docs.withColumn("fold", F.lit(1))).select(F.lit("t").alias("task"), F.lit("c").alias("corpus"), "*")
    text = plan(checks.text_issues(checks.text_presence(record_facts(pool_rows(pools))), examples=False))
    assert "SortAggregate" not in text and "Python" not in text
    for line in text.splitlines():
        assert "Exchange" not in line or "text#" not in line


def test_rotation_check_reads_test_splits_only(spark, docs, tmp_path):
    write_pools(dedup_and_fold(docs), str(tmp_path), "t", "c")
    text = plan(checks.rotation_issues(record_facts(parse_lines(scan_lines(spark, str(tmp_path))))))
    assert "(split#" in text.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.corpus)
def test_corpora_need_no_python_workers(spark, spec):
    schema = "row_id bigint, fault string, " + ", ".join(f"`{c}` string" for c in spec.columns)
    raw = spark.createDataFrame([], schema)
    folded = build_corpus(raw, spec) if spec.has_closed_labels or spec.fold_rule == "contiguous" else None
    if folded is not None:
        text = plan(folded)
        assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text and "NestedLoop" not in text
