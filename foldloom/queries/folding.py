"""Queries on dedup, folds, rotation and sampling."""

from pyspark.sql import functions as F

from foldloom.operators.dedup import dedup_first, dedup_stats, with_order_key
from foldloom.operators.folds import dedup_and_fold, seeded_position, small_strata
from foldloom.operators.pools import few_shot, rotate, split_sizes
from foldloom.plans.corpus import build_corpora
from foldloom.plans.spec import CorpusSpec
from foldloom.queries.tables import FOLDED_SQL, documents, offense_rows, rotated_sql, table


def dedup_survivors(spark, sf_dir):
    return dedup_first(documents(spark, sf_dir)).select(F.col("row_id").alias("doc_id"), "label", "text")


DEDUP_SURVIVORS_SQL = f"WITH {FOLDED_SQL} SELECT doc_id, lang AS label, text FROM uniq"


def dedup_counts(spark, sf_dir):
    """Per language, and so a text in two languages stays in both."""
    return dedup_stats(documents(spark, sf_dir), ["label"])


DEDUP_COUNTS_SQL = """
SELECT lang AS label, count(*) AS rows_before, count(DISTINCT text) AS rows_after, count(*) - count(DISTINCT text) AS rows_removed
FROM documents GROUP BY lang
"""


def seeded_shuffle(spark, sf_dir):
    placed = seeded_position(dedup_first(documents(spark, sf_dir)))
    return placed.select(F.col("row_id").alias("doc_id"), "position")


SEEDED_SHUFFLE_SQL = f"WITH {FOLDED_SQL} SELECT doc_id, row_number() OVER (ORDER BY h) - 1 AS position FROM uniq"


def folds_contiguous(spark, sf_dir):
    return dedup_and_fold(documents(spark, sf_dir)).select(F.col("row_id").alias("doc_id"), "label", "fold")


FOLDS_CONTIGUOUS_SQL = f"WITH {FOLDED_SQL} SELECT doc_id, lang AS label, fold FROM folded"


def folds_stratified(spark, sf_dir):
    folded = dedup_and_fold(documents(spark, sf_dir), "stratified")
    return folded.select(F.col("row_id").alias("doc_id"), "label", "fold")


STRATIFIED_SQL = f"""
{FOLDED_SQL},
classes AS (SELECT lang, count(*) AS n, sum(count(*)) OVER (ORDER BY md5('=' || lang)) - count(*) AS first FROM uniq GROUP BY lang),
upto AS (
  SELECT lang, i, sum((first + n - i + 4) // 5 - (first - i + 4) // 5) OVER (PARTITION BY lang ORDER BY i) AS rows_upto
  FROM classes, range(0, 4) AS r(i)),
ranked AS (SELECT doc_id, lang, h, row_number() OVER (PARTITION BY lang ORDER BY h) - 1 AS p FROM uniq),
strat AS (
  SELECT doc_id, ranked.lang, h, CAST(1 + count(*) FILTER (WHERE rows_upto <= p) AS INTEGER) AS fold
  FROM ranked JOIN upto ON ranked.lang = upto.lang GROUP BY ALL)
"""
FOLDS_STRATIFIED_SQL = f"WITH {STRATIFIED_SQL} SELECT doc_id, lang AS label, fold FROM strat"


def folds_open_labels(spark, sf_dir):
    """Line items with part and supplier as the label: about as many classes as rows, most of them smaller than the folds."""
    key = F.concat_ws("/", "l_orderkey", "l_linenumber").alias("text")
    rows = table(spark, sf_dir, "lineitem", key, F.concat_ws("/", "l_partkey", "l_suppkey").alias("label"))
    # Some keys occur twice: the smaller label stays.
    folded = dedup_and_fold(with_order_key(rows.withColumn("row_id", F.col("label"))), "stratified")
    return folded.select("text", "label", "fold")


FOLDS_OPEN_LABELS_SQL = """
WITH rows AS (
  SELECT l_orderkey || '/' || l_linenumber AS text, min(l_partkey || '/' || l_suppkey) AS label
  FROM lineitem GROUP BY ALL),
placed AS (
  SELECT text, label, count(*) OVER (PARTITION BY label) AS n,
         row_number() OVER (PARTITION BY label ORDER BY sha256('42|' || text)) - 1 AS p,
         row_number() OVER (ORDER BY md5('=' || label), sha256('42|' || text)) - 1 AS place FROM rows),
shares AS (SELECT text, label, p, f, (place - p + n - f + 4) // 5 - (place - p - f + 4) // 5 AS share FROM placed, range(0, 5) AS r(f)),
upto AS (SELECT text, label, p, f, sum(share) OVER (PARTITION BY text ORDER BY f) AS upto FROM shares)
SELECT text, label, CAST(1 + count(*) FILTER (WHERE upto <= p) AS INTEGER) AS fold FROM upto GROUP BY text, label
"""


def strata_report(spark, sf_dir):
    """Classes too small for the folds: here the lengths of parts' names as classes of brands."""
    parts = table(spark, sf_dir, "part", "p_brand", F.concat_ws("/", "p_type", "p_size").alias("label"))
    return small_strata(parts, ["p_brand"])


STRATA_REPORT_SQL = """
WITH s AS (SELECT p_brand, concat_ws('/', p_type, p_size) AS label, count(*) AS n FROM part GROUP BY ALL),
     m AS (SELECT *, max(n) OVER (PARTITION BY p_brand) AS largest FROM s)
SELECT p_brand, label, n, CASE WHEN largest < 5 THEN 'FAIL' ELSE 'WARN' END AS severity FROM m WHERE n < 5
"""


def cv_rotation(spark, sf_dir):
    folded = dedup_and_fold(documents(spark, sf_dir)).select(F.col("row_id").alias("doc_id"), "fold")
    return rotate(folded).select("doc_id", "k", "split")


CV_ROTATION_SQL = f"WITH {FOLDED_SQL} SELECT doc_id, k, split FROM ({rotated_sql('folded', 'doc_id')})"


def pool_sizes(spark, sf_dir):
    return split_sizes(dedup_and_fold(offense_rows(spark, sf_dir)))


POOL_SIZES_SQL = f"""
WITH j AS (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS copy FROM documents JOIN labels USING (doc_id)),
folded AS (SELECT doc_id, ntile(5) OVER (ORDER BY sha256('42|' || text)) AS fold FROM j WHERE copy = 1)
SELECT k, split, count(*) AS n_rows FROM ({rotated_sql('folded', 'doc_id')}) GROUP BY k, split
"""


def few_shot_train(spark, sf_dir):
    folded = dedup_and_fold(documents(spark, sf_dir))
    shots = few_shot(folded, 4)
    return shots.select(F.col("row_id").alias("doc_id"), "k", "label", F.col("shot").cast("bigint").alias("shot"))


FEW_SHOT_SQL = f"""
WITH {FOLDED_SQL},
ranked AS (
  SELECT doc_id, k, lang AS label, row_number() OVER (PARTITION BY k, lang ORDER BY h) AS shot
  FROM ({rotated_sql('folded', 'doc_id, lang, h')}) WHERE split = 'train')
SELECT doc_id, k, label, shot FROM ranked WHERE shot <= 4
"""

DOCUMENT_CORPORA = [
    CorpusSpec("category", "documents", [], "text", "source"),
    CorpusSpec("intent", "conversations", [], "text", "role"),
    CorpusSpec("hate", "benchmark", [], "text", "code", label_rule="strict_integer", labels={0: "zero"}),
]


def corpora_in_one_job(spark, sf_dir):
    """Three corpora in one plan; the last has a bad label and is left out whole."""
    rows = table(spark, sf_dir, "conversations", F.expr("conv_id * 1000 + turn").alias("row_id"), "text", "role")
    inputs = [
        table(spark, sf_dir, "documents", F.col("doc_id").alias("row_id"), "text", "source"),
        rows,
        table(spark, sf_dir, "benchmark", F.col("item_id").alias("row_id"), "text").withColumn(
            "code", F.when(F.col("row_id") == 7, "seven").otherwise("0")
        ),
    ]
    folded = build_corpora(list(zip(DOCUMENT_CORPORA, inputs)))
    return folded.select("task", "corpus", "row_id", "label", "fold")


CORPORA_SQL = """
WITH rows AS (
  SELECT 'category' AS task, 'documents' AS corpus, doc_id AS row_id, text, source AS label FROM documents
  UNION ALL SELECT 'intent', 'conversations', conv_id * 1000 + turn, text, role FROM conversations),
c AS (SELECT *, row_number() OVER (PARTITION BY corpus, text ORDER BY row_id) AS copy FROM rows)
SELECT task, corpus, row_id, label, CAST(ntile(5) OVER (PARTITION BY corpus ORDER BY sha256('42|' || text)) AS INTEGER) AS fold
FROM c WHERE copy = 1
"""

QUERIES = {
    "dedup_first": (dedup_survivors, DEDUP_SURVIVORS_SQL),
    "dedup_stats": (dedup_counts, DEDUP_COUNTS_SQL),
    "seeded_shuffle": (seeded_shuffle, SEEDED_SHUFFLE_SQL),
    "folds_contiguous": (folds_contiguous, FOLDS_CONTIGUOUS_SQL),
    "folds_stratified": (folds_stratified, FOLDS_STRATIFIED_SQL),
    "folds_open_labels": (folds_open_labels, FOLDS_OPEN_LABELS_SQL),
    "small_strata": (strata_report, STRATA_REPORT_SQL),
    "cv_rotation": (cv_rotation, CV_ROTATION_SQL),
    "split_sizes": (pool_sizes, POOL_SIZES_SQL),
    "few_shot": (few_shot_train, FEW_SHOT_SQL),
    "corpora_in_one_job": (corpora_in_one_job, CORPORA_SQL),
}
