"""Queries on the quality checks: over clean pools and over pools with faults."""

from pyspark.sql import functions as F

from foldloom.operators import checks
from foldloom.operators.folds import dedup_and_fold
from foldloom.operators.pools import SPLITS, rotate
from foldloom.queries.folding import STRATIFIED_SQL
from foldloom.queries.tables import FOLDED_SQL, documents, rotated_sql, table
from foldloom.sources.pools import parse_lines, pool_rows, record_facts, scan_lines
from foldloom.storage import new_folder, stage

SHOWN = ["k", "split", "check", "severity", "n"]


def faulty_folds(spark, sf_dir):
    """Raw documents with their copies, a source belonging to one fold as a whole."""
    fold = F.expr("CAST(substring(source, 4) AS INT) DIV 4 + 1")
    docs = table(spark, sf_dir, "documents", "text", F.col("lang").alias("label"), fold.alias("fold"))
    return docs.select(F.lit("raw").alias("task"), F.lit("documents").alias("corpus"), "*")


def faulty_facts(spark, sf_dir):
    return rotate(record_facts(pool_rows(faulty_folds(spark, sf_dir))))


FAULTY_SQL = f"""
raw AS (SELECT text, lang AS label, CAST(substr(source, 4) AS INTEGER) // 4 + 1 AS fold FROM documents),
pools AS ({rotated_sql('raw', 'text, label')})
"""

# JSON lines with a different fault per source; the other sources are sound and carry the whole text.
FAULTY_LINE = """
CASE source WHEN 'src0' THEN concat('{"text": ', doc_id, ', "label": "', lang, '"}')
            WHEN 'src1' THEN concat('{"label": "', lang, '"}')
            WHEN 'src2' THEN concat(substring(sound, 1, length(sound) - length(lang) - 3), 'null}')
            WHEN 'src3' THEN concat('{"text": "  ", "label": "', lang, '"}')
            WHEN 'src4' THEN concat(substring(sound, 1, length(sound) - 1), ', "id": ', doc_id, '}')
            WHEN 'src5' THEN substring(sound, 1, length(sound) - 1)
            WHEN 'src6' THEN concat('{"text": [], "label": "', lang, '"}')
            ELSE sound END
"""
LANG_SPLIT = "CASE lang WHEN 'en' THEN 'train' WHEN 'fr' THEN 'valid' ELSE 'test' END"


def faulty_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    sound = F.to_json(F.struct("text", F.col("lang").alias("label")))
    return docs.withColumn("sound", sound).select(
        F.lit("raw").alias("task"),
        F.lit("documents").alias("corpus"),
        F.lit("01").alias("k"),
        F.expr(LANG_SPLIT).alias("split"),
        F.expr(FAULTY_LINE).alias("value"),
    )


FAULTY_LINES_SQL = f"""
lines AS (
  SELECT {LANG_SPLIT} AS split, {FAULTY_LINE} AS value
  FROM (SELECT *, CAST(json_object('text', text, 'label', lang) AS VARCHAR) AS sound FROM documents)),
parsed AS (
  SELECT split, json_valid(value) AS ok, CASE WHEN json_valid(value) THEN value END AS j FROM lines),
typed AS (
  SELECT split, ok, json_type(j, '$.text') AS text_type, json_type(j, '$.label') AS label_type,
         json_extract_string(j, '$.text') AS text, json_extract_string(j, '$.label') AS label, json_keys(j) AS keys
  FROM parsed)
"""


def check_values(spark, sf_dir):
    facts = record_facts(parse_lines(faulty_lines(spark, sf_dir)))
    return checks.place_issues(checks.profile(facts)).where("check <> 'split_share'").select(SHOWN)


def _count_sql(check, severity, condition):
    return f"SELECT split, '{check}' AS \"check\", '{severity}' AS severity, count(*) AS n FROM typed WHERE {condition} GROUP BY split"


CHECK_VALUES_SQL = f"WITH {FAULTY_LINES_SQL} SELECT '01' AS k, * FROM (" + " UNION ALL ".join(
    [
        _count_sql("bad_json", "ERROR", "NOT ok"),
        _count_sql("missing_keys", "ERROR", "ok AND NOT (list_contains(keys, 'text') AND list_contains(keys, 'label'))"),
        _count_sql("extra_keys", "WARN", "ok AND len(list_filter(keys, lambda x: x NOT IN ('text', 'label'))) > 0"),
        _count_sql("empty_text", "ERROR", "ok AND (text IS NULL OR trim(text) IN ('', '0', '[]'))"),
        _count_sql("empty_label", "ERROR", "ok AND (label IS NULL OR trim(label) = '')"),
        _count_sql("text_not_string", "ERROR", "ok AND text_type IS DISTINCT FROM 'VARCHAR'"),
        _count_sql("label_not_string", "ERROR", "ok AND label_type IS DISTINCT FROM 'VARCHAR'"),
    ]
) + ")"


def check_duplicates(spark, sf_dir):
    issues = checks.text_issues(checks.text_presence(faulty_facts(spark, sf_dir), examples=False), examples=False)
    return issues.where("check = 'duplicate_texts'").select(SHOWN)


DUPLICATES_SQL = """
SELECT k, split, 'duplicate_texts' AS "check", 'ERROR' AS severity, count(*) - count(DISTINCT text) AS n
FROM pools GROUP BY k, split HAVING count(*) > count(DISTINCT text)
"""


def check_leakage(spark, sf_dir):
    issues = checks.text_issues(checks.text_presence(faulty_facts(spark, sf_dir)))
    leaks = issues.where("check = 'leakage'")
    return leaks.select(*SHOWN, F.array_join("detail", "|").alias("examples"))


SHARED_SQL = """
masks AS (SELECT k, text, bool_or(split = 'train') AS tr, bool_or(split = 'valid') AS va, bool_or(split = 'test') AS te FROM pools GROUP BY k, text),
shared AS (
  SELECT k, 'train,valid' AS split, text FROM masks WHERE tr AND va
  UNION ALL SELECT k, 'train,test', text FROM masks WHERE tr AND te
  UNION ALL SELECT k, 'valid,test', text FROM masks WHERE va AND te)
"""
LEAKAGE_SQL = "SELECT k, split, 'leakage' AS \"check\", 'ERROR' AS severity, count(*) AS n FROM shared GROUP BY k, split"
CHECK_LEAKAGE_SQL = f"""
WITH {FAULTY_SQL}, {SHARED_SQL},
few AS (SELECT *, row_number() OVER (PARTITION BY k, split ORDER BY sha256(text)) AS no FROM shared),
shown AS (
  SELECT k, split, string_agg(example, '|' ORDER BY example) AS examples
  FROM (SELECT k, split, substr(text, 1, 60) AS example FROM few WHERE no <= 3) GROUP BY k, split)
SELECT c.*, examples FROM ({LEAKAGE_SQL}) c JOIN shown USING (k, split)
"""


def role_folds(spark, sf_dir):
    """Conversations with their turn as the fold, so that some roles are in few folds."""
    fold = F.least(F.col("turn") + 1, F.lit(5)).cast("int")
    rows = table(spark, sf_dir, "conversations", "text", F.col("role").alias("label"), fold.alias("fold"))
    return rows.select(F.lit("raw").alias("task"), F.lit("conversations").alias("corpus"), "*")


ROLE_POOLS_SQL = f"""
raw AS (SELECT text, role AS label, least(turn + 1, 5) AS fold FROM conversations),
pools AS ({rotated_sql('raw', 'text, label')})
"""


def check_labels(spark, sf_dir):
    facts = rotate(record_facts(pool_rows(role_folds(spark, sf_dir))))
    issues = checks.label_issues(checks.label_presence(facts))
    return issues.select(*SHOWN, F.array_join("detail", "|").alias("labels"))


LABEL_GAPS_SQL = """
have AS (SELECT k, label, bool_or(split = 'train') AS tr, bool_or(split = 'valid') AS va, bool_or(split = 'test') AS te FROM pools GROUP BY k, label),
filled AS (SELECT DISTINCT k, split FROM pools),
gaps AS (
  SELECT k, 'valid' AS split, 'labels_not_in_train' AS "check", label FROM have WHERE va AND NOT tr
  UNION ALL SELECT k, 'test', 'labels_not_in_train', label FROM have WHERE te AND NOT tr
  UNION ALL SELECT k, 'valid', 'labels_of_train_absent', label FROM have WHERE tr AND NOT va AND (k, 'valid') IN (SELECT (k, split) FROM filled)
  UNION ALL SELECT k, 'test', 'labels_of_train_absent', label FROM have WHERE tr AND NOT te AND (k, 'test') IN (SELECT (k, split) FROM filled))
"""
CHECK_LABELS_SQL = f"""
WITH {ROLE_POOLS_SQL}, {LABEL_GAPS_SQL}
SELECT k, split, "check", 'WARN' AS severity, count(*) AS n, string_agg(label, '|' ORDER BY label) AS labels FROM gaps GROUP BY k, split, "check"
"""


def check_shares(spark, sf_dir):
    """Orders with their status as the split: far from 60/20/20."""
    split = F.expr("CASE o_orderstatus WHEN 'O' THEN 'train' WHEN 'F' THEN 'valid' ELSE 'test' END")
    pools = table(
        spark, sf_dir, "orders", F.lit("raw").alias("task"), F.lit("orders").alias("corpus"),
        F.concat(F.lit("0"), F.substring("o_orderpriority", 1, 1)).alias("k"), split.alias("split"),
        F.col("o_orderkey").cast("string").alias("text"), F.col("o_orderstatus").alias("label"),
    )
    issues = checks.place_issues(checks.profile(record_facts(pool_rows(pools))))
    return issues.select(*SHOWN, F.array_join("detail", "|").alias("detail"))


SHARES_SQL = """
sizes AS (SELECT k, split, count(*) AS n FROM pools GROUP BY k, split),
shares AS (SELECT *, sum(n) OVER (PARTITION BY k) AS total, 100 * n / sum(n) OVER (PARTITION BY k) AS percent, CASE split WHEN 'train' THEN 60 ELSE 20 END AS expected FROM sizes)
"""
CHECK_SHARES_SQL = f"""
WITH pools AS (
  SELECT '0' || substr(o_orderpriority, 1, 1) AS k,
         CASE o_orderstatus WHEN 'O' THEN 'train' WHEN 'F' THEN 'valid' ELSE 'test' END AS split FROM orders),
{SHARES_SQL}
SELECT k, split, 'split_share' AS "check", 'WARN' AS severity, n,
       n || ' of ' || total || ' rows, expected ' || expected || '%' AS detail
FROM shares WHERE abs(percent - expected) > 5
"""


def check_rotations(spark, sf_dir):
    return checks.rotation_issues(faulty_facts(spark, sf_dir)).select(SHOWN)


ROTATIONS_SQL = """
SELECT a.k || ',' || b.k AS k, 'test' AS split, 'test_overlap' AS "check", 'ERROR' AS severity, count(*) AS n
FROM (SELECT DISTINCT k, text FROM pools WHERE split = 'test') a
JOIN (SELECT DISTINCT k, text FROM pools WHERE split = 'test') b ON a.text = b.text AND a.k < b.k GROUP BY ALL
"""


def check_presence(spark, sf_dir):
    """Customers as pools in which some segment and nation meet nowhere: splits without rows, without files, and too many folds."""
    split = F.expr("CASE WHEN c_mktsegment = 'BUILDING' THEN 'train' WHEN c_mktsegment = 'MACHINERY' THEN 'valid' ELSE 'test' END")
    base = table(
        spark, sf_dir, "customer", F.lit("raw").alias("task"), F.col("c_mktsegment").alias("corpus"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("k"), split.alias("split"),
        F.col("c_name").alias("text"), F.lit("x").alias("label"), "c_acctbal",
    )
    files = base.select("task", "corpus", "k", "split").distinct()
    profiles = checks.profile(record_facts(pool_rows(base.where("c_acctbal > 8000"))))
    issues = checks.place_issues(profiles, files).unionByName(checks.fold_count_issues(files))
    return issues.where("check <> 'split_share'").select("corpus", *SHOWN)


CHECK_PRESENCE_SQL = """
WITH base AS (
  SELECT c_mktsegment AS corpus, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS k, c_acctbal,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'train' WHEN c_mktsegment = 'MACHINERY' THEN 'valid' ELSE 'test' END AS split FROM customer),
files AS (SELECT DISTINCT corpus, k, split FROM base),
filled AS (SELECT DISTINCT corpus, k, split FROM base WHERE c_acctbal > 8000),
grid AS (SELECT DISTINCT corpus, k, s AS split FROM files, (VALUES ('train'), ('valid'), ('test')) AS v(s))
SELECT corpus, k, split, 'missing_file' AS "check", 'ERROR' AS severity, CAST(1 AS BIGINT) AS n FROM grid WHERE (corpus, k, split) NOT IN (SELECT (corpus, k, split) FROM files)
UNION ALL SELECT corpus, k, split, 'empty_split', 'ERROR', 1 FROM files WHERE (corpus, k, split) NOT IN (SELECT (corpus, k, split) FROM filled)
UNION ALL SELECT corpus, NULL, NULL, 'fold_count', 'INFO', count(DISTINCT k) FROM files GROUP BY corpus HAVING count(DISTINCT k) <> 5
"""

# Corpora of the status queries: raw documents by language, folded documents, conversations, and one that is not there.
REGISTRY = [("raw", name) for name in ("en", "fr", "de", "es", "pt")] + [("clean", "documents"), ("raw", "conversations")]


def _status(spark, sf_dir):
    raw = faulty_folds(spark, sf_dir).withColumn("corpus", F.col("label"))
    names = [F.lit("clean").alias("task"), F.lit("documents").alias("corpus")]
    clean = dedup_and_fold(documents(spark, sf_dir)).select(*names, "text", "label", "fold")
    folds = raw.unionByName(clean).unionByName(role_folds(spark, sf_dir))
    facts = rotate(stage(record_facts(pool_rows(folds))))
    files = facts.select("task", "corpus", "k", "split").distinct()
    issues = checks.all_issues(facts, files, examples=False)
    return checks.corpus_status(checks.registry_table(spark, REGISTRY), issues, files)


STATUS_CTE = f"""
WITH {FOLDED_SQL},
raw_docs AS (SELECT text, lang AS label, CAST(substr(source, 4) AS INTEGER) // 4 + 1 AS fold FROM documents),
raw_talk AS (SELECT text, role AS label, least(turn + 1, 5) AS fold FROM conversations),
all_pools AS (
  SELECT 'raw' AS task, label AS corpus, * FROM ({rotated_sql('raw_docs', 'text, label')})
  UNION ALL SELECT 'clean', 'documents', * FROM ({rotated_sql('folded', 'text, lang')})
  UNION ALL SELECT 'raw', 'conversations', * FROM ({rotated_sql('raw_talk', 'text, label')})),
per_text AS (
  SELECT task, corpus, k, text, count(DISTINCT split) AS splits, count(*) AS copies, bool_or(split = 'test') AS tested
  FROM all_pools GROUP BY ALL),
per_split AS (
  SELECT *, sum(n) OVER (PARTITION BY task, corpus, k) AS total
  FROM (SELECT task, corpus, k, split, count(*) AS n FROM all_pools GROUP BY task, corpus, k, split)),
per_label AS (
  SELECT task, corpus, k, label, bool_or(split = 'train') AS tr, bool_or(split = 'valid') AS va, bool_or(split = 'test') AS te
  FROM all_pools GROUP BY ALL),
findings AS (
  SELECT task, corpus, 2 AS severity FROM per_text WHERE splits > 1 OR copies > 1
  UNION ALL SELECT task, corpus, 2 FROM per_text WHERE tested GROUP BY task, corpus, text HAVING count(*) > 1
  UNION ALL SELECT task, corpus, 2 FROM per_split GROUP BY task, corpus, k HAVING count(*) < 3
  UNION ALL SELECT task, corpus, 1 FROM per_split WHERE abs(100 * n / total - CASE split WHEN 'train' THEN 60 ELSE 20 END) > 5
  UNION ALL SELECT task, corpus, 1 FROM per_label WHERE (tr <> va) OR (tr <> te)),
registry AS (SELECT * FROM (VALUES {', '.join(str(pair) for pair in REGISTRY)}) AS v(task, corpus)),
worst AS (SELECT task, corpus, max(severity) AS severity FROM findings GROUP BY task, corpus),
there AS (SELECT DISTINCT task, corpus, true AS found FROM all_pools),
status AS (
  SELECT task, corpus, CASE WHEN found IS NULL THEN 'MISSING' WHEN severity = 2 THEN 'FAIL' WHEN severity = 1 THEN 'WARN' ELSE 'OK' END AS status
  FROM registry LEFT JOIN there USING (task, corpus) LEFT JOIN worst USING (task, corpus))
"""


def corpus_status(spark, sf_dir):
    return _status(spark, sf_dir)


def status_summary(spark, sf_dir):
    return checks.status_summary(_status(spark, sf_dir))


def status_gate(spark, sf_dir):
    return checks.gate(_status(spark, sf_dir))


def check_clean_folds(spark, sf_dir):
    """What all checks have read of deduped and folded documents, and what they found: nothing but warnings about labels may come."""
    names = [F.lit("clean").alias("task"), F.lit("documents").alias("corpus")]
    folds = dedup_and_fold(documents(spark, sf_dir), "stratified").select(*names, "text", "label", "fold")
    facts = rotate(stage(record_facts(pool_rows(folds))))
    issues = checks.all_issues(facts, examples=False).groupBy("k", "split").agg(
        F.count_if(F.col("severity") == "ERROR").alias("n_errors"), F.count_if(F.col("check") == "split_share").alias("n_share_warnings")
    )
    texts = checks.text_presence(facts, examples=False)
    read = texts.groupBy("k").agg(*[F.sum(f"in_{split}").alias(split) for split in SPLITS], F.count("*").alias("n_texts"))
    rows = read.select("k", "n_texts", F.inline(F.array(*[F.struct(F.lit(split).alias("split"), F.col(split).alias("n_rows")) for split in SPLITS])))
    found = rows.join(issues, ["k", "split"], "left")
    return found.select("k", "split", "n_rows", "n_texts", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_errors", "n_share_warnings")])


CHECK_CLEAN_FOLDS_SQL = f"""
WITH {STRATIFIED_SQL},
pools AS ({rotated_sql('strat JOIN uniq USING (doc_id)', 'text')}),
sizes AS (SELECT k, split, count(*) AS n_rows FROM pools GROUP BY k, split),
texts AS (SELECT k, count(DISTINCT text) AS n_texts FROM pools GROUP BY k),
twice AS (SELECT k, split, count(*) - count(DISTINCT text) AS n FROM pools GROUP BY k, split)
SELECT k, split, n_rows, n_texts, CAST(n > 0 AS BIGINT) AS n_errors,
       CAST(abs(100 * n_rows / n_texts - CASE split WHEN 'train' THEN 60 ELSE 20 END) > 5 AS BIGINT) AS n_share_warnings
FROM sizes JOIN texts USING (k) JOIN twice USING (k, split)
"""


def check_utf8(spark, sf_dir):
    """Written lines of which some hold bytes that are not UTF-8, inside and outside of the JSON strings."""
    root = new_folder(spark)
    docs = table(spark, sf_dir, "documents", "text", "lang", "source")
    sound = F.to_json(F.struct("text", F.col("lang").alias("label"))).cast("binary")
    broken = F.expr(
        """CASE source WHEN 'src1' THEN concat(binary('{"text": "'), unhex('E7E36F'), binary('", "label": "x"}'))
                       WHEN 'src2' THEN concat(sound, unhex('C3')) WHEN 'src3' THEN unhex('FFFE') ELSE sound END"""
    )
    lines = docs.withColumn("sound", sound).select(F.expr(LANG_SPLIT).alias("split"), broken.cast("string").alias("value"))
    # The text sink writes the bytes of a string as they are.
    lines.write.partitionBy("split").text(f"{root}/task=raw/corpus=documents/k=01")
    facts = record_facts(parse_lines(scan_lines(spark, root)))
    return checks.place_issues(checks.profile(facts)).where("check <> 'split_share'").select(SHOWN)


CHECK_UTF8_SQL = f"""
SELECT '01' AS k, {LANG_SPLIT} AS split, "check", 'ERROR' AS severity, count(*) AS n
FROM documents, (VALUES ('bad_utf8'), ('bad_json')) AS v("check") WHERE source IN ('src1', 'src2', 'src3') GROUP BY ALL
"""

QUERIES = {
    "check_values": (check_values, CHECK_VALUES_SQL),
    "check_duplicates": (check_duplicates, f"WITH {FAULTY_SQL} {DUPLICATES_SQL}"),
    "check_leakage": (check_leakage, CHECK_LEAKAGE_SQL),
    "check_labels": (check_labels, CHECK_LABELS_SQL),
    "check_shares": (check_shares, CHECK_SHARES_SQL),
    "check_rotations": (check_rotations, f"WITH {FAULTY_SQL} {ROTATIONS_SQL}"),
    "check_presence": (check_presence, CHECK_PRESENCE_SQL),
    "check_clean_folds": (check_clean_folds, CHECK_CLEAN_FOLDS_SQL),
    "check_utf8": (check_utf8, CHECK_UTF8_SQL),
    "corpus_status": (corpus_status, f"{STATUS_CTE} SELECT * FROM status"),
    "status_summary": (
        status_summary,
        f"{STATUS_CTE} SELECT status, count(*) AS n_corpora FROM status GROUP BY status",
    ),
    "status_gate": (
        status_gate,
        f"""{STATUS_CTE} SELECT NOT bool_or(status IN ('FAIL', 'MISSING')) AS passed,
        CASE WHEN bool_or(status IN ('FAIL', 'MISSING')) THEN 'FAILED' WHEN bool_or(status = 'WARN') THEN 'PASSED_WITH_WARNINGS'
             ELSE 'PASSED' END AS verdict FROM status""",
    ),
}
