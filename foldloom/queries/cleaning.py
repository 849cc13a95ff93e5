"""Queries on scalar cleaning, labels and accounting."""

from pyspark.sql import functions as F

from foldloom.functions.json import truthy_string
from foldloom.functions.labels import mapped, star_polarity
from foldloom.functions.numeric import to_integer, to_number
from foldloom.functions.text import first_item, is_blank, na_to_null, strip, title_and_body
from foldloom.operators.cleaning import corpus_gate, drop_blank, kept_rows, reject_report, tag_rows
from foldloom.operators.labels import relabel_by_table, relabel_drop, relabel_keep, unmapped_report, whitelist
from foldloom.plans.spec import CorpusSpec
from foldloom.plans.vocabularies import OFFENSE, POLARITY
from foldloom.queries.tables import table

# White space of several kinds around some of the texts, and texts that are nothing else.
DIRTY_TEXT = """
CASE source WHEN 'src0' THEN '' WHEN 'src1' THEN concat(' ', chr(9), chr(160)) WHEN 'src2' THEN NULL
            WHEN 'src3' THEN concat(chr(9), ' ', text, chr(10), ' ') WHEN 'src4' THEN concat(chr(160), text, chr(13))
            WHEN 'src5' THEN concat(chr(28), text, chr(133)) ELSE text END
"""
# DuckDB spells the same code points with chr() as well.
WHITE_SPACE_SQL = " || ".join(f"chr({n})" for n in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8232, 8233, 8239, 8287, 12288, *range(8192, 8203)))


def clean_blank_null(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", F.expr(DIRTY_TEXT).alias("text"))
    return drop_blank(docs.withColumn("text", strip(F.col("text"))), "text")


CLEAN_BLANK_NULL_SQL = f"""
SELECT doc_id, text FROM (
  SELECT doc_id, trim({DIRTY_TEXT}, {WHITE_SPACE_SQL}) AS text FROM documents)
WHERE length(text) > 0
"""

TITLE = "CASE WHEN url LIKE '%#top' OR url LIKE '%//m.%' THEN NULL ELSE concat(url, ' ') END"
BODY = "CASE WHEN url LIKE 'https://m.%' OR url LIKE '%ref=x' THEN NULL ELSE html END"


def title_body_concat(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", "page_id", F.expr(TITLE).alias("title"), F.expr(BODY).alias("body"))
    text = strip(title_and_body(F.col("title"), F.col("body")))
    return pages.select("page_id", text.alias("text")).where(F.length("text") > 0)


TITLE_BODY_CONCAT_SQL = f"""
SELECT page_id, text FROM (
  SELECT page_id, trim(coalesce({TITLE}, '') || ' ' || coalesce({BODY}, ''), {WHITE_SPACE_SQL}) AS text FROM pages)
WHERE length(text) > 0
"""

# Values as strings, some of them no numbers.
SPOILED_VALUE = """
CASE event_type WHEN 'error' THEN concat('x', CAST(value AS STRING)) WHEN 'signup' THEN concat(CAST(value AS STRING), 'd')
                WHEN 'view' THEN concat(' -', CAST(value AS STRING), ' ') ELSE CAST(value AS STRING) END
"""
NUMBER_SQL = "CASE WHEN regexp_matches(v, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$') THEN TRY_CAST(trim(v) AS DOUBLE) END"


def numeric_lenient(spark, sf_dir):
    events = table(spark, sf_dir, "events", "event_id", F.expr(SPOILED_VALUE).alias("v"))
    numbers = events.select("event_id", to_number(F.col("v")).alias("number"))
    return numbers.where("number IS NOT NULL").withColumn("whole", to_integer(F.col("number")))


NUMERIC_LENIENT_SQL = f"""
SELECT event_id, number, CAST(trunc(number) AS INTEGER) AS whole FROM (
  SELECT event_id, {NUMBER_SQL} AS number FROM (SELECT event_id, {SPOILED_VALUE} AS v FROM events))
WHERE number IS NOT NULL
"""

STRICT = CorpusSpec("hate", "events", [], "event_type", "v", label_rule="strict_integer", labels=OFFENSE)


def numeric_strict_gate(spark, sf_dir):
    """Every event type as a corpus whose label must be 0 or 1 after truncation."""
    raw = table(
        spark, sf_dir, "events", F.col("event_id").alias("row_id"), "event_type", F.expr(SPOILED_VALUE).alias("v")
    )
    tagged = tag_rows(raw, STRICT).withColumnRenamed("text", "corpus")
    return corpus_gate(tagged)


NUMERIC_STRICT_GATE_SQL = f"""
WITH n AS (SELECT event_type, {NUMBER_SQL} AS number FROM (SELECT event_type, {SPOILED_VALUE} AS v FROM events))
SELECT event_type AS corpus, count(*) AS rows_in, count(*) FILTER (WHERE trunc(number) IN (0, 1)) AS rows_kept,
       CASE WHEN count(*) FILTER (WHERE number IS NULL) > 0 THEN 'BAD_LABEL_TYPE'
            WHEN count(*) FILTER (WHERE trunc(number) IN (0, 1)) = 0 THEN 'EMPTY' ELSE 'OK' END AS status
FROM n GROUP BY event_type
"""

LABEL_LIST = "CASE lang WHEN 'es' THEN concat(',', source) WHEN 'fr' THEN concat(' ', lang, ' ,', source) ELSE concat(lang, ', ', source) END"


def first_label(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", F.expr(LABEL_LIST).alias("labels"))
    return docs.select("doc_id", first_item(F.col("labels")).alias("label")).where(~is_blank(F.col("label")))


FIRST_LABEL_SQL = f"""
SELECT doc_id, label FROM (SELECT doc_id, trim(split_part({LABEL_LIST}, ',', 1)) AS label FROM documents)
WHERE label <> ''
"""

TURN_OR_NULL = "CASE WHEN turn % 3 = 1 THEN NULL ELSE text END"
TWEETS = CorpusSpec("reviews", "tweets", [], "tweet", "role", null_text="nan", admitted=("user", "assistant"))


def null_text_as_nan(spark, sf_dir):
    """Missing texts as the text ``nan``, which older corpora hold."""
    row_id = F.expr("conv_id * 1000 + turn").alias("row_id")
    raw = table(spark, sf_dir, "conversations", row_id, F.expr(TURN_OR_NULL).alias("tweet"), "role")
    return kept_rows(tag_rows(raw, TWEETS))


NULL_TEXT_AS_NAN_SQL = f"""
SELECT conv_id * 1000 + turn AS row_id, coalesce({TURN_OR_NULL}, 'nan') AS text, role AS label FROM conversations
WHERE role IN ('user', 'assistant')
"""

BRAND_WITH_TOKENS = """
CASE p_type WHEN 'ECONOMY' THEN 'NA' WHEN 'LARGE' THEN 'null' WHEN 'SMALL' THEN '' WHEN 'MEDIUM' THEN ' NA '
            WHEN 'STANDARD' THEN 'none' ELSE p_brand END
"""


def na_tokens(spark, sf_dir):
    parts = table(spark, sf_dir, "part", "p_partkey", F.expr(BRAND_WITH_TOKENS).alias("brand"))
    return parts.withColumn("brand", na_to_null(F.col("brand")))


NA_TOKENS_SQL = f"""
SELECT p_partkey, CASE WHEN brand IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN',
       '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN NULL ELSE brand END AS brand
FROM (SELECT p_partkey, {BRAND_WITH_TOKENS} AS brand FROM part)
"""


def truthy_values(spark, sf_dir):
    """A JSON value that counts as missing when it is 0."""
    value = F.try_variant_get(F.try_parse_json("props"), "$.k", "variant")
    events = table(spark, sf_dir, "events", "event_id", "props")
    return events.select("event_id", truthy_string(value).alias("k")).where("k IS NOT NULL")


TRUTHY_VALUES_SQL = """
SELECT event_id, json_extract_string(props, '$.k') AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) <> 0
"""

ADMITTED = ("src1", "src3", "src5", "SRC7")


def label_whitelist(spark, sf_dir):
    return whitelist(table(spark, sf_dir, "documents", "doc_id", F.col("source").alias("label")), ADMITTED)


LABEL_WHITELIST_SQL = f"SELECT doc_id, source AS label FROM documents WHERE source IN {ADMITTED}"

LANGUAGES = {"en": "inglês", "fr": "francês", "DE": "alemão"}


def relabel_keeping(spark, sf_dir):
    return relabel_keep(table(spark, sf_dir, "documents", "doc_id", F.col("lang").alias("label")), LANGUAGES)


RELABEL_KEEPING_SQL = """
SELECT doc_id, CASE lang WHEN 'en' THEN 'inglês' WHEN 'fr' THEN 'francês' WHEN 'DE' THEN 'alemão' ELSE lang END AS label FROM documents
"""

SECTIONS = {"src0": "um", "src1": "um", "src2": "um", "src3": "dois", "src4": "dois", "src10": "três", "SRC11": "três"}


def relabel_merging(spark, sf_dir):
    return relabel_drop(table(spark, sf_dir, "documents", "doc_id", F.col("source").alias("label")), SECTIONS)


RELABEL_MERGING_SQL = """
SELECT doc_id, CASE WHEN source IN ('src0', 'src1', 'src2') THEN 'um' WHEN source IN ('src3', 'src4') THEN 'dois' ELSE 'três' END AS label
FROM documents WHERE source IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src10')
"""


def relabel_from_table(spark, sf_dir):
    """Nation keys of customers by names; nations of one region have no name and keep the key."""
    customers = table(spark, sf_dir, "customer", "c_custkey", F.col("c_nationkey").cast("string").alias("label"))
    nations = table(spark, sf_dir, "nation").where("n_regionkey <> 0")
    names = nations.select(F.col("n_nationkey").cast("string").alias("raw"), F.col("n_name").alias("label"))
    return relabel_by_table(customers, names)


RELABEL_FROM_TABLE_SQL = """
SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS label
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 0
"""


def stars_polarity(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    stars = to_integer(F.col("l_quantity") / 10)
    return lines.select("l_orderkey", "l_linenumber", star_polarity(stars).alias("label")).where("label IS NOT NULL")


STARS_POLARITY_SQL = """
SELECT l_orderkey, l_linenumber, CASE WHEN trunc(l_quantity / 10) IN (1, 2) THEN 'Negativo' ELSE 'Positivo' END AS label
FROM lineitem WHERE trunc(l_quantity / 10) IN (1, 2, 4, 5)
"""


def offense_names(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return labels.select(
        "doc_id",
        mapped(F.col("toxic"), OFFENSE).alias("toxic_name"),
        mapped(F.col("quality"), POLARITY).alias("quality_name"),
    )


OFFENSE_NAMES_SQL = """
SELECT doc_id, CASE toxic WHEN 0 THEN 'Não Ofensivo' WHEN 1 THEN 'Ofensivo' END AS toxic_name,
       CASE quality WHEN 0 THEN 'Negativo' WHEN 1 THEN 'Positivo' END AS quality_name FROM labels
"""


def unmapped_labels(spark, sf_dir):
    return unmapped_report(table(spark, sf_dir, "documents", F.col("source").alias("label")), SECTIONS)


UNMAPPED_LABELS_SQL = """
SELECT source AS label, count(*) AS n_rows FROM documents
WHERE source NOT IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src10', 'SRC11') GROUP BY source
"""

REVIEW = CorpusSpec(
    "reviews", "documents", [], "dirty", "stars", null_text="", strip_text=True, drop_blank_text=True,
    label_rule="lenient_integer", labels=POLARITY,
)
STARS = "CASE lang WHEN 'es' THEN 'x' WHEN 'de' THEN '3' ELSE CAST(quality AS STRING) END"


def reject_accounting(spark, sf_dir):
    """Rows per rule that rejects them first: blank text, no label, no number, label not admitted."""
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", F.expr(DIRTY_TEXT).alias("dirty"))
    raw = docs.join(table(spark, sf_dir, "labels", "doc_id", "quality"), "doc_id", "left")
    return reject_report(tag_rows(raw.withColumn("stars", F.expr(STARS)).withColumnRenamed("doc_id", "row_id"), REVIEW))


REJECT_ACCOUNTING_SQL = f"""
WITH r AS (SELECT coalesce(trim({DIRTY_TEXT}, {WHITE_SPACE_SQL}), '') AS text, {STARS} AS stars
           FROM documents LEFT JOIN labels USING (doc_id))
SELECT CASE WHEN text = '' THEN 'blank_text' WHEN stars IS NULL THEN 'null_label' WHEN stars = 'x' THEN 'not_a_number'
            WHEN stars NOT IN ('0', '1') THEN 'label_not_admitted' ELSE 'kept' END AS reason, count(*) AS n_rows
FROM r GROUP BY ALL
"""

QUERIES = {
    "clean_blank_null": (clean_blank_null, CLEAN_BLANK_NULL_SQL),
    "null_text_as_nan": (null_text_as_nan, NULL_TEXT_AS_NAN_SQL),
    "title_body_concat": (title_body_concat, TITLE_BODY_CONCAT_SQL),
    "numeric_lenient": (numeric_lenient, NUMERIC_LENIENT_SQL),
    "numeric_strict_gate": (numeric_strict_gate, NUMERIC_STRICT_GATE_SQL),
    "first_label": (first_label, FIRST_LABEL_SQL),
    "na_tokens": (na_tokens, NA_TOKENS_SQL),
    "truthy_values": (truthy_values, TRUTHY_VALUES_SQL),
    "label_whitelist": (label_whitelist, LABEL_WHITELIST_SQL),
    "relabel_keep": (relabel_keeping, RELABEL_KEEPING_SQL),
    "relabel_drop_merge": (relabel_merging, RELABEL_MERGING_SQL),
    "relabel_by_table": (relabel_from_table, RELABEL_FROM_TABLE_SQL),
    "stars_polarity": (stars_polarity, STARS_POLARITY_SQL),
    "code_names": (offense_names, OFFENSE_NAMES_SQL),
    "unmapped_report": (unmapped_labels, UNMAPPED_LABELS_SQL),
    "reject_accounting": (reject_accounting, REJECT_ACCOUNTING_SQL),
}
