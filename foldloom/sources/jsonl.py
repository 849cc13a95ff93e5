"""JSON lines: bad lines are marked and the rest is kept."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldloom.functions.json import as_string, truthy_string
from foldloom.plans.spec import JsonLines
from foldloom.sources.position import file_position

BAD_RECORD = "_bad_record\n"


def scan_jsonl(
    spark: SparkSession, path: str, columns: Sequence[str], source: JsonLines, input_no: int = 0
) -> DataFrame | None:
    """The needed keys as strings, with ``row_id``, ``fault`` and ``lacks``; None if there is no such file.

    ``lacks`` has a bit for each needed key that a sound line does not have, so that a column that no line has is known from one
    aggregate over the rows. Keys are read as VARIANT, since under a string schema 0, false and [] would become strings
    that no longer look empty. Other keys are not built.
    """
    fields = [T.StructField(name, T.VariantType()) for name in columns]
    schema = T.StructType([*fields, T.StructField(BAD_RECORD, T.StringType())])
    try:
        raw = spark.read.schema(schema).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_RECORD)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    value = truthy_string if source.truthy else as_string
    bad = F.col(f"`{BAD_RECORD}`").isNotNull()
    lacks = sum([F.when(F.col(f"`{name}`").isNull(), 1 << i).otherwise(0) for i, name in enumerate(columns)], F.lit(0))
    return raw.select(
        *[value(F.col(f"`{name}`")).alias(name) for name in columns],
        file_position(input_no).alias("row_id"),
        F.when(bad, "bad_line").alias("fault"),
        F.when(~bad, lacks).alias("lacks"),
    )
