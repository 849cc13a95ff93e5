"""Delimited text: header check, choice of delimiter and encoding, ragged rows, missing-value tokens."""

import csv
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldloom.functions.text import na_to_null
from foldloom.plans.spec import Delimited
from foldloom.sources.position import file_position

# Field names never end in a line feed, so this one cannot meet a column of the file.
BAD_RECORD = "_bad_record\n"
HEADER_BYTES, HEADER_LINES = 1 << 16, 1000


def _options(source: Delimited, sep: str, encoding: str) -> dict:
    quote = '"' if source.quoted else ""
    return dict(
        header=True, sep=sep, quote=quote, escape='"' if source.quoted else "\\",
        multiLine=source.multiline, encoding=encoding,
    )


@dataclass(frozen=True)
class Layout:
    """How files are read: what their first line and their bytes decide."""

    sep: str
    encoding: str
    width: int
    places: tuple[int, ...]


def first_record(spark: SparkSession, path: str, source: Delimited, sep: str, encoding: str = "UTF-8") -> list[str]:
    """The fields of the first record of one file, also if it has line feeds inside quotes."""
    options = {**_options(source, sep, encoding), "header": False}
    row = spark.read.csv(path, **options).first()
    return [name or "" for name in row] if row else []


def _fields(lines: Sequence[str], source: Delimited, sep: str) -> list[str] | None:
    """The fields of the record that begins with the first of these lines; None if it goes on behind the last one."""
    if not source.quoted:
        return lines[0].split(sep)
    if len(sep) > 1:
        return [field.strip('"') for field in lines[0].split(sep)]
    reader = csv.reader((f"{line}\n" for line in lines), delimiter=sep, strict=False)
    record = next(reader, [])
    begun = "\n".join(lines[: reader.line_num])
    return None if begun.count('"') % 2 else record


def _head(lines: DataFrame, file: str) -> list[bytearray]:
    """The first lines of a file from the first that is not empty, for a header that goes on behind a line feed."""
    own = lines.where(F.col("_metadata.file_path") == file).select(F.col("value").cast("binary").alias("line"), F.monotonically_increasing_id().alias("at"), "_metadata.file_block_start")
    rows = [row.line for row in own.orderBy("file_block_start", "at").limit(HEADER_LINES).collect()]
    while rows and not rows[0]:
        rows.pop(0)
    return rows


def _layout(names: Callable[[str], list[str]], columns: Sequence[str], source: Delimited, encoding: str) -> Layout | None:
    """The layout under the first separator that gives the needed columns. A repeated name means its first column."""
    for sep in filter(None, (source.sep, source.fallback_sep)):
        found = names(sep)
        if set(columns) <= set(found):
            return Layout(sep, encoding, len(found), tuple(found.index(name) for name in columns))
    return None


def file_layouts(spark: SparkSession, path: str, columns: Sequence[str], source: Delimited) -> dict[Layout, list[str]] | None:
    """The files of an input by layout, None if there are none or one of them lacks a needed column.

    A census over raw lines tells for each file its first line that is not empty, and whether all of its bytes are UTF-8; files are grouped by both before
    anything reaches the driver. A single file without a fallback encoding is known by its first record alone. A file without
    any line is in no layout.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if source.fallback_encoding is None and len(lines.inputFiles()) == 1:
        found = _layout(lambda sep: first_record(spark, path, source, sep), columns, source, "UTF-8")
        return {found: []} if found else None
    # As the reader takes it: it passes over empty lines, and over blank ones if records are lines.
    shown = F.col("value") if source.multiline else F.trim("value")
    begins = (F.col("_metadata.file_block_start") == 0) & (shown != "")
    seen = lines.select(
        F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("valid"),
        F.when(begins, F.substring(F.col("value").cast("binary"), 1, HEADER_BYTES)).alias("line"),
        F.when(begins, F.monotonically_increasing_id()).alias("at"),
    )
    census = seen.groupBy("file").agg(F.bool_and("valid").alias("valid"), F.min_by("line", "at").alias("line"))
    kinds = census.where("line IS NOT NULL").groupBy("valid", "line").agg(F.sort_array(F.collect_list("file")).alias("files"))
    layouts: dict[Layout, list[str]] = {}
    for valid, line, files in kinds.collect():
        encoding = "UTF-8" if valid or source.fallback_encoding is None else source.fallback_encoding
        head = [line] if len(line) < HEADER_BYTES and bytes(line).count(b'"') % 2 == 0 else _head(lines, files[0])
        text = [bytes(part).decode(encoding, "replace") for part in head]
        text[0] = text[0].removeprefix("\ufeff")
        found = _layout(lambda sep: _fields(text, source, sep) or [], columns, source, encoding)
        if found is None:
            return None
        layouts.setdefault(found, []).extend(files)
    return layouts or None


def field_count(record: Column, source: Delimited, sep: str) -> Column:
    """Fields of one raw record."""
    escaped = re.escape(sep)
    if not source.quoted:
        return F.size(F.split(record, escaped, -1))
    # Possessive loops keep no state for each character, so the length of a field does not matter.
    field = rf'(?:"[^"]*+(?:""[^"]*+)*+"[^{escaped}]*+|[^"{escaped}][^{escaped}]*+|)'
    return F.regexp_count(record, F.lit(rf"(?:^|{escaped}){field}"))


def scan_delimited(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    source: Delimited,
    input_no: int = 0,
) -> DataFrame | None:
    """The needed columns as strings, with ``row_id`` and ``fault``; None if a column is missing.

    Every file is read by its own header and encoding: files of one layout are one scan. Short rows are filled with nulls. Over-long
    rows have the fault 'ragged'.
    """
    layouts = file_layouts(spark, path, columns, source)
    if layouts is None:
        return None
    # The files of the commonest layout are those of no other, so only odd files are named in the plan.
    usual = max(layouts, key=lambda layout: len(layouts[layout]))
    odd = [file for layout, files in layouts.items() if layout != usual for file in files]
    scans = []
    for layout, files in layouts.items():
        file = F.col("_metadata.file_path")
        inside = (~file.isin(odd) if layout == usual else file.isin(files)) if odd else F.lit(True)
        scans.append(_scan(spark, path, columns, source, layout, inside, input_no))
    return reduce(DataFrame.unionByName, scans)


def _scan(spark: SparkSession, path: str, columns: Sequence[str], source: Delimited, layout: Layout, inside: Column, input_no: int) -> DataFrame:
    fields = [T.StructField(name, T.StringType()) for name in [*(f"_c{i}" for i in range(layout.width)), BAD_RECORD]]
    # Records are counted field by field only if the parser keeps all columns.
    reader = spark.read.schema(T.StructType(fields)).option("columnPruning", False)
    raw = reader.csv(
        path, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_RECORD, **_options(source, layout.sep, layout.encoding)
    )
    bad = F.col(f"`{BAD_RECORD}`")
    ragged = bad.isNotNull() & (field_count(bad, source, layout.sep) > layout.width)
    return raw.where(inside).select(
        *[na_to_null(F.col(f"_c{place}")).alias(name) for name, place in zip(columns, layout.places, strict=True)],
        file_position(input_no).alias("row_id"),
        F.when(ragged, "ragged").alias("fault"),
    )
