"""Written pools as one table of lines, whatever their layout."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldloom.functions.json import is_falsy, kind
from foldloom.functions.text import is_blank, text_digest

PLACE = ["task", "corpus", "k", "split"]

# The two folder layouts, hive partitions and {task}/{corpus}/few_shot/{kk}/{split}.jsonl, where
# the last is a file or a folder of files.
HIVE_PATH = r"/task=([^/]+)/corpus=([^/]+)/k=([^/]+)/split=([^/]+)/[^/]+$"
PLAIN_PATH = r"/([^/]+)/([^/]+)/few_shot/([^/]+)/([^/]+)\.jsonl(?:/[^/]+)?$"


def _placed(df: DataFrame, layout: str) -> DataFrame:
    """Add task, corpus, k and split from the path of the file."""
    pattern = HIVE_PATH if layout == "hive" else PLAIN_PATH
    path = F.url_decode(F.col("_path"))
    parts = [F.regexp_extract(path, pattern, i + 1).alias(name) for i, name in enumerate(PLACE)]
    return df.select("*", *parts).where("corpus <> ''").drop("_path")


def scan_lines(spark: SparkSession, root: str, layout: str = "hive") -> DataFrame:
    """Every non-blank line of the tree, as raw text with its place.

    The hive layout is read with declared partition columns, so a filter on them prunes
    folders and '01' stays a string.
    """
    if layout == "hive":
        schema = "value string, " + ", ".join(f"{name} string" for name in PLACE)
        lines = spark.read.schema(schema).text(root)
    else:
        lines = _placed(
            spark.read.option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.json*")
            .text(root)
            .select("value", F.col("_metadata.file_path").alias("_path")),
            layout,
        )
    return lines.where(~is_blank(F.col("value")))


def scan_files(spark: SparkSession, root: str, layout: str = "hive") -> DataFrame:
    """The places for which a file exists. Lists files and reads none."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(F.col("path").alias("_path"))
    )
    return _placed(files, layout).select(*PLACE).distinct()


def folder_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
        return True
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


# What ``schema_of_variant`` says of a sound line.
SOUND = "OBJECT<label: STRING, text: STRING>"


def parse_lines(lines: DataFrame) -> DataFrame:
    """The facts that the checks need about every line; see ``record_facts`` for the columns.

    A line is parsed once, as VARIANT, because the checks look at JSON types and key names. The shape of
    a sound line answers all of them at once; only other lines are looked at key by key.
    A line that is no JSON object counts as a bad line.
    """
    parsed = lines.select(
        *PLACE, "value", F.try_parse_json("value").alias("_line"), F.is_valid_utf8("value").alias("_utf8")
    )
    strings = [F.try_variant_get("_line", f"$.{name}", "string").alias(f"_{name}") for name in ("text", "label")]
    shaped = parsed.select("*", F.schema_of_variant("_line").alias("_shape"), *strings)
    good = F.coalesce(F.col("_utf8") & F.col("_shape").startswith("OBJECT"), F.lit(False))
    sound = F.coalesce(F.col("_utf8") & (F.col("_shape") == SOUND), F.lit(False))
    rated = shaped.select("*", good.alias("_good"), sound.alias("_sound"))
    columns = [(~F.col("_utf8")).alias("bad_utf8"), (~F.col("_good")).alias("bad_json")]
    for name in ("text", "label"):
        string = F.col(f"_{name}")
        value = F.try_variant_get("_line", f"$.{name}", "variant")
        columns += [
            F.when(F.col("_good"), string).alias(name),
            F.when(F.col("_sound"), "STRING").when(F.col("_good"), kind(value)).alias(f"{name}_kind"),
            F.when(F.col("_sound"), string == "").when(F.col("_good"), is_falsy(value)).alias(f"{name}_falsy"),
        ]
    keys = F.when(F.col("_sound"), F.array(F.lit("text"), F.lit("label"))).when(
        F.col("_good"), F.json_object_keys("value")
    )
    return rated.select(*PLACE, *columns, keys.alias("keys"))


def _carried(rows: DataFrame) -> list[str]:
    return [name for name in (*PLACE, "fold") if name in rows.columns]


def pool_rows(pools: DataFrame) -> DataFrame:
    """The same facts for a table of pools that has not been written: all lines are sound.

    Folds do as well: their facts can be rotated afterwards, so that every text is looked at once.
    """
    return pools.select(
        *_carried(pools),
        F.lit(False).alias("bad_utf8"),
        F.lit(False).alias("bad_json"),
        "text",
        "label",
        *[F.when(F.col(name).isNull(), "-").otherwise("STRING").alias(f"{name}_kind") for name in ("text", "label")],
        *[(F.coalesce(name, F.lit("")) == "").alias(f"{name}_falsy") for name in ("text", "label")],
        F.array(F.lit("text"), F.lit("label")).alias("keys"),
    )


def record_facts(rows: DataFrame, example_chars: int = 60) -> DataFrame:
    """One narrow row per line: flags, label, and a digest in place of the text.

    The digest covers the whole text; the first characters are kept only to show examples.
    A missing text or label counts as an empty one, as do both in a bad line, which is out of all
    checks but its own.
    """
    required = ("text", "label")
    text = F.coalesce("text", F.lit(""))
    flags = []
    for name in required:
        empty = F.col(f"{name}_falsy") | F.coalesce(is_blank(F.col(name)), F.lit(True))
        flags.append((~F.col("bad_json") & empty).alias(f"{name}_empty"))
        flags.append((~F.col("bad_json") & (F.col(f"{name}_kind") != "STRING")).alias(f"{name}_not_string"))
        flags.append((~F.col("bad_json") & ~F.array_contains("keys", name)).alias(f"{name}_missing"))
    extra = F.size(F.array_except("keys", F.array(*[F.lit(name) for name in required]))) > 0
    return rows.select(
        *_carried(rows),
        "bad_utf8",
        "bad_json",
        *flags,
        (~F.col("bad_json") & F.coalesce(extra, F.lit(False))).alias("extra_keys"),
        F.coalesce("label", F.lit("")).alias("label"),
        text_digest(text).alias("digest"),
        F.substring(text, 1, example_chars).alias("example"),
    )
