"""Quality checks of pools as grouped aggregates; every finding is a row.

All checks work on the facts of ``sources.pools.record_facts``: one row per line, with a digest for the text.
Findings are ``(task, corpus, k, split, check, severity, n, detail)``. Severity is ERROR, WARN or INFO.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldloom.operators.folds import N_FOLDS
from foldloom.operators.pools import SPLITS
from foldloom.sources.pools import PLACE

ISSUE = [*PLACE, "check", "severity", "n", "detail"]
FOLD = ["task", "corpus", "k"]
PAIRS = (("train", "valid"), ("train", "test"), ("valid", "test"))

# Accepted shares of a rotation in percent, and the tolerance in points.
SHARES = {"train": 60, "valid": 20, "test": 20}
TOLERANCE = 5
EXAMPLES = 3


def _finding(check: str, severity: str, n: Column, split: Column | None = None, detail: Column | None = None):
    none = F.lit(None).cast("array<string>")
    fields = [F.lit(check).alias("check"), F.lit(severity).alias("severity"), n.cast("bigint").alias("n")]
    if split is not None:
        fields.insert(0, split.alias("split"))
    return F.struct(*fields, (none if detail is None else detail).alias("detail"))


def _findings(groups: DataFrame, findings: Sequence[Column]) -> DataFrame:
    """One row per finding that counts anything, from a table with one row per group."""
    keys = [name for name in PLACE if name in groups.columns]
    listed = groups.select(*keys, F.inline(F.array(*findings))).where("n > 0")
    return listed.select(*ISSUE)


def profile(facts: DataFrame) -> DataFrame:
    """Counts per pool file group: one aggregate serves the value checks and the share check."""
    flags = [name for name, kind in facts.dtypes if kind == "boolean"]
    return facts.groupBy(*PLACE).agg(
        F.count_if(~F.col("bad_json")).alias("n_rows"),
        F.count_if(F.col("text_missing") | F.col("label_missing")).alias("keys_missing"),
        *[F.count_if(F.col(name)).alias(name) for name in flags],
    )


# Checks that are one count of the profile each, with the column they read.
VALUE_ERRORS = {
    "missing_keys": "keys_missing",
    "empty_text": "text_empty",
    "empty_label": "label_empty",
    "text_not_string": "text_not_string",
    "label_not_string": "label_not_string",
    "bad_json": "bad_json",
    "bad_utf8": "bad_utf8",
}


def expected_places(files: DataFrame, rotations: DataFrame | None = None) -> DataFrame:
    """Every split of the rotations that have any file, and of those in ``rotations``, whose folder exists."""
    splits = F.array(*[F.lit(name) for name in SPLITS])
    known = files.select(*FOLD)
    if rotations is not None:
        known = known.unionByName(rotations.select(*FOLD))
    return known.distinct().withColumn("split", F.explode(splits))


def place_issues(profiles: DataFrame, files: DataFrame | None = None, rotations: DataFrame | None = None) -> DataFrame:
    """Everything that the profile of a split tells: keys, empty values, types, JSON, UTF-8, and its share.

    With ``files``, the places for which a file exists, also splits without a file and splits with a file
    and no rows; ``rotations`` adds rotations that are folders without files. A share is that of a non-empty split among the rows of its rotation.
    """
    findings = [_finding(check, "ERROR", F.col(column)) for check, column in VALUE_ERRORS.items()]
    findings.append(_finding("extra_keys", "WARN", F.col("extra_keys")))
    total = F.sum("n_rows").over(Window.partitionBy(*FOLD))
    expected = F.coalesce(
        *[F.when(F.col("split") == split, share) for split, share in SHARES.items()], F.lit(SHARES["test"])
    )
    # A share of rows p/total is compared without a division, which an empty rotation would make undefined.
    distance = F.abs(100 * F.col("n_rows") - expected * F.col("_total"))
    off = (F.col("n_rows") > 0) & (distance > TOLERANCE * F.col("_total"))
    shown = F.array(F.format_string("%d of %d rows, expected %d%%", "n_rows", "_total", expected))
    findings.append(_finding("split_share", "WARN", F.when(off, F.col("n_rows")), detail=shown))
    if files is None:
        return _findings(profiles.withColumn("_total", total), findings)

    placed = expected_places(files, rotations).join(files.withColumn("_file", F.lit(True)), PLACE, "left").join(profiles, PLACE, "left")
    no_file = F.col("_file").isNull()
    no_rows = ~no_file & (F.coalesce("n_rows", F.lit(0)) == 0)
    findings.append(_finding("missing_file", "ERROR", no_file.cast("int")))
    findings.append(_finding("empty_split", "ERROR", no_rows.cast("int")))
    return _findings(placed.withColumn("_total", total), findings)


def fold_count_issues(files: DataFrame, n_folds: int = N_FOLDS) -> DataFrame:
    """Corpora with another number of folds: for information, without effect on the status."""
    counts = files.groupBy("task", "corpus").agg(F.count_distinct("k").alias("_folds"))
    blank = F.lit(None).cast("string")
    wrong = counts.where(F.col("_folds") != n_folds).withColumn("k", blank).withColumn("split", blank)
    return _findings(wrong, [_finding("fold_count", "INFO", F.col("_folds"))])


def label_presence(facts: DataFrame) -> DataFrame:
    """One row per rotation and label, telling the splits that have it."""
    return facts.where("NOT bad_json").groupBy(*FOLD, "label").agg(
        *[F.max(F.col("split") == split).alias(f"in_{split}") for split in SPLITS]
    )


def label_issues(labels: DataFrame, examples: bool = True) -> DataFrame:
    """Labels of valid or test that train lacks, and labels of train that a non-empty valid or test lacks.
    The finding names all of them."""
    pairs = [("train", split) for split in SPLITS[1:]]
    gaps = []
    for train, split in pairs:
        gaps.append((f"labels_not_in_train:{split}", F.col(f"in_{split}") & ~F.col(f"in_{train}"), split))
        gaps.append((f"labels_of_train_absent:{split}", F.col(f"in_{train}") & ~F.col(f"in_{split}"), split))
    counted = labels.groupBy(*FOLD).agg(
        *[F.count_if(condition).alias(name) for name, condition, _ in gaps],
        *[F.max(f"in_{split}").alias(f"has_{split}") for split in SPLITS],
    )
    findings = [
        _finding(name.split(":")[0], "WARN", F.when(F.col(f"has_{split}"), F.col(f"`{name}`")), F.lit(split))
        for name, _, split in gaps
    ]
    issues = _findings(counted, findings)
    if not examples:
        return issues
    listed = F.array(
        *[
            F.struct(F.lit(split).alias("split"), F.lit(name.split(":")[0]).alias("check"), condition.alias("hit"))
            for name, condition, split in gaps
        ]
    )
    hits = labels.select(*FOLD, "label", F.inline(listed)).where("hit")
    return _with_examples(issues, hits, "label", "label", limit=None)


def _with_examples(issues: DataFrame, hits: DataFrame, order: str, shown: str, limit: int | None = EXAMPLES) -> DataFrame:
    """Fill ``detail`` with the first few hits of every finding, or with all of them. Both sides are cut to findings."""
    key = [*PLACE, "check"]
    if limit is not None:
        first = F.row_number().over(Window.partitionBy(*key).orderBy(order))
        hits = hits.withColumn("_no", first).where(F.col("_no") <= limit)
    lists = hits.groupBy(*key).agg(F.sort_array(F.collect_list(shown)).alias("_examples"))
    joined = issues.join(lists, key, "left").withColumn("detail", F.coalesce("_examples", "detail"))
    return joined.select(*ISSUE)


def text_presence(facts: DataFrame, examples: bool = True) -> DataFrame:
    """One row per rotation and text with its copies in each split.

    This is the only shuffle of the duplicate and leakage checks. Copies collapse before it, so a text that
    is everywhere costs no more than another. The example depends on the digest, so to carry
    it along as a key does not change the groups.
    """
    text = ["digest", "example"] if examples else ["digest"]
    return facts.where("NOT bad_json").groupBy(*FOLD, *text).agg(
        *[F.count_if(F.col("split") == split).alias(f"in_{split}") for split in SPLITS]
    )


def text_issues(texts: DataFrame, examples: bool = True) -> DataFrame:
    """Copies inside a split, and texts shared by two splits of a rotation."""
    shared = {(a, b): (F.col(f"in_{a}") > 0) & (F.col(f"in_{b}") > 0) for a, b in PAIRS}
    counted = texts.groupBy(*FOLD).agg(
        *[F.sum(F.greatest(F.col(f"in_{split}") - 1, F.lit(0))).alias(f"copies_{split}") for split in SPLITS],
        *[F.count_if(condition).alias(f"shared_{a}_{b}") for (a, b), condition in shared.items()],
    )
    findings = [
        _finding("duplicate_texts", "ERROR", F.col(f"copies_{split}"), F.lit(split)) for split in SPLITS
    ] + [_finding("leakage", "ERROR", F.col(f"shared_{a}_{b}"), F.lit(f"{a},{b}")) for a, b in PAIRS]
    issues = _findings(counted, findings)
    if not examples:
        return issues
    listed = F.array(
        *[
            F.struct(F.lit(f"{a},{b}").alias("split"), F.lit("leakage").alias("check"), condition.alias("hit"))
            for (a, b), condition in shared.items()
        ]
    )
    hits = texts.select(*FOLD, "digest", "example", F.inline(listed)).where("hit")
    return _with_examples(issues, hits, "digest", "example")


def rotation_issues(facts: DataFrame) -> DataFrame:
    """Texts that are in the test sets of two rotations, per pair of rotations.

    Only test splits are read. One aggregate of fixed-width values tells the texts of more than one rotation;
    only these are counted by the set of rotations that test them, and only those few sets are taken apart into pairs.
    """
    tests = facts.where("NOT bad_json AND split = 'test'").select(*FOLD, "digest")
    text, number = ["task", "corpus", "digest"], F.xxhash64("k")
    several = tests.groupBy(*text).agg(F.min(number).alias("_lo"), F.max(number).alias("_hi")).where("_lo <> _hi").select(*text)
    tested = tests.join(several, text, "left_semi").groupBy("task", "corpus", "digest").agg(F.sort_array(F.collect_set("k")).alias("ks"))
    sets = tested.where(F.size("ks") > 1).groupBy("task", "corpus", "ks").agg(F.count("*").alias("_n"))
    pairs = sets.select("*", F.posexplode("ks").alias("_i", "_first")).select(
        "*", F.explode(F.slice(F.col("ks"), F.col("_i") + 2, F.size("ks"))).alias("_second")
    )
    summed = pairs.groupBy(
        "task", "corpus", F.concat_ws(",", "_first", "_second").alias("k"), F.lit("test").alias("split")
    ).agg(F.sum("_n").alias("_n"))
    return _findings(summed, [_finding("test_overlap", "ERROR", F.col("_n"))])


def all_issues(
    facts: DataFrame,
    files: DataFrame | None = None,
    n_folds: int = N_FOLDS,
    examples: bool = True,
    rotations: DataFrame | None = None,
) -> DataFrame:
    """Every check. Without ``files`` a split that has rows is taken to exist."""
    if files is None:
        files = facts.select(*PLACE).distinct()
    parts = [
        place_issues(profile(facts), files, rotations),
        fold_count_issues(files if rotations is None else expected_places(files, rotations), n_folds),
        label_issues(label_presence(facts), examples),
        text_issues(text_presence(facts, examples), examples),
        rotation_issues(facts),
    ]
    return reduce(DataFrame.unionByName, parts)


def registry_table(spark: SparkSession, corpora: Sequence[tuple[str, str]]) -> DataFrame:
    """``(task, corpus)`` rows of a registry."""
    rows = [F.struct(F.lit(task).alias("task"), F.lit(corpus).alias("corpus")) for task, corpus in corpora]
    return spark.range(1).select(F.inline(F.array(*rows)))


def corpus_status(registry: DataFrame, issues: DataFrame, files: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """MISSING, EMPTY, FAIL, WARN or OK for every registered corpus.

    ``folders`` names the corpora whose folder exists though it has no pools.
    """
    key = ["task", "corpus"]
    worst = issues.groupBy(*key).agg(
        F.max(F.col("severity") == "ERROR").alias("_error"), F.max(F.col("severity") == "WARN").alias("_warn")
    )
    found = files.select(*key).distinct().withColumn("_found", F.lit(True))
    if folders is None:
        folders = registry.limit(0)
    empty = folders.select(*key).distinct().withColumn("_empty", F.lit(True))
    # All of these have one row per corpus at most.
    joined = registry
    for part in (worst, found, empty):
        joined = joined.join(part, key, "left")
    status = (
        F.when(F.col("_found").isNull() & F.col("_empty").isNotNull(), "EMPTY")
        .when(F.col("_found").isNull(), "MISSING")
        .when(F.col("_error"), "FAIL")
        .when(F.col("_warn"), "WARN")
        .otherwise("OK")
    )
    return joined.select(*key, status.alias("status"))


def status_summary(status: DataFrame) -> DataFrame:
    """Corpora per status; an empty corpus counts as missing."""
    merged = F.when(F.col("status") == "EMPTY", "MISSING").otherwise(F.col("status"))
    return status.groupBy(merged.alias("status")).agg(F.count("*").alias("n_corpora"))


def gate(status: DataFrame) -> DataFrame:
    """One row: failed when any corpus fails or is missing; warnings alone pass."""
    failed = F.coalesce(F.max(F.col("status").isin("FAIL", "MISSING", "EMPTY")), F.lit(False))
    warned = F.coalesce(F.max(F.col("status") == "WARN"), F.lit(False))
    verdict = F.when(failed, "FAILED").when(warned, "PASSED_WITH_WARNINGS").otherwise("PASSED")
    return status.agg((~failed).alias("passed"), verdict.alias("verdict"))
