"""Checking a tree of written pools."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldloom.operators.checks import all_issues, corpus_status, expected_places, gate, registry_table, status_summary
from foldloom.operators.folds import N_FOLDS
from foldloom.operators.sinks import corpus_folder, pool_folder, rotation_folder
from foldloom.sources.pools import PLACE, folder_exists, parse_lines, record_facts, scan_files, scan_lines
from foldloom.storage import drop_folder, new_folder, stage


@dataclass(frozen=True)
class Validation:
    issues: DataFrame
    status: DataFrame
    summary: DataFrame
    gate: DataFrame
    folder: str

    def close(self) -> None:
        """Drop the staged tables; the results cannot be read after that. Also done at the end of a ``with`` block."""
        drop_folder(self.issues.sparkSession, self.folder)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()


def validate_tree(
    spark: SparkSession,
    root: str,
    corpora: Sequence[tuple[str, str]],
    layout: str = "hive",
    n_folds: int = N_FOLDS,
) -> Validation:
    """All checks over a tree. Lines are parsed once; the checks read the staged facts."""
    folder = new_folder(spark)
    registered = reduce(Column.__or__, [(F.col("task") == task) & (F.col("corpus") == corpus) for task, corpus in corpora])
    facts = stage(record_facts(parse_lines(scan_lines(spark, root, layout).where(registered))), folder)
    files = stage(scan_files(spark, root, layout).where(registered), folder)
    # A rotation may be a folder without any file: those that lack files are looked up, n_folds per corpus at most.
    known = {tuple(row) for row in files.select("task", "corpus", "k").distinct().collect()}
    wanted = [(*pair, f"{i:02d}") for pair in sorted({row[:2] for row in known}) for i in range(1, n_folds + 1)]
    bare = [place for place in wanted if place not in known and folder_exists(spark, rotation_folder(root, *place, layout))]
    rotations = spark.createDataFrame(bare, "task string, corpus string, k string") if bare else None
    # Files without a byte are in no scan, so the places that lack rows are looked up: three per rotation at most.
    unseen = [tuple(row) for row in expected_places(files).join(files, PLACE, "left_anti").select(PLACE).collect()]
    hollow = [place for place in unseen if folder_exists(spark, pool_folder(root, *place, layout))]
    if hollow:
        files = files.unionByName(spark.createDataFrame(hollow, files.schema))
    registry = registry_table(spark, corpora)
    # Which registered corpora have no pools: a bounded list, one row per corpus.
    absent = [tuple(row) for row in registry.join(files, ["task", "corpus"], "left_anti").collect()]
    empty = [pair for pair in absent if folder_exists(spark, corpus_folder(root, *pair, layout))]
    folders = registry_table(spark, empty) if empty else None
    issues = stage(all_issues(facts, files, n_folds, rotations=rotations), folder)
    status = corpus_status(registry, issues, files, folders)
    return Validation(issues, status, status_summary(status), gate(status), folder)
