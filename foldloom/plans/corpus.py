"""Building one corpus, and running many."""

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from foldloom.functions.text import SEED
from foldloom.operators.cleaning import FATAL, corpus_gate, kept_rows, tag_rows
from foldloom.operators.dedup import dedup_first, with_order_key
from foldloom.operators.folds import N_FOLDS, dedup_and_fold, has_stratum_for_all_folds
from foldloom.operators.sinks import write_few_shot_tree, write_fold_table, write_pools
from foldloom.plans.spec import CorpusSpec
from foldloom.sources.inputs import scan_inputs
from foldloom.sources.pools import folder_exists
from foldloom.storage import drop_folder, new_folder, scratch, stage

STATUS = "task string, corpus string, status string, rows_in bigint, rows_kept bigint, detail string"
REPORT = "task string, corpus string, report string, item string, n bigint"


def fold_corpus(kept: DataFrame, spec: CorpusSpec, seed: int = SEED, n_folds: int = N_FOLDS) -> DataFrame:
    """Clean rows of one corpus to rows with a fold. ``kept`` may bring its ``order_key``."""
    rows = kept if "order_key" in kept.columns else with_order_key(kept, seed)
    fits = True if spec.fold_rule == "contiguous" or spec.has_closed_labels else None
    return dedup_and_fold(rows, spec.fold_rule, n_folds=n_folds, fits=fits)


def build_corpus(raw: DataFrame, spec: CorpusSpec, seed: int = SEED, n_folds: int = N_FOLDS) -> DataFrame:
    """Raw rows to ``(row_id, text, label, order_key, fold)``, lazily."""
    return fold_corpus(kept_rows(tag_rows(raw, spec)), spec, seed, n_folds)


def tag_corpora(raws: Sequence[tuple[CorpusSpec, DataFrame]]) -> DataFrame:
    """The tagged rows of several corpora as one table with ``task`` and ``corpus``."""
    tagged = [
        tag_rows(raw, spec).select(F.lit(spec.task).alias("task"), F.lit(spec.corpus).alias("corpus"), "*")
        for spec, raw in raws
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def build_corpora(
    raws: Sequence[tuple[CorpusSpec, DataFrame]], seed: int = SEED, n_folds: int = N_FOLDS
) -> DataFrame:
    """Corpora with the same fold rule and kind of ``row_id`` in one job. Those that fail the gate are left out.

    Dedup, order and folds are all within the corpus.
    """
    rules = {spec.fold_rule for spec, _ in raws}
    if len(rules) != 1:
        raise ValueError("build corpora with different fold rules in separate calls")
    # The gate is one row per corpus: it is read first, and corpora that fail are not in the plan of the others.
    gate = corpus_gate(tag_corpora(raws), ["task", "corpus"]).where("status = 'OK'").select("task", "corpus").collect()
    passed = {tuple(row) for row in gate}
    good = [(spec, raw) for spec, raw in raws if (spec.task, spec.corpus) in passed]
    tagged = tag_corpora(good) if good else tag_corpora(raws).limit(0)
    rows = with_order_key(kept_rows(tagged), seed)
    closed = rules == {"contiguous"} or all(spec.has_closed_labels for spec, _ in raws)
    return dedup_and_fold(rows, rules.pop(), ["task", "corpus"], n_folds=n_folds, fits=True if closed else None)


def run_corpus(
    spark: SparkSession,
    spec: CorpusSpec,
    paths: Sequence[str],
    root: str,
    seed: int = SEED,
    n_folds: int = N_FOLDS,
    layout: str = "hive",
    reports: str | None = None,
    compression: str | None = None,
) -> tuple[tuple, list[tuple]]:
    """Scan, clean, gate, fold and write one corpus; a corpus that fails leaves its old pools alone. Gives the status row and the
    rows of its reports; labels that the vocabulary lacks, which may be many, are written to the folder ``reports``.

    Files are parsed once: the tagged rows are staged, then the gate reads their reasons, the
    fold limits their keys, and the write their texts. Fold sizes are counted by the write itself.
    """
    raw = scan_inputs(spark, spec, paths)
    if raw is None:
        status = "MISSING_COLUMNS" if any(folder_exists(spark, path) for path in paths) else "NO_INPUT"
        return (spec.task, spec.corpus, status, 0, 0, None), []
    with scratch(spark) as folder:
        tagged = stage(with_order_key(tag_rows(raw, spec, with_unmapped=reports is not None), seed), folder)
        if reports is not None and spec.labels and not spec.label_rule.endswith("_integer"):
            lacking = tagged.where("unmapped IS NOT NULL").groupBy("unmapped").agg(F.count("*").alias("n"))
            names = [F.lit(v).alias(k) for k, v in (("task", spec.task), ("corpus", spec.corpus), ("report", "unmapped"))]
            lacking.select(*names, F.col("unmapped").alias("item"), "n").write.parquet(f"{reports}/{spec.corpus}")
        return _run_staged(spark, spec, tagged, folder, root, seed, n_folds, layout, compression)


def _run_staged(
    spark: SparkSession, spec: CorpusSpec, tagged: DataFrame, folder: str, root: str, seed: int, n_folds: int, layout: str, compression: str | None
) -> tuple[tuple, list[tuple]]:
    lacks = F.bit_and("lacks") if "lacks" in tagged.columns else F.lit(None).cast("int")
    reasons = tagged.groupBy("reject_reason").agg(F.count("*").alias("n"), lacks.alias("lacks")).collect()
    counts = {row["reject_reason"]: row["n"] for row in reasons}
    kept = counts.get(None, 0)
    status = "OK" if kept else "EMPTY"
    for reason, verdict in FATAL.items():
        status = verdict if counts.get(reason) else status
    known = [row["lacks"] for row in reasons if row["lacks"] is not None]
    if known and reduce(and_, known):
        status = "MISSING_COLUMNS"
    rows = kept_rows(tagged)
    if status == "OK" and spec.fold_rule == "stratified":
        spread = has_stratum_for_all_folds(dedup_first(rows), n_folds=n_folds)
        status = "OK" if spread else "CLASSES_TOO_SMALL"
    report = [("reject", reason or "kept", n) for reason, n in counts.items()]
    if status == "OK":
        watch = Observation()
        sizes = [F.count_if(F.col("fold") == fold).alias(str(fold)) for fold in range(1, n_folds + 1)]
        folded = fold_corpus(rows, spec, seed, n_folds).observe(watch, *sizes)
        if layout == "hive":
            write_pools(folded, root, spec.task, spec.corpus, n_folds, compression=compression)
        else:
            stored = spark.read.parquet(write_fold_table(folded, folder, spec.task, spec.corpus, n_folds))
            write_few_shot_tree(stored, root, spec.task, spec.corpus, n_folds, compression)
        report += size_report(kept, {int(fold): n for fold, n in watch.get.items()})
    return (spec.task, spec.corpus, status, sum(counts.values()), kept, None), [(spec.task, spec.corpus, *row) for row in report]


def size_report(rows_before: int, folds: Mapping[int, int]) -> list[tuple[str, str, int]]:
    """What dedup took out, and the sizes of all pools, from the sizes of the folds."""
    after, n_folds = sum(folds.values()), len(folds)
    out = [("dedup", "rows_before", rows_before), ("dedup", "rows_after", after), ("dedup", "rows_removed", rows_before - after)]
    for k in folds:
        valid = k % n_folds + 1
        out.append(("split_size", f"{k:02d}/test", folds[k]))
        if n_folds > 1:
            out.append(("split_size", f"{k:02d}/valid", folds[valid]))
        out.append(("split_size", f"{k:02d}/train", sum(n for fold, n in folds.items() if fold not in (k, valid))))
    return out


@dataclass(frozen=True)
class Run:
    """What a run came to: ``status`` has a row per corpus. ``reports`` has ``(task, corpus, report, item, n)``: rows by reject reason
    ('reject'), labels that the vocabulary lacks ('unmapped'), rows before and after dedup ('dedup'), rows by rotation and split ('split_size')."""

    status: DataFrame
    reports: DataFrame
    folder: str

    def close(self) -> None:
        """Drop the stored reports. Also done at the end of a ``with`` block."""
        drop_folder(self.status.sparkSession, self.folder)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()


def run_with_reports(
    spark: SparkSession,
    specs: Sequence[CorpusSpec],
    inputs: str | Mapping[str, Sequence[str]],
    root: str,
    seed: int = SEED,
    n_folds: int = N_FOLDS,
    layout: str = "hive",
    at_once: int = 4,
    compression: str | None = None,
) -> Run:
    """As ``run_corpora``, with the reports of all corpora, which the jobs of the run count on their way."""
    folder = new_folder(spark)
    results = _run_all(spark, specs, inputs, root, seed, n_folds, layout, at_once, folder, compression)
    reports = spark.createDataFrame([row for _, report in results for row in report], REPORT)
    written = [f"{folder}/{spec.corpus}" for spec in specs if folder_exists(spark, f"{folder}/{spec.corpus}")]
    if written:
        reports = reports.unionByName(spark.read.schema(REPORT).parquet(*written))
    return Run(spark.createDataFrame([status for status, _ in results], STATUS), reports, folder)


def run_corpora(
    spark: SparkSession,
    specs: Sequence[CorpusSpec],
    inputs: str | Mapping[str, Sequence[str]],
    root: str,
    seed: int = SEED,
    n_folds: int = N_FOLDS,
    layout: str = "hive",
    at_once: int = 4,
    compression: str | None = None,
) -> DataFrame:
    """Every corpus of the list as jobs of one session, a few at once, and a status row for each.

    ``inputs`` is a folder with one folder per corpus, or the paths by corpus name. An exception in one
    corpus is reported as ERROR, with its whole text in ``detail``, and does not stop the others. ``compression`` is that of the pools' files.
    """
    results = _run_all(spark, specs, inputs, root, seed, n_folds, layout, at_once, None, compression)
    return spark.createDataFrame([status for status, _ in results], STATUS)


def _run_all(spark, specs, inputs, root, seed, n_folds, layout, at_once, reports, compression) -> list[tuple[tuple, list[tuple]]]:
    def paths(spec: CorpusSpec) -> list[str]:
        if isinstance(inputs, str):
            return [f"{inputs.rstrip('/')}/{spec.corpus}/{name}" for name in spec.files]
        return list(inputs[spec.corpus])

    def run(spec: CorpusSpec) -> tuple[tuple, list[tuple]]:
        try:
            return run_corpus(spark, spec, paths(spec), root, seed, n_folds, layout, reports, compression)
        except Exception as error:
            return (spec.task, spec.corpus, "ERROR", 0, 0, f"{type(error).__name__}: {error}"), []

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(run, specs))


def failed_count(status: DataFrame) -> DataFrame:
    """One row: corpora in all, and those that were not written."""
    return status.agg(
        F.count("*").alias("n_corpora"), F.count_if(F.col("status") != "OK").alias("n_failed")
    )
