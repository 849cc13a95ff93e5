"""Replacement of written trees as a whole, and writes without a sort."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from foldloom.operators.folds import dedup_and_fold
from foldloom.operators.sinks import unsorted_write, write_few_shot_tree, write_fold_table, write_pools
from foldloom.sources.pools import scan_files, scan_lines
from foldloom.storage import replacement, stage

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def texts(n, word="t"):
    return [(i, f"{word}{i}", "a") for i in range(n)]


def lines(spark, root, layout="hive"):
    return sorted((r.k, r.split, r.value) for r in scan_lines(spark, str(root), layout).collect())


def failing(folded):
    """The same rows, one of which stops the write after others have been written."""
    stop = F.raise_error(F.lit("stopped")).cast("string")
    return folded.withColumn("text", F.when(F.col("text") == "new39", stop).otherwise(F.col("text")))


@pytest.mark.parametrize("layout", ["hive", "few_shot"])
def test_a_write_that_fails_half_way_leaves_the_old_tree(spark, make_rows, tmp_path, layout):
    def write(folded, n_folds=5, spoil=False):
        if layout == "hive":
            write_pools(failing(folded) if spoil else folded, str(tmp_path), "t", "c", n_folds)
        else:
            stored = stage(folded)
            write_few_shot_tree(failing(stored) if spoil else stored, str(tmp_path), "t", "c", n_folds)

    write(dedup_and_fold(make_rows(texts(30))))
    before = lines(spark, tmp_path, layout)
    assert len(before) == 150
    with pytest.raises(Exception, match="stopped"):
        write(dedup_and_fold(make_rows(texts(40, "new"), 8)), spoil=True)
    assert lines(spark, tmp_path, layout) == before
    assert not [name for _, names, _ in os.walk(tmp_path) for name in names if name.startswith(".")]
    write(dedup_and_fold(make_rows(texts(9, "new")), n_folds=3), n_folds=3)
    assert {(k, split) for k, split, _ in lines(spark, tmp_path, layout)} == {(k, s) for k in ("01", "02", "03") for s in ("train", "valid", "test")}


def test_what_a_killed_run_left_is_put_right(spark, tmp_path):
    target, new, old = tmp_path / "c", tmp_path / ".new.c", tmp_path / ".old.c"

    def run():
        with replacement(spark, str(target)) as folder:
            assert not os.path.exists(folder)
            os.mkdir(folder)
            (tmp_path / ".new.c" / "x").write_text("third")

    # Stopped while writing: the target is the first tree, and half of the second is there.
    target.mkdir(), new.mkdir()
    (target / "x").write_text("first")
    run()
    assert (target / "x").read_text() == "third" and not new.exists() and not old.exists()
    # Stopped between the renames: the old tree is hidden, and comes back if the next write fails.
    target.rename(old)
    with pytest.raises(RuntimeError):
        with replacement(spark, str(target)):
            raise RuntimeError
    assert (target / "x").read_text() == "third" and not old.exists()
    # Stopped after the swap: the hidden tree is out of date.
    old.mkdir()
    (old / "x").write_text("first")
    run()
    assert (target / "x").read_text() == "third" and not old.exists()
    # A write that makes no folder cannot take the place of one.
    with pytest.raises(Exception):
        with replacement(spark, str(target)):
            pass
    assert (target / "x").read_text() == "third" and not old.exists()


def test_hidden_trees_are_not_scanned(spark, make_rows, tmp_path):
    write_pools(dedup_and_fold(make_rows(texts(10))), str(tmp_path), "t", "c")
    os.rename(tmp_path / "task=t" / "corpus=c", tmp_path / "task=t" / ".new.corpus=c")
    write_pools(dedup_and_fold(make_rows(texts(5))), str(tmp_path), "t", "d")
    assert {r.corpus for r in scan_lines(spark, str(tmp_path)).collect()} == {"d"}
    assert {r.corpus for r in scan_files(spark, str(tmp_path)).collect()} == {"d"}


def last_plan(spark):
    """The plan of the last query that ran, as the session's store of executions has it."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return spark._jsparkSession.sharedState().statusStore().executionsList().last().physicalPlanDescription()


def test_pools_are_written_without_a_sort(spark, make_rows, tmp_path):
    """The plan of the write, and that the session has its own setting back, also if several writes are open."""
    folded = stage(dedup_and_fold(make_rows(texts(40))))
    before = spark.conf.get(WRITERS, None)
    seen = []
    with unsorted_write(spark, 15):
        assert int(spark.conf.get(WRITERS)) >= 15
        inner = threading.Thread(target=lambda: seen.append(write_pools(folded, str(tmp_path / "p"), "t", "c")))
        inner.start()
        inner.join()
        assert int(spark.conf.get(WRITERS)) >= 15
    assert spark.conf.get(WRITERS, None) == before and seen
    write_pools(folded, str(tmp_path / "p"), "t", "c")
    assert "Generate" in last_plan(spark) and "Sort" not in last_plan(spark)
    write_fold_table(folded, str(tmp_path / "f"), "t", "c")
    assert "Execute InsertIntoHadoopFsRelationCommand" in last_plan(spark) and "Sort" not in last_plan(spark)
    folded.write.partitionBy("fold").json(str(tmp_path / "g"))
    assert "Sort" in last_plan(spark)
    folder = tmp_path / "p" / "task=t" / "corpus=c"
    # One task writes all its pools, each to one file.
    files = [name for _, _, names in os.walk(folder) for name in names if name.endswith(".json")]
    assert len({name.split("-")[1] for name in files}) == folded.rdd.getNumPartitions()
    assert len(lines(spark, tmp_path / "p")) == 200


def test_a_fold_table_is_replaced(spark, make_rows, tmp_path):
    write_fold_table(dedup_and_fold(make_rows(texts(20))), str(tmp_path), "t", "c")
    folder = write_fold_table(dedup_and_fold(make_rows(texts(7)), n_folds=2), str(tmp_path), "t", "c", n_folds=2)
    assert sorted(r.fold for r in spark.read.parquet(folder).collect()) == [1, 1, 1, 1, 2, 2, 2]


def data_files(folder):
    return [name for _, _, names in os.walk(folder) for name in names if name.startswith("part-")]


def test_pools_can_be_compressed(spark, make_rows, tmp_path):
    folded = dedup_and_fold(make_rows([(i, f"ação {i}", "ab"[i % 2]) for i in range(40)]))
    write_pools(folded, str(tmp_path / "plain"), "t", "c")
    write_pools(folded, str(tmp_path / "small"), "t", "c", compression="gzip")
    write_few_shot_tree(stage(folded), str(tmp_path / "few"), "t", "c", compression="gzip")
    assert all(name.endswith(".json") for name in data_files(tmp_path / "plain"))
    assert all(name.endswith(".json.gz") for folder in ("small", "few") for name in data_files(tmp_path / folder))
    expected = lines(spark, tmp_path / "plain")
    assert len(expected) == 200
    assert lines(spark, tmp_path / "small") == expected == lines(spark, tmp_path / "few", "few_shot")
    assert scan_files(spark, str(tmp_path / "small")).count() == 15 == scan_files(spark, str(tmp_path / "few"), "few_shot").count()


@pytest.fixture
def pools_folder(monkeypatch, tmp_path):
    from foldloom.queries import files

    monkeypatch.setattr(files, "new_folder", lambda spark: str(tmp_path / "pools"))
    return files, tmp_path / "pools"


@pytest.fixture
def documents_folder(spark, tmp_path):
    rows = [(i, f"text {i % 50}", ["en", "fr"][i % 2], f"src{i % 20}") for i in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("name, n", [("tree_status", None), ("replaced_pools", 150), ("pools_round_trip", 250)])
def test_queries_compress_their_pools(spark, documents_folder, pools_folder, name, n):
    files, root = pools_folder
    result = getattr(files, name)(spark, documents_folder)
    assert data_files(root) and all(name.endswith(".json.gz") for name in data_files(root))
    if n is None:
        assert {(r.task, r.corpus): r.status for r in result.collect()}["raw", "absent"] == "MISSING"
    elif name == "replaced_pools":
        rows = result.collect()
        assert sum(r.n_rows for r in rows) == n and all(r.n_rows == r.n_texts for r in rows)
    else:
        assert result.count() == n


def test_replaced_pools_shuffle_no_texts(spark, documents_folder, pools_folder):
    files, _ = pools_folder
    plan = files.replaced_pools(spark, documents_folder)._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert keys and not [line for line in keys if "text#" in line.replace("sha2(cast(text#", "")]


@pytest.mark.parametrize("name, runner", [("corpora_failed", "run_corpora"), ("corpora_run", "run_corpora"), ("corpora_run_reports", "run_with_reports")])
def test_corpora_queries_ask_for_compressed_pools(spark, pools_folder, monkeypatch, name, runner):
    files, _ = pools_folder
    asked = []

    class Ran:
        reports = None

    monkeypatch.setattr(files, "_write_raw_corpora", lambda *_: None)
    monkeypatch.setattr(files, "failed_count", lambda status: status)
    monkeypatch.setattr(files, runner, lambda *args, compression=None: asked.append(compression) or Ran())
    getattr(files, name)(spark, "none")
    assert asked == ["gzip"]


@pytest.mark.parametrize("layout", ["hive", "few_shot"])
def test_a_run_writes_compressed_pools(spark, tmp_path, layout):
    from foldloom.plans.corpus import run_with_reports
    from foldloom.plans.spec import CorpusSpec, JsonLines

    (tmp_path / "raw" / "c").mkdir(parents=True)
    (tmp_path / "raw" / "c" / "a.jsonl").write_text("\n".join(f'{{"x": "t{i}", "y": "l"}}' for i in range(20)))
    spec = CorpusSpec("t", "c", ["a.jsonl"], "x", "y", source=JsonLines())
    run = run_with_reports(spark, [spec], str(tmp_path / "raw"), str(tmp_path / "out"), layout=layout, compression="gzip")
    assert [r.status for r in run.status.collect()] == ["OK"]
    assert all(name.endswith(".json.gz") for name in data_files(tmp_path / "out"))
    assert len(lines(spark, tmp_path / "out", layout)) == 100
