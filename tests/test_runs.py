import json
import os
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from foldloom.operators.dedup import with_order_key
from foldloom.operators.folds import dedup_and_fold
from foldloom.operators.pools import rotate
from foldloom.operators.sinks import write_few_shot_tree, write_fold_table, write_pools
from foldloom.plans.corpus import failed_count, run_corpora, run_with_reports
from foldloom.plans.registry import BY_NAME, SPECS
from foldloom.plans.validation import validate_tree
from foldloom.sources.pools import scan_lines

N = 30


def raw_content(spec):
    """Raw rows of the spec: N good ones, one copy, and some that must go."""
    labels = {
        "RulingBRCorpus": ["direito civil", "direito penal"], "EniacCorpus": ["lazer, bar", "comida"],
        "MMLU_PTBR_Corpus": ["anatomy", "virology"], "RecognasummCorpus": ["saúde", "Mundo"],
        "HateBRCorpus": ["0", "1"], "TuPyCorpus": ["0", "1"], "CourtDecisionCorpus": ["yes", "no"],
        "IntentPTCorpus": ["play_game", "general_greet"], "KaggleTweetsCorpus": ["Positivo", "Negativo"],
        "OlistCorpus": ["0", "1"], "BuscapeCorpus": ["0", "1"],
    }.get(spec.corpus, ["1", "5"])
    rows = [{spec.text_column: f"ação {i}", spec.label_column: labels[i % 2], spec.title_column or "other": f"t{i}"} for i in range(N)]
    rows.append({**rows[0], spec.label_column: labels[1]})
    rows.append({spec.text_column: "no label", spec.title_column or "other": "x"})
    return rows


def write_raw(spark, root, spec):
    rows = raw_content(spec)
    (root / spec.corpus).mkdir(parents=True)
    columns = [*dict.fromkeys(c for row in rows for c in row)]
    share = -(-len(rows) // len(spec.files))
    for no, name in enumerate(spec.files):
        part = rows[no * share : (no + 1) * share]
        path = root / spec.corpus / name
        if name.endswith(".jsonl"):
            path.write_text("\n".join(json.dumps(row, ensure_ascii=False) for row in part) + "\n{bad\n")
        elif name.endswith(".parquet"):
            df = spark.createDataFrame([tuple(row.get(c) for c in columns) for row in part], ", ".join(f"{c} string" for c in columns))
            df.coalesce(1).write.parquet(str(path))
        else:
            sep = {"MMLU_PTBR_Corpus": "\t", "CourtDecisionCorpus": "<=>"}.get(spec.corpus, ",")
            quoted = lambda value: f'"{value}"' if "," in value and sep == "," else value
            text = "\n".join(sep.join(quoted(row.get(c, "")) for c in columns) for row in [dict(zip(columns, columns)), *part])
            path.write_bytes(text.encode("latin-1" if spec.corpus == "OlistCorpus" else "utf-8"))


@pytest.fixture(scope="module")
def full_run(spark, tmp_path_factory):
    raw, out = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("out")
    for spec in SPECS:
        write_raw(spark, raw, spec)
    status = run_corpora(spark, SPECS, str(raw), str(out))
    return status, out


def test_all_corpora_are_built(full_run):
    status, _ = full_run
    rows = {r.corpus: r for r in status.collect()}
    assert set(rows) == set(BY_NAME)
    assert {r.status for r in rows.values()} == {"OK"}
    for spec in SPECS:
        bad_lines = len(spec.files) if spec.files[0].endswith(".jsonl") else 0
        assert (rows[spec.corpus].rows_in, rows[spec.corpus].rows_kept) == (N + 2 + bad_lines, N + 1), spec.corpus
    assert tuple(failed_count(status).first()) == (15, 0)


def test_written_tree_is_valid(spark, full_run):
    _, out = full_run
    result = validate_tree(spark, str(out), [(s.task, s.corpus) for s in SPECS])
    assert result.issues.where("severity = 'ERROR'").count() == 0
    assert {r.status for r in result.status.collect()} <= {"OK", "WARN"}
    assert result.gate.first().passed


def test_written_lines(full_run):
    """Key order, plain UTF-8, zero-padded folders; every text once per rotation, and the first label wins."""
    _, out = full_run
    for spec in SPECS:
        root = out / f"task={spec.task}" / f"corpus={spec.corpus}"
        seen = defaultdict(list)
        for k in range(1, 6):
            for split in ("train", "valid", "test"):
                lines = [line for f in (root / f"k={k:02d}" / f"split={split}").glob("*.json") for line in f.read_text().splitlines()]
                assert len(lines) == (18 if split == "train" else 6)
                for line in lines:
                    assert line.startswith('{"text":"') and '","label":"' in line and "ação" in line
                    seen[json.loads(line)["text"]].append((split, json.loads(line)["label"]))
        assert len(seen) == N
        for places in seen.values():
            assert Counter(s for s, _ in places) == {"train": 3, "valid": 1, "test": 1}
            assert len({label for _, label in places}) == 1


def test_failed_corpora_keep_their_old_pools(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    spec = BY_NAME["HateBRCorpus"]
    write_raw(spark, raw, spec)
    run_corpora(spark, [spec], str(raw), str(out))
    before = sorted(r.value for r in scan_lines(spark, str(out)).collect())
    assert len(before) == 5 * N
    path = raw / "HateBRCorpus" / "HateBR.csv"
    good = path.read_text()
    for content, expected in (
        (good + "\nnovo,dois,x", "BAD_LABEL_TYPE"), (good + "\nnovo,1,x,y", "RAGGED"), ("comentario,label_final\nx,7\n", "EMPTY"), ("a,b\n1,2\n", "MISSING_COLUMNS"),
    ):
        path.write_text(content)
        assert [r.status for r in run_corpora(spark, [spec], str(raw), str(out)).collect()] == [expected]
        assert sorted(r.value for r in scan_lines(spark, str(out)).collect()) == before


def test_stratified_corpora_need_one_class_for_all_folds(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    spec = BY_NAME["IntentPTCorpus"]
    (raw / spec.corpus).mkdir(parents=True)
    path = raw / spec.corpus / "pt-PT.jsonl"
    lines = [json.dumps({"utt": f"t{i}", "intent": f"c{i % 3}"}) for i in range(12)] * 2
    for content, expected in ((lines, "CLASSES_TOO_SMALL"), ([*lines, '{"utt": "more", "intent": "c0"}'], "OK")):
        path.write_text("\n".join(content))
        assert [r.status for r in run_corpora(spark, [spec], str(raw), str(out)).collect()] == [expected]
    assert [r.status for r in run_corpora(spark, [spec], str(tmp_path / "none"), str(out)).collect()] == ["NO_INPUT"]


def test_an_exception_in_one_corpus_does_not_stop_the_others(spark, tmp_path):
    raw = tmp_path / "raw"
    specs = [BY_NAME["HateBRCorpus"], BY_NAME["BrandsCorpus"]]
    write_raw(spark, raw, specs[0])
    (raw / "BrandsCorpus").mkdir()
    (raw / "BrandsCorpus" / "brandsBr.parquet").write_text("not parquet")
    status = {r.corpus: r.status for r in run_corpora(spark, specs, str(raw), str(tmp_path / "out")).collect()}
    assert status["HateBRCorpus"] == "OK" and status["BrandsCorpus"] == "ERROR"


def test_a_smaller_corpus_leaves_no_stale_splits(spark, make_rows, tmp_path):
    root = str(tmp_path)
    write_pools(dedup_and_fold(make_rows([(i, f"t{i}", "a") for i in range(10)])), root, "t", "c")
    write_pools(dedup_and_fold(make_rows([(1, "only", "b")])), root, "t", "c", rebalance=True)
    places = {(r.k, r.split, r.value) for r in scan_lines(spark, root).collect()}
    line = '{"text":"only","label":"b"}'
    assert places == {("01", "test", line), ("02", "train", line), ("03", "train", line), ("04", "train", line), ("05", "valid", line)}


def test_partition_filters_reach_the_tree_scan(spark, make_rows, tmp_path):
    write_pools(dedup_and_fold(make_rows([(i, f"t{i}", "a") for i in range(10)])), str(tmp_path), "t", "c")
    lines = scan_lines(spark, str(tmp_path)).where("k = '01' AND split = 'test'")
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan
    assert lines.count() == 2


def test_fold_table_gives_the_same_pools(spark, make_rows, tmp_path):
    folded = dedup_and_fold(make_rows([(i, f"t{i}", "a") for i in range(17)]))
    stored = spark.read.parquet(write_fold_table(folded, str(tmp_path), "t", "c"))
    pools = lambda df: sorted((r.text, r.k, r.split) for r in rotate(df).collect())
    assert pools(stored) == pools(folded)


def test_seed_changes_the_folds(spark):
    df = spark.createDataFrame([(i, f"t{i}", "a") for i in range(50)], "row_id bigint, text string, label string")
    folds = [{r.text: r.fold for r in dedup_and_fold(with_order_key(df, seed)).collect()} for seed in (42, 42, 43)]
    assert folds[0] == folds[1] != folds[2]


def test_plain_layout(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    spec = BY_NAME["IntentPTCorpus"]
    write_raw(spark, raw, spec)
    status = run_corpora(spark, [spec], str(raw), str(out), layout="few_shot")
    assert [r.status for r in status.collect()] == ["OK"]
    result = validate_tree(spark, str(out), [("intent", "IntentPTCorpus"), ("intent", "none")], layout="few_shot")
    assert {r.corpus: r.status for r in result.status.collect()} == {"IntentPTCorpus": "OK", "none": "MISSING"}
    sizes = Counter((r.k, r.split) for r in scan_lines(spark, str(out), "few_shot").collect())
    assert sizes == {(f"{k:02d}", s): n for k in range(1, 6) for s, n in (("train", 18), ("valid", 6), ("test", 6))}


def test_plain_layout_keeps_empty_splits_as_files(spark, make_rows, tmp_path):
    stored = spark.read.parquet(write_fold_table(dedup_and_fold(make_rows([(1, "a", "x"), (2, "b", "x")])), str(tmp_path / "f"), "t", "c"))
    write_few_shot_tree(stored, str(tmp_path / "out"), "t", "c")
    issues = validate_tree(spark, str(tmp_path / "out"), [("t", "c")], layout="few_shot").issues
    checks = Counter(r.check for r in issues.collect())
    # Folds 3 to 5 are empty: as test set in three rotations, as valid set in three, as train set in the first.
    assert checks["empty_split"] == 7 and "missing_file" not in checks


def write_lines(path, lines):
    path.parent.mkdir(parents=True)
    path.write_text("\n".join(json.dumps(line, ensure_ascii=False) if isinstance(line, dict) else line for line in lines))


@pytest.mark.parametrize("layout", ["hive", "few_shot"])
def test_reports_of_a_run(spark, tmp_path, layout):
    raw, out = tmp_path / "raw", tmp_path / "out"
    intents = [{"utt": f"t{i % 18}", "intent": ("play_game", "no such", "general_greet")[i % 3]} for i in range(36)]
    write_lines(raw / "IntentPTCorpus" / "pt-PT.jsonl", [*intents, "{bad", {"utt": "x"}, {"intent": "other"}])
    news = [{"Noticia": f"n{i}", "Categoria": ("saúde", "nenhuma", None)[i % 3]} for i in range(30)]
    write_lines(raw / "RecognasummCorpus" / "train.jsonl", news)
    write_raw(spark, raw, BY_NAME["HateBRCorpus"])
    specs = [BY_NAME[name] for name in ("IntentPTCorpus", "RecognasummCorpus", "HateBRCorpus", "OlistCorpus")]
    with run_with_reports(spark, specs, str(raw), str(out), layout=layout) as run:
        status = {r.corpus: r.status for r in run.status.collect()}
        got = {(r.corpus, r.report, r.item): r.n for r in run.reports.collect()}
    assert status == {"IntentPTCorpus": "OK", "RecognasummCorpus": "OK", "HateBRCorpus": "OK", "OlistCorpus": "NO_INPUT"}
    part = lambda corpus, report: {item: n for (c, r, item), n in got.items() if (c, r) == (corpus, report)}
    assert part("IntentPTCorpus", "reject") == {"kept": 36, "bad_line": 1, "null_label": 1, "null_text": 1}
    assert part("IntentPTCorpus", "unmapped") == {"no such": 12}
    assert part("IntentPTCorpus", "dedup") == {"rows_before": 36, "rows_after": 18, "rows_removed": 18}
    assert part("RecognasummCorpus", "reject") == {"kept": 10, "label_unmapped": 10, "null_label": 10}
    assert part("RecognasummCorpus", "unmapped") == {"nenhuma": 10}
    assert part("HateBRCorpus", "unmapped") == {}
    for corpus, n in (("IntentPTCorpus", 18), ("RecognasummCorpus", 10), ("HateBRCorpus", N)):
        written = Counter(f"{r.k}/{r.split}" for r in scan_lines(spark, str(out), layout).where(F.col("corpus") == corpus).collect())
        assert written == part(corpus, "split_size") and sum(written.values()) == 5 * n
    assert not [c for c, _, _ in got if c == "OlistCorpus"]


def test_nothing_staged_stays_after_a_run(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    raw = tmp_path / "raw"
    write_raw(spark, raw, BY_NAME["IntentPTCorpus"])
    before = set(os.listdir(shared))
    with run_with_reports(spark, [BY_NAME["IntentPTCorpus"]], str(raw), str(tmp_path / "out")) as run:
        assert run.status.first().status == "OK"
    run_corpora(spark, [BY_NAME["IntentPTCorpus"]], str(raw), str(tmp_path / "out"))
    assert set(os.listdir(shared)) == before


def test_json_lines_without_a_column_are_not_taken_for_empty_ones(spark, tmp_path):
    spec = BY_NAME["IntentPTCorpus"]
    path = tmp_path / "raw" / spec.corpus / "pt-PT.jsonl"
    path.parent.mkdir(parents=True)
    cases = [
        (['{"utt": "a"}', '{"utt": "b", "x": 1}', "{bad"], "MISSING_COLUMNS"), (['{"x": 1}'], "MISSING_COLUMNS"),
        (['{"utt": "a"}', '{"intent": "b"}'], "EMPTY"), (["{bad"], "EMPTY"), ([""], "EMPTY"),
    ]
    for lines, expected in cases:
        path.write_text("\n".join(lines))
        assert [r.status for r in run_corpora(spark, [spec], str(tmp_path / "raw"), str(tmp_path / "out")).collect()] == [expected], lines


def test_failed_runs_leave_pools_and_count(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    write_raw(spark, raw, BY_NAME["HateBRCorpus"])
    status = run_corpora(spark, [BY_NAME["HateBRCorpus"], BY_NAME["OlistCorpus"]], str(raw), str(out))
    assert tuple(failed_count(status).first()) == (2, 1)
