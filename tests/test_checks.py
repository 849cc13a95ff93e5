import json

import pytest
from pyspark.sql import functions as F

from foldloom.operators import checks
from foldloom.plans.validation import validate_tree
from foldloom.sources.pools import parse_lines, pool_rows, record_facts


def pools(spark, rows):
    """Facts of in-memory pools from ``(k, split, text, label)``."""
    df = spark.createDataFrame(rows, "k string, split string, text string, label string")
    return record_facts(pool_rows(df.select(F.lit("t").alias("task"), F.lit("c").alias("corpus"), "*")))


def found(issues):
    return {(r.k, r.split, r.check, r.severity, r.n) for r in issues.collect()}


def rotation(texts, k="01", labels="ab"):
    """Sound pools of one rotation: 60/20/20 of the texts, all labels everywhere."""
    n = len(texts)
    cut = {"train": texts[: n * 3 // 5], "valid": texts[n * 3 // 5 : n * 4 // 5], "test": texts[n * 4 // 5 :]}
    return [(k, split, t, labels[i % len(labels)]) for split, part in cut.items() for i, t in enumerate(part)]


TEXTS = [f"text {i}" for i in range(20)]


def test_sound_pools_have_no_findings(spark):
    issues = checks.all_issues(pools(spark, rotation(TEXTS)))
    # One rotation instead of five is for information only.
    assert {(i[2], i[3], i[4]) for i in found(issues)} == {("fold_count", "INFO", 1)}


def test_duplicates_and_leakage(spark):
    rows = rotation(TEXTS) + [("01", "train", "text 0", "a"), ("01", "test", "text 0", "a"), ("01", "valid", "text 19", "b"), ("01", "test", None, "a"), ("01", "valid", "", "a")]
    issues = checks.text_issues(checks.text_presence(pools(spark, rows)))
    assert found(issues) == {
        ("01", "train", "duplicate_texts", "ERROR", 1),
        ("01", "train,test", "leakage", "ERROR", 1),
        # A missing text is the same as an empty one.
        ("01", "valid,test", "leakage", "ERROR", 2),
    }
    detail = {r.split: r.detail for r in issues.where("check = 'leakage'").collect()}
    assert detail == {"train,test": ["text 0"], "valid,test": ["", "text 19"]}


def test_examples_are_three_and_cut_to_sixty_characters(spark):
    rows = [("01", split, f"{i}" + "ç" * 100, "a") for i in range(5) for split in ("train", "test")]
    issue = checks.text_issues(checks.text_presence(pools(spark, rows))).collect()[0]
    assert issue.n == 5 and len(issue.detail) == 3 and all(len(d) == 60 for d in issue.detail)


def test_texts_that_differ_after_the_example_are_different(spark):
    rows = [("01", "train", "x" * 500 + "1", "a"), ("01", "test", "x" * 500 + "2", "a")]
    assert found(checks.text_issues(checks.text_presence(pools(spark, rows)))) == set()


def test_labels(spark):
    rows = [("01", "train", "1", "a"), ("01", "train", "2", "b"), ("01", "valid", "3", "a"), ("01", "valid", "4", "c"), ("01", "valid", "5", None)]
    issues = checks.label_issues(checks.label_presence(pools(spark, rows)))
    assert found(issues) == {
        ("01", "valid", "labels_not_in_train", "WARN", 2),
        ("01", "valid", "labels_of_train_absent", "WARN", 1),
    }
    assert {tuple(r.detail) for r in issues.collect()} == {("", "c"), ("b",)}
    # Without a train set every label is one that train lacks.
    assert found(checks.label_issues(checks.label_presence(pools(spark, [("02", "test", "1", "a")])))) == {
        ("02", "test", "labels_not_in_train", "WARN", 1)
    }


@pytest.mark.parametrize("sizes, off", [((60, 20, 20), []), ((65, 20, 15), []), ((66, 20, 14), ["test", "train"]), ((50, 25, 25), ["train"])])
def test_shares_are_off_beyond_five_points(spark, sizes, off):
    rows = [("01", split, f"{split}{i}", "a") for split, n in zip(("train", "valid", "test"), sizes) for i in range(n)]
    issues = checks.place_issues(checks.profile(pools(spark, rows))).where("check = 'split_share'")
    assert sorted(r.split for r in issues.collect()) == off


def test_test_sets_of_two_rotations(spark):
    rows = [(k, "test", t, "a") for k, texts in {"01": "xyz", "02": "yz", "03": "z", "05": "q"}.items() for t in texts]
    issues = checks.rotation_issues(pools(spark, rows))
    assert {(r.k, r.n) for r in issues.collect()} == {("01,02", 2), ("01,03", 1), ("02,03", 1)}


LINES = {
    '{"text": "a", "label": "x"}': set(),
    '{"text": 5, "label": "x"}': {"text_not_string"},
    '{"text": 0, "label": "x"}': {"text_not_string", "empty_text"},
    '{"label": "x"}': {"missing_keys", "empty_text", "text_not_string"},
    '{"text": "a", "label": null}': {"empty_label", "label_not_string"},
    '{"text": "a", "label": " \\t"}': {"empty_label"},
    '{"text": "\\u00a0", "label": "x"}': {"empty_text"},
    '{"text": "a", "label": "x", "more": 1}': {"extra_keys"},
    '{"text": "a", "label": ["x"]}': {"label_not_string"},
    "{bad": {"bad_json"},
    "123": {"bad_json"},
    "[]": {"bad_json"},
}


@pytest.mark.parametrize("line, expected", LINES.items())
def test_values(spark, line, expected):
    lines = spark.createDataFrame([("t", "c", "01", "train", line)], "task string, corpus string, k string, split string, value string")
    issues = checks.place_issues(checks.profile(record_facts(parse_lines(lines))))
    assert {r.check for r in issues.collect()} - {"split_share"} == expected


def write_plain(root, corpus, k, split, lines):
    folder = root / "t" / corpus / "few_shot" / k
    folder.mkdir(parents=True, exist_ok=True)
    content = b"\n".join(line if isinstance(line, bytes) else json.dumps(line, ensure_ascii=False).encode() for line in lines)
    (folder / f"{split}.jsonl").write_bytes(content)


def write_corpus(root, corpus, texts=TEXTS, folds=5, skip=(), extra={}):
    folds_of = [texts[i::5] for i in range(5)]
    for i in range(folds):
        parts = {"test": folds_of[i], "valid": folds_of[(i + 1) % 5]}
        parts["train"] = [t for j in range(5) if j not in (i, (i + 1) % 5) for t in folds_of[j]]
        for split, part in parts.items():
            if (i + 1, split) in skip:
                continue
            rows = [{"text": t, "label": "ERRO"} for t in part] + extra.get((i + 1, split), [])
            write_plain(root, corpus, f"{i + 1:02d}", split, rows)


def test_tree_of_single_files(spark, tmp_path):
    """Every kind of corpus status, on the layout with one file per split."""
    write_corpus(tmp_path, "sound")
    write_corpus(tmp_path, "four", folds=4)
    write_corpus(tmp_path, "gap", skip={(2, "valid")})
    write_corpus(tmp_path, "warn", extra={(1, "valid"): [{"text": "new", "label": "other ERRO"}]})
    write_corpus(tmp_path, "broken", extra={(3, "test"): [b"{bad", b""], (3, "train"): [b'{"text": "a\xe7\xe3o", "label": "ERRO"}']})
    write_corpus(tmp_path, "blank")
    write_plain(tmp_path, "blank", "05", "train", [b"", b"  "])
    (tmp_path / "t" / "hollow" / "few_shot").mkdir(parents=True)
    names = ["sound", "four", "gap", "warn", "broken", "blank", "hollow", "absent"]
    result = validate_tree(spark, str(tmp_path), [("t", name) for name in names], layout="few_shot")

    status = {r.corpus: r.status for r in result.status.collect()}
    assert status == {
        "sound": "OK", "four": "OK", "gap": "FAIL", "warn": "WARN", "broken": "FAIL", "blank": "FAIL", "hollow": "EMPTY", "absent": "MISSING"
    }
    issues = {(r.corpus, r.k, r.split, r.check, r.n) for r in result.issues.collect() if r.severity == "ERROR"}
    assert issues == {
        ("gap", "02", "valid", "missing_file", 1),
        ("broken", "03", "test", "bad_json", 1),
        ("broken", "03", "train", "bad_json", 1),
        ("broken", "03", "train", "bad_utf8", 1),
        ("blank", "05", "train", "empty_split", 1),
    }
    info = {(r.corpus, r.n) for r in result.issues.where("severity = 'INFO'").collect()}
    assert info == {("four", 4)}
    assert {r.status: r.n_corpora for r in result.summary.collect()} == {"OK": 2, "WARN": 1, "FAIL": 3, "MISSING": 2}
    assert tuple(result.gate.first()) == (False, "FAILED")


def test_gate_passes_with_warnings(spark):
    status = lambda *names: spark.createDataFrame([("t", str(i), s) for i, s in enumerate(names)], "task string, corpus string, status string")
    assert tuple(checks.gate(status("OK", "WARN")).first()) == (True, "PASSED_WITH_WARNINGS")
    assert tuple(checks.gate(status("OK", "OK")).first()) == (True, "PASSED")
    assert tuple(checks.gate(status("OK", "MISSING")).first()) == (False, "FAILED")
    assert tuple(checks.gate(status("EMPTY")).first()) == (False, "FAILED")


def test_a_label_finding_names_all_labels(spark):
    rows = rotation(TEXTS) + [("01", "test", f"more {i}", f"label {i:02d}") for i in range(12)]
    issues = checks.label_issues(checks.label_presence(pools(spark, rows)))
    assert [(r.split, r.check, r.n, r.detail) for r in issues.collect()] == [("test", "labels_not_in_train", 12, [f"label {i:02d}" for i in range(12)])]


def test_an_empty_rotation_folder_is_seen(spark, tmp_path):
    folder = tmp_path / "t" / "c" / "few_shot"
    for k, split, text, label in rotation(TEXTS):
        path = folder / k / f"{split}.jsonl"
        path.parent.mkdir(parents=True, exist_ok=True)
        with open(path, "a") as out:
            out.write(json.dumps({"text": text, "label": label}) + "\n")
    (folder / "03").mkdir()
    with validate_tree(spark, str(tmp_path), [("t", "c")], layout="few_shot") as result:
        got = {i[:4] for i in found(result.issues) if i[2] == "missing_file"}
    assert got == {("03", split, "missing_file", "ERROR") for split in ("train", "valid", "test")}
