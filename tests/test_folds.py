import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foldloom.operators.dedup import dedup_first, dedup_stats, with_order_key
from foldloom.operators.folds import (
    contiguous_folds, dedup_and_fold, seeded_position, small_strata, stratified_folds,
)
from foldloom.operators.pools import few_shot, rotate, split_sizes


def key(text):
    return hashlib.sha256(f"42|{text}".encode()).digest()


def survivors(rows):
    first = {}
    for row_id, text, label in sorted(rows):
        first.setdefault(text, (row_id, label))
    return {text: first[text] for text in sorted(first, key=key)}


def even_sizes(n, folds=5):
    return [n // folds + (1 if i < n % folds else 0) for i in range(folds)]


def brute_contiguous(rows):
    texts = list(survivors(rows))
    folds, start = {}, 0
    for no, size in enumerate(even_sizes(len(texts)), 1):
        folds.update({text: no for text in texts[start : start + size]})
        start += size
    return folds


def brute_stratified(rows):
    """Deal the classes, in the order of their digests one after another, out to the folds in turn; then cut each class in its seeded order."""
    kept = survivors(rows)
    classes = defaultdict(list)
    for text, (_, label) in kept.items():
        classes[label].append(text)
    folds, place = {}, 0
    for label in sorted(classes, key=lambda label: hashlib.md5(f"={label}".encode()).hexdigest()):
        share = Counter((place + i) % 5 for i in range(len(classes[label])))
        place += len(classes[label])
        texts = iter(classes[label])
        for no in range(5):
            for _ in range(share[no]):
                folds[next(texts)] = no + 1
    return folds


def folds_of(df):
    return {r.text: r.fold for r in df.select("text", "fold").collect()}


def test_dedup_keeps_the_first_row_and_its_label(make_rows):
    rows = [(3, "a", "x"), (1, "a", "y"), (2, "b", "x"), (5, " a", "z"), (4, "b", "w")]
    for given_rows in (rows, rows[::-1]):
        kept = dedup_first(make_rows(given_rows, 3)).select("row_id", "text", "label").collect()
        assert sorted(map(tuple, kept)) == [(1, "a", "y"), (2, "b", "x"), (5, " a", "z")]
    assert dedup_stats(make_rows(rows)).first().asDict() == {"rows_before": 5, "rows_after": 3, "rows_removed": 2}


def test_dedup_stats_of_nothing(make_rows):
    assert dedup_stats(make_rows([])).first().asDict() == {"rows_before": 0, "rows_after": 0, "rows_removed": 0}


def test_dedup_orders_struct_row_ids(spark):
    rows = spark.createDataFrame(
        [((1, "a", 0, 9), "t", "late"), ((0, "b", 0, 99), "t", "early"), ((1, "a", 0, 3), "u", "first"), ((1, "a", 7, 1), "u", "later")],
        "row_id struct<input_no:int,file:string,block:bigint,seq:bigint>, text string, label string",
    )
    assert {r.label for r in dedup_first(with_order_key(rows)).collect()} == {"early", "first"}


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 23])
def test_contiguous_sizes(make_rows, n):
    rows = [(i, f"t{i}", "x") for i in range(n)]
    folds = folds_of(dedup_and_fold(make_rows(rows)))
    assert [Counter(folds.values())[i] for i in range(1, 6)] == even_sizes(n)
    assert folds == brute_contiguous(rows)


def test_stratified_small_classes(make_rows):
    rows = [(i * 100 + j, f"{i}/{j}", f"class{i}") for i, n in enumerate([1, 4, 5, 6, 13, 2]) for j in range(n)]
    folded = dedup_and_fold(make_rows(rows), "stratified")
    folds = folds_of(folded)
    assert folds == brute_stratified(rows)
    per_class = defaultdict(Counter)
    for _, text, label in rows:
        per_class[label][folds[text]] += 1
    for counts in per_class.values():
        sizes = [counts[i] for i in range(1, 6)]
        assert max(sizes) - min(sizes) <= 1
    total = Counter(folds.values())
    assert max(total.values()) - min(total.values()) <= 1


def test_classes_smaller_than_the_folds_are_reported(make_rows):
    rows = [(i, f"a{i}", "big") for i in range(9)] + [(100, "b", "one")]
    assert [tuple(r) for r in small_strata(make_rows(rows)).collect()] == [("one", 1, "WARN")]
    assert {r.severity for r in small_strata(make_rows(rows[6:])).collect()} == {"FAIL"}


@pytest.mark.parametrize("rule", ["contiguous", "stratified"])
def test_folds_do_not_depend_on_partitions_or_input_order(spark, make_rows, rule):
    rng = random.Random(1)
    rows = [(i, f"text {rng.randrange(150)}", rng.choice("abc")) for i in range(300)]
    expected = (brute_contiguous if rule == "contiguous" else brute_stratified)(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for shuffles, partitions, given_rows in ((1, 1, rows), (8, 7, rows[::-1]), (200, 3, sorted(rows, key=str))):
            spark.conf.set("spark.sql.shuffle.partitions", shuffles)
            assert folds_of(dedup_and_fold(make_rows(given_rows, partitions), rule)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcdefghijklmnopq"), st.sampled_from("xyz")), max_size=40))
def test_folds_agree_with_brute_force(make_rows, pairs):
    rows = [(i, text, label) for i, (text, label) in enumerate(pairs)]
    df = make_rows(rows)
    assert folds_of(dedup_and_fold(df)) == brute_contiguous(rows)
    assert folds_of(dedup_and_fold(df, "stratified")) == brute_stratified(rows)


def test_separate_steps_agree_with_the_fused_one(make_rows):
    rows = [(i, f"t{i % 41}", "abc"[i % 3]) for i in range(90)]
    deduped = dedup_first(make_rows(rows))
    assert folds_of(contiguous_folds(deduped)) == brute_contiguous(rows)
    assert folds_of(stratified_folds(deduped)) == brute_stratified(rows)


@pytest.mark.parametrize("fits", [True, False])
def test_broadcast_and_salted_joins_agree(make_rows, fits):
    rows = [(i, f"t{i}", "abc"[min(i % 5, 2)]) for i in range(80)]
    assert folds_of(dedup_and_fold(make_rows(rows), "stratified", fits=fits)) == brute_stratified(rows)
    grouped = dedup_and_fold(make_rows(rows).withColumn("corpus", F.col("label")), within=["corpus"], fits=fits)
    for name in "abc":
        part = [row for row in rows if row[2] == name]
        assert folds_of(grouped.where(F.col("corpus") == name)) == brute_contiguous(part)


def test_one_text_with_most_of_the_rows(make_rows):
    rows = [(i, "the same" if i % 3 else f"t{i}", "hot" if i % 2 else "cold") for i in range(3000)]
    assert folds_of(dedup_and_fold(make_rows(rows, 8))) == brute_contiguous(rows)
    assert folds_of(dedup_and_fold(make_rows(rows, 8), "stratified")) == brute_stratified(rows)


def test_seeded_position_is_the_rank_of_the_key(make_rows):
    rows = [(i, f"t{i}", "x") for i in range(500)]
    placed = {r.text: r.position for r in seeded_position(make_rows(rows)).collect()}
    assert placed == {text: i for i, text in enumerate(sorted((t for _, t, _ in rows), key=key))}


def test_other_fold_numbers(make_rows):
    rows = [(i, f"t{i}", "x") for i in range(23)]
    for n in (2, 3, 10):
        folds = Counter(folds_of(dedup_and_fold(make_rows(rows), n_folds=n)).values())
        assert [folds[i] for i in range(1, n + 1)] == even_sizes(23, n)


def test_rotation(make_rows):
    rows = [(i, f"t{i}", "xy"[i % 2]) for i in range(37)]
    folded = dedup_and_fold(make_rows(rows))
    pools = rotate(folded).select("text", "fold", "k", "split").collect()
    assert len(pools) == 5 * 37
    by_text = defaultdict(list)
    for row in pools:
        by_text[row.text].append(row.split)
        place = (row.fold - int(row.k)) % 5
        assert row.split == {0: "test", 1: "valid"}.get(place, "train")
    assert all(Counter(splits) == {"test": 1, "valid": 1, "train": 3} for splits in by_text.values())
    sizes = Counter((r.k, r.split) for r in pools)
    assert {(r.k, r.split): r.n_rows for r in split_sizes(folded).collect()} == sizes
    valid = {k: {r.text for r in pools if r.k == k and r.split == "valid"} for k in sorted({r.k for r in pools})}
    test = {k: {r.text for r in pools if r.k == k and r.split == "test"} for k in valid}
    assert list(valid) == ["01", "02", "03", "04", "05"]
    for k in range(1, 6):
        assert valid[f"{k:02d}"] == test[f"{k % 5 + 1:02d}"]


def test_few_shot_takes_the_first_of_every_class(make_rows):
    rows = [(i, f"t{i}", "a" if i < 50 else "b" if i < 56 else "c") for i in range(57)]
    folded = dedup_and_fold(make_rows(rows))
    got = defaultdict(set)
    for r in few_shot(folded, 3).collect():
        got[r.k, r.label].add(r.text)
    train = defaultdict(list)
    for r in rotate(folded).where("split = 'train'").collect():
        train[r.k, r.label].append(r.text)
    assert got == {place: set(sorted(texts, key=key)[:3]) for place, texts in train.items()}


def test_a_hundred_folds_have_names_of_their_own(make_rows):
    folded = dedup_and_fold(make_rows([(i, f"t{i}", "x") for i in range(300)]), n_folds=100)
    pools = rotate(folded, 100)
    names = {r.k: r.n for r in pools.where("split = 'test'").groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert names == {f"{k:02d}": 3 for k in range(1, 101)} and "100" in names
    assert pools.count() == 30_000


def test_classes_without_a_label_are_a_class(make_rows):
    rows = [(i, f"t{i}", None if i % 2 else "") for i in range(60)]
    folds = dedup_and_fold(make_rows(rows), "stratified").groupBy("fold", "label").agg(F.count("*").alias("n")).collect()
    assert {(r.fold, r.label): r.n for r in folds} == {(f, label): 6 for f in range(1, 6) for label in (None, "")}


def test_open_label_sets_have_no_window_over_all_classes(make_rows):
    rows = [(i, f"t{i}", f"class {i % 700}") for i in range(2000)]
    folded = dedup_and_fold(make_rows(rows, 4), "stratified", fits=False)
    assert folds_of(folded) == brute_stratified(rows)
    plan = folded._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line]
    assert windows and not [line for line in windows if "windowspecdefinition(_" in line and "ORDER" not in line and "ASC" in line.split("windowspecdefinition(")[1].split(",")[0]]


def test_open_label_sets_are_not_repeated_for_a_join(make_rows):
    """Each row is shuffled by its class once: limits of as many classes as rows are not repeated under every salt."""
    rows = [(i, f"t{i}", f"class {i % 700}") for i in range(1000)]
    folded = dedup_and_fold(make_rows(rows, 4), "stratified", fits=False)
    assert folds_of(folded) == brute_stratified(rows)
    assert "Generate" not in folded._jdf.queryExecution().executedPlan().toString()


def test_large_classes_among_open_ones(make_rows, monkeypatch):
    """Large classes get limits and small ones places, in one order of classes."""
    monkeypatch.setattr("foldloom.operators.folds.CLASS_ROWS", 12)
    labels = ["big"] * 60 + ["more"] * 31 + ["n"] * 17 + ["", "a", "a"]
    rows = [(i, f"t{i % 140}", labels[i] if i < len(labels) else f"class {i % 29}") for i in range(170)]
    assert folds_of(dedup_and_fold(make_rows(rows, 3), "stratified", fits=False)) == brute_stratified(rows)
    both = [(i, f"{corpus}{text}", f"{corpus}{label}") for corpus in "xy" for i, text, label in rows]
    grouped = make_rows(both).withColumn("corpus", F.substring("text", 1, 1))
    folded = dedup_and_fold(grouped, "stratified", within=["corpus"], fits=False)
    for corpus in "xy":
        assert folds_of(folded.where(F.col("corpus") == corpus)) == brute_stratified([row for row in both if row[1][0] == corpus])
