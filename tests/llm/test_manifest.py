"""The manifest against trees built in plain Python."""

import hashlib
import random
import zlib

import pytest

from foldloom.llm import manifest as M
from foldloom.storage import scratch

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, hash int, slot int, `a.b` string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    return H(*map(encoded, (doc_id, source, lang, None if n_chars is None else n_chars + more, text)))


def build(nodes):
    """The root and for each node its steps: (sibling, whether it stands at the left)."""
    paths, level, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for i, place in enumerate(at):
            other = place ^ 1
            paths[i].append((level[other] if other < len(level) else None, other < place))
        level = [H(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at = [place // 2 for place in at]
    return level[0], paths


def brute(rows, every=7):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    names = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in names:
        trees[lang].sort(key=lambda row: (row[0] is not None, row[0] or 0, leaf(row)))
    built = {lang: build([leaf(row) for row in trees[lang]]) for lang in names}
    root, over = build([built[lang][0] for lang in names])
    out = []
    for lang, above in zip(names, over, strict=True):
        for row, path in zip(trees[lang], built[lang][1], strict=True):
            path = [*path, *above]
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % every == 0
            node = leaf(row, int(tampered))
            for sibling, left in path:
                node = H(node) if sibling is None else H(sibling, node) if left else H(node, sibling)
            proof = H(*(sibling for sibling, _ in path if sibling is not None))
            out.append((row[0], leaf(row), built[lang][0], root, proof, node, node == root))
    return sorted(out, key=str)


def check(spark, rows):
    with scratch(spark) as folder:
        docs = spark.createDataFrame([(*r, "t", 1, 2, "x") for r in rows], SCHEMA).repartition(3)
        got = M.manifest(docs, folder)
        assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def make(n, langs, rng):
    return [(i, f"text {rng.random()}", rng.choice(langs), rng.choice(["s", None]), rng.choice([None, i, 2**63 - 1])) for i in range(n)]


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (2, ["en"]), (3, [None]), (7, ["en", "de"]), (40, ["en", None, "", "é", "z", "𝄞", "￿"])])
def test_trees_of_few_leaves(spark, n, langs):
    check(spark, make(n, langs, random.Random(n)))


def test_trees_of_several_rounds(spark, monkeypatch):
    """Blocks of four leaves, so that trees of 1 to 70 leaves take up to four rounds, and more groups than a block holds."""
    monkeypatch.setattr(M, "LEVELS", 2)
    rng, rows = random.Random(1), []
    for lang, n in [("one", 1), ("four", 4), ("five", 5), ("sixteen", 16), ("17", 17), ("64", 64), ("65", 65), (None, 70), *((f"x{i}", 1) for i in range(9))]:
        rows += [(rng.randrange(10**6), "t", lang, "s", 5) for _ in range(n)]
    check(spark, rows)


def test_a_tree_longer_than_a_block(spark):
    check(spark, make(2500, ["en", "en", "en", "de"], random.Random(2)))


def test_ties_nulls_repeated_rows_and_long_texts(spark):
    rng = random.Random(3)
    rows = make(30, ["en", None], rng)
    rows += [rows[0], rows[0], (5, "other", "en", "s", 1), (None, "x", "en", "s", 1), (None, "y", "en", None, None), (None, None, None, None, None)]
    rows += [(100, "", "en", "", 0), (101, "ü" * 1_000_000, "en", "s", 1), (-7, "a:b|-", "en", "1:a", -1)]
    check(spark, rows)


def test_empty_table(spark):
    with scratch(spark) as folder:
        assert M.manifest(spark.createDataFrame([], SCHEMA), folder).count() == 0


def test_any_change_of_a_field_is_seen(spark):
    """Only untouched rows verify: every seventh key by crc32 is tampered with, except where the count is null."""
    rows = [(i, "t", "en", "s", i if i % 2 else None) for i in range(200)]
    with scratch(spark) as folder:
        got = {r.doc_id: r.verified for r in M.manifest(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"), folder).collect()}
    assert {i for i, verified in got.items() if not verified} == {i for i in range(200) if i % 2 and zlib.crc32(str(i).encode()) % 7 == 0}
