"""Near-duplicate classes against all pairs of full sets, and the parts of the sketch."""

import random
import re

import numpy as np
import pytest

from foldloom.llm import hyperminhash as H

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, component_id int, `a.b` string"


def prose(rng, n):
    return ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(n)]


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def classes(rows, percent):
    sets, inside = [shingle_set(r[1]) for r in rows], {}
    numbers = {}
    rows_of = [np.array(sorted(numbers.setdefault(g, len(numbers)) for g in s), int) for s in sets]
    held = np.zeros((len(rows), len(numbers)), np.float32)
    for i, own in enumerate(rows_of):
        held[i, own] = 1
    both, n = held @ held.T, held.sum(1)
    linked = (both > 0) & (100 * both >= percent * (n[:, None] + n[None] - both))
    label = np.arange(len(rows))
    while True:
        new = np.array([label[row].min() if row.any() else label[i] for i, row in enumerate(linked)])
        new = new[new]
        if (new == label).all():
            break
        label = new
    for i, r in enumerate(rows):
        if r[0] is not None:
            inside[label[i]] = min(r[0], inside.get(label[i], r[0]))
    return sorted(((r[0], len(sets[i]), c, r[0] == c) for i, r in enumerate(rows) for c in [inside.get(label[i])]), key=str)


def check(spark, rows, percent=85):
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(5)
    assert sorted(map(tuple, H.near_duplicates(docs, percent=percent).collect()), key=str) == classes(rows, percent)


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(words)), n):
        out[i] = "changed" + str(rng.randrange(10**9))
    return out


def test_nulls_empty_short_long_and_repeated_texts(spark):
    rng = random.Random(1)
    base = prose(rng, 120)
    long = prose(rng, 20_000)
    texts = [
        base, [w.upper() for w in base], edited(rng, base, 1), edited(rng, base, 2), edited(rng, base, 9), base[:-1], base[:12], base[:11], base[1:12], base[:4],
        long, edited(rng, long, 200), long[:-300], long[:15_000],
    ]
    rows = [(100 + i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(3, None), (2, ""), (1, " \t\n"), (9, "One"), (8, "one"), (7, "one two"), (103, " ".join(base)), (100, " ".join(base)), (100, " ".join(base)), (100, " ".join(prose(rng, 30)))]
    rows += [(None, " ".join(base)), (None, None)]
    check(spark, rows)
    assert H.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_text_held_by_null_ids_only_links_with_nothing(spark):
    rng = random.Random(2)
    base = prose(rng, 100)
    rows = [(1, " ".join(base[:-1])), (None, " ".join(base)), (None, " ".join(base))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, H.near_duplicates(docs).collect()), key=str) == sorted([(1, 95, 1, True), (None, 96, None, True), (None, 96, None, True)], key=str)


@pytest.mark.parametrize("percent", [85, 70])
def test_a_large_group_of_near_copies_with_several_classes(spark, percent):
    """More members than a block, each a few to many edits from its base, and chains whose ends do not link."""
    rng = random.Random(3)
    base, rows = prose(rng, 150), []
    for i in range(900):
        rows.append((5000 - i, " ".join(edited(rng, base, rng.randrange(0, 16)))))
    words = prose(rng, 200)
    for i in range(60):
        words = edited(rng, words, 2)
        rows.append((9000 - i, " ".join(words)))
    for i in range(300):
        rows.append((20_000 + i, " ".join(prose(rng, rng.randrange(1, 40)))))
    check(spark, rows, percent)


def test_small_sets_near_the_threshold(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        words = prose(rng, rng.randrange(9, 40))
        rows += [(4 * i, " ".join(words)), (4 * i + 1, " ".join(words[: -rng.randrange(1, 4)])), (4 * i + 2, " ".join([*words, *prose(rng, rng.randrange(1, 4))]))]
    check(spark, rows)


def test_registers_hold_leading_zeros_and_the_bits_after_the_first_one():
    rng = random.Random(5)
    values = [rng.getrandbits(64) >> rng.randrange(0, 50) for _ in range(2000)]
    want = []
    for v in values:
        zeros = 64 - v.bit_length()
        bits = format(v, "064b")
        want.append(53 << 10 if zeros > 52 else zeros << 10 | int((bits[zeros + 1 :] + "0" * 10)[:10], 2))
    got = H.compressed(np.array(values, np.uint64))
    assert [(g >> 10, g & 1023) for g, z in zip(got.tolist(), want) if z >> 10 < 53] == [(z >> 10, z & 1023) for z in want if z >> 10 < 53]


def test_estimates_are_right_on_average_and_chance_matches_are_counted():
    rng = np.random.default_rng(6)
    for n, share in ((40, 0.8), (400, 0.85), (3000, 0.5)):
        errors = []
        for _ in range(300):
            own = rng.integers(0, 2**64, n, np.uint64)
            both = round(2 * n * share / (1 + share))
            other = np.concatenate([own[:both], rng.integers(0, 2**64, n - both, np.uint64)])
            a, b = H.registers([own, other])
            errors.append(H.estimate(np.array([(a == b).sum()]), np.array([n]), np.array([n]))[0] - both / (2 * n - both))
        assert abs(np.mean(errors)) < 0.01
        assert np.std(errors) < 1.4 * np.sqrt(share * (1 - share) * (1 / H.REGISTERS + 1 / n))
    # The sum over counts of zeros against the sum over every cell of zeros and mantissa.
    n, m = 50, 90
    low = (2.0 ** -np.arange(1, 55))[:, None] * (1 + np.arange(1024) / 1024)
    high = low + (2.0 ** -np.arange(1, 55))[:, None] / 1024
    cells = [((1 - low / 160) ** s - (1 - high / 160) ** s) / (1 - (1 - 1 / 160) ** s) for s in (n, m)]
    assert abs(160 * (cells[0] * cells[1]).sum() / H.chance_matches(np.array([n]), np.array([m]))[0] - 1) < 0.02


def test_bitmaps_never_differ_in_more_bits_than_sets_in_members():
    rng = np.random.default_rng(7)
    for _ in range(200):
        n, m = rng.integers(1, 300, 2)
        both = rng.integers(0, 2**64, rng.integers(0, 200), np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 2**64, k, np.uint64)]) for k in (n, m))
        assert H.bits_apart(H.bitmap(a), H.bitmap(b)) <= n + m
