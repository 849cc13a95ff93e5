"""The corpus pipeline as a whole against a plain version of its stages, on a small folder of tables."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foldloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng, n):
    return ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(n)]


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(words)), n):
        out[i] = f"edit{rng.randrange(10**9)}"
    return out


def shingles(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []


def one_of_each_group(docs):
    sets = [set(shingles(WORD.findall((d[1] or "").lower()))) for d in docs]
    label = list(range(len(docs)))
    for _ in docs:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a & b and 100 * len(a & b) >= 80 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    least = {}
    for i, d in enumerate(docs):
        least[label[i]] = min(d[0], least.get(label[i], d[0]))
    return [d for i, d in enumerate(docs) if least[label[i]] == d[0]]


def without_repeats(docs):
    words = [WORD.findall(d[1] or "") for d in docs]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    out = []
    for d, w in zip(docs, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        out.append((d, gone, [x for x, g in zip(w, gone, strict=True) if not g]))
    return out


def holds(words, item):
    want = Counter(shingles(item))
    for start in range(max(1, len(words) - len(item) + 1)):
        own = Counter(shingles(words[start : start + len(item)]))
        both, either = sum((want & own).values()), sum((want | own).values())
        if both and 100 * both >= 80 * either:
            return True
    return False


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(1)
    base, passage, long = prose(rng, 120), prose(rng, 55), prose(rng, 20_000)
    items = [prose(rng, n) for n in (12, 40, 60)]
    texts = [prose(rng, rng.randrange(40, 160)) for _ in range(25)]
    texts += [base, base, edited(rng, base, 2), edited(rng, base, 3), edited(rng, base, 30), [w.upper() for w in base], long, long[:-100], long[:9_000]]
    texts += [prose(rng, 40) + passage + prose(rng, 30), passage + prose(rng, 60), prose(rng, 70) + passage, passage + ["x"] + passage]
    texts += [prose(rng, 30) + items[0] + prose(rng, 30), items[1], prose(rng, 20) + edited(rng, items[2], 1) + prose(rng, 9), prose(rng, 50) + items[1][:20]]
    texts += [["one"], ["one"], ["One", "two"], []]
    docs = [(10 * i, " ".join(t), "en", f"s{i % 3}" if i % 5 else None) for i, t in enumerate(texts)] + [(5, None, None, "s1"), (7, None, None, None), (9, " \n ", "en", "s0")]
    return [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in docs], [(i, " ".join(w)) for i, w in enumerate(items)] + [(9, None), (10, "")]


@pytest.fixture
def folder(spark, tmp_path, tables):
    docs, items = tables
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    # No document is marked, so the first stage lets all pass.
    spark.createDataFrame([(d[0], 0) for d in docs[::2]], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_rows_of_the_whole_pipeline(spark, folder, tables):
    docs, items = tables
    kept = without_repeats(one_of_each_group(docs))
    assert len(kept) <= len(docs) - 5 and sum(sum(gone) for _, gone, _ in kept) > 150
    item_words = [w for w in ([x.lower() for x in WORD.findall(t or "")] for _, t in items) if w]
    want = {d[0]: words for d, _, words in kept if not any(holds([x.lower() for x in words], item) for item in item_words)}
    assert len(want) < len(kept) - 2

    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: WORD.findall(r.text or "") for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
    sizes = Counter(r.source for r in got)
    names = sorted(sizes, key=lambda s: "" if s is None else f"={s}")
    slots = mixing.schedule([-(-sizes[s] // 100) for s in names], [sizes[s] ** 0.5 for s in names])
    assert sorted((r.source or "", r.block, r.slot, r.place) for r in got) == sorted((s or "", i // 100, own[i // 100], i % 100) for s, own in zip(names, slots, strict=True) for i in range(sizes[s]))


def test_stages_keep_the_columns_and_take_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "substring_dedup", "decontamination", "mixing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), folder)
        assert out.count() == 0 and out.columns[:5] == docs.columns, name
        if name != "mixing":
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]


def test_toxic_documents_go_first(spark, folder, tables):
    rng = random.Random(3)
    clean = [(1000 + i, " ".join(prose(rng, 40)), "en", "s0", 1) for i in range(120)]
    toxic = [(3000 + i, " ".join(prose(rng, 20) + ["vileword", "hatefulword"] + prose(rng, 20)), "en", "s0", 1) for i in range(120)]
    docs = spark.createDataFrame(clean + toxic, DOCS)
    marks = [(d[0], int(d[0] >= 3000)) for d in clean + toxic if d[0] % 3]
    spark.createDataFrame(marks, "doc_id bigint, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    left = corpus_pipeline.drop_toxic(spark, docs, folder).agg(F.count_if(F.col("doc_id") < 3000).alias("clean"), F.count_if(F.col("doc_id") >= 3000).alias("toxic")).first()
    assert left.clean == 120 and left.toxic == 0
