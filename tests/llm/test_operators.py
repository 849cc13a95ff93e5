"""Each operator against a brute-force version, on small tables with nulls, empty and long texts, ties and repeated rows."""

import base64
import gzip
import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foldloom.llm import components, decontamination, fingerprints, language, licenses, mixing, ngram_join, quality, substring_dedup, toxicity, warc, words
from foldloom.llm.components import connected
from foldloom.llm.fm_index import FMIndex

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, row string, part int, h string"


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, a shared passage, a text with a repeat of its own, null, empty, blank, short and long texts."""
    rng = random.Random(1)
    base, passage = prose(rng, 120), prose(rng, 50)
    near = base.split()
    near[60] = "CHANGED"
    own = prose(rng, 40)
    texts = [
        base, base, base.upper(), " ".join(near), prose(rng, 80) + " " + passage + "\n" + prose(rng, 60), passage + " " + prose(rng, 90),
        own + " x " + own, None, "", " \t\n", "one", "one", "One two", prose(rng, 3000), prose(rng, 34), prose(rng, 35),
        "ünï cödé " * 30, "é", "12 34",
    ]
    out = [(i, t, "en", "s0" if i % 3 else None, "r", i, "x") for i, t in enumerate(texts)]
    return out + [out[0], (None, base, None, "s1", "r", None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def test_ngram_join(docs, rows, empty):
    got = sorted(map(tuple, ngram_join.jaccard_join(docs).collect()), key=str)
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    smallest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            smallest[find(i)] = min(r[0], smallest.get(find(i), r[0]))
    assert got == sorted(((r[0], len(sets[i]), smallest[find(i)]) for i, r in enumerate(rows)), key=str)
    assert ngram_join.jaccard_join(empty).count() == 0


def test_ngram_join_in_lists_of_several_classes(spark):
    """Chains of near copies, where neighbours link and others do not, in groups that share a passage."""
    rng = random.Random(5)
    table, shared = [], prose(rng, 40)
    for group in range(3):
        words = (shared + " " + prose(rng, 60)).split()
        for step in range(12):
            table.append((100 * group + step, " ".join(words)))
            words[45 + 4 * step % 50] = f"edit{group}x{step}"
    sets = {i: shingle_set(t) for i, t in table}
    want = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    want[i] = min(want[i], want[j])
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_join(spark.createDataFrame(table, "doc_id bigint, text string")).collect()}
    assert got == want


def test_ngram_join_of_a_large_group_in_blocks(spark, monkeypatch):
    """Hundreds of classes in one list, more members than a block and than a chunk, repeated and null ids, and chains."""
    monkeypatch.setattr(ngram_join, "BLOCK", 48)
    monkeypatch.setattr(ngram_join, "CHUNK", 32)
    rng = random.Random(6)
    base, table = prose(rng, 150).split(), []

    def edit(words, n):
        out = list(words)
        for i in rng.sample(range(len(words)), n):
            out[i] = f"edit{rng.randrange(10**9)}"
        return out

    for i in range(600):
        table.append((2000 - i, " ".join(edit(base, rng.randrange(0, 24)))))
    words = prose(rng, 200).split()
    for i in range(80):
        words = edit(words, 3)
        table.append((3000 - i, " ".join(words)))
    table += [(5, table[3][1]), (1500, table[7][1]), (1500, table[7][1])]
    sets = [shingle_set(t) for _, t in table]
    held = np.zeros((len(table), len(set().union(*sets))), np.float32)
    number = {}
    for i, own in enumerate(sets):
        held[i, [number.setdefault(g, len(number)) for g in own]] = 1
    both, n = held @ held.T, held.sum(1)
    linked, label = 100 * both >= 80 * (n[:, None] + n[None] - both), np.arange(len(table))
    for _ in table:
        label = np.array([label[row].min() for row in linked])
    least = {}
    for i, (doc_id, _) in enumerate(table):
        least[label[i]] = min(doc_id, least.get(label[i], doc_id))
    assert len(least) > 100
    want = sorted((doc_id, len(sets[i]), least[label[i]]) for i, (doc_id, _) in enumerate(table))
    docs = spark.createDataFrame([*table, (None, table[0][1])], "doc_id bigint, text string").repartition(4)
    assert sorted(map(tuple, ngram_join.jaccard_join(docs).where("doc_id is not null").collect())) == want


def test_merge_skip_equals_counting():
    rng = random.Random(7)
    for _ in range(300):
        lists = [sorted(rng.sample(range(40), rng.randrange(1, 30))) for _ in range(rng.randrange(0, 12))]
        least = rng.randrange(1, 8)
        counts = Counter(v for own in lists for v in own)
        assert list(ngram_join.merge_skip(lists, least)) == sorted((v, n) for v, n in counts.items() if n >= least)


def test_representatives_keep_every_class(docs):
    kept = ngram_join.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted({r.doc_id for r in kept.collect() if r.doc_id is not None}) == [0, 4, 5, 6, 7, 8, 9, 10, 12, 13, 14, 15, 16, 17, 18]


def test_t_occurrence_equals_counting():
    rng = np.random.default_rng(3)
    query = np.unique(rng.integers(0, 400, 120).astype(np.uint64))
    members = []
    for drop in range(0, 60, 2):
        kept = rng.choice(query, len(query) - drop, replace=False)
        members.append(np.unique(np.concatenate([kept, rng.integers(400, 500, drop // 2).astype(np.uint64)])))
    want = [i for i, m in enumerate(members) if 180 * len(np.intersect1d(m, query)) >= 80 * (len(m) + len(query))]
    assert want and ngram_join.t_occurrence(query, members, 80) == want


def test_bitmaps_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    for n, m in ((5, 6), (60, 70), (500, 620), (1000, 1030)):
        a, b = (np.unique(rng.integers(0, 1 << 62, k).astype(np.uint64)) for k in (n, m))
        b = np.unique(np.concatenate([a[: n // 2], b]))
        apart = ngram_join.bits_apart(ngram_join.bitmap(a), ngram_join.bitmap(b))
        assert apart <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("task_links", [200_000, 7])
def test_components(spark, monkeypatch, task_links):
    monkeypatch.setattr(components, "TASK_LINKS", task_links)
    pairs = [(i, i + 1) for i in range(20)] + [(50, 40), (40, 60), (60, 60), (70, 70), (40, 50)] + [(90, 100 + i) for i in range(30)]
    want = {**dict.fromkeys(range(21), 0), 40: 40, 50: 40, 60: 40, 90: 90, **{100 + i: 90 for i in range(30)}}
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    rows = connected(links).collect()
    assert {r.node: r.component for r in rows} == want and len(rows) == len(want)
    named = links.select(*[F.unhex(F.format_string("%04d", c)).alias(c) for c in "ab"])
    assert {bytes(r.node).hex(): bytes(r.component).hex() for r in connected(named).collect()} == {f"{k:04d}": f"{v:04d}" for k, v in want.items()}
    assert connected(links.limit(0)).count() == 0


def test_substring_dedup(docs, rows, empty):
    words = [WORD.findall(r[1] or "") for r in rows]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    want = []
    for r, w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append((r[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert sum(w[2] for w in want) > 500
    assert sorted(map(tuple, substring_dedup.digests(docs).collect()), key=str) == sorted(want, key=str)
    cleaned = substring_dedup.remove_repeats(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    assert substring_dedup.digests(empty).count() == 0


def test_windows_of_hot_anchors_are_dealt_out_alone(docs, monkeypatch):
    want = sorted(map(tuple, substring_dedup.digests(docs).collect()), key=str)
    monkeypatch.setattr(substring_dedup, "HOT", 1)
    assert sorted(map(tuple, substring_dedup.digests(docs).collect()), key=str) == want


def test_texts_go_to_python_in_small_batches(spark):
    session = spark.newSession()
    rng = random.Random(8)
    passage = prose(rng, 50)
    own = [(f"{prose(rng, 400)} before{i}", f"after{i} {prose(rng, 500)}") for i in range(900)]
    texts = [f"{a} {passage} {b}" if i % 3 == 0 else f"{a}  {b}" for i, (a, b) in enumerate(own)]
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
    assert got == {i: f"{a} {b}" if i % 3 == 0 else texts[i] for i, (a, b) in enumerate(own)}

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [sum(map(len, batch.column("text").to_pylist()))]})

    found = docs.mapInArrow(sizes, "n bigint, size bigint").collect()
    assert sum(r.n for r in found) == 900 and sum(r.size for r in found) > 3 << 20
    assert max(r.size for r in found) < 2.1 * (1 << 20)

    own_limit = spark.newSession()
    own_limit.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "9m")
    substring_dedup.remove_repeats(own_limit.createDataFrame([(1, "a")], "doc_id bigint, text string"))
    assert own_limit.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "9m"


def test_hashing_of_a_batch_takes_little_memory():
    batch = pa.RecordBatch.from_pydict({"text": [prose(random.Random(i), 1000) for i in range(1000)]})
    words._powers.cache_clear()
    tracemalloc.start()
    try:
        for part in words.slices(batch, "text"):
            data, offsets = words.utf8(part.column("text"))
            starts, stops, firsts = words.spans(data, offsets, words.WHITE)
            substring_dedup.runs(words.word_hashes(data, starts, stops), firsts, 35)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40 << 20


def test_fm_index_counts_all_occurrences():
    rng = np.random.default_rng(2)
    pieces = [rng.integers(0, 3, rng.integers(6, 30)).astype(np.uint64) for _ in range(40)]
    weights = rng.integers(1, 4, 40)
    index = FMIndex(pieces, weights)
    counts = Counter()
    for piece, weight in zip(pieces, weights, strict=True):
        for i in range(len(piece) - 4):
            counts[tuple(piece[i : i + 5])] += weight
    owner = np.concatenate([np.full(len(p) - 4, i) for i, p in enumerate(pieces)])
    inner = np.concatenate([np.arange(len(p) - 4) for p in pieces])
    got = index.occurrences(index.starts[owner] + inner, 5)
    assert got.tolist() == [counts[tuple(pieces[o][i : i + 5])] for o, i in zip(owner, inner, strict=True)]


def test_toxicity_learns_a_pair_that_no_single_term_tells():
    """Toxic if both or neither of two terms are there: only the interaction separates it."""
    import pyarrow as pa

    rng = random.Random(7)
    texts, labels = [], []
    for _ in range(800):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join(["alpha"] * a + ["beta"] * b + ["filler"]))
        labels.append(float(a and b))
    found = list(toxicity.term_buckets(pa.array(texts)))
    machine = toxicity.fit(found, np.array(labels), min_z=0.5, epochs=40)
    scores = machine.scores(pa.array(["alpha beta filler", "alpha filler", "beta filler", "filler", ""]), machine.place())
    assert scores[0] > 0.5 and (scores[1:] < 0.5).all()


def test_toxicity_edges(spark, docs, rows, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(19)] + [(None, 1), (3, None), (999, 1)], "doc_id bigint, label int")
    machine = toxicity.train(docs, labels)
    got = toxicity.score(docs, machine).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    blank = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, blank).collect()} == {0.5}
    assert toxicity.score(empty, machine).count() == 0
    assert toxicity.keep_clean(docs, machine).columns == docs.columns


def test_warc_round_trip(spark, tmp_path):
    rows = [(3, "http://a/1", "<p>é</p>"), (1, "http://a/2", "<p>é</p>"), (2, None, None), (5, "http://a/\n3", ""), (4, "http://b", "x" * 100_000), (None, "http://c", "x" * 100_000), (7, "u", "\r\n\r\nWARC/1.1\r\n")]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id bigint, url string, html string, digest string").repartition(2)
    folder = f"file://{tmp_path}/warc"
    got = {r.page_id: r for r in warc.read(warc.write(pages, folder), folder).collect()}
    first = {3: 1, 5: 2, None: 4}
    assert set(got) == {r[0] for r in rows}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        record = got[page_id]
        assert record.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (record.payload_bytes, record.refers_to) == (len(payload), first.get(page_id))
        assert record.record_type == ("revisit" if page_id in first else "response")
        assert bytes(record.payload) == (b"" if page_id in first else payload)
    assert warc.read(warc.write(pages.limit(0), folder + "2"), folder + "2").count() == 0


def strict_records(data):
    """The records of an archive by the rules of WARC 1.1, with the checks a reader makes."""
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        assert version == "WARC/1.1" and all(": " in line for line in lines)
        fields = dict(line.split(": ", 1) for line in lines)
        assert {"WARC-Record-ID", "WARC-Date", "WARC-Type", "Content-Length", "Content-Type", "WARC-Target-URI"} <= set(fields) and len(fields) == len(lines)
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", fields["WARC-Record-ID"])
        assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"])
        size = int(fields["Content-Length"])
        block, data = rest[:size], rest[size:]
        assert data[:4] == b"\r\n\r\n"
        data = data[4:]
        http, _, payload = block.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK\r\n") and fields["Content-Type"] == "application/http; msgtype=response"
        if fields["WARC-Type"] == "response":
            assert len(payload) == int(dict(x.split(b": ") for x in http.split(b"\r\n")[1:])[b"Content-Length"])
            assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
        else:
            assert not payload and fields["WARC-Profile"].endswith("/1.1/revisit/identical-payload-digest")
            assert fields["WARC-Refers-To-Date"] == fields["WARC-Date"]
        yield fields


def test_archives_are_valid_records_with_ids_of_their_own(spark, tmp_path):
    rows = [(1, "http://a", "x"), (1, "http://a", "x"), (2, "http://b", "x"), (3, None, "é" * 1000), (None, "http://c\n", ""), (4, None, "é" * 1000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    index = warc.write(pages, f"file://{tmp_path}/warc", date="2020-02-29T12:00:00Z")
    records = [r for f in (tmp_path / "warc").iterdir() for r in strict_records(gzip.decompress(f.read_bytes()))]
    assert len(records) == 6 and len({r["WARC-Record-ID"] for r in records}) == 6 and {r["WARC-Date"] for r in records} == {"2020-02-29T12:00:00Z"}
    referred = {r["Page-ID"]: (r["WARC-Refers-To-Target-URI"], r["Refers-To-Page-ID"]) for r in records if r["WARC-Type"] == "revisit"}
    assert referred == {"2": ("http://a", "1"), "4": ("urn:no-target:3", "3")}
    got = sorted((r.page_id or 0, r.url, r.record_type) for r in warc.read(index, f"file://{tmp_path}/warc").collect())
    assert [g[0] for g in got] == [0, 1, 1, 2, 3, 4] and [g[2] for g in got] == ["response"] * 3 + ["revisit", "response", "revisit"]
    # Each index row is a record that can be read alone.
    for row in index.collect():
        with open(row.file, "rb") as f:
            f.seek(row.offset)
            assert next(strict_records(gzip.decompress(f.read(row.length))))["WARC-Type"] == row.record_type


def test_reads_are_coalesced():
    records = [(0, 10), (10, 5), (100_000, 7), (100_007, 9 << 20), (100_007 + (9 << 20), 3)]
    assert [(a, n, held) for a, n, held in warc.coalesced(records)] == [
        (0, 15, [0, 1]), (100_000, 7, [2]), (100_007, 9 << 20, [3]), (100_007 + (9 << 20), 3, [4]),
    ]


def ppm_bits(train: bytes, text: bytes) -> float:
    """Code length by counting contexts one by one."""
    stats = [Counter() for _ in range(4)]
    padded = b"\n\n\n" + train
    for i in range(3, len(padded)):
        for order in range(4):
            stats[order][padded[i - order : i], padded[i]] += 1
    bits, padded = 0.0, b"\n\n\n" + text
    for i in range(3, len(padded)):
        for order in (3, 2, 1, 0):
            seen = {s: n for (c, s), n in stats[order].items() if c == padded[i - order : i]}
            total, kinds = sum(seen.values()), len(seen)
            if padded[i] in seen:
                bits += math.log2((total + kinds) / seen[padded[i]])
                break
            if kinds:
                bits += math.log2((total + kinds) / kinds)
        else:
            bits += 8
    return bits


def test_language_code_lengths_are_exact():
    import pyarrow as pa

    from foldloom.llm.words import utf8

    train = {"a": b"banana bandana", "b": b"ttt uuu tttu"}
    counts = [np.unique(language.grams(*utf8(pa.array([t.decode()]))), return_counts=True) for t in train.values()]
    model = language.build(list(train), counts)
    for text in ("banana", "tu tu", "zé!", "anab\nt"):
        got = model.code_lengths(language.grams(*utf8(pa.array([text])))).sum(axis=0)
        assert np.allclose(got, [ppm_bits(t, text.encode()) for t in train.values()], rtol=1e-5)


def test_language_edges(spark, docs, rows, empty):
    learnt = spark.createDataFrame([(1, "the cat and the hat " * 20, "en"), (2, "der hund und die katze " * 20, "de"), (3, None, "fr"), (4, "x", None)], "doc_id bigint, text string, lang string")
    model = language.train(learnt)
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {7, 8, 9, 18} and got[7].score == 0
    more = spark.createDataFrame([(1, "the hat"), (2, "und der hund")], "doc_id bigint, text string")
    assert [r.lang_pred for r in language.predict(more, model).orderBy("doc_id").collect()] == ["en", "de"]
    assert language.predict(empty, model).count() == 0
    assert {r.lang_pred for r in language.predict(docs, language.train(learnt.limit(0))).collect()} == {"und"}


def test_decontamination(spark, docs, empty):
    rng = random.Random(9)
    item, other = prose(rng, 40), prose(rng, 6)
    edited = item.split()
    edited[0] = "other"
    table = [
        (1, prose(rng, 50) + " " + item.upper() + " " + prose(rng, 30)), (2, " ".join(edited)), (3, prose(rng, 200)), (4, " ".join(item.split()[:20])),
        (5, prose(rng, 20) + " " + other), (6, None), (7, ""), (1, prose(rng, 50)), (8, item + " " + item), (None, item),
    ]
    data = spark.createDataFrame([(*r, "x") for r in table], "doc_id bigint, text string, item_id string")
    items = spark.createDataFrame([(1, item), (2, other), (3, None), (4, ""), (5, item)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.matches(data, items).collect()}
    assert set(got) == {(d, i) for d in (1, 2, 8, None) for i in (1, 5)} | {(5, 2)}
    assert got[1, 1] == got[8, 1] == got[5, 2] == 1 and 0.8 <= got[2, 1] < 1
    assert sorted(r.doc_id for r in decontamination.clean(data, items).collect()) == [1, 3, 4, 6, 7]
    assert decontamination.clean(data, items.limit(0)).count() == len(table)
    assert decontamination.matches(empty, items).count() == 0


def test_overlap_counts_repeated_shingles(spark):
    row = spark.createDataFrame([([1, 1, 2, 3], [1, 1, 1, 3])], "a array<bigint>, b array<bigint>")
    assert row.select(decontamination.overlap(row.a, row.b)).first()[0] == 3


def test_fingerprints(spark, docs, rows, empty):
    got = fingerprints.edited(docs).collect()
    assert len(got) == len(rows)
    order = sorted({r[0]: r[1] or "" for r in rows if r[0] is not None}.items(), reverse=True)
    by_id = {r.doc_id: r for r in got}
    for (doc_id, text), (_, following) in zip(order[:-1], order[1:], strict=True):
        n = len(text) // 3
        changed = text[: len(text) - n] + following[:n]
        assert by_id[doc_id].n_chars == len(text)
        if doc_id != 0:  # repeated, so its neighbour is itself
            assert by_id[doc_id].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
    assert by_id[0].fingerprint == by_id[1].fingerprint != by_id[4].fingerprint
    assert by_id[7].fingerprint == by_id[8].fingerprint == by_id[9].fingerprint == "" and by_id[8].near_edited == 1.0
    assert fingerprints.edited(empty).count() == 0


def test_fingerprints_estimate_generalised_jaccard(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "SAMPLES", 16)
    rng = random.Random(11)
    table, want = [], []
    for i in range(60):
        # Words of its own for each pair: samples depend on words alone, so pairs with the same words would err together.
        words = [f"d{i}w{int(rng.expovariate(0.05))}" for _ in range(100)]
        other = words[:70] + [f"d{i}v{rng.randint(0, 50)}" for _ in range(30)]
        a, b = Counter(words), Counter(other)
        want.append(sum((a & b).values()) / sum((a | b).values()))
        table.append((i, " ".join(words), " ".join(other)))
    data = spark.createDataFrame(table, "row bigint, x string, y string")
    terms = fingerprints.with_terms(fingerprints.with_terms(data, "x", "a"), "y", "b")
    found = fingerprints.signatures(terms, {"a": 0, "b": 1}).collect()
    own, other = ({r.row: r.signature for r in found if r.which == w} for w in (0, 1))
    means = [np.mean(np.array(own[i]) == np.array(other[i])) for i in range(60)]
    assert abs(np.mean(means) - np.mean(want)) < 0.05


def test_quality(spark, docs, rows, empty):
    labels = spark.createDataFrame([(i, int(i < 7)) for i in range(19)] + [(None, 1), (2, None)], "doc_id bigint, label int")
    got = quality.scores(docs, labels, host="source", path="lang").collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.keep == (r.score >= 0.5) for r in got)
    assert quality.scores(empty, labels, host="source", path="lang").count() == 0
    assert {r.p for r in quality.scores(docs, labels.limit(0), host="source", path="lang").collect()} == {0.5}


def test_sparse_hosts_shrink_to_the_mean(spark):
    table = [(i, prose(random.Random(i), 30), "big" if i < 60 else f"h{i}", "p") for i in range(80)]
    data = spark.createDataFrame(table, "doc_id bigint, text string, host string, path string")
    labels = spark.createDataFrame([(i, int(i % 10 > 0) if i < 60 else i % 2) for i in range(80)], "doc_id bigint, label int")
    got = {r.doc_id: r for r in quality.scores(data, labels).collect()}
    base = np.mean([int(i % 10 > 0) if i < 60 else i % 2 for i in range(80)])
    assert all(abs(got[i].host_posterior - base) < 1e-9 for i in range(60, 80))  # no other document on the host
    assert got[1].host_posterior != base


def fluid(blocks, weights, slot):
    """What each source is owed by a slot, step by step, in exact fractions."""
    exact, owed, left = [Fraction(w) for w in weights], [Fraction(0)] * len(blocks), Fraction(slot)
    while left:
        active = [i for i in range(len(blocks)) if owed[i] < blocks[i]]
        total = sum(exact[i] for i in active)
        step = min(left, *((blocks[i] - owed[i]) * total / exact[i] for i in active))
        for i in active:
            owed[i] += step * exact[i] / total
        left -= step
    return owed


@pytest.mark.parametrize(
    "blocks, weights",
    [
        ([300, 40, 611, 1], [0.5, 0.13, 0.36, 0.01]), ([500, 333, 167], [1 / 2, 1 / 3, 1 / 6]), ([7], [0.3]), ([1] * 30, [1.0] * 30),
        ([900, 1, 1], [0.99995, 0.00005, 0.001]), ([200, 200, 200], [1e-300, 1.0, 1e9]), ([50, 60, 70, 80], [50**0.5, 60**0.5, 70**0.5, 80**0.5]),
    ],
)
def test_schedule_keeps_each_source_within_one_block_of_what_it_is_owed(blocks, weights):
    slots = mixing.schedule(blocks, weights)
    assert [len(own) for own in slots] == blocks and all(own == sorted(own) for own in slots)
    assert sorted(s for own in slots for s in own) == list(range(sum(blocks)))
    done, taken = [0] * len(blocks), {s: i for i, own in enumerate(slots) for s in own}
    for slot in range(sum(blocks)):
        done[taken[slot]] += 1
        assert all(abs(d - o) < 1 for d, o in zip(done, fluid(blocks, weights, slot + 1), strict=True))


def test_schedule_of_many_blocks_keeps_the_given_weights():
    """Weights that are no whole shares of a period, among them very small ones, while all sources have rows."""
    weights = [1 / 2, 1 / 3, 1 / 6, 1e-5, 5e-5]
    total = sum(map(Fraction, weights))
    n = 200_000
    slots = mixing.schedule([int(n * Fraction(w) / total) + 2 for w in weights], weights)
    for own, w in zip(slots, weights, strict=True):
        own = [s for s in own if s < n]
        for j, slot in enumerate(own):
            assert j < (slot + 1) * Fraction(w) / total and slot * Fraction(w) / total < j + 1
        assert abs(len(own) - n * Fraction(w) / total) < 1


def test_random_schedules():
    rng = random.Random(9)
    for _ in range(60):
        k = rng.randrange(1, 7)
        test_schedule_keeps_each_source_within_one_block_of_what_it_is_owed([rng.randrange(1, 25) for _ in range(k)], [rng.choice([1.0, 2.0, rng.random() + 1e-6]) for _ in range(k)])


def test_mixing(docs, rows, empty):
    got = mixing.mix_sources(docs, {None: 1, "s0": 2, "s1": 1, "absent": 5}, block_rows=2).collect()
    assert len(got) == len(rows)
    sizes = Counter(r[3] for r in rows)
    names = [None, "s0", "s1"]
    slots = mixing.schedule([-(-sizes[name] // 2) for name in names], [1, 2, 1])
    for name, own in zip(names, slots, strict=True):
        placed = sorted((r.block, r.place, r.slot) for r in got if r.source == name)
        assert placed == [(i // 2, i % 2, own[i // 2]) for i in range(sizes[name])]
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, {"s0": 1})
    assert mixing.mix_sources(empty).count() == 0


def test_mixing_follows_the_hash_of_the_id_whatever_the_partitions(spark):
    table = spark.createDataFrame([(i, "ab"[i % 3 == 0]) for i in range(500)], "doc_id bigint, source string")
    plans = [sorted(map(tuple, mixing.mix_sources(table.repartition(n), block_rows=7).collect())) for n in (1, 5)]
    assert plans[0] == plans[1]
    order = [r.doc_id for r in table.where("source = 'a'").orderBy(F.pmod(F.shiftrightunsigned(F.xxhash64(F.lit(42), "doc_id"), 3), F.lit(1)), F.xxhash64(F.lit(42), "doc_id")).collect()]
    assert [row[0] for row in sorted(plans[0], key=lambda row: (row[2], row[4])) if row[1] == "a"] == order


def test_mixing_of_one_id_dealt_out_to_many_buckets(spark, monkeypatch):
    """Rows without an id and repeated rows: places are whole, and no window holds them all."""
    for name, value in (("HEAVY_ROWS", 50), ("BUCKET_ROWS", 20), ("BUCKETS", 4)):
        monkeypatch.setattr(mixing, name, value)
    table = [(None, "a")] * 400 + [(7, "a")] * 300 + [(i, "a") for i in range(100, 400)] + [(i, None) for i in range(60)]
    docs = spark.createDataFrame(table, "doc_id bigint, source string").repartition(4)
    got = mixing.mix_sources(docs, block_rows=10).collect()
    for name, n in (("a", 1000), (None, 60)):
        own = sorted((r.block, r.place, r.doc_id) for r in got if r.source == name)
        assert [(b, p) for b, p, _ in own] == [(i // 10, i % 10) for i in range(n)]
        if name:
            assert all(i not in (None, 7) for _, _, i in own[:300]) and all(i in (None, 7) for _, _, i in own[300:])
    rows = docs.select(F.struct("doc_id").alias("_in"), F.lit("=a").alias("_source"), F.xxhash64(F.lit(42), "doc_id").alias("_order"))
    plan = mixing._numbered(rows, 5)
    assert sorted(r._index for r in plan.collect()) == list(range(1060))


def test_mixing_keeps_columns_with_clashing_names(spark):
    names = ["doc_id", "source", "_source", "_order", "_offset", "_index", "_in", "_slots", "_n", "a.b", "slot", "place"]
    docs = spark.createDataFrame([(i, "s", *range(10)) for i in range(30)], ", ".join(f"`{n}` {'string' if n == 'source' else 'bigint'}" for n in names))
    got = mixing.mix_sources(docs, block_rows=4)
    assert got.columns == [*names[:-2], "block", "slot", "place"]
    assert sorted((r.doc_id, r._in, r["a.b"]) for r in got.collect()) == [(i, 4, 7) for i in range(30)]


def test_licenses(spark, empty):
    table = [
        (1, "Some text.\nReleased under the MIT License.\nMore"), (2, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public\nLicense as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
        (3, "You may not use this file except in compliance with the License. Licensed under the Apache License, Version 2.0 (the License);"), (4, None), (5, ""), (5, "all rights reserved"),
        (6, "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0."),
    ]
    data = spark.createDataFrame([(*r, "x") for r in table], "doc_id bigint, text string, licenses string")
    got = sorted((r.doc_id, r.licenses) for r in licenses.scan(data).collect())
    assert got == [(1, "MIT"), (2, "GPL-3.0"), (3, ""), (4, ""), (5, ""), (5, "Proprietary"), (6, "CC-BY-NC-4.0")]
    assert licenses.scan(empty).count() == 0
