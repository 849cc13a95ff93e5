"""Alignment against a plain version: whole texts under the library that defines A, ends intersected as sets, links counted in a dictionary."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from foldloom.llm import token_alignment as T

FOLDER = "/opt/tokenizers"
A, B = f"{FOLDER}/byte_bpe_50k.json", f"{FOLDER}/piece_bpe_32k.model"
pytestmark = pytest.mark.skipif(not os.path.exists(A), reason="no vocabulary files")
SCHEMA = "doc_id bigint, text string, row int, pair string, `n.a` int"


class Plain:
    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.signs = T.byte_signs()

    def tokens(self, text):
        """Ids and bytes under both, nothing if the bytes differ."""
        if not text:
            return None
        found = self.a.encode(f" {text}", add_special_tokens=False)
        a = [(i, bytes(self.signs[c] for c in self.a.id_to_token(i))) for i in found.ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes.fromhex(piece[3:5]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        raw = f" {text}".encode()
        return (a, b) if b"".join(t for _, t in a) == raw == b"".join(t for _, t in b) else None

    def groups(self, text):
        found = self.tokens(text)
        if found is None:
            return []
        ends = [np.cumsum([len(t) for _, t in side]).tolist() for side in found]
        out, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            i_to, j_to = ends[0].index(cut) + 1, ends[1].index(cut) + 1
            out.append(([x for x, _ in found[0][i:i_to]], [x for x, _ in found[1][j:j_to]]))
            i, j = i_to, j_to
        return out

    def table(self, rows):
        groups = [self.groups(text) for _, text in rows]
        counts = Counter((a[-1], b[-1]) for doc in groups for a, b in doc)
        best = {}
        for (a, b), n in counts.items():
            best[b] = max(n, best.get(b, 0))
        out = []
        for (doc_id, _), doc in zip(rows, groups, strict=True):
            links = [(a[-1], b[-1]) for a, b in doc]
            text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in doc)
            out.append((
                doc_id, sum(len(a) for a, _ in doc), sum(len(b) for _, b in doc), len(doc), len(links), sum(counts[x] == best[x[1]] for x in links),
                sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if doc else "",
            ))
        return sorted(out, key=str)


@pytest.fixture(scope="module")
def plain():
    return Plain()


PARTS = [
    "a", "b", " ", "  ", "\n", "\r\n", "\t", "é", "漢字", "'s", "don't", "1234", "\x1c", "\x85", "\xa0", " ", " the", "ing", "!", "...", "<s>", "</s>", "<unk>",
    "<0x41>", "<|endoftext|>", "😀", "\x00", "　", " Ünï", "ſ", "ﬁ", "①", "á", " multi-token words", "█",
]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(0, 14))) for _ in range(300)]
    texts += [None, "", " ", "a", "x▁y", "▁", "word " * 4000, "a" * 30_000, " ".join(rng.choices(["alignment", "tokens", "über", "naïve"], k=20_000))]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, rows[1], rows[1], (None, texts[0]), (None, None)]


def test_table_against_the_plain_version(spark, plain, rows):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(4)
    got = T.alignment(docs, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain.table(rows)


def test_joined_counts_are_the_same_without_a_broadcast(spark, plain, rows, monkeypatch):
    monkeypatch.setattr(T, "BROADCAST_ROWS", 5)
    docs = spark.createDataFrame(rows[:60], "doc_id bigint, text string")
    assert sorted(map(tuple, T.alignment(docs, A, B).collect()), key=str) == plain.table(rows[:60])


def test_empty_table_and_broken_bytes(spark):
    assert T.alignment(spark.createDataFrame([], SCHEMA), A, B).count() == 0
    broken = spark.sql("SELECT 5L AS doc_id, CAST(unhex('61E7') AS STRING) AS text")
    assert [tuple(r) for r in T.alignment(broken, A, B).collect()] == [(5, 0, 0, 0, 0, 0, 0, "")]


def test_groups_join_to_the_tokens_of_both(plain, rows):
    """Whole digests come from the right order of tokens: groups of a text, flattened, are its tokens, and their bytes agree group by group."""
    for _, text in rows[:200]:
        found = plain.tokens(text)
        if found:
            names = [dict(side) for side in found]
            for a, b in plain.groups(text):
                assert b"".join(names[0][i] for i in a) == b"".join(names[1][i] for i in b)


def test_shared_cuts_of_several_intervals():
    rng = random.Random(2)
    for _ in range(400):
        a, b, starts, stops, want, base = [], [], [], [], [], 0
        for _ in range(rng.randrange(1, 5)):
            size = rng.randrange(1, 60)
            own = [sorted({*rng.sample(range(1, size + 1), rng.randrange(0, size + 1)), size}) for _ in range(2)]
            starts.append(len(a))
            want += [len(a) + i for i, end in enumerate(own[0]) if end in own[1]]
            a += [base + end for end in own[0]]
            b += [base + end for end in own[1]]
            stops.append(len(a))
            base += size
        assert T.shared_cuts(*map(np.array, (a, b, starts, stops))).tolist() == want


def test_vocabulary_in_another_order_is_refused(tmp_path):
    path = tmp_path / "v.json"
    path.write_text('{"model": {"vocab": {"a": 0, "b": 1, "ab": 300}, "merges": ["a b"]}}')
    with pytest.raises(ValueError):
        T.read_files(str(path), B)
