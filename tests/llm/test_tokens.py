import base64
import random

import numpy as np
import pyarrow as pa
import pytest

from bartide.llm import tokens

tiktoken = pytest.importorskip("tiktoken")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def public():
    try:
        with open(tokens.vocabulary_path(), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    except FileNotFoundError:
        pytest.skip("no vocabularies")
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n=400):
    rnd = random.Random(2)
    parts = ["'s", "'re", "'ll", "'", "''", " ", "  ", "\n", "\r\n", "\t", "a", "Zb", "é", "中文", "ก", "٣", "12", "²", "!", "...", "—", " ", "　", "\x1c", "\x85", "😀", "́", "_", "'Em", "s", "\x00", "<|endoftext|>", "lake"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 15))) for _ in range(n)] + [None, "", "'", " ", "  ", "word " * 5000, "x" * 100_000]


def test_ids_are_those_of_the_tokenizer(spark, public):
    rows = [(i, t) for i, t in enumerate(texts())] + [(0, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((i, public.encode_ordinary(t) if t else []) for i, t in rows)
    for lexicon in (None, tokens.compile_lexicon(df.limit(0), "text"), tokens.compile_lexicon(df, "text", size=7), tokens.compile_lexicon(df, "text", size=50, mounted=False)):
        assert sorted((r.doc_id, r.ids) for r in tokens.encode(df, "doc_id", "text", lexicon=lexicon).collect()) == want
    assert sorted((r.doc_id, r.n_tokens) for r in tokens.sizes(df, "doc_id", "text").collect()) == [(i, len(x)) for i, x in want]
    assert tokens.encode(df.limit(0), "doc_id", "text").count() == 0


def test_word_counts(spark):
    df = spark.createDataFrame([("lake lake's lake",), (" lake",), (None,)], "text string")
    assert {bytes(r.word): r.n for r in tokens.word_counts(df, "text").collect()} == {b"lake": 1, b" lake": 3, b"'s": 1}


def test_transducer():
    rnd = random.Random(0)
    words = sorted({bytes(rnd.choice(b"abc\xff") for _ in range(rnd.randint(1, 6))) for _ in range(800)})
    t = tokens.Transducer.build(words)
    others = [bytes(rnd.choice(b"abc\xff") for _ in range(rnd.randint(0, 7))) for _ in range(500)]
    got = t.numbers(pa.array(words + others, pa.large_binary()))
    at = {w: i for i, w in enumerate(words)}
    assert got.tolist() == [at.get(w, -1) for w in words + others]
    # Minimal: no two states accept the same continuations.
    chain = tokens.Transducer.build(sorted(p + b"xyz" for p in (b"a", b"b", b"c")))
    assert len(chain.final) == 5 and len(chain.keys) == 6
    assert tokens.Transducer.build([]).numbers(pa.array([b"a", b""], pa.large_binary())).tolist() == [-1, -1]


def test_long_documents_are_cut_only_between_documents(monkeypatch):
    monkeypatch.setattr(tokens, "BYTES_AT_ONCE", 10)
    pieces = list(tokens._texts(pa.array(["abc", "d" * 50, None, "", "efg"])))
    assert [(i, n) for i, n, _, _ in pieces] == [(0, 1), (1, 3), (4, 1)] or sum(n for _, n, _, _ in pieces) == 5
    assert b"".join(bytes(d) for _, _, d, _ in pieces) == b"abc" + b"d" * 50 + b"efg"
    assert isinstance(pieces[0][3], np.ndarray)
