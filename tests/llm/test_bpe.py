import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(PATH)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def texts():
    r = random.Random(3)
    odd = ["", "a", " ", "\n\n \t x", "a" * 3000, "ab" * 700 + "  é" * 99, "日本語 12½ Ⅸ",
           "I'LL don't we've", "퟿\U0010ffff", "x y　z", "\x00\x1c\x85"]
    return odd + ["".join(r.choice("ab é日\n\t'0.½́\x1c ") for _ in range(r.randrange(80))) for _ in range(500)]


def test_encoder_equals_the_library(vocabulary, library, monkeypatch):
    for chunk in (bpe._CHUNK_WORDS, 7):  # also where texts are longer than a chunk
        monkeypatch.setattr(bpe, "_CHUNK_WORDS", chunk)
        monkeypatch.setattr(bpe, "_KNOWN_WORDS", chunk)
        got = list(bpe.Encoder(vocabulary, public_tokenizers.PATTERN).encode(texts()))
        assert got == [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in texts()]


def test_matrix_and_heap_merge_alike(vocabulary):
    r = random.Random(5)
    words = [bytes(r.choice(b"theranoi ") for _ in range(r.randrange(1, 200))) for _ in range(300)]
    for word, ids in zip(words, bpe.merge_words(vocabulary, words), strict=True):
        assert ids.tolist() == bpe._merge_long(vocabulary, word).tolist()


def test_pair_table_finds_every_pair_and_no_other(vocabulary):
    some = [t for t in vocabulary.ranks if len(t) > 1][:3000]
    pairs = [(vocabulary.ranks[t[:1]], vocabulary.ranks[t[1:]], vocabulary.ranks[t]) for t in some if t[1:] in vocabulary.ranks]
    left, right, merged = np.array(pairs).T
    assert (vocabulary.lookup(left.astype(np.int32), right.astype(np.int32)) == merged).all()
    assert vocabulary.lookup(np.array([-1, 5]), np.array([3, -1])).tolist() == [bpe.NONE] * 2


def test_round_trip_of_a_table(make_docs):
    rows = [(1, None), (2, ""), (None, "tie"), (3, "tie"), (3, "tie"), (4, "é " * 200_000)]
    done = bpe.round_trip(make_docs(rows, extra=True), PATH, public_tokenizers.PATTERN).collect()
    assert len(done) == len(rows)
    assert all(bytes(r["decoded"]).decode() == (r["row"]["text"] or "") for r in done)
    assert bpe.round_trip(make_docs([]), PATH, public_tokenizers.PATTERN).collect() == []
