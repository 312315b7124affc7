from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from gridspan.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RAW = open(PATH, "rb").read()


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(RAW),
        special_tokens={},
    )


def texts_of(n: int) -> list[str]:
    rng = random.Random(3)
    signs = " \t\n\r'sstremvldabAB19.,!#é中　\xa0\x1c\x85ßÄ٣½\U0001F600\0"
    out = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [*out, "", "a" * 5000, "ab" * 3000, " " * 500, "'" * 300, "<|endoftext|>", "x" + "\n" * 9]


def test_encode_and_decode_equal_the_library(reference):
    texts = texts_of(4000)
    ids, offsets, counts = bpe.Encoder(RAW).encode(texts)
    cut = np.concatenate([[0], np.cumsum(counts)])
    for i, text in enumerate(texts):
        own, at = ids[cut[i] : cut[i + 1]], offsets[cut[i] : cut[i + 1]]
        assert own.tolist() == reference.encode_ordinary(text), repr(text)
        assert bpe.decoded(RAW, own, at) == text.encode()


def test_every_code_point_has_the_class_the_library_gives_it(reference):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a" + chr(c) + "1" for c in points]
    encoder = bpe.Encoder(RAW)
    for a in range(0, len(texts), 200_000):
        part = texts[a : a + 200_000]
        ids, _, counts = encoder.encode(part)
        cut = np.concatenate([[0], np.cumsum(counts)])
        expected = reference.encode_ordinary_batch(part)
        assert [ids[x:y].tolist() for x, y in zip(cut, cut[1:])] == expected


def test_the_cache_starts_afresh(monkeypatch, reference):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    encoder = bpe.Encoder(RAW)
    for text in texts_of(200):
        assert encoder.encode([text])[0].tolist() == reference.encode_ordinary(text)


def test_merging_many_pieces_equals_merging_each():
    encoder = bpe.Encoder(RAW)
    rng = random.Random(9)
    pieces = ["".join(rng.choice("theransdoi \u00e9'") for _ in range(rng.randint(1, 40))).encode()
              for _ in range(3000)]
    pieces = [p for p in pieces if p not in encoder.ranks]
    tokens, sizes = bpe.merged_many(pieces, encoder.table, np.array(encoder.single))
    cut = np.concatenate([[0], np.cumsum(sizes)])
    for i, piece in enumerate(pieces):
        own = bpe.merged(piece, encoder.ranks, encoder.pairs, encoder.single)
        assert tokens[cut[i] : cut[i + 1]].tolist() == own
        assert bpe._merged_long(piece, encoder.ranks) == own


def test_encode_then_decode_frames(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts_of(60))], "doc_id long, text string")
    back = bpe.decode(bpe.encode(docs, PATH, ["doc_id", "text"]), PATH, ["doc_id", "text"]).collect()
    assert len(back) == docs.count()
    assert all(bytes(r.decoded) == r.text.encode() for r in back)


def test_scan_equals_stepping():
    products, functions, (begins, own) = bpe.automaton()
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 9, 5000)
    through = bpe._scan(own[symbols], products)
    state = bpe.FRESH
    for i, x in enumerate(symbols):
        state, _ = bpe._step(state, int(x))
        assert functions[through[i], bpe.FRESH] == state


@pytest.mark.parametrize("empty", [False, True])
def test_frame(spark, reference, empty):
    rows = [] if empty else [(1, None, 9), (2, "", 9), (None, "It's  ok\n", 9), (2, "", 9),
                             (3, "word " * 30000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = bpe.digests(docs, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def expected(i, text, _):
        ids = reference.encode_ordinary(text or "")
        joined = ",".join(map(str, ids)).encode()
        return (i, len(ids), hashlib.sha256(joined).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest())

    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(expected(*r)) for r in rows)


def test_a_task_gives_freed_memory_back_and_keeps_its_rows():
    def run(batches):
        for b in batches:
            held = [bytes(1000) for _ in range(20_000)]
            yield b, len(held)

    from gridspan.llm.frames import releasing

    assert releasing(run).__name__ == "run"
    assert list(releasing(run)([1, 2])) == [(1, 20_000), (2, 20_000)]
