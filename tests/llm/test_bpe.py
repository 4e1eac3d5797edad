"""The streams against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shopgrain.llm import bpe
from shopgrain.llm.bpe import (
    Decoder,
    decode_column,
    decoded,
    encode_column,
    encoder,
    sufficient_lookahead,
    token_digests,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(library, text):
    ids = encoder(PATH).encode(text)
    expected = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == expected
    back = "".join(decoded(ids, encoder(PATH).bytes))
    assert back == library.decode(expected, skip_special_tokens=False)


def test_characters_of_all_kinds(library):
    rng = random.Random(1)
    letters = [chr(c) for c in [*range(256), *range(0x2000, 0x2070)]]
    letters += list("　 ᠎﻿一\U0001f600́٠Ⅻ")
    for _ in range(600):
        same(library, "".join(rng.choices(letters, k=rng.choice([1, 5, 60, 600]))))


def test_parts_of_words_and_special_tokens(library):
    rng = random.Random(2)
    parts = [" ", "  ", "\n", "a", "th", "in", '"', "=", "<|endoftext|>", "'s", "0", "12", "é"]
    for _ in range(600):
        same(library, "".join(rng.choices(parts, k=rng.choice([1, 5, 60, 600]))))


def test_pieces_longer_than_the_window(library):
    """Streams that emit before their end; no break for thousands of letters."""
    rng = random.Random(3)
    e = encoder(PATH)
    words = [b.decode() for b in e.bytes.values() if b.isalpha()]
    for i in range(60):
        same(library, "".join(rng.choices(words, k=900)))
        same(library, "".join(rng.choices(["a", "e", "th", "in", "ing", "the", "zz"], k=3000)))
        same(library, rng.choice([" ", "=", "-", "aa"]) * (2000 + i))


def test_long_pieces_are_emitted_early(library):
    """A stream lets go of nearly all tokens of a long piece before the piece ends."""
    e = bpe.Encoder(PATH)
    text = " ".join(["ab" * 20_000, "=" * 9_000, "short words"])
    ids = e.encode(text)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    held = e.window + e.lookahead
    assert 0.9 * len(ids) - held < e.early < len(ids)
    few = bpe.Encoder(PATH)
    few.encode("no piece of this text is as long as the lookahead")
    assert few.early == 0


def test_pieces_merged_together(library):
    rng = random.Random(4)
    e = encoder(PATH)
    letters = "abcdefghijklmnopqrstuvwxyz" * 4 + "éèêàüßñ\u4e00\u0434 0123456789'-.,"
    pieces = [p for p in ("".join(rng.choices(letters, k=rng.randint(1, 32))) for _ in range(5000))]
    data = [p.encode()[:32] for p in pieces]
    for width in bpe.TOGETHER:
        some = [d for d in data if len(d) <= width]
        assert e.merged_together(some, width) == [bpe.packed(e.merged(d)) for d in some]
    assert e.merged_together([], 8) == []


def test_blocks_and_generations_change_nothing(library, monkeypatch):
    """Texts over many blocks and groups; a memory that is full again and again."""
    for name, value in (("BLOCK", 50), ("GROUP", 200), ("KEPT", 20)):
        monkeypatch.setattr(bpe, name, value)
    rng = random.Random(5)
    e = bpe.Encoder(PATH)
    words = [b.decode(errors="ignore") for b in list(e.bytes.values())[:3000]]
    texts = ["", " ", "x" * 500, "<|endoftext|>" * 5, "a<|endoftext|> b\n\n"]
    texts += ["".join(rng.choices([*words, " ", "  \n", "\u3000"], k=300)) for _ in range(40)]
    got = {i: [] for i in range(len(texts))}
    for i, ids in e.encode_many(texts):
        got[i] += ids.tolist()
    for i, text in enumerate(texts):
        assert got[i] == library.encode(text, add_special_tokens=False).ids
    assert len(e.runs) <= 220 and len(e.pieces) <= 400


def test_lookahead_of_small_lists():
    # Tokens 0..3 are one byte; (1, 2) comes before (0, 1): what follows 1 decides.
    assert sufficient_lookahead([(1, 2), (0, 1)], [4, 5], [1, 1, 1, 1, 2, 2]) == 2
    assert sufficient_lookahead([(0, 1)], [4], [1, 1, 1, 1, 2]) == 1
    assert sufficient_lookahead([], [], [1]) == 0


def test_decoder_holds_incomplete_characters(library):
    pieces = {i: bytes([i]) for i in range(256)}
    for data in ("é😀x".encode(), b"\xe2\x82", b"\xff\xf0\x9f\x98a", b"\xed\xa0\x80"):
        d = Decoder(pieces)
        text = "".join(d.feed([b]) for b in data) + d.end()
        assert text == data.decode(errors="replace")
    e = encoder(PATH)
    rng = np.random.default_rng(1)
    for _ in range(200):
        ids = rng.integers(0, 50257, 40).astype("<u4")
        expected = library.decode(ids.tolist(), skip_special_tokens=False)
        assert "".join(decoded(ids, e.bytes)) == expected


def test_columns_and_edge_rows(spark, library):
    """Null, empty and very long texts, repeated rows, clashing names, an empty table."""
    long = "word, " * 30000 + "z" * 50000
    rows = [(1, None, 0), (2, "", 0), (3, long, 0), (3, long, 0), (None, "a b", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = token_digests(df, "text", PATH, ["doc_id"]).collect()
    assert len(out) == 5
    empty = hashlib.sha256(b"").hexdigest()
    for r in out:
        text = {1: "", 2: "", 3: long, None: "a b"}[r.doc_id]
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert {r.ids_sha256 for r in out if r.doc_id in (1, 2)} == {empty}
    assert token_digests(df.limit(0), "text", PATH, ["doc_id"]).count() == 0
    ids = encode_column(df, "text", PATH, ["doc_id"])
    back = {r.doc_id: r.decoded for r in decode_column(ids, "ids", PATH, ["doc_id"]).collect()}
    assert back == {1: "", 2: "", 3: long, None: "a b"}
