"""Words, components and pieces against plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers

from pairloom.llm import huffman, pieces, words as W
from pairloom.llm.graph import components

SAMPLES = ["", " ", "One two  two\tthree\nfour", "ÄÖ é x a", "x" * 3000 + " y", "a.b-c d_9 日本", "\x0b\x1c z"]


@pytest.mark.parametrize("separators, pattern, lower", [(W.WHITE, r"[^\x20\x09-\x0D]+", False), (W.NOT_ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)])
def test_words_are_those_of_the_pattern(separators, pattern, lower, monkeypatch):
    monkeypatch.setattr(W, "SLICE", 64)  # many slices, also inside words
    random.seed(3)
    texts = SAMPLES + ["".join(random.choice("aB \n.é1") for _ in range(random.randint(0, 400))) for _ in range(50)]
    data, offsets = W.utf8(pa.array([*texts, None]))
    hashes, begin, until, at = W.words(data, offsets, separators, lower)
    known: dict[str, int] = {}
    for k, text in enumerate(texts):
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text) if lower else text
        want = re.findall(pattern, folded)
        assert int(at[k + 1] - at[k]) == len(want)
        for w, h in zip(want, hashes[at[k] : at[k + 1]].tolist()):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def test_cover_and_spans():
    covered = W.cover(10, np.array([1, 3, 8]), np.array([3, 2, 1]))
    assert covered.tolist() == [False, True, True, True, True, False, False, False, True, False]
    assert [x.tolist() for x in W.spans(covered)] == [[1, 8], [5, 9]]


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 11), (7, 7), (20, 19), (19, 18), (18, 21), (None, 5)] + [(100, k) for k in range(101, 140)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    got = {r["id"]: r["component"] for r in found.df.collect()}
    want = {1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10, 18: 18, 19: 18, 20: 18, 21: 18} | {k: 100 for k in range(100, 140)}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).df.count() == 0


def _asked(remembering, words: list[bytes], keys: list[int]) -> list[bytes]:
    size = np.array([len(w) for w in words])
    ids, start, many = remembering(np.array(keys, np.uint64), np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size)
    return [ids[b : b + n].tobytes() for b, n in zip(start, many)]


def test_remembered_pieces():
    asked = []

    def encode(found):
        asked.extend(found)
        return [np.frombuffer(p, np.uint8).astype("<i4").tobytes() * 2 for p in found]

    one = pieces.Remembering(encode, most=6)
    for words, keys in [
        ([b"abc", b" d"], [9, 3]),
        ([b"abc", b" d"], [9, 3]),  # known by now
        ([b"xyz", b"ab"], [9, 9]),  # other pieces of the same hash
        ([b"e" * 1000, b"f", b"f2"], [1, 7, 7]),
        ([b"g%d" % k for k in range(9)], list(range(20, 29))),  # more than are kept
        ([b"abc", b"g8"], [9, 28]),
    ]:
        assert _asked(one, words, keys) == encode(words)
        assert len(one.keys) <= 12 and (np.diff(one.keys.astype(np.int64)) > 0).all()
    assert asked.count(b"abc") < 9 and len(one.data) < 100  # long pieces are not kept


def test_known_pieces_are_not_encoded_again():
    many = []
    one = pieces.Remembering(lambda found: (many.append(len(found)), [p[:4].ljust(4) for p in found])[1])
    words = [b"w%06d" % k for k in range(300_000)]
    for at in (0, 100_000, 200_000, 0):  # the two generations of before held the last 200,000
        _asked(one, words[at : at + 100_000], list(range(at, at + 100_000)))
    assert sum(many) == 300_000


def test_words_as_the_library_encodes_them():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    words = [" word", "word", " Ärger", "naïve", "ƀɏ", " 中文", "×÷", "ɐ", "ªº", " don't", "x" * 300, " ", "\u0130", "e\u0301", "1a"]
    encoder = huffman._encoder(path)[0]
    got = encoder.encode([w.encode() for w in words])
    assert got == [np.array(library.encode(w, add_special_tokens=False).ids, "<i4").tobytes() for w in words]
