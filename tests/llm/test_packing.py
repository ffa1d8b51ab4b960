import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from visittrail.llm import packing, token_output
from visittrail.llm.tokens import WordIds, encoded

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.fixture(scope="module")
def rows(odd):
    rng = random.Random(8)
    made = [(200 + i, " ".join(rng.choices(["the", "Anea", "tion.", "é,", "12"], k=n)))
            for i, n in enumerate([*range(0, 300, 3), 98, 99, 100, 199, 200, 99 * 2 + 1])]
    return made + odd


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def pieces_of(tokenizer, rows, length):
    out = []
    for doc, text in rows:
        ids = ids_of(tokenizer, text)
        out += [(doc, k, at, tuple(ids[at:at + length]))
                for k, at in enumerate(range(0, len(ids), length))]
    return out


def key(x):
    return tuple((v is None, v or 0) for v in x)


def test_pieces_and_places(documents, rows, tokenizer):
    found = packing.packed(documents(rows), PATH, length=100).collect()
    expected = sorted(((d, k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
                       for d, k, at, ids in pieces_of(tokenizer, rows, 100)), key=key)
    assert sorted((tuple(r[:5]) for r in found), key=key) == expected
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 100
    least = -(-sum(r["length"] for r in found) // 100)
    assert len(sequences) <= 1.02 * least + 1


def test_written_matrices_round_trip(documents, rows, tokenizer):
    found = token_output.write_packed(documents(rows), PATH, length=100).collect()
    back = []
    for r in found:
        line = token_output.read_rows(r["file"], 100)[r["row"]]
        assert zlib.crc32(line[:r["used"]].astype("<u4").tobytes()) == r["ids_crc32"]
        assert (line[r["used"]:] == 0).all() and r["cu_seqlens"][-1] == r["used"]
        assert r["cu_seqlens"][:-1] == r["position_resets"]
        ends = zip(r["doc_ids"], r["pieces"], r["cu_seqlens"], r["cu_seqlens"][1:], strict=False)
        back += [(d, k, tuple(line[a:b].tolist())) for d, k, a, b in ends]
    expected = [(d, k, ids) for d, k, _, ids in pieces_of(tokenizer, rows, 100)]
    order = lambda x: (key(x[:2]), x[2])
    assert sorted(back, key=order) == sorted(expected, key=order)


def test_text_ids_and_wide_vocabularies(spark):
    docs = spark.createDataFrame([("a", "one two"), ("b", None)], "doc_id string, text string")
    rows = token_output.write_packed(docs, PATH, length=8).collect()
    assert sorted(i for r in rows for i in r["doc_ids"]) == ["a", "b"]
    with pytest.raises(ValueError):
        token_output.write_packed(docs, PATH, length=8, kind="<u1")


def test_empty_table(documents):
    assert packing.packed(documents([]), PATH).collect() == []
    assert token_output.write_packed(documents([]), PATH).collect() == []


def test_only_long_documents_are_cut():
    for lengths in ([5, 5, 5], [100], [1], [], [60, 60, 40, 40, 1] * 50, [34] * 100):
        where, offset = packing.pack(np.array(lengths, dtype=int), 100)
        fill = {}
        for w, o, n in sorted(zip(where.tolist(), offset.tolist(), lengths, strict=True)):
            assert fill.get(w, 0) == o
            fill[w] = o + n
        assert all(v <= 100 for v in fill.values())


def test_configurations_reach_the_optimum():
    # 30 of 51 and 60 of 24: each 51 takes two of 24 (99 of 100).
    uses, patterns = packing.configurations(np.array([51, 24]), np.array([30.0, 60.0]), 100)
    assert abs(uses.sum() - 30) < 1e-6
    assert (patterns @ [51, 24] <= 100).all()


def test_best_fit_is_that_of_a_scan():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 101, 500)
    where, _ = token_output.best_fit_decreasing(lengths, 100)
    rooms, expected = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        fits = [(r, b) for b, r in enumerate(rooms) if r >= lengths[i]]
        b = min(fits)[1] if fits else len(rooms)
        if not fits:
            rooms.append(100)
        rooms[b] -= lengths[i]
        expected[i] = b
    assert len(rooms) == where.max() + 1


def test_word_lookup_equals_whole_texts(tokenizer):
    texts = [
        "J̌ Été.. A.B, (x). don't DON'T. it's, “hi”. 12.5, a1b2.",
        "<|endoftext|>  x\x1cy z\u0085", "日本語。 H̱. İstanbul.",
        "ﬁn, ½ x² Ⅳ. ǅ. 한글, ＡＢ.", "", " \n", "é ́x",
    ]
    with open(PATH, encoding="utf-8") as f:
        ready = WordIds(f.read())
    for _ in range(2):
        found = list(encoded(ready, [t.encode() for t in texts]))
        for text, ids in zip(texts, found, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, text)[:-1]
