import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from visittrail.llm import tokencount

PATHS = {name: public_tokenizers.path(name)
         for name in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model")}


def count_of(name):
    if name.endswith(".model"):
        pieces = SentencePieceProcessor(model_file=PATHS[name])
        return lambda text: len(pieces.encode(text))
    tokenizer = Tokenizer.from_file(PATHS[name])
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def rows(odd):
    rng = random.Random(12)
    signs = ["a", "B", "don't", "'s", " ", "  ", "\n", "\t\r\n", "1", "23", "<|endoftext|>", "<|",
             "|>", "é", "漢字", "。", "、", "　", " ", "…", "!!", "'", "\u0085", "\u001c"]
    mixed = [(100 + i, "".join(rng.choices(signs, k=rng.randrange(200)))) for i in range(150)]
    return odd + mixed + [(300, "<|endoftext|>" * 3), (301, "漢字。" * 3_000)]


@pytest.mark.parametrize("name", PATHS)
@pytest.mark.parametrize("batch", [7, tokencount.BATCH_CHARS])
def test_equals_whole_texts(documents, rows, name, batch):
    count = count_of(name)
    some = rows if name != "piece_bpe_32k.model" else [r for r in rows if len(r[1] or "") < 20_000]
    out = tokencount.token_counts(documents(some), PATHS[name], limit=30, batch_chars=batch)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = [(i, len((t or "").encode()), count(t or "")) for i, t in some]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        ((i, size, n, n > 30) for i, size, n in expected), key=str)


def test_parts_are_short_and_whole():
    text = " ".join(f"word{i}" for i in range(5_000))
    cut = list(tokencount.parts(text, 100))
    assert "".join(cut) == text and max(map(len, cut)) < 110


def test_only_plain_byte_level_files_are_cut():
    spec = {"normalizer": None, "added_tokens": [],
            "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}}
    assert tokencount.cuts_safely(spec)
    assert not tokencount.cuts_safely(spec | {"normalizer": {"type": "NFC"}})
    assert not tokencount.cuts_safely(spec | {"added_tokens": [
        {"content": "a b", "lstrip": False, "rstrip": False, "single_word": False}]})
    assert not tokencount.cuts_safely(spec | {"pre_tokenizer": {
        "type": "ByteLevel", "add_prefix_space": True}})


def test_empty_table(documents):
    assert tokencount.token_counts(documents([]), PATHS["byte_bpe_50k.json"]).collect() == []
