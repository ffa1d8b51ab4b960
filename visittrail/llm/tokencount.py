"""Token counts of whole texts.

Texts are encoded in Arrow functions that return lengths only. A batch for the tokenizer is filled
by bytes, not by rows. Where the tokenizer cuts texts at white space anyway, they are cut there
first: each distinct word of a block of texts is encoded once, and one text never stands in memory as
one list of tokens.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visittrail.llm.common import prepare
from visittrail.llm.tokens import WordCache

#: Characters that the tokenizer is given at once, and of texts whose words are counted together.
BATCH_CHARS, BLOCK_CHARS = 64 << 10, 2 << 20
#: Words are remembered up to this length.
CACHED_CHARS = 32

#: Places where a byte-level tokenizer always ends a word: before white space that follows something
#: else, and between letters and full-width punctuation. No special string has them.
SAFE_CUT = regex.compile(
    r"(?<=\S)(?=[ \t\n\r])"
    r"|(?<=[A-Za-z0-9À-ÖØ-öぁ-ゖァ-ヺ一-龥가-힣])"
    r"(?=[、。！，．：；？])")

#: White space and what follows it. The signs are white space here but not to tokenizers.
WORD, ODD_SIGN = re.compile(r"\s*\S+|\s+"), re.compile(r"[\x1c-\x1f]")


def words(text: str, most: int) -> list[str]:
    """The text in parts whose tokens add up to its own, long ones cut at further safe places."""
    found = [text] if ODD_SIGN.search(text) else WORD.findall(text)
    if len(text) <= most:
        return found
    return [part for word in found for part in (parts(word, most) if len(word) > most else (word,))]


def parts(text: str, most: int) -> Iterator[str]:
    """The text, cut at the first safe place after every `most` characters."""
    at = 0
    while len(text) - at > most:
        cut = SAFE_CUT.search(text, at + most)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def cuts_safely(spec: dict) -> bool:
    """Whether SAFE_CUT holds for a tokenizer file: plain byte-level words, no special blanks."""
    words = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None and words.get("type") == "ByteLevel"
        and words.get("use_regex", True) and not words.get("add_prefix_space", True)
        and not any(SAFE_CUT.search(t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"]
                    or t["content"][:1].isspace() for t in spec.get("added_tokens", ()))
    )


class Counted(WordCache):
    """Numbers of tokens for a .json or .model file, remembered by word where texts may be cut."""

    def __init__(self, name: str, model: bytes):
        super().__init__()
        if name.endswith(".model"):
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
            self.encode, self.cut = (lambda texts: pieces.encode(texts, num_threads=1)), False
            return
        # One task has one core: the library's own threads would take those of other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(model.decode())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.encode = lambda texts: tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        self.cut = cuts_safely(json.loads(model))

    def numbers(self, texts: list[str], most: int) -> Iterator[int]:
        """Tokens of each text; `most` characters or one text are encoded at a time."""
        for batch in by_size(texts, most):
            yield from map(len, self.encode(batch))

    def count(self, texts: list[str], most: int = BATCH_CHARS) -> list[int]:
        if not self.cut:
            return list(self.numbers(texts, most))
        totals = []
        for block in by_size(texts, BLOCK_CHARS):
            own = [words(text, most) for text in block]
            new = self.missing(set().union(*own))
            self.update(zip(new, self.numbers(new, most), strict=True))
            totals += [sum(map(self.__getitem__, some)) for some in own]
            for word in new:
                if len(word) > CACHED_CHARS:
                    del self[word]
        return totals


def by_size(texts: list[str], most: int) -> Iterator[list[str]]:
    """The texts in turn, in lists of at most so many characters or of one text."""
    batch, size = [], 0
    for text in texts:
        if batch and size + len(text) > most:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += len(text)
    if batch:
        yield batch


#: Kept between the tasks of one worker.
_READY: dict[str, Counted] = {}


def token_counts(docs: DataFrame, path: str, limit: int = 1024, text: str = "text",
                 doc_id: str = "doc_id", batch_chars: int = BATCH_CHARS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row, whatever its doc_id.

    n_tokens is what the file's library gives for the whole text without begin, end or added special
    tokens; special strings inside texts count as the library counts them. A null text is empty: no
    bytes, no tokens. path: a .json (tokenizers) or .model (sentencepiece) file. Texts are cut
    only for byte-level .json files; a stretch without a safe place is encoded whole. Other columns
    are left out. An empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    sent = spark.sparkContext.broadcast((path, Path(path).read_bytes()))

    @F.arrow_udf("bigint")
    def tokens(texts: pa.Array) -> pa.Array:
        name, model = sent.value
        if name not in _READY:
            _READY[name] = Counted(name, model)
        counts = _READY[name].count(texts.fill_null("").to_pylist(), batch_chars)
        return pa.array(counts, pa.int64())

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    counted = docs.select(
        F.col(doc_id).alias("doc_id"), F.octet_length(whole).cast("bigint").alias("n_bytes"),
        tokens(whole).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
