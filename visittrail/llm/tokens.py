"""Token ids of whole texts, cut into pieces of at most a sequence's length."""

from __future__ import annotations

import json
import unicodedata
import zlib
from array import array
from collections.abc import Collection, Iterable
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from visittrail.llm.common import kept, prepare, utf8

#: Words that a worker remembers, up to this length.
CACHED_WORDS, CACHED_BYTES = 250_000, 48
#: Text bytes whose words are looked up together; and how many words stand in one text for it.
LOOKUP_BYTES, LOOKUP_WORDS = 1 << 20, 8192
#: What strings of special tokens start with.
SPECIAL = b"<|"
WORD_END = "</w>"
#: ASCII signs that are neither letters, digits nor white space.
SIGNS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
#: How such a tokenizer splits a text (a fixed value of the tokenizer file).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordCache(dict):
    """What is known of words, in bounded memory: once full, it keeps those that came again."""

    def __init__(self, most: int = CACHED_WORDS):
        self.most, self.again = most, set()

    def missing(self, words: Collection) -> list:
        """Those of the present, distinct words that are not known; room is made for them."""
        new = [w for w in words if w not in self]
        known = set(words).difference(new)
        self.again.update(known)
        if len(self) + len(new) > self.most:
            hot = self.again if 2 * len(self.again) < self.most else known
            kept = {w: self[w] for w in hot}
            self.clear()
            self.update(kept)
            self.again = set()
        return new


class WordIds(WordCache):
    """Ids of words, as little-endian bytes, for a tokenizer that drops white space.

    Such a tokenizer never joins what white space parts, so a text's ids are its words' ids in
    turn. New words are looked up many at a time and told apart by the tokens with a word end.
    """

    def __init__(self, spec: str, kind: str = "<u4"):
        super().__init__()
        self.tokenizer, self.kind = Tokenizer.from_str(spec), kind
        self.code = np.dtype(kind).char
        self.by_word = json.loads(spec)["model"].get("end_of_word_suffix") == WORD_END
        vocab = self.tokenizer.get_vocab()
        self.split = regex.compile(SPLIT)
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items()
                   if token.endswith(WORD_END) or token.startswith("<|")]] = True

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._each(texts)
        # The tokenizer writes words small itself, but not the strings of special tokens, and marks
        # that follow a letter are joined to it before.
        small = [t.lower() if t.isascii() and SPECIAL not in t else t for t in texts]
        lists = pc.ascii_split_whitespace(pa.array(small, pa.binary()).view(pa.string()))
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.view(pa.binary()).to_pylist()
        missing = self.missing(words)
        for at in range(0, len(missing), LOOKUP_WORDS):
            self._learn(missing[at:at + LOOKUP_WORDS])
        own = pa.array(map(self.__getitem__, words), pa.binary(), size=len(words))
        for w in missing:
            if len(w) > CACHED_BYTES:
                del self[w]
        ids = own.take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1)
        ends = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        whole = ids.buffers()[2].to_pybytes() if len(ids) else b""
        return list(map(whole.__getitem__, map(slice, ends, ends[1:])))

    def _each(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch(
            [t.decode() for t in texts], add_special_tokens=False)
        return [np.array(x.ids, dtype=self.kind).tobytes() for x in found]

    def _learn(self, words: list[bytes]) -> None:
        """Words as stems and the signs behind them, each distinct one looked up once."""
        found = {w: self._stem(w) for w in words}
        stems = {part for both in found.values() for part in both}
        ids = {part: self[part] for part in stems if part in self}
        ids[b""] = b""
        ids.update(self._look_up(list(stems.difference(ids))))
        for word, (stem, signs) in found.items():
            self[word] = ids[stem] + ids[signs]

    @staticmethod
    def _stem(word: bytes) -> tuple[bytes, bytes]:
        """The word without the signs at its end, where the tokenizer splits these off anyway."""
        stem = word.rstrip(SIGNS)
        if stem.isalpha():
            return stem.lower(), word[len(stem):]
        if len(stem) == len(word) or not stem or SPECIAL in word:
            return word, b""
        last = stem[-1:]
        if last.isalnum() or (last >= b"\x80" and stem.decode()[-1].isalpha()):
            return stem, word[len(stem):]
        return word, b""

    def _look_up(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Words of ASCII letters are what the model itself takes; others go the whole way."""
        tokenize = self.tokenizer.model.tokenize
        found = {w: array(self.code, [t.id for t in tokenize(w.decode())]).tobytes()
                 for w in words if w.isalpha()}
        others = [w for w in words if not w.isalpha()]
        return found | dict(self._in_one_text(others)) if others else found

    def _in_one_text(self, words: list[bytes]) -> Iterable[tuple[bytes, bytes]]:
        """Each word has as many word ends as the tokenizer splits it into."""
        counts = np.fromiter(map(self._parts, words), dtype=np.int64, count=len(words))
        text = b" ".join(words).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids,
                       dtype=self.kind)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != counts.sum():
            return zip(words, self._each(words), strict=True)
        whole = ids.tobytes()
        cuts = np.r_[0, np.r_[0, ends][np.cumsum(counts)]] * ids.itemsize
        cuts = cuts.tolist()
        return zip(words, map(whole.__getitem__, map(slice, cuts, cuts[1:])), strict=True)

    def _parts(self, word: bytes) -> int:
        return len(self.split.findall(unicodedata.normalize("NFC", word.decode()).lower()))


def word_ids(name: str, spec: str) -> WordIds:
    return kept(("word ids", name), lambda: WordIds(spec))


def encoded(ids: WordIds, texts: list[bytes]):
    """Each text's ids, looked up for LOOKUP_BYTES of text at a time."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= LOOKUP_BYTES):
            size += len(texts[end])
            end += 1
        yield from ids.encode(texts[at:end])
        at = end


def vocabulary(spark: SparkSession, path: str):
    """The tokenizer file's name and text, sent to the executors once."""
    return spark.sparkContext.broadcast((path, Path(path).read_text(encoding="utf-8")))


def tokenized(docs: DataFrame, path: str, length: int, end_id: int = 1, text: str = "text",
              doc_id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's pieces.

    A document is its text's ids and then `end_id`; null counts as empty. Only a document of more
    than `length` ids is cut, after every `length` ids. ids: little-endian unsigned 32-bit, as
    is what ids_crc32 is taken of. Rows are never merged, whatever their doc_id.
    """
    sent = vocabulary(prepare(docs.sparkSession), path)
    fields = "start: bigint, length: bigint, ids_crc32: bigint" + ", ids: binary" * with_ids

    @F.arrow_udf(f"array<struct<{fields}>>")
    def pieces(texts: pa.Array) -> pa.Array:
        ready = word_ids(*sent.value)
        end = np.array([end_id], dtype="<u4").tobytes()
        offsets, start, size, crc, ids = [0], [], [], [], []
        for found in encoded(ready, utf8(texts)):
            whole = found + end
            for at in range(0, len(whole), 4 * length):
                part = whole[at:at + 4 * length]
                start.append(at // 4)
                size.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                if with_ids:
                    ids.append(part)
            offsets.append(len(start))
        columns = [pa.array(start, pa.int64()), pa.array(size, pa.int64()),
                   pa.array(crc, pa.int64())]
        names = ["start", "length", "ids_crc32"]
        if with_ids:
            columns.append(pa.array(ids, pa.binary()))
            names.append("ids")
        return pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, names))

    return docs.select(
        F.col(doc_id).alias("doc_id"), F.posexplode(pieces(F.col(text))).alias("piece", "p")
    ).select("doc_id", "piece", "p.*")
