"""Byte-level BPE with a vocabulary file: texts to token ids and back.

A text is cut at the vocabulary's special tokens, then into words by the byte-level rule, and every word is merged
by itself.  A short word is a contiguous array of parts with the rank of each part's merge with the next: the
smallest rank is looked for, that boundary deleted, the two neighbouring ranks refreshed, until no merge is left.  Looking
through the array again and again is the fastest way for a handful of parts but quadratic, so words of more than
``LONG_WORD`` bytes do the same merges in the same order from a heap over a linked list.

Words recur, so a task remembers the ids of up to ``REMEMBERED`` words; it shuffles nothing and holds one batch.

Defined results: a NULL text is an empty one and has no ids; a NULL id stays NULL; repeated rows are encoded each; an empty table
gives no rows.  Columns other than ``doc_id`` and ``text`` are ignored.  Bytes that ids don't make valid UTF-8 are
decoded as replacement characters.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import table, texts_of

LONG_WORD, REMEMBERED, ROWS = 256, 250_000, 512
ID_BITS = 32
ID_MASK, NO_MERGE = (1 << ID_BITS) - 1, 1 << 62
#: The byte-level rule's words (a fixed value of these vocabularies).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def printed_bytes() -> dict[str, int]:
    """The character by which the vocabulary writes each byte: itself where it is printable, else the next from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


#: Letters of old blocks, classed alike by all Unicode versions.
COMMON = re.compile("[^\x00-\u024f]")


def newer(text: str) -> bool:
    """Whether a character has no class in Python's own tables: Unicode versions may class it differently."""
    return COMMON.search(text) is not None and any(unicodedata.category(c) == "Cn" for c in set(text))


class Vocabulary:
    """Ranks of the merges, and the bytes of every id."""

    def __init__(self, source: str):
        """``source``: the content of a tokenizers file with a byte-level BPE model."""
        import regex
        from tokenizers import pre_tokenizers
        given = json.loads(source)
        model, before = given["model"], given["pre_tokenizer"] or {}
        added = given.get("added_tokens") or []
        if (model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True)
                or given["normalizer"] or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges")
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)):
            raise ValueError("only plain byte-level BPE vocabularies are read")
        byte_of, ids = printed_bytes(), model["vocab"]
        self.bytes_of = {k: bytes(map(byte_of.__getitem__, token)) for token, k in ids.items()}
        self.bytes_of |= {t["id"]: t["content"].encode() for t in added}
        self.id_of_byte = [ids[c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        #: (id, id) -> rank and id of the merge, in one number.
        self.merges = {(ids[a], ids[b]): rank << ID_BITS | ids[a + b] for rank, (a, b) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in added}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.words_of = regex.compile(WORDS).findall
        self.slow_words = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str

    def words(self, text: str) -> list[str]:
        """Words of a text without special tokens; characters of newer Unicode versions are classed by the library."""
        if text.isascii() or not newer(text):
            return self.words_of(text)
        byte_of = printed_bytes()
        return [bytes(map(byte_of.__getitem__, w)).decode() for w, _ in self.slow_words(text)]

    def merge(self, word: bytes) -> list[int]:
        parts = [self.id_of_byte[b] for b in word]
        return self.merge_long(parts) if len(parts) > LONG_WORD else self.merge_short(parts)

    def merge_short(self, parts: list[int]) -> list[int]:
        find = self.merges.get
        ranks = [find(pair, NO_MERGE) for pair in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < NO_MERGE:
            at = ranks.index(best)
            parts[at:at + 2] = [best & ID_MASK]
            del ranks[at]
            if at:
                ranks[at - 1] = find((parts[at - 1], parts[at]), NO_MERGE)
            if at < len(ranks):
                ranks[at] = find((parts[at], parts[at + 1]), NO_MERGE)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        find, end = self.merges.get, len(parts)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [(merge, k) for k, pair in enumerate(zip(parts, parts[1:])) if (merge := find(pair))]
        heapq.heapify(heap)
        while heap:
            merge, k = heapq.heappop(heap)
            nxt = after[k]
            if parts[k] < 0 or nxt >= end or find((parts[k], parts[nxt])) != merge:
                continue  # an older entry: one of its parts has been merged since
            parts[k], parts[nxt], after[k] = merge & ID_MASK, -1, after[nxt]
            if after[k] < end:
                before[after[k]] = k
                if merge := find((parts[k], parts[after[k]])):
                    heapq.heappush(heap, (merge, k))
            if before[k] >= 0 and (merge := find((parts[before[k]], parts[k]))):
                heapq.heappush(heap, (merge, before[k]))
        return [p for p in parts if p >= 0]


class WordIds(dict):
    """Ids of a word as little-endian 32-bit bytes, remembered."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> bytes:
        found = np.array(self.vocabulary.merge(word.encode()), "<u4").tobytes()
        if len(word) <= LONG_WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found

    def encode(self, text: str) -> bytes:
        v = self.vocabulary
        if v.split_added is None or not v.split_added.search(text):
            return b"".join(map(self.__getitem__, v.words(text)))
        return b"".join(np.array([v.added[part]], "<u4").tobytes() if k % 2 else b"".join(map(self.__getitem__, v.words(part)))
                        for k, part in enumerate(v.split_added.split(text)))


def _encode(source, batches):
    ids = WordIds(Vocabulary(source.value))
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            rows = batch.slice(k, ROWS)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array([ids.encode((t or b"").decode()) for t in texts_of(rows)], pa.binary())],
                                             names=["doc_id", "ids"])


def _decode(source, batches):
    bytes_of = Vocabulary(source.value).bytes_of
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            rows = batch.slice(k, ROWS)
            texts = [b"".join(map(bytes_of.__getitem__, np.frombuffer(x or b"", "<u4").tolist())).decode("utf-8", "replace")
                     for x in rows.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("ids"), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])


def _source(spark: SparkSession, vocabulary: str | None):
    """The vocabulary file's content, sent to each executor once.  It is read on the driver, and its size doesn't grow with the data."""
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    with open(vocabulary, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids``: the text's token ids as little-endian unsigned 32-bit integers."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(partial(_encode, _source(docs.sparkSession, vocabulary)), f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id``, ``ids`` and ``text``, special tokens included; NULL ids are none."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(partial(_decode, _source(encoded.sparkSession, vocabulary)), f"doc_id {kind}, ids binary, text string")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(encode(table(spark, sf_dir, "documents"))).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
