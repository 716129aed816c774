"""Packing of tokenized documents into sequences, as a cutting-stock problem solved by column generation.

Documents are tokenized and cut into pieces of few distinct lengths: whole sequences, then a multiple of
``unit`` tokens, then a tail shorter than ``unit``.  The length histogram is therefore of fixed size
whatever the corpus.  A linear program over patterns (how many pieces of each length share a sequence) is
solved by column generation: a knapsack by dynamic programming finds the pattern of best price.  Its
solution is rounded down, the few pieces left over are packed first-fit decreasing, and pieces, ranked
within their length in a distributed way, take the slots of the patterns.

Defined results: a NULL text is an empty one and becomes a single piece, the end id alone.  Repeated rows are packed
each.  An empty table gives no rows.  Columns of ``docs`` other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import numbered, stored, table, texts_of

SEQUENCE, UNIT, END_ID = 4096, 64, 2
#: Word forms whose ids a task remembers; the memory is emptied beyond that.
REMEMBERED = 250_000
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def cuts(tokens: int, sequence: int, unit: int) -> list[int]:
    """Ends of a document's pieces: whole sequences, a multiple of ``unit``, the tail."""
    whole = tokens - tokens % sequence
    ends = list(range(sequence, whole + 1, sequence))
    for end in (tokens - tokens % unit, tokens):
        if end > (ends[-1] if ends else 0):
            ends.append(end)
    return ends


#: Plain words: letters whose lower case and composition don't depend on neighbours, then signs that start no contraction.
PLAIN = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([.,;:!?*#$%&|]*)")
#: The vocabulary writes a byte as a printable character: itself where it is one, else the next from 256 on.
_PRINTED = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
_PRINTED |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}


class WordIds(dict):
    """Ids of a word between ASCII white space, as little-endian bytes.

    The vocabulary's rules never join text across white space, nor letters with the signs after them, so
    words, and the two parts of plain words, are encoded one by one and remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer, self.parts = Tokenizer.from_file(path), {}
        self.merge = self.tokenizer.model.tokenize
        table = np.arange(self.tokenizer.get_vocab_size(), dtype="<u4").tobytes()
        self.bytes_of = [table[k:k + 4] for k in range(0, len(table), 4)]

    def part(self, word: bytes) -> bytes:
        found = self.parts.get(word)
        if found is None:
            if len(self.parts) >= REMEMBERED:
                self.parts.clear()
            form = word.decode() if word.isascii() else word.decode("latin-1").translate(_PRINTED)
            found = self.parts[word] = b"".join([self.bytes_of[t.id] for t in self.merge(form)]) if word else b""
        return found

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        plain = PLAIN.fullmatch(word)
        if plain:
            letters, signs = plain.groups()
            ids = self.part(letters.lower() if letters.isascii() else letters.decode().lower().encode())
            if signs:
                ids += self.part(signs)
        else:
            ids = np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        return ids


def tokenized_pieces(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE, unit: int = UNIT,
                     end_id: int = END_ID) -> DataFrame:
    """One row per piece: document, first token, length, checksum of its ids, tokens of the document."""
    end = np.array([end_id], "<u4").tobytes()

    def cut_batches(batches):
        ids = WordIds(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                data = b"".join(map(ids.__getitem__, (text or b"").split())) + end
                start, tokens = 0, len(data) // 4
                for stop in cuts(tokens, sequence, unit):
                    rows.append((doc_id, start, stop - start, zlib.crc32(memoryview(data)[4 * start:4 * stop]), tokens))
                    start = stop
            columns = list(zip(*rows)) or repeat((), 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(cut_batches, PIECES)


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack: how many pieces of each size give the highest total price within the capacity."""
    value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        value[room], last[room] = value[room - 1], -1
        fits = int(np.searchsorted(sizes, room, "right"))
        if fits:
            offers = value[room - sizes[:fits]] + prices[:fits]
            k = int(offers.argmax())
            if offers[k] > value[room] + 1e-12:
                value[room], last[room] = offers[k], k
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            pattern[last[room]] += 1
            room -= int(sizes[last[room]])
    return pattern


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-4,
                      most_columns: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often the linear program uses each, for sizes in ascending order.

    Revised simplex with one pattern for each size at first.  It ends at the optimum, within ``gap`` of
    the bound tokens / capacity, or after ``most_columns`` pivots; any stage is a feasible solution, the
    pivots only save padding.
    """
    per_size = capacity // sizes
    patterns = np.diag(per_size).astype(float)
    inverse = np.diag(1.0 / per_size)
    use = demand / per_size
    bound = float(sizes @ demand) / capacity
    for _ in range(most_columns):
        if use.sum() <= bound * (1 + gap):
            break
        prices = inverse.sum(axis=0)
        pattern = best_pattern(prices, sizes, capacity)
        if prices @ pattern <= 1 + 1e-7:
            break
        direction = inverse @ pattern
        grows = direction > 1e-9
        ratios = np.full(len(use), np.inf)
        ratios[grows] = use[grows] / direction[grows]
        leave = int(ratios.argmin())
        step = max(ratios[leave], 0.0)
        use = np.maximum(use - step * direction, 0.0)
        use[leave] = step
        row = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, row)
        inverse[leave] = row
        patterns[leave] = pattern
    return patterns.astype(np.int64), use


def slots(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Where the ranked pieces of each length go: rows ``(length, rank0, rank1, per_sequence, sequence0,
    offset0)``.  Ranks rank0 to rank1 - 1 of that length fill sequences from sequence0 on, per_sequence in each."""
    if not len(sizes):
        return []
    patterns, use = column_generation(sizes, demand, capacity)
    left, placed, rows, sequence = demand.copy(), np.zeros(len(sizes), np.int64), [], 0

    def put(pattern: np.ndarray, times: int) -> None:
        nonlocal sequence
        offset = 0
        for k in np.flatnonzero(pattern):
            n = int(pattern[k])
            rows.append((int(sizes[k]), int(placed[k]), int(placed[k]) + n * times, n, sequence, offset))
            placed[k] += n * times
            left[k] -= n * times
            offset += n * int(sizes[k])
        sequence += times

    for pattern, share in sorted(zip(patterns, use), key=lambda x: -x[1]):
        used = pattern > 0
        times = min(int(share + 1e-6), int((left[used] // pattern[used]).min())) if used.any() else 0
        if times:
            put(pattern, times)
    while left.any():  # what rounding down has left: a few pieces for each pattern
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for k in range(len(sizes) - 1, -1, -1):
            pattern[k] = min(left[k], room // sizes[k])
            room -= int(pattern[k] * sizes[k])
        used = pattern > 0
        put(pattern, int((left[used] // pattern[used]).min()))
    return rows


def pack(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``pieces`` (few distinct lengths up to ``sequence``) with ``sequence_id`` and ``offset``."""
    histogram = sorted((r["length"], r["count"]) for r in pieces.groupBy("length").count().collect())
    sizes, demand = (np.array(x, np.int64) for x in (zip(*histogram) if histogram else ((), ())))
    plan = pieces.sparkSession.createDataFrame(
        slots(sizes, demand, sequence),
        "length bigint, rank0 bigint, rank1 bigint, per_sequence bigint, sequence0 bigint, offset0 bigint")
    ranked = numbered(pieces, ["length"], ["doc_id", "start", "ids_crc32", "doc_tokens"], "rank")
    k = F.col("rank") - F.col("rank0")
    # The plan has at most (distinct lengths + leftovers) rows, bounded by sequence and unit alone.
    return (ranked.join(F.broadcast(plan.withColumnRenamed("length", "of")),
                        (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("rank0")) & (F.col("rank") < F.col("rank1")))
            .select(*pieces.columns, (F.col("sequence0") + F.floor(k / F.col("per_sequence"))).alias("sequence_id"),
                    (F.col("offset0") + (k % F.col("per_sequence")) * F.col("length")).alias("offset")))


def pack_documents(docs: DataFrame, vocabulary: str | None = None, sequence: int = SEQUENCE, unit: int = UNIT) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return pack(stored(tokenized_pieces(docs, vocabulary, sequence, unit)), sequence)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
