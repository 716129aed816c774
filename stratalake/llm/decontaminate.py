"""Benchmark decontamination: an FM-index of each shard of training texts answers which test phrases occur where.

A shard is a bounded run of documents within a task.  Words of the benchmark get numbers; a training word
that no neighbouring pair of the benchmark explains cannot take part in an occurrence, so it only ends a
run.  The runs left are one text over a small alphabet: suffix array, Burrows-Wheeler transform, wavelet
tree for ranks, and sampled suffix positions.  All phrases are searched backwards together, ranges of
equal suffixes are located by walking to the next sample, and the spans found are merged per document.

The benchmark is read in blocks of bounded size, each one pass over the documents that adds to the spans
of the pass before, so nothing that grows is broadcast and no row is shuffled.

Defined results: NULL and wordless texts have no words, no hits and aren't contaminated; benchmark items
without words are ignored; items with a NULL id hit words but aren't named.  Repeated documents get a row
each, repeated items count once.  An empty benchmark hits nothing.  Other columns of ``docs`` are kept,
but those named like a result give way to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import kinds, stored, table, texts_of

WINDOW = 13
#: Words of a shard's index at most, unless one document is longer; bytes of benchmark text in a block.
SHARD_WORDS, BLOCK_BYTES, SAMPLE_EVERY = 400_000, 4_000_000, 16
#: Passes over the documents between two written tables.
PASSES = 8
#: A word is a run of bytes other than 00-2F, 3A-60 and 7B-7F, after lower-casing A-Z.
_FOLD = bytes(32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F
              else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes, by doubling the compared length until all differ."""
    rank, width = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while True:
        following = np.full(len(rank), 0, np.int64)
        following[:-width] = rank[width:] + 1
        key = rank * (len(rank) + 1) + following
        order = np.argsort(key, kind="stable")
        new = np.empty(len(rank), np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank, width = new, width * 2
        if rank[order[-1]] == len(rank) - 1 or width >= len(rank):
            return order


class WaveletTree:
    """Ranks in a sequence of numbers below ``2 ** bits``: one bit row for each binary digit, highest first."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for digit in range(bits - 1, -1, -1):
            bit = (values >> digit) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(int(len(bit) - bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbol: np.ndarray, until: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before the position beside it."""
        begin, end = np.zeros_like(until), until.copy()
        for level in range(self.bits):
            one = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            row, zeros = self.ones[level], self.zeros[level]
            begin = np.where(one, zeros + row[begin], begin - row[begin])
            end = np.where(one, zeros + row[end], end - row[end])
        return end - begin

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol, at = np.zeros_like(at), at.copy()
        for level in range(self.bits):
            row, zeros = self.ones[level], self.zeros[level]
            one = row[at + 1] - row[at]
            at = np.where(one == 1, zeros + row[at], at - row[at])
            symbol = symbol * 2 + one
        return symbol


class FMIndex:
    """Backward search over a text of numbers from 1 up; 0 ends it."""

    def __init__(self, text: np.ndarray, alphabet: int, sample_every: int = SAMPLE_EVERY):
        text = np.append(text, 0)
        suffixes = suffix_array(text)
        last = text[suffixes - 1]
        self.size = len(text)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        self.tree = WaveletTree(last, max(1, int(alphabet - 1).bit_length()))
        marked = suffixes % sample_every == 0
        self.marks = np.concatenate([[0], np.cumsum(marked)])
        self.samples = suffixes[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that start with each phrase.  Row i of ``phrases`` holds ``lengths[i]`` numbers, right-aligned."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for step in range(phrases.shape[1]):
            live = np.flatnonzero((step < lengths) & (low < high))
            symbol = phrases[live, phrases.shape[1] - 1 - step]
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes given by their rank: walk back to a sampled one."""
        found, rows, steps, open_ = np.zeros(len(rows), np.int64), rows.copy(), 0, np.arange(len(rows))
        while len(open_):
            sampled = self.marks[rows + 1] > self.marks[rows]
            found[open_[sampled]] = self.samples[self.marks[rows[sampled]]] + steps
            open_, rows = open_[~sampled], rows[~sampled]
            symbol = self.tree.access(rows)
            rows = self.before[symbol] + self.tree.rank(symbol, rows)
            steps += 1
        return found


class Phrases:
    """Windows of a block of benchmark items, as numbers of their words, each distinct one once."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 2) for w in words_of(text)]
            for k in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[k:k + window]), set()).update([] if item is None else [item])
        self.owners = list(owners.values())
        self.lengths = np.array([len(k) for k in owners], np.int64)
        self.table = np.zeros((len(owners), window), np.int64)
        for i, k in enumerate(owners):
            self.table[i, window - len(k):] = k
        self.alphabet = len(self.numbers) + 2
        left, right = self.table[:, :-1].ravel(), self.table[:, 1:].ravel()
        self.pairs = np.unique((left * self.alphabet + right)[left > 0])
        self.single = np.zeros(self.alphabet, bool)  # items of one word need no neighbour
        self.single[self.table[self.lengths == 1, -1]] = True


def hits(texts: list[list[bytes]], phrases: Phrases) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """Word spans found in each text, and the items they come from; one index for all these texts."""
    counts = [len(t) for t in texts]
    total = sum(counts)
    get = phrases.numbers.get
    numbers = np.fromiter((get(w, 0) for t in texts for w in t), np.int64, total)
    start = np.zeros(total + 1, bool)
    start[np.cumsum([0, *counts])] = True
    pair = numbers[:-1] * phrases.alphabet + numbers[1:]
    known = np.zeros(total + 1, bool)  # known[i]: words i - 1 and i may stand in one occurrence
    if total > 1 and len(phrases.pairs):
        at = np.minimum(np.searchsorted(phrases.pairs, pair), len(phrases.pairs) - 1)
        known[1:total] = (phrases.pairs[at] == pair) & ~start[1:total]
    kept = np.flatnonzero(known[:-1] | known[1:] | phrases.single[numbers])
    out: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in texts]
    if not len(kept):
        return out
    # 1 stands between two runs; origin tells where a word of the indexed text comes from.
    cut = np.flatnonzero(~known[kept])
    text, origin = np.insert(numbers[kept], cut, 1), np.insert(kept, cut, -1)
    index = FMIndex(text, phrases.alphabet)
    low, high = index.search(phrases.table, phrases.lengths)
    phrase = np.repeat(np.arange(len(low)), high - low)
    rows = np.arange(len(phrase)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + np.repeat(low, high - low)
    first = origin[index.locate(rows)]
    ends = np.cumsum(counts)
    owner = np.searchsorted(ends, first, "right")
    for p, d, f in zip(phrase.tolist(), owner.tolist(), first.tolist()):
        begin = f - int(ends[d]) + counts[d]
        out[d][0].append((begin, begin + int(phrases.lengths[p])))
        out[d][1].update(phrases.owners[p])
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _search_pass(docs: DataFrame, items: list[tuple[str | None, bytes]], window: int, first: bool, keep: list[str]) -> DataFrame:
    spans_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        phrases = Phrases(items, window)
        for batch in batches:
            found, counts, shard, size = [], [], [], 0
            for text in texts_of(batch):
                words = words_of(text)
                if shard and size + len(words) > SHARD_WORDS:
                    found += hits(shard, phrases)
                    shard, size = [], 0
                shard.append(words)
                counts.append(len(words))
                size += len(words)
            found += hits(shard, phrases)
            if not first:
                earlier = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
                found = [(s + [(x["begin"], x["end"]) for x in s0], i.union(i0)) for (s, i), (s0, i0) in zip(found, earlier)]
            spans = [[{"begin": b, "end": e} for b, e in merged(s)] for s, _ in found]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(counts, pa.int64()), pa.array(spans, spans_type),
                 pa.array([sorted(i) for _, i in found], pa.list_(pa.string()))], names=[*keep, "n_words", "spans", "items"])

    return docs.mapInArrow(run, f"{kinds(docs, keep)}, n_words bigint, spans array<struct<begin:bigint,end:bigint>>, items array<string>")


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (merged word ranges hit) and ``items`` (names of the items, as strings).

    The text goes, unless asked for.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.encode("text", "utf-8").alias("text")).filter(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    others = [c for c in docs.columns if c not in ("text", "n_words", "spans", "items")]
    out = docs.select(*others, "text")
    for b in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).distinct().collect()
        out = _search_pass(out, [(r["item"], bytes(r["text"])) for r in block], window, b == 0,
                           [*others, "text"] if keep_text or b + 1 < blocks else others)
        if b % PASSES == PASSES - 1 and b + 1 < blocks:
            out = stored(out)
    return out


def verdicts(found: DataFrame) -> DataFrame:
    """Adds ``n_hit`` and ``contaminated`` (a twentieth of the words or more is hit)."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["begin"])
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = verdicts(benchmark_hits(docs, table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


SQL = {"op5_decontaminate": r"""
with item_words as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where text is not null),
windows as (
  select distinct item_id, case when len(w) < 13 then len(w) else 13 end as n, array_to_string(list_slice(w, k, k + 12), ' ') as phrase
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as k from item_words where len(w) > 0)),
doc_words as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
starts as (
  select r, n, k, array_to_string(list_slice(w, k, k + n - 1), ' ') as phrase
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as k from doc_words cross join (select distinct n from windows))),
found as (select s.r, s.k, s.n, x.item_id from starts s join windows x on x.n = s.n and x.phrase = s.phrase),
hit as (select r, count(distinct k + j) as n_hit from (select distinct r, k, n, unnest(range(0, n)) as j from found) group by r),
items as (select r, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as names
          from found group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(h.n_hit, 0) as bigint) as n_hit,
       cast(coalesce(i.n_items, 0) as bigint) as n_items, sha256(coalesce(i.names, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 and 20 * coalesce(h.n_hit, 0) >= len(d.w) as contaminated
from doc_words d left join hit h on h.r = d.r left join items i on i.r = d.r
"""}
