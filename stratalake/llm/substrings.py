"""Removal of repeated passages by level-wise doubling of the compared window.

The shortest level is sampled: of every ``min_words`` consecutive words, the window of smallest hash is an
anchor, so equal passages have equal anchors.  Anchors that occur once end there.  Windows whose parts of
the level before are all repeated are extended to twice that length, and so on until ``min_words`` is
reached or none survive.  For 35 words the levels are 18 and 35, two windows of 18 that share a word.

Documents are dealt into chunks of bounded size by a hash.  A chunk sends each of its window hashes once, with a
mark if it has it twice, so a passage in a third of all documents adds one row for each chunk; what is
repeated comes back to the chunk.  The chunks are shuffled once and read by every level.

Windows are compared by 64 bits of hash and, at the last level, 31 more.

Defined results: NULL and wordless texts have no words and lose none; texts shorter than ``min_words`` lose none;
equal rows are copies of each other and lose what they share; an empty table gives no rows.  Other columns of
``docs`` are kept, but those named like a result give way to it (and ``_chunk`` goes).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import kinds, table, texts_of

MIN_WORDS, SEED_WORDS = 35, 18
#: Chunks: at least so many, and more so that one holds about so many bytes.
CHUNKS, CHUNK_BYTES = 512, 8_000_000


def levels(min_words: int, seed_words: int = SEED_WORDS) -> list[int]:
    """Window lengths, each at most twice the one before, ending at ``min_words``."""
    out = [min_words]
    while out[0] > seed_words:
        out.insert(0, -(-out[0] // 2))
    return out


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes in order."""
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b + np.uint64(0xD1B54A32D192ED03))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def ahead(a: np.ndarray, k: int, fill=0) -> np.ndarray:
    """``a`` moved k places to the front."""
    if k <= 0:
        return a
    out = np.full_like(a, fill)
    out[:max(0, len(a) - k)] = a[k:]
    return out


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position on: doubled, and joined with a shifted copy at last."""
    have, hashes = 1, words
    while have * 2 <= length:
        hashes, have = mix(hashes, ahead(hashes, have)), have * 2
    return mix(hashes, ahead(hashes, length - have)) if have < length else hashes


def sliding(a: np.ndarray, width: int, pick) -> np.ndarray:
    """Smallest or largest (``pick``) of ``width`` values from each position on; the end is filled by its own values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        a, have = pick(a, np.concatenate([a[step:], a[max(0, len(a) - step):]])[:len(a)]), have + step
    return a


class Chunk:
    """Word hashes of some documents in a row."""

    def __init__(self, texts: list[bytes | None]):
        import xxhash
        words = [(t or b"").split() for t in texts]
        self.counts = np.array([len(w) for w in words], np.int64)
        self.words = words
        self.hashes = np.fromiter((h for w in words for h in map(xxhash.xxh3_64_intdigest, w)), np.uint64, int(self.counts.sum()))
        ends = np.repeat(np.cumsum(self.counts), self.counts)
        self.left = ends - np.arange(len(ends))  # words from here to the document's end

    def anchors(self, length: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Window hashes of the first level, and which of them are the least of some ``min_words`` words."""
        hashes = window_hashes(self.hashes, length)
        width = min_words - length + 1
        least = np.where(self.left >= min_words, sliding(hashes, width, np.minimum), np.uint64(0))
        # The largest of the minima of all windows that hold the position; 0 stands before the text.
        around = sliding(np.concatenate([np.zeros(width - 1, np.uint64), least]), width, np.maximum)[:len(hashes)]
        return hashes, (around == hashes) & (self.left >= length) & (hashes > 0)

    def candidates(self, level: int, lengths: list[int], repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window hashes of a level, and which windows have only repeated parts in the level before."""
        length, before = lengths[level], lengths[level - 1]
        hashes = window_hashes(self.hashes, length)
        fits = self.left >= length
        if level == 1:
            parts, _ = self.anchors(before, lengths[-1])
            width = lengths[-1] - before + 1
            # The anchor of every window of the last length, and so of every shorter window inside one.
            known = np.isin(sliding(parts, width, np.minimum), repeated) & (self.left >= lengths[-1])
            if length < lengths[-1]:
                span = lengths[-1] - length + 1
                known = sliding(np.concatenate([np.zeros(span - 1, bool), known]), span, np.maximum)[:len(known)]
            return hashes, known & fits
        ok = np.isin(window_hashes(self.hashes, before), repeated)
        return hashes, ok & ahead(ok, length - before, False) & fits

    def covered(self, length: int, repeated: np.ndarray) -> np.ndarray:
        """Words that a repeated window of the last level holds."""
        starts = np.isin(window_hashes(self.hashes, length), repeated) & (self.left >= length)
        steps = np.zeros(len(starts) + 1, np.int64)
        at = np.flatnonzero(starts)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + length, -1)
        return np.cumsum(steps[:-1]) > 0


def _sent(chunk_id: int, hashes: np.ndarray, check: np.ndarray | None) -> pa.Table:
    """Each distinct hash once: ``hash``, and ``tag`` of 31 check bits, chunk and the mark for several places."""
    values, first, counts = np.unique(hashes, return_index=True, return_counts=True)
    tag = (np.int64(chunk_id) << 1) | (counts > 1)
    if check is not None:
        tag = tag | (check[first] >> np.uint64(33)).astype(np.int64) << 32
    return pa.table({"hash": values.view(np.int64), "tag": tag.astype(np.int64)})


def _chunk_texts(chunk: pa.Table) -> list[bytes | None]:
    return [t for b in chunk.to_batches() for t in texts_of(b)]


def _repeated(sent: DataFrame) -> DataFrame:
    """``chunk, hash`` of the windows that stand in several chunks, or several times in one."""
    same = Window.partitionBy("hash", F.shiftright("tag", 32))
    several = (F.count(F.lit(1)).over(same) > 1) | (F.max(F.col("tag").bitwiseAND(F.lit(1))).over(same) == 1)
    return (sent.withColumn("_several", several).filter("_several")
            .select(F.shiftright(F.col("tag").bitwiseAND(F.lit(0xFFFFFFFF)), 1).cast("int").alias("_chunk"), "hash"))


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, seed_words: int = SEED_WORDS, chunks: int | None = None,
                   keep_text: bool = False) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept`` (what is left, joined by single spaces); the text goes, unless asked for."""
    docs = docs.drop("n_words", "n_removed", "kept", "_chunk")
    lengths = levels(min_words, seed_words)
    if chunks is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        chunks = max(CHUNKS, size // CHUNK_BYTES)
    others = [c for c in docs.columns if c != "text" or keep_text]
    dealt = docs.withColumn("_chunk", F.pmod(F.xxhash64(*docs.columns), F.lit(chunks)).cast("int"))
    sent_kind, last = "hash bigint, tag bigint", len(lengths) - 1

    def first_level(key, chunk):
        c = Chunk(_chunk_texts(chunk))
        hashes, flags = c.anchors(lengths[0], min_words)
        return _sent(key[0].as_py(), hashes[flags], None)

    def next_level(level: int):
        def run(key, chunk, repeated):
            if not chunk.num_rows or not repeated.num_rows:
                return pa.table({"hash": pa.array([], pa.int64()), "tag": pa.array([], pa.int64())})
            c = Chunk(_chunk_texts(chunk))
            hashes, flags = c.candidates(level, lengths, _hashes(repeated))
            check = window_hashes(c.hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5), lengths[level])[flags] if level == last else None
            return _sent(key[0].as_py(), hashes[flags], check)
        return run

    def clean(key, chunk, repeated):
        c = Chunk(_chunk_texts(chunk))
        gone = c.covered(min_words, _hashes(repeated)) if repeated.num_rows else np.zeros(len(c.hashes), bool)
        kept, removed, start = [], [], 0
        for words, n in zip(c.words, c.counts.tolist()):
            g = gone[start:start + n]
            removed.append(int(g.sum()))
            kept.append(b" ".join(words if not removed[-1] else [w for w, x in zip(words, g.tolist()) if not x]))
            start += n
        out = {n: chunk.column(n) for n in others} | {"n_words": pa.array(c.counts), "n_removed": pa.array(removed, pa.int64()),
                                                "kept": pa.array(kept, pa.binary()).cast(pa.string())}
        return pa.table(out)

    sent = dealt.groupBy("_chunk").applyInArrow(first_level, sent_kind)
    for level in range(1, len(lengths)):
        sent = dealt.groupBy("_chunk").cogroup(_repeated(sent).groupBy("_chunk")).applyInArrow(next_level(level), sent_kind)
    return dealt.groupBy("_chunk").cogroup(_repeated(sent).groupBy("_chunk")).applyInArrow(
        clean, kinds(docs, others) + ", n_words bigint, n_removed bigint, kept string")


def _hashes(repeated: pa.Table) -> np.ndarray:
    return np.sort(repeated.column("hash").to_numpy().view(np.uint64))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = {"op7_substrings": r"""
with words as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (select r, k, array_to_string(list_slice(w, k, k + 34), ' ') as phrase from (select r, w, unnest(range(1, len(w) - 33)) as k from words)),
again as (select r, k from (select r, k, count(*) over (partition by phrase) as n from starts) where n > 1),
gone as (select r, list(distinct k + j) as p, count(distinct k + j) as n from (select r, k, unnest(range(0, 35)) as j from again) group by r),
left_over as (
  select w.r, string_agg(w.word, ' ' order by w.k) as kept from (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as k from words) w
  left join (select r, unnest(p) as k from gone) g on g.r = w.r and g.k = w.k where g.k is null group by w.r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(g.n, 0) as bigint) as n_removed, sha256(coalesce(l.kept, '')) as kept_sha256
from words d left join gone g on g.r = d.r left join left_over l on l.r = d.r
"""}
