"""Spelling variants: words one edit apart, and the frequent form that each rare word stands for.

Pairs are joined by asymmetric q-chunks.  The shorter word (either, of two as long) contributes two disjoint chunks, its
halves; the other contributes the positional grams a half may lie at: as long as the half, and shifted by at most one,
which the difference of lengths tells.  One edit touches one half only, so the other half is a gram of the other word.

A half that many words share would make all their pairs.  Words are joined by longer keys instead: with the shared half
taken away, the rests are one edit apart too and are chunked again.  A key so keeps all of a word but a hole, first a quarter, that
shrinks to a character, and no key holds more than ``KEY_PAIRS`` possible pairs before pairs are formed.  A pair is formed at the
first of its keys only, so none is formed twice, and verified by edit distance.

Each word's nearest frequent word is its form, and roots follow forms by pointer doubling: occurrences grow tenfold
with every step, so a few rounds suffice.

Defined results: a NULL text has no words; a NULL ``doc_id`` is the empty text in the hash that makes slips.  Repeated rows
count each.  No words of two occurrences, or an empty table, give no rows.  Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import stored, table, texts_of
from stratalake.operators.joins import sized_join

SHORTEST, LEAST_COUNT, FORM_TIMES = 7, 2, 10
#: A document's run of letters slips if this divides its hash.
SLIP_EVERY = 31
#: Possible pairs of a key; beyond that its words get longer keys.
KEY_PAIRS = 2_000
#: Bytes of a key in the list of those with more, about.
HOT_BYTES = 100
#: Distinct words that a task counts before it hands the counts on.
HELD_WORDS, ROWS = 200_000, 512
LETTERS = r"[A-Za-zÀ-ÿ]"
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def slipped(doc_id: str, run: str, every: int) -> str:
    """The run, or for a hash that ``every`` divides the run without one letter."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _words(shortest: int, every: int, batches):
    runs_of = re.compile(f"{LETTERS}{{{shortest},}}").findall  # a shorter run cannot become a word
    held: Counter = Counter()

    def handed():
        out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
        for doc_id, text in zip(batch.column("id").to_pylist(), texts_of(batch)):
            for run, n in Counter(runs_of((text or b"").translate(_FOLDED).decode())).items():
                word = slipped(doc_id, run, every)
                if len(word) >= shortest:
                    held[word] += n
            if len(held) >= HELD_WORDS:
                yield handed()
    if held:
        yield handed()


def words(docs: DataFrame, shortest: int = SHORTEST, least_count: int = LEAST_COUNT, slip_every: int = SLIP_EVERY) -> DataFrame:
    """``word, n``: runs of at least ``shortest`` letters that occur ``least_count`` times, slips made."""
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")
    counted = docs.select(ids, "text").mapInArrow(partial(_words, shortest, slip_every), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _grown(rows: DataFrame, level: int) -> DataFrame:
    """Every row twice, its key with one more chunk and the rest without it.

    ``of`` is the length of the rest of the word that contributes chunks; the row's own ``rest`` is as long, or longer by one.
    The first chunk is the first half, and the last the second half, at a shift of that difference.  Side and length
    of the chunk are part of the key, so that only chunks of the same place meet.  Rows of the last chunk also note the
    first in ``skipped``: words that share it as well meet there already.
    """
    rows = rows.withColumns({"half": F.floor(F.col("of") / 2).cast("int"), "longer": F.length("rest") - F.col("of")})
    first, last = F.expr("substring(rest, 1, half)"), F.expr("substring(rest, half + 1 + longer)")
    key = lambda side, gram: F.concat("key", F.lit(side), F.col("of").cast("string"), F.lit(":"), gram).alias("key")
    grown = F.array(
        F.struct(key("<", first), F.expr("substring(rest, half + 1)").alias("rest"), (F.col("of") - F.col("half")).alias("of"), F.col("skipped")),
        F.struct(key(">", last), F.expr("substring(rest, 1, half + longer)").alias("rest"), F.col("half").alias("of"),
                 F.concat("skipped", F.array(F.concat(F.lit(f"{level}:"), first))).alias("skipped")))
    return rows.withColumn("grown", F.explode(grown)).select("word", "n", "chunks", "grown.*")


def near_pairs(vocabulary: DataFrame, key_pairs: int = KEY_PAIRS) -> DataFrame:
    """``a, na, b, nb``: each pair of words one insertion, deletion or replacement apart, once."""
    role = lambda chunks, of: F.struct(F.lit(chunks).alias("chunks"), of.alias("of"))
    long = F.length("word")
    rows = (vocabulary.withColumn("role", F.explode(F.array(role(True, long), role(False, long), role(False, long - 1))))
            .select("word", "n", "role.*", F.lit("").alias("key"), F.col("word").alias("rest"), F.lit(None).cast("array<string>").alias("skipped"))
            .withColumn("skipped", F.coalesce("skipped", F.array().cast("array<string>"))))
    rows, level, found = _grown(rows, 0), 1, []
    while True:
        # Half a word is shared by too many others: the first keys hold two chunks already.
        rows, level = stored(_grown(rows, level)), level + 1
        sizes = rows.groupBy("key").agg(F.count_if("chunks").alias("nc"), F.count_if(~F.col("chunks")).alias("ng"), F.max("of").alias("left"))
        # A hole of one character cannot shrink; the words that share all but that are few by themselves.
        hot = stored(sizes.filter((F.col("nc") * F.col("ng") > key_pairs) & (F.col("left") > 1)).select("key", F.lit(True).alias("hot")))
        n_hot = hot.count()
        marked = sized_join(rows, hot, ["key"], n_hot * HOT_BYTES, "left") if n_hot else rows.withColumn("hot", F.lit(None).cast("boolean"))
        cold = marked.filter("hot is null")
        chunk = cold.filter("chunks").select("key", F.col("word").alias("a"), F.col("n").alias("na"), F.col("rest").alias("ra"), F.col("skipped").alias("sa"))
        gram = cold.filter(~F.col("chunks")).select("key", F.col("word").alias("b"), F.col("n").alias("nb"), F.col("rest").alias("rb"), F.col("skipped").alias("sb"))
        # Of two words as long, each contributes both; the smaller one's chunks count.
        once = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
        near = (F.levenshtein("ra", "rb", 1) == 1) & ~F.arrays_overlap("sa", "sb")
        found.append(stored(chunk.join(gram, "key").filter(once & near).select("a", "na", "b", "nb")))
        if not n_hot:
            return reduce(DataFrame.unionByName, found)
        rows = marked.filter("hot").drop("hot")


def variants(vocabulary: DataFrame, form_times: int = FORM_TIMES, key_pairs: int = KEY_PAIRS) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word."""
    pairs = near_pairs(vocabulary, key_pairs)
    both = pairs.select(F.inline(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")),
                                         F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n")))))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    formed = vocabulary.join(best, "word", "left").withColumn("form_n", F.when(-F.col("best.less") >= F.col("n") * form_times, -F.col("best.less")))
    formed = stored(formed.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                                  F.when(F.col("form_n").isNotNull(), F.col("best.near")).alias("form"), "form_n"))
    links = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return formed.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = stored(words(table(spark, sf_dir, "documents")))
    return variants(vocabulary).select("word", "form", "root", "n", "n_near", "form_n")
