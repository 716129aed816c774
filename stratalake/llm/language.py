"""Language identification by compression: the dictionary that shortens a text most names its language.

A raw-content dictionary is taken from learning texts of each language.  A text is compressed in blocks
under every dictionary, in lower case; the smallest total wins.  Blocks keep long texts from teaching the compressor
their own language, so the dictionaries decide however long the text is.

Defined results: NULL, empty and letterless texts are ``und`` with score 0.  With nothing to learn from,
every text is ``und``.  Equal sizes go to the language first in order.  Repeated rows are predicted each.
Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import held_out, table, texts_of

UNDETERMINED = "und"
#: Learning texts for each language, at most: so many documents, so many bytes in all.
LEARN_DOCS, DICTIONARY_BYTES = 1_000, 500_000
BLOCK_BYTES, LEVEL = 4_096, 6
#: A best language less than this share smaller than the second is no verdict.
LEAST_MARGIN = 0.01


def dictionaries(docs: DataFrame, docs_each: int = LEARN_DOCS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Raw dictionary content by language, from the documents of smallest hash that aren't held out.

    The sample is bounded by the parameters for each language: texts are taken whole, equal ones once, until it is
    full; only the text that fills it is cut.  A language's hashes are even, so its number of texts gives a bound on the
    hash under which twice as many fall as are wanted; only those are ranked, however large the language.
    """
    part = F.encode(F.lower("text"), "utf-8")
    known = (docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
             .select("doc_id", "lang", part.alias("part")).withColumn("digest", F.md5("part")))
    ranked = Window.partitionBy("lang").orderBy("first.h", "first.doc_id", "digest")
    texts = known.groupBy("lang", "digest").agg(F.min(F.struct(F.xxhash64("doc_id", "digest").alias("h"), "doc_id")).alias("first"),
                                                F.max(F.octet_length("part")).alias("bytes"))
    # A row for each language: the share of its hashes that holds the sample.
    shares = texts.groupBy("lang").agg((F.lit(2.0 * docs_each + 100) / F.count(F.lit(1))).alias("share"))
    low = (F.col("first.h") / F.lit(2.0 ** 64) + 0.5) < F.col("share")
    chosen = (texts.join(F.broadcast(shares), "lang").filter(low)
              .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= docs_each)
              .withColumn("start", F.sum(F.col("bytes") + 1).over(ranked) - F.col("bytes") - 1).filter(F.col("start") < size)
              .select("lang", "digest", F.col("first.doc_id").alias("chosen_id"), "rank", "start"))
    texts = (known.join(F.broadcast(chosen), ["lang", "digest"]).filter(F.col("doc_id").eqNullSafe(F.col("chosen_id")))
             .select("lang", "rank", F.expr(f"substring(part, 1, int({size} - start))").alias("part")).dropDuplicates(["lang", "rank"])
             .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "part"))).alias("parts")))
    return {r["lang"]: b"\n".join(bytes(p["part"]) for p in r["parts"]) for r in texts.orderBy("lang").collect()}


def identify(docs: DataFrame, content: dict[str, bytes], block: int = BLOCK_BYTES, level: int = LEVEL,
             least_margin: float = LEAST_MARGIN) -> DataFrame:
    """``doc_id``, ``best`` language, ``score`` (share of the second best size saved, scaled to 0 to 1) and
    ``lang``, which is ``und`` where the margin is too narrow."""

    def predict(batches):
        import zstandard
        compressors = {}
        for lang, raw in sorted(content.items()):
            dictionary = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=level)
            compressors[lang] = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=False,
                                                         write_checksum=False, write_dict_id=False).compress
        for batch in batches:
            best, scores, langs = [], [], []
            for text in texts_of(batch):
                sizes = []
                text = (text or b"").decode().lower()
                if compressors and any(map(str.isalpha, text)):
                    text = text.encode()
                    parts = [text[k:k + block] for k in range(0, len(text), block)]
                    sizes = sorted((sum(len(f(p)) for p in parts), lang) for lang, f in compressors.items())
                margin = 0.0 if not sizes else 1.0 if len(sizes) == 1 else (sizes[1][0] - sizes[0][0]) / sizes[1][0]
                best.append(sizes[0][1] if sizes else UNDETERMINED)
                scores.append(min(1.0, margin * 4))
                langs.append(best[-1] if margin >= least_margin else UNDETERMINED)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(best, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array(langs, pa.string())], names=["doc_id", "best", "score", "lang"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(predict, f"doc_id {kind}, best string, score double, lang string")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, dictionaries(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("best").alias("lang_pred"), "score",
                        (F.col("lang") == F.col("best")).alias("clear_margin"))
